"""Sources, sinks, shaping and chunking on small fixtures."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.text import html_text, html_title, mask, redact, sentences, truncate
from gleaner.operators import chunking, shaping
from gleaner.operators.ordinal import with_ordinal
from gleaner.plans.documents import REVIEW_SCHEMA
from gleaner.sources import readers, writers


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize(("value", "expected"), [("", ""), ("12345678", "********"), ("123456789", "1234*6789")])
def test_mask(spark, value, expected):
    assert one(spark, mask, value) == expected


def test_truncate_and_redact(spark):
    assert one(spark, lambda c: truncate(c, 3), "abcd") == "abc..." and one(spark, lambda c: truncate(c, 4), "abcd") == "abcd"
    text = "mail a.b@c.org or see https://x.y/z, 10.0.0.1"
    assert one(spark, redact, text) == "mail <EMAIL> or see <URL> <IP>"
    assert one(spark, lambda c: redact(c, ["EMAIL"], keep_type=False), "a@b.io") == "***"


def test_html(spark):
    page = "<html><head><title> A &amp;lt; B\n</title><style>p{}</style></head><script>var t='</p>';</script><!-- x --><p>Hi&nbsp;<b>you</b></p></html>"
    assert one(spark, html_title, page) == "A &lt; B"
    assert one(spark, html_text, page) == "Hi you"


def test_sentences(spark):
    assert one(spark, sentences, "One. Two?\nThree v1.5! ") == ["One.", "Two?", "Three v1.5!"]


def docs_of(spark, *metas):
    return spark.createDataFrame([(i, m) for i, m in enumerate(metas)], "n int, metadata map<string,string>")


def standard(spark, meta, loader=None):
    return shaping.standardise_metadata(docs_of(spark, meta), loader, "n").first().metadata


def test_extension_is_used_only_without_a_loader(spark):
    assert standard(spark, {"file_path": "a/B.PDF"})["document_type"] == "pdf"
    assert "document_type" not in standard(spark, {"file_path": "a/b.pdf"}, "TextLoader")
    assert standard(spark, {"file_path": "a/b.pdf"}, "WebBaseLoader")["document_type"] == "web_page"


def test_source_order_and_chunk_id(spark):
    found = standard(spark, {"url": "u", "entry_id": "e"})
    assert found["source"] == "u" and found["chunk_id"] == "0"
    assert standard(spark, {"source": "s", "file_path": "f", "chunk_id": "9"})["chunk_id"] == "9"


def test_arxiv_overrides_and_pubmed_does_not(spark):
    arxiv = standard(spark, {"title": "old", "Title": "new", "entry_id": "http://arxiv.org/abs/1.2"}, "arxiv")
    assert arxiv["title"] == "new" and arxiv["arxiv_id"] == "1.2" and arxiv["url"] == "http://arxiv.org/abs/1.2"
    pubmed = standard(spark, {"title": "old", "article_title": "new", "pmid": "7"}, "PubMed")
    assert pubmed["title"] == "old" and pubmed["url"] == "https://pubmed.ncbi.nlm.nih.gov/7/" and pubmed["entry_id"] == "7"


def test_time_stamp_rule(spark):
    rows = shaping.stamp_loaded(docs_of(spark, {"source": "s"}, {"a": "b"}, {"source": "s", "load_timestamp": "old"}), F.lit("now"))
    assert [r.metadata.get("load_timestamp") for r in rows.orderBy("n").collect()] == ["now", None, "old"]


def test_hit_scores_and_ids(spark):
    raw = [
        (1, "r", 0, "text", {"id": "a", "similarity": "0.7", "score": "0.9", "k": "v"}),
        (1, "r", 1, "text", {"retriever": "own"}), (1, "r", 2, None, {}), (1, "r", 9, "cut", {}),
    ]
    frame = spark.createDataFrame(raw, "query_id long, retriever_type string, position int, page_content string, metadata map<string,string>")
    rows = shaping.shape_hits(frame, top_k=5).orderBy("rank").collect()
    assert [round(r.score, 6) for r in rows] == [0.9, 0.95, 0.7]
    assert rows[1].metadata == {"retriever": "own"}
    assert rows[0].metadata == {"id": "a", "k": "v", "retriever": "r"} and rows[0].doc_id == "a" and rows[2].doc_id == "doc_2"


def test_missing_counterpart_fails(spark):
    responses = spark.createDataFrame([("q1", ["c"], "r")], "question_id string, retrieved_contexts array<string>, response string")
    golden = spark.createDataFrame([("q2", "u", "ref")], "question_id string, user_input string, reference string")
    with pytest.raises(Exception, match="no counterpart"):
        shaping.join_responses(responses, golden).collect()


def test_field_paths():
    from pyspark.sql import types as T

    schema = T._parse_datatype_string("id string, summary_embedding array<double>, p struct<items:array<struct<embedding_x:int>>>")
    assert shaping.field_paths(schema) == ["summary_embedding", "p.items[0].embedding_x"]


def test_ordinals_are_dense_and_ordered(spark):
    frame = spark.createDataFrame([(i * 7 % 101, i) for i in range(101)], "k int, v int").repartition(6)
    rows = with_ordinal(frame, ["k"]).orderBy("ordinal").collect()
    assert [r.ordinal for r in rows] == list(range(101)) and [r.k for r in rows] == sorted(r.k for r in rows)


def test_recursive_chunks_cover_the_text(spark):
    text = "\n\n".join(" ".join(f"word{i}-{j}" for j in range(30)) for i in range(5)) + "\n\n" + "x" * 250
    chunks = chunking.split_recursive(text, 100, 20, chunking.SEPARATORS)
    assert all(len(c) <= 100 for c in chunks)
    joined = " ".join(chunks)
    assert all(word in joined for word in text.split() if len(word) < 100)
    rows = chunking.recursive_chunks(spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id int, text string"), 100, 20)
    assert [r.chunk_text for r in rows.orderBy("chunk_id").collect()] == chunks


def test_recursive_overlap_and_merge():
    assert chunking.split_recursive("aa bb cc dd", 5, 2, [" ", ""]) == ["aa bb", "bb cc", "cc dd"]
    assert chunking.split_recursive("abcdefgh", 3, 1, [""]) == ["abc", "cde", "efg", "gh"]
    assert chunking.split_recursive("a\n\nb", 10, 0, chunking.SEPARATORS) == ["a\n\nb"]


def test_windows_end_with_the_text(spark):
    frame = spark.createDataFrame([(1, "abcdefghij"), (2, "ab"), (3, "")], "doc_id int, text string")
    rows = chunking.fixed_windows(frame, 4, 1, ["doc_id"]).orderBy("doc_id", "chunk_id").collect()
    assert [(r.doc_id, r.chunk_text, r.start) for r in rows] == [(1, "abcd", 0), (1, "defg", 3), (1, "ghij", 6), (2, "ab", 0)]


def test_semantic_chunks_keep_every_sentence(spark):
    text = "Red red red. Red red. Red red red red. Blue blue. Blue blue blue. Blue."
    frame = spark.createDataFrame([(1, text), (2, "Only one."), (3, "")], "doc_id int, text string")
    rows = chunking.semantic_chunks(frame, percentile=0.6, buffer=0).orderBy("doc_id", "chunk_id").collect()
    assert " ".join(r.chunk_text for r in rows if r.doc_id == 1) == text
    assert sum(r.n_sentences for r in rows if r.doc_id == 1) == 6
    assert [r.chunk_text for r in rows if r.doc_id == 2] == ["Only one."] and not [r for r in rows if r.doc_id == 3]
    assert any(r.chunk_text.startswith("Blue") for r in rows if r.doc_id == 1)


def test_review_csv(spark, tmp_path):
    header = ",".join(REVIEW_SCHEMA.names)
    (tmp_path / "jw1.csv").write_text(f'{header}\n2020,T,u,A,8,"line one\nsays ""hi""",en\n2020,T2,u,A,,x,en\n')
    (tmp_path / "jw3.csv").write_text(f"{header}\n2021,T3,u,B,bad,y,de\n")
    paths = [str(tmp_path / f"jw{n}.csv") for n in (1, 2, 3)]
    docs = readers.read_csv_documents(spark, paths, REVIEW_SCHEMA, path_pattern=".*/jw([0-9])[.]csv", title="Volume $1", quoted_newlines=True)
    docs = readers.shifted_access(docs, F.lit("2024-02-01").cast("timestamp"), 4)
    rows = {r.Review_Title: r for r in docs.collect()}
    assert rows["T"].page_content == 'text: line one\nsays "hi"\nlang: en' and rows["T"].Rating == 8
    assert rows["T2"].Rating == 0 and rows["T2"].bad_rating is None
    assert rows["T3"].Rating == 0 and rows["T3"].bad_rating == "bad" and rows["T3"].Movie_Title == "Volume 3"
    assert rows["T3"].last_accessed_at == dt.datetime(2024, 1, 31)


def test_text_and_binary_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "b.pdf").write_bytes(b"x")
    (tmp_path / "c.pdf").write_bytes(b"abc")
    assert [r.page_content for r in readers.read_text_files(spark, str(tmp_path)).collect()] == ["one\ntwo"]
    listed = readers.list_binary(spark, str(tmp_path), fingerprint=True)
    rows = {r.file_name: r for r in listed.collect()}
    assert rows["c.pdf"].length == 3 and len(rows["c.pdf"].sha256) == 64
    pages = spark.createDataFrame([("c.pdf", "text"), ("b.pdf", " ")], "file_name string, page_content string")
    assert [r.file_name for r in readers.files_without_content(listed, pages).collect()] == ["b.pdf"]
    before = readers.folder_fingerprint(listed.drop("sha256")).first()
    (tmp_path / "d.pdf").write_bytes(b"x")
    after = readers.folder_fingerprint(readers.list_binary(spark, str(tmp_path))).first()
    assert (before.n_files, after.n_files) == (2, 3) and before.digest != after.digest


def test_fingerprints_of_folders_and_content(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "same.pdf").write_bytes(b"1")
    both = readers.folder_fingerprint(readers.list_binary(spark, str(tmp_path))).first()
    one = readers.folder_fingerprint(readers.list_binary(spark, str(tmp_path / "x"))).first()
    assert both.n_files == 2 and both.digest != one.digest
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "")], "k int, t string")
    new = spark.createDataFrame([(1, "a"), (2, ""), (4, ""), (5, "e")], "k int, t string")
    found = {r.k: r.change for r in readers.changed_keys(old, new, "k", ["t"]).collect()}
    assert found == {2: "changed", 3: "removed", 5: "added"}


def test_processed_json_files_are_not_read(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"v": 1}')
    (tmp_path / "b.json").write_text('{"v": 2}')
    schema = T.StructType().add("v", T.IntegerType())
    rows = readers.read_json_folder(spark, str(tmp_path), schema)
    done = rows.filter("v = 1").select("file_path")
    rest = readers.read_json_folder(spark, str(tmp_path), schema, processed=done)
    assert [r.v for r in rest.collect()] == [2] and all(f.endswith("b.json") for f in rest.inputFiles())
    assert readers.read_json_folder(spark, str(tmp_path), schema, processed=rows.select("file_path")).count() == 0


def test_wrapped_test_set(spark, tmp_path):
    examples = [
        {"question": "q0", "context": ["c"], "answer": "a"},
        {"user_input": "q1", "reference_contexts": ["c1"], "reference": "r1"},
        {"id": "x", "text": "t", "question": "ignored", "answers": {"text": ["first", "second"]}},
    ]
    (tmp_path / "set.json").write_text(json.dumps({"examples": examples}, indent=2))
    rows = readers.map_test_set(readers.read_test_set(spark, str(tmp_path / "set.json"))).orderBy("question").collect()
    assert [(r.question_id, r.question, r.context, r.answer) for r in rows] == [
        ("0", "q0", ["c"], "a"), ("1", "q1", ["c1"], "r1"), ("x", "t", [], "first"),
    ]


def test_line_test_set(spark, tmp_path):
    lines = [{"question": "q0", "answer": "a"}, {"question": "q1"}, {"id": "x", "text": "t"}]
    (tmp_path / "set.jsonl").write_text("\n".join(map(json.dumps, lines)))
    rows = readers.map_test_set(readers.read_test_lines(spark, str(tmp_path / "set.jsonl"))).orderBy("question").collect()
    assert rows[2].question_id == "x" and len({r.question_id for r in rows}) == 3 and all(r.question_id for r in rows)
    (tmp_path / "bad.json").write_text('{"examples": [')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_test_set(spark, str(tmp_path / "bad.json")).collect()


def test_golden_set_checks_columns(spark):
    with pytest.raises(ValueError, match="reference"):
        readers.golden_set(spark.createDataFrame([("q",)], "user_input string"))
    scalar = spark.createDataFrame([("q", "r", 5)], "user_input string, reference string, reference_contexts int")
    assert readers.golden_corpus(readers.golden_set(scalar), ["user_input"]).first().text == "5"


def test_split_prefers_train(spark, tmp_path):
    rows = spark.createDataFrame([(1, "test"), (2, "train")], "n int, split string")
    rows.write.partitionBy("split").parquet(str(tmp_path / "s"))
    assert [r.n for r in readers.read_split(spark, str(tmp_path / "s")).collect()] == [2]
    assert [r.n for r in readers.read_split(spark, str(tmp_path / "s"), "absent").collect()] == [1]


def test_no_readable_source_fails(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.read_first({"a": lambda: spark.read.parquet(str(tmp_path / "none"))})


def test_graph_files(spark, tmp_path):
    graph = {"nodes": [{"id": "a", "type": "t", "properties": {"k": "v"}}], "relationships": [{"source": "a", "target": "b", "type": "r", "properties": {}}]}
    (tmp_path / "kg.json").write_text(json.dumps(graph, indent=1))
    nodes, rels = readers.read_graph_file(spark, str(tmp_path / "kg.json"))
    assert nodes.first().properties == {"k": "v"} and rels.first().target == "b"
    writers.save_graph(nodes, rels, str(tmp_path / "deep" / "kg"))
    assert readers.read_graph(spark, str(tmp_path / "deep" / "kg"))[0].count() == 1
    (tmp_path / "bad.json").write_text("{nodes: [")
    with pytest.raises(Exception):
        readers.read_graph_file(spark, str(tmp_path / "bad.json"))[0].collect()
    with pytest.raises(Exception):
        readers.read_graph(spark, str(tmp_path / "nowhere"))[0].collect()


def test_result_store_appends_runs(spark, tmp_path):
    metrics = spark.createDataFrame([("bm25", 0.5)], "retriever_type string, recall double")
    for run in ("r1", "r2"):
        writers.store_results(metrics, str(tmp_path / "out"), F.lit(run))
    rows = spark.read.json(str(tmp_path / "out" / "metrics"))
    assert rows.count() == 2 and {r.run_ts for r in rows.collect()} == {"r1", "r2"}
    assert not (tmp_path / "out" / "results").exists()


def test_hashed_vectors_are_unit_length(spark):
    from gleaner.operators.dense import embed

    rows = embed(spark.createDataFrame([("a b a",), ("",)], "text string"), dims=16).collect()
    assert np.linalg.norm(rows[0].vector) == pytest.approx(1) and sum(rows[1].vector) == 0


def test_files_of_zero_bytes_are_listed_and_warned_about(spark, tmp_path):
    (tmp_path / "in" / "a b").mkdir(parents=True)
    (tmp_path / "in" / "full.txt").write_text("text")
    (tmp_path / "in" / "a b" / "em+p%ty.txt").write_text("")
    (tmp_path / "in" / "other.bin").write_text("")
    files = readers.list_binary(spark, str(tmp_path / "in"), "*.txt", fingerprint=True)
    rows = {r.file_name: r for r in files.collect()}
    assert {name: r.length for name, r in rows.items()} == {"full.txt": 4, "em+p%ty.txt": 0}
    assert rows["em+p%ty.txt"].path == f"file:{tmp_path}/in/a b/em+p%ty.txt" and rows["em+p%ty.txt"].sha256.startswith("e3b0c442")
    pages = spark.createDataFrame([("full.txt", "text")], "file_name string, page_content string")
    assert [r.file_name for r in readers.files_without_content(files, pages).collect()] == ["em+p%ty.txt"]


def test_recursive_chunks_hand_on_a_few_texts_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    from gleaner.operators import chunking

    held = []
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda self, run, schema: held.append(run) or self.withColumn("chunks", F.array()))
    chunking.recursive_chunks(spark.createDataFrame([(1, "x")], "doc_id long, text string"), 10, 2)
    texts = ["some words here"] * 950 + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(952)), "text": texts})
    out = list(held[0](iter([batch])))
    assert max(b.num_rows for b in out) <= chunking.TEXTS and sum(b.num_rows for b in out) == 952
    assert [c for b in out for c in b.column(1).to_pylist()] == [chunking.split_recursive(t, 10, 2, chunking.SEPARATORS) if t else [] for t in texts]
