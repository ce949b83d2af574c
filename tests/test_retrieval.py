"""Search operators against brute force on small fixtures, with skewed groups of copies."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner.functions import vectors
from gleaner.functions.text import words
from gleaner.operators import blocks, catalog, dense, fusion, lexical
from gleaner.operators.matching import containment

WORDS = [f"w{i}" for i in range(60)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    docs = [(i, " ".join(rng.choices(WORDS, weights=range(60, 0, -1), k=rng.randint(3, 40)))) for i in range(80)]
    copies = [(100 + i, docs[0][1]) for i in range(40)]  # a third of the corpus is one text
    queries = [(q, " ".join(rng.choices(WORDS, k=5))) for q in range(12)]
    return docs + copies, queries


@pytest.fixture(scope="module")
def frames(spark, texts):
    docs, queries = texts
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(queries, "query_id long, text string"),
    )


def brute_bm25(docs, queries, k):
    tokens = {i: t.split() for i, t in docs}
    n = len(docs)
    avgdl = sum(map(len, tokens.values())) / n
    df = Counter(w for t in tokens.values() for w in set(t))
    idf = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: floor if v < 0 else v for w, v in idf.items()}
    hits = []
    for q, text in queries:
        scores = []
        for i, doc in tokens.items():
            counts = Counter(doc)
            score = sum(
                idf.get(w, 0) * counts[w] * 2.5 / (counts[w] + 1.5 * (0.25 + 0.75 * len(doc) / avgdl))
                for w in text.split() if w in counts
            )
            if score > 0:
                scores.append((-round(score, 6), i))
        hits += [(q, i, -s, r) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(hits)


def as_rows(hits):
    return sorted((r.query_id, r.doc_id, r.score, r["rank"]) for r in hits.collect())


def test_bm25_matches_brute_force(frames, texts):
    corpus, queries = frames
    found = as_rows(lexical.bm25(lexical.build_index(corpus), queries, k=4))
    expected = brute_bm25(*texts, 4)
    assert [(q, d, r) for q, d, _, r in found] == [(q, d, r) for q, d, _, r in expected]
    assert np.allclose([s for _, _, s, _ in found], [s for _, _, s, _ in expected], atol=2e-6)


def test_bm25_is_the_same_in_tiles(frames, monkeypatch):
    corpus, queries = frames
    index = lexical.build_index(corpus)
    whole = as_rows(lexical.bm25(index, queries, k=4))
    monkeypatch.setattr(blocks, "TILE_ROWS", 30)
    assert as_rows(lexical.bm25(index, queries, k=4, max_query_rows=7)) == whole


def test_saved_index_gives_the_same_hits(frames, spark, tmp_path):
    corpus, queries = frames
    index = lexical.build_index(corpus)
    index.save(str(tmp_path / "index"))
    loaded = lexical.load_index(spark, str(tmp_path / "index"))
    assert as_rows(lexical.bm25(loaded, queries, k=4)) == as_rows(lexical.bm25(index, queries, k=4))
    assert sorted(map(tuple, loaded.postings().collect())) == sorted(map(tuple, index.postings().collect()))


def test_best_keeps_the_head_of_every_query():
    rng = np.random.default_rng(5)
    query, doc, score = rng.integers(0, 20, 5000), rng.permutation(5000), rng.integers(0, 30, 5000).astype(float)
    best = blocks._Best(20, 6)
    best.room = 200
    for part in np.array_split(np.arange(5000), 40):
        best.add(query[part], doc[part], score[part])
    got = sorted(zip(*best.cut(), strict=True))
    want = []
    for q in range(20):
        rows = sorted((-s, d) for x, d, s in zip(query, doc, score, strict=True) if x == q)[:6]
        want += [(q, d, -s) for s, d in rows]
    assert got == sorted(want)


def test_scratch_needs_a_shared_folder(spark, tmp_path):
    from types import SimpleNamespace

    from gleaner import session

    bare = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="checkpoint"):
        session.scratch_root(bare)
    bare.sparkContext.getCheckpointDir = lambda: "shared://x/"
    assert session.scratch_root(bare) == "shared://x"


def test_release_deletes_what_was_handed_out(spark, monkeypatch):
    from pathlib import Path

    from gleaner import session

    monkeypatch.setattr(session, "_scratch", {})
    kept = session.materialise(spark.range(3), "kept")
    assert kept.count() == 3
    folder = Path(session._scratch[spark.sparkContext.applicationId][0].removeprefix("file:"))
    assert folder.exists() and session.release(spark) == 1 and not folder.exists()


def unit(rng, n, dims):
    v = rng.normal(size=(n, dims))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def vector_frames(spark):
    rng = np.random.default_rng(3)
    docs = unit(rng, 90, 8)
    docs[60:] = docs[0]  # a third of the vectors are copies
    queries = unit(rng, 10, 8)
    make = lambda m, name: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{name} long, vector array<double>")
    return docs, queries, make(docs, "doc_id"), make(queries, "query_id")


def brute_dense(docs, queries, k):
    out = []
    for q, scores in enumerate(np.round(queries @ docs.T, 6)):
        order = sorted(range(len(docs)), key=lambda i: (-scores[i], i))[:k]
        out += [(q, i, r) for r, i in enumerate(order, 1)]
    return sorted(out)


def test_dense_matches_brute_force(vector_frames):
    docs, queries, corpus, asked = vector_frames
    found = sorted((r.query_id, r.doc_id, r["rank"]) for r in dense.dense(corpus, asked, 5, 8).collect())
    assert found == brute_dense(docs, queries, 5)


def test_cell_search_with_all_cells_is_exact(vector_frames, spark):
    docs, queries, corpus, asked = vector_frames
    cells = spark.createDataFrame([(i, docs[i].tolist()) for i in range(4)], "cell long, vector array<double>")
    indexed = dense.assign_cells(corpus, "doc_id", cells)
    found = dense.cell_search(indexed, asked, cells, k=5, probes=4)
    assert sorted((r.query_id, r.doc_id, r["rank"]) for r in found.collect()) == brute_dense(docs, queries, 5)


def test_trained_cells_reach_recall_and_prune_folders(spark):
    rng = np.random.default_rng(4)
    docs = unit(rng, 2000, 8)
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(docs)], "doc_id long, vector array<double>")
    asked = spark.createDataFrame([(i, docs[i * 50].tolist()) for i in range(40)], "query_id long, vector array<double>")
    cells = dense.train_cells(corpus, 24)
    indexed = dense.assign_cells(corpus, "doc_id", cells)
    found = {(r.query_id, r.doc_id) for r in dense.cell_search(indexed, asked, cells, k=5, probes=8).collect()}
    exact = {(r.query_id, r.doc_id) for r in dense.dense(corpus, asked, 5, 8).collect()}
    assert indexed.count() == 2000 and len(found & exact) >= 0.9 * len(exact)
    plan = indexed.filter("cell IN (1, 2)")._jdf.queryExecution().toString()
    assert "PartitionFilters: [cell" in plan
    assert dense.train_cells(corpus.limit(0), 3).count() == 0


def test_large_cell_ids_stay_whole(spark):
    big = (1 << 60) + 1
    cells = spark.createDataFrame([(big, [1.0, 0.0]), (big + 2, [1.0, 0.0])], "cell long, vector array<double>")
    corpus = spark.createDataFrame([(1, [1.0, 0.0])], "doc_id long, vector array<double>")
    assert dense.assign_cells(corpus, "doc_id", cells).first().cell == big


def test_hot_cell_is_tiled(vector_frames, spark, monkeypatch):
    docs, queries, corpus, asked = vector_frames
    monkeypatch.setattr(blocks, "TILE_ROWS", 10)
    same = F.lit(0).cast("bigint")
    found = blocks.topk_by_key(corpus.withColumn("cell", same), asked.withColumn("cell", same), "cell", dense.DOT, 5, max_query_rows=3)
    assert sorted((r.query_id, r.doc_id, r["rank"]) for r in found.collect()) == brute_dense(docs, queries, 5)


def test_wrong_dimension_fails(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0])], "doc_id long, embedding array<double>")
    with pytest.raises(Exception, match="expected 3 dimensions"):
        dense.unit_vectors(table, "doc_id", dims=3).collect()


def test_mmr_matches_brute_force(vector_frames):
    docs, queries, corpus, asked = vector_frames
    fetched = dense.dense(corpus, asked, 15, 8).drop("rank").join(corpus, "doc_id")
    found = sorted((r.query_id, r["rank"], r.doc_id) for r in dense.diversify(fetched, 5, 0.5).collect())
    expected = []
    for q in range(len(queries)):
        scores = np.round(queries[q] @ docs.T, 6)
        pool = sorted(range(len(docs)), key=lambda i: (-scores[i], i))[:15]
        chosen = []
        while len(chosen) < 5:
            def value(i):
                near = max((docs[i] @ docs[j] for j in chosen), default=0.0)
                return round(0.5 * scores[i] - 0.5 * near, 9)
            pick = max((i for i in pool if i not in chosen), key=lambda i: (value(i), -pool.index(i)))
            chosen.append(pick)
            expected.append((q, len(chosen), pick))
    assert found == sorted(expected)


def test_containment_matches_brute_force(spark, texts):
    docs, _ = texts
    rng = random.Random(1)
    passages = []
    for n in range(40):
        text = rng.choice(docs)[1]
        a = rng.randrange(len(text))
        passages.append((n, text[a : a + rng.choice([1, 3, 6, 12, 25, 60])]))
    passages += [(90, "w1 w2 w3 absent w4 w5"), (91, "zzz"), (92, docs[0][1])]
    found = containment(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(passages, "query_id long, text string")
    )
    expected = sorted((q, d) for q, p in passages for d, t in docs if p in t)
    assert sorted((r.query_id, r.doc_id) for r in found.collect()) == expected


def ranked(spark, name, lists):
    rows = [(name, q, d, r, 1.0) for q, docs in lists.items() for r, d in enumerate(docs, 1)]
    return spark.createDataFrame(rows, "retriever_type string, query_id long, doc_id string, rank int, score double")


def members(spark, **available):
    return spark.createDataFrame(list(available.items()), "retriever_type string, available boolean")


def test_fusion_formula_and_member_order(spark):
    a = ranked(spark, "a", {1: ["x", "y", "z"]})
    b = ranked(spark, "b", {1: ["y", "x", "y", "w"]})  # the repeated y counts once
    weights = fusion.equal_weights(members(spark, a=True, b=True))
    one = fusion.fuse(a.unionByName(b), weights).orderBy("rank").collect()
    two = fusion.fuse(b.unionByName(a), weights).orderBy("rank").collect()
    assert one == two
    assert [(r.doc_id, r.score) for r in one][:2] == [("x", round(0.5 / 61 + 0.5 / 62, 9)), ("y", round(0.5 / 62 + 0.5 / 61, 9))]


def test_ensemble_degrades(spark):
    hits = ranked(spark, "a", {1: ["x", "y"]}).unionByName(ranked(spark, "b", {1: ["z"]}))
    one = fusion.fuse(hits, fusion.equal_weights(members(spark, a=True, b=False)))
    assert [r.doc_id for r in one.orderBy("rank").collect()] == ["x", "y"]
    assert fusion.fuse(hits, fusion.equal_weights(members(spark, a=False, b=False))).count() == 0


def test_hyde_replaces_or_averages(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0])], "query_id long, vector array<double>")
    extra = spark.createDataFrame([(1, [0.0, 1.0])], "query_id long, vector array<double>")
    mixed = {r.query_id: r.vector for r in dense.blend(q, extra).collect()}
    assert np.allclose(mixed[1], [math.sqrt(0.5)] * 2) and mixed[2] == [1.0, 0.0]
    assert {r.query_id: r.vector for r in dense.blend(q, extra, "replace").collect()}[1] == [0.0, 1.0]


def test_unknown_names_are_rejected(spark):
    asked = spark.createDataFrame([("hybrid",), ("nope",)], "retriever_type string")
    rows = {r.retriever_type: (r.engine, r.accepted) for r in catalog.resolve(asked).collect()}
    assert rows == {"hybrid": ("ensemble_retriever", True), "nope": (None, False)}


def test_registered_retrievers_run_in_a_sweep(frames):
    corpus, queries = frames
    catalog.register("mine", lambda c, q, k: lexical.bm25(lexical.build_index(c), q, k))
    hits = catalog.run_registered(["mine"], corpus, queries, k=2)
    assert {r.retriever_type for r in hits.select("retriever_type").distinct().collect()} == {"mine"}


def test_md5_vectors_hash_each_different_word_once(spark, monkeypatch):
    """The buckets are those of the column expression, and md5 is not taken of every word of every text."""
    texts = ["one two two three", None, "", " \t one\n\r", "a\x0bb one", "é ü one", " "]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    embedded = dense.embed(rows, hashing="md5")
    assert "md5" not in embedded._jdf.queryExecution().optimizedPlan().toString()
    want = rows.select("doc_id", vectors.count_vectors(64)(vectors.token_buckets(words(F.col("text")), 64, "md5")).alias("vector"))
    assert sorted(embedded.select("doc_id", "vector").collect()) == sorted(want.collect())

    asked = []
    real = vectors.hashlib.md5
    monkeypatch.setattr(vectors.hashlib, "md5", lambda word: asked.append(word) or real(word))
    held, buckets = vectors.md5_buckets(pa.array(["x y x", "y  x"]), 64)
    assert sorted(w for w in asked if w) == [b"x", b"y"] and held.tolist() == [0, 0, 0, 1, 1] and len(buckets) == 5
