"""The pipeline against a plain version of its stages, and each stage on odd rows."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import bpe, classifier, mixing, pii, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 9)))
    rows = []
    for i in range(260):
        words = [word() for _ in range(rng.randint(40, 80))]
        if i % 5 == 0:
            words = [w + "%%%" for w in words]
        if i % 7 == 1:
            words[3] = f"{word()}@{word()}.org"
        rows.append(" ".join(words))
        if i % 11 == 3:
            rows.append(rows[-1])
        if i % 11 == 4:
            rows.append(" ".join([*words[:-1], word()]))
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en" if i % 3 else "fr", f"src{i % 2}", len(t)) for i, t in enumerate(texts(8))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{where}/documents.parquet")
    labels = [(i, int("%%%" not in t), 0) for i, t, *_ in rows if i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return where, rows


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def test_pipeline_equals_a_plain_version(spark, folder):
    where, rows = folder
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, where).collect()}
    # Quality and mixture: the marked texts go; near-duplicates: pairwise; data: as the stage's own model says.
    good = [r for r in rows if "%%%" not in r[1]]
    kept = []
    for r in good:
        mine = shingles(r[1])
        if all(100 * len(mine & o) < 85 * len(mine | o) for o in (shingles(k[1]) for k in kept)):
            kept.append(r)
    frame = spark.createDataFrame(kept, SCHEMA)
    model = pii.learn(frame)
    base = [pii.base_spans(r[1]) for r in kept]
    added = pii.added_spans(model, [r[1] for r in kept], base)
    clean = {r[0]: (pii.replaced(r[1], b + a), r) for r, b, a in zip(kept, base, added, strict=True)}
    supply = {}
    path = lambda r: (f"domain{int(r[3][3:]) % 4}", r[2], r[3])
    for text, r in clean.values():
        supply[path(r)] = supply.get(path(r), 0) + len(text.split())
    budget = mixing.budgets(supply, queries.MIX_WEIGHTS, int(0.9 * sum(supply.values())), 1)
    place = {
        r.doc_id: (r.p0, r.p1)
        for r in frame.select("doc_id", *(F.xxhash64(F.lit(queries.MIX_SEED), F.lit(e).cast("long"), F.col("doc_id").cast("string")).alias(f"p{e}") for e in (0, 1))).collect()
    }
    want = {}
    for leaf, amount in budget.items():
        held = 0
        whole = amount // supply[leaf]
        for i in sorted((i for i, (_, r) in clean.items() if path(r) == leaf), key=lambda i: place[i][whole]):
            if whole or held < amount:
                want[i] = clean[i][0]
            held += len(clean[i][0].split())
    assert set(found) == set(want)
    ranks = {t: i for i, t in enumerate(bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, text in want.items():
        ids = reference.encode_ordinary(text)
        assert found[i].n_tokens == len(ids) and found[i].n_chars == len(text)
        assert found[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_on_odd_rows(spark, folder):
    where, rows = folder
    odd = [(None, None, None, None, None), (1000, None, None, "x", None), (1001, "", "", "", 0), (1002, "a@b.cd " * 9000, "zz", "src1", 63000),
           (1003, "same text of five words", "en", None, 23), (1004, "same text of five words", "en", "src0", 23)]
    docs = spark.createDataFrame([*rows[:40], *odd, odd[-1]], SCHEMA).withColumns({"score": F.lit("s"), "ids": F.lit(1), "domain": F.lit(2)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, where)
        assert out.columns == docs.columns, name
        ids = [r.doc_id for r in out.collect()]
        if name == "near-duplicates":
            assert 1003 in ids and 1004 not in ids and {None, 1000, 1001} <= set(ids)
        if name == "personal data":
            assert len(ids) == docs.count()
        assert stage(spark, docs.limit(0), where).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, where)
    assert last.count() == docs.count() and {"n_tokens", "ids_sha256", "decoded_sha256"} <= set(last.columns)
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), where).count() == 0


def test_held_out_accuracy(spark, folder):
    where, rows = folder
    scores = queries.QUERIES["op6_quality_trees"](spark, where).collect()
    bad = {i for i, t, *_ in rows if "%%%" in t}
    held = [(r.predicted == 1) == (r.doc_id not in bad) for r in scores if r.held_out]
    assert len(held) > 20 and sum(held) >= 0.97 * len(held)
    assert classifier.MAX_ROWS >= len(rows)
