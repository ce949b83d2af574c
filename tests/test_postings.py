"""The stored inverted index against the scan of all documents, and what its block bounds leave out."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import lexical, postings
from gleaner.operators.ordinal import numbered

WORDS = [f"w{i}" for i in range(400)]


def rows_of(hits):
    return sorted((r.query_id, r.doc_id, round(r.score, 5), r["rank"]) for r in hits.collect())


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(11)
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    docs = [(3 * i + 1, " ".join(rng.choices(WORDS, weights, k=rng.randint(1, 60)))) for i in range(3000)]
    docs += [(90_000 + i, docs[0][1]) for i in range(1500)]  # a third is one text
    docs += [(100_000, None), (100_001, ""), (100_002, "w0 " * 500), (100_003, "rare w399")]
    asked = [(q, " ".join(rng.choices(WORDS, weights, k=rng.randint(1, 12)))) for q in range(60)]
    asked += [(100, "unknown"), (101, ""), (102, "rare"), (103, "w0"), (104, docs[7][1])]
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(6),
        spark.createDataFrame(asked, "query_id long, text string"),
    )


@pytest.fixture(scope="module")
def index(frames, tmp_path_factory):
    return postings.build(frames[0], str(tmp_path_factory.mktemp("postings") / "index"))


def test_hits_equal_those_of_the_scan(frames, index):
    corpus, asked = frames
    for k in (1, 10):
        assert rows_of(postings.search(index, asked, k)) == rows_of(lexical.bm25(lexical.build_index(corpus), asked, k))


def test_stored_postings_are_those_of_the_documents(frames, index):
    want = lexical.build_index(frames[0]).postings()
    assert sorted(map(tuple, postings.postings(index).collect())) == sorted(map(tuple, want.collect()))


def test_blocks_are_bounded_sorted_and_hold_their_highest_gain(index):
    assert index.blocks.select("shard").distinct().count() > 1
    last = {}
    for r in index.blocks.orderBy("term", "shard", "block").collect():
        gains = [postings._gain(tf, dl, index.k1, index.b, index.avgdl) for tf, dl in zip(r.tfs, r.dls, strict=True)]
        assert 0 < len(r.nums) <= postings.BLOCK and r.nums == sorted(set(r.nums)) and abs(max(gains) - r.top) < 1e-12
        assert (r.first, r.last) == (r.nums[0], r.nums[-1]) and {n // index.shard_docs for n in r.nums} == {r.shard}
        assert r.block == 0 or last[r.term, r.shard] < r.first
        last[r.term, r.shard] = r.last


def test_only_the_folders_of_asked_terms_are_read(spark, index):
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit("w5")), F.lit(postings.BUCKETS))).first()[0]
    asked = index.blocks.filter(F.col("bucket").isin([bucket]))
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", asked._jdf.queryExecution().toString())
    files = {row[0].rsplit("/", 2)[1] for row in asked.select(F.input_file_name()).collect()}
    assert files == {f"bucket={bucket}"} and len(index.blocks.inputFiles()) > 20


def test_windows_that_cannot_matter_are_not_scored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(postings, "LEAST_SHARD", 20_000)
    # One document in a thousand has the word three times; all have it once.
    texts = F.concat(F.when(F.col("id") % 1000 == 77, "x x x ").otherwise("x "), F.lit("f "), F.concat(F.lit("u"), F.col("id") % 50))
    corpus = spark.range(20_000).select(F.col("id").alias("doc_id"), texts.alias("text"))
    index = postings.build(corpus, str(tmp_path / "index"))
    asked = spark.createDataFrame([(1, "x"), (2, "x u7")], "query_id long, text string")
    assert index.shard_docs == 20_000
    found = postings.candidates(index, asked, 5).collect()
    used = {r.query_id: (r.scored, r.windows) for r in found}
    assert used[1][1] == 79 and used[1][0] < 40 and used[2][0] < 79
    assert rows_of(postings.search(index, asked, 5)) == rows_of(lexical.bm25(lexical.build_index(corpus), asked, 5))


def test_query_blocks_and_text_ids(spark, frames, index, tmp_path):
    corpus, asked = frames
    assert rows_of(postings.search(index, asked, 4, max_query_rows=40)) == rows_of(postings.search(index, asked, 4))
    named = corpus.withColumn("doc_id", F.format_string("d%07d", "doc_id"))
    by_name = postings.build(named, str(tmp_path / "named"))
    keyed = asked.withColumn("query_id", F.concat(F.lit("q"), F.col("query_id")))
    want = [(f"q{q}", f"d{d:07d}", s, r) for q, d, s, r in rows_of(postings.search(index, asked, 4))]
    assert rows_of(postings.search(by_name, keyed, 4)) == sorted(want)


def test_bounds_are_never_too_low():
    rng = np.random.default_rng(2)
    import pyarrow as pa

    rows = []
    for term in range(6):
        nums = np.sort(rng.choice(2000, rng.integers(1, 900), replace=False))
        for part in np.array_split(nums, -(-len(nums) // postings.BLOCK)):
            tf, dl = rng.integers(1, 9, len(part)), rng.integers(9, 90, len(part))
            rows.append({"term": f"t{term}", "first": part[0], "last": part[-1], "top": (tf / dl).max(), "nums": part, "tfs": tf, "dls": dl})
    shard = postings.Shard(pa.Table.from_pylist(rows), [f"t{i}" for i in range(6)], 2000, lambda tf, dl: tf / dl)
    for _ in range(50):
        weights = rng.normal(0.5, 1, 6)
        docs, scores = shard.score(np.arange(6), weights, np.arange(8))
        bound = shard.bounds(np.arange(6), weights)[2]
        assert (scores <= bound[docs // postings.WINDOW] + 1e-6).all()
        best, value, _, _ = shard.best(np.arange(6), weights, 7)
        want = [(-s, d) for d, s in zip(docs, scores, strict=True) if s > 0]
        assert sorted(want)[:7] == [(-s, d) for d, s in zip(best, value, strict=True)]


def test_empty_tables(spark, frames, index, tmp_path):
    empty = postings.build(frames[0].limit(0), str(tmp_path / "none"))
    assert postings.search(empty, frames[1], 3).count() == 0
    assert postings.search(index, frames[1].limit(0), 3).count() == 0


def test_lists_move_and_not_single_postings(spark, frames):
    counted = lexical.build_index(frames[0], ordered=True)
    docs = numbered(counted.docs, "num")
    assert [r.num for r in docs.orderBy("doc_id").collect()] == list(range(frames[0].count()))
    schema = "bucket int, term string, first long, packed binary"
    rows = docs.select("num", "dl", "terms", "counts").mapInArrow(postings._gathered(1000), schema).collect()
    found = set()
    for r in rows:
        entries = np.frombuffer(r.packed, np.int32).reshape(-1, 3)
        assert entries[0, 0] == 0 and (np.diff(entries[:, 0]) > 0).all() and (entries[-1, 0] + r.first) // 1000 == r.first // 1000
        found |= {(r.term, r.first + int(n), int(tf), int(dl)) for n, tf, dl in entries}
    want = docs.select("num", "dl", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("tf"))))
    want = [(r.term, r.num, r.tf, r.dl) for r in want.collect()]
    assert found == set(want) and len(rows) < len(want) / 3
