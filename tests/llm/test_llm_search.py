import math
import random

import numpy as np

from gleaner.llm import topk

SCHEMA = "vec_id long, embedding array<float>, id int, terms string, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "t", 0.5) for i, v in rows], SCHEMA)


def plain(rows, k, every=2):
    good = [(i, [math.floor(8 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = set()
    for q in {i for i, _ in good if i % every == 0}:
        mine = min(v for i, v in good if i == q)
        scored = sorted((-sum(a * b for a, b in zip(mine, v, strict=True)), i) for i, v in good if i != q and len(v) == len(mine))
        want |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])}
    return want


def found(spark, rows, k):
    vectors = topk.whole_numbers(frame(spark, rows), 8)
    return [tuple(r) for r in topk.top_k(vectors, vectors.filter("id % 2 = 0"), k).collect()]


def test_equals_brute_force_with_ties_and_gaps(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.0, 0.5, -0.25, 1.0]) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(30)]
    rows += [(300, None), (302, [float("nan"), 1.0, 1.0, 1.0]), (304, [float("inf"), 0.0, 0.0, 0.0]), (306, [None, 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    want = plain(rows, 5)
    assert sorted(found(spark, rows, 5)) == sorted(want)
    monkeypatch.setattr(topk, "BLOCK_BYTES", 8 * 4 * 10)  # several blocks
    monkeypatch.setattr(topk, "SLICE_SCORES", 64)
    assert sorted(found(spark, rows, 5)) == sorted(want)


def test_few_candidates_repeats_and_lengths(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.5]), (1, [1.0, 1.0]), (2, [1.0, 2.0, 3.0])]
    assert sorted(found(spark, rows, 10)) == [(0, 1, 1, 32 + 32)]
    assert found(spark, rows[:1], 3) == [] and found(spark, [], 3) == []
    twice = found(spark, [(0, [1.0]), (1, [1.0]), (1, [1.0])], 5)
    assert sorted(twice) == [(0, 1, 1, 64), (0, 2, 1, 64)]


def test_selection_is_the_sorted_head():
    rng = np.random.default_rng(2)
    for _ in range(50):
        scores, ids = rng.integers(0, 5, 40), rng.permutation(40)
        got = topk.select(scores, ids, 7)
        want = sorted(zip(-scores, ids, strict=True))[:7]
        assert [(-s, i) for s, i in zip(*got, strict=True)] == want


def test_one_block_of_queries_at_a_time(spark, monkeypatch):
    rows = [(i, [(i * 7 + t * t) % 11 - 5 for t in range(6)]) for i in range(120)]
    vectors = spark.createDataFrame(rows, "id long, terms array<long>")
    asked = vectors.filter("id % 2 = 0")
    want = sorted(map(tuple, topk.top_k(vectors, asked, 5).collect()))
    live, most = set(), []
    plain = type(spark.sparkContext).broadcast

    def broadcast(context, value):
        made = plain(context, value)
        live.add(id(made))
        most.append(len(live))
        destroy = made.destroy
        made.destroy = lambda: (live.discard(id(made)), destroy())
        return made

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    monkeypatch.setattr(topk, "BLOCK_BYTES", 48 * 7)
    assert sorted(map(tuple, topk.top_k(vectors, asked, 5).collect())) == want
    assert len(most) > 8 and max(most) == 1 and not live
