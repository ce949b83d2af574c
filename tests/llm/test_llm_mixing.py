import pytest
from pyspark.sql import functions as F

from gleaner.llm import mixing


def test_shares_and_shortages():
    assert mixing.fill([(1, 100), (1, 100)], 50) == [25, 25]
    assert mixing.fill([(1, 10), (1, 100), (2, 1000)], 100) == [10, 30, 60]
    assert mixing.fill([(0, 10), (1, 10)], 100) == [0, 10]
    assert sum(mixing.fill([(1, 100), (1, 100), (1, 100)], 100)) == 100
    assert mixing.fill([], 10) == [] and mixing.fill([(1, 5)], 0) == [0]


def test_siblings_before_ancestors():
    leaves = {("a", "x", "1"): 10, ("a", "x", "2"): 100, ("a", "y", "3"): 100, ("b", "x", "4"): 1000}
    got = mixing.budgets(leaves, {}, 200, 1)
    # a and b get 100 each; inside a, x and y 50 each; leaf 1 leaves 15 of its 25 to its sibling.
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 40, ("a", "y", "3"): 50, ("b", "x", "4"): 100}
    got = mixing.budgets(leaves, {("a",): 3.0}, 1000, 1)
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 100, ("a", "y", "3"): 100, ("b", "x", "4"): 790}
    assert mixing.budgets(leaves, {("b",): 0}, 5000, 2)[("b", "x", "4")] == 0
    with pytest.raises(ValueError):
        mixing.build_tree(leaves, {("a",): -1})


def plain(rows, weights, total, epochs, seed, place):
    """rows: (id, path, tokens); every leaf takes whole epochs, then the ordered documents up to its budget."""
    leaves = {}
    for _, path, n in rows:
        leaves[path] = leaves.get(path, 0) + n
    found = {}
    for path, budget in mixing.budgets(leaves, weights, total, epochs).items():
        whole, part = divmod(budget, leaves[path]) if leaves[path] else (0, 0)
        held = 0
        inside = sorted((place[whole, i], i, n) for i, p, n in rows if p == path)
        for at in sorted({x[0] for x in inside}):
            group = [x for x in inside if x[0] == at]
            for _, i, n in group:
                found.setdefault(i, []).append(0 if n == 0 else whole + (held < part))
            held += sum(n for _, _, n in group)
    return {i: sorted(c) for i, c in found.items()}


@pytest.mark.parametrize("fraction,epochs,per_range", [(0.5, 1, 4096), (0.5, 1, 4), (0.9, 2, 8), (3.0, 2, 8), (0.0, 1, 8)])
def test_mix_equals_brute_force(spark, monkeypatch, fraction, epochs, per_range):
    monkeypatch.setattr(mixing, "RANGE_ROWS", per_range)
    rows = []
    for i in range(300):
        lang, source = ("en", None, "fr")[i % 3], "hot" if i % 2 else f"s{i % 5}"
        rows.append((i, "d" if i % 7 else None, lang, source, "w " * (i % 11), 1))
    rows += [rows[12], rows[12], (400, "d", "en", "hot", None, 1), (401, "d", "en", "hot", " \n", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, text string, copies int")
    weights = {("d",): 2.0, ("d", "en"): 3.0, ("d", "en", "hot"): 0.5}
    total = int(fraction * sum(len((r[4] or "").split()) for r in rows))
    found = mixing.mix(docs, mixing.word_tokens(F.col("text")), weights, fraction=fraction, epochs=epochs, seed=5).collect()
    assert len(found) == len(rows)
    ids = docs.select("doc_id", *(F.xxhash64(F.lit(5), F.lit(e).cast("long"), F.col("doc_id").cast("string")).alias(f"e{e}") for e in range(epochs + 1)))
    place = {(e, r.doc_id): r[f"e{e}"] for r in ids.collect() for e in range(epochs + 1)}
    key = lambda r: tuple(mixing.NONE if x is None else x for x in r[1:4])
    want = plain([(r[0], key(r), len((r[4] or "").split())) for r in rows], weights, total, epochs, 5, place)
    got = {}
    for r in found:
        got.setdefault(r.doc_id, []).append(r.copies)
    assert {i: sorted(c) for i, c in got.items()} == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, domain string, lang string, source string, text string")
    assert mixing.mix(docs, mixing.word_tokens(F.col("text")), {}).count() == 0


def test_words(spark):
    texts = [None, "", " \n", "a", " a  b\tc\x0bd\x0ce\r", "a b"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in frame.select(mixing.word_tokens(F.col("text"))).collect()] == [0, 0, 0, 1, 5, 1]
