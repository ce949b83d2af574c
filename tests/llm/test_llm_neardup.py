import random
from itertools import combinations

from gleaner.llm import neardup


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset([tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else []))


def plain(docs):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed):
    """Copies with few and many changes, chains, copies of copies, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = [None, "", "  \n", "one two", "One  TWO", "one two three", "a b c d e", "A B c d E", "ä b c d e", "Ä b c d e"]
    for size in (60, 120, 400):
        base = [word() for _ in range(size)]
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, size // 40, size // 20, size // 8])):
                copy[rng.randrange(size)] = word()
            texts.append(" ".join(copy))
        chain = list(base)
        for _ in range(15):
            chain[rng.randrange(size)] = word()
            texts.append("\n".join(chain))
    passage = [word() for _ in range(60)]
    texts += [" ".join(passage + [word() for _ in range(rng.choice([4, 20, 200]))]) for _ in range(30)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_components_equal_brute_force(spark):
    for seed in (1, 2):
        docs = corpus(seed)
        frame = spark.createDataFrame([(i, t, "k", 5, 1) for i, t in docs], "doc_id long, text string, key string, n int, component int")
        rows = neardup.components(frame).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain(docs)
        assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_rest_of_open_buckets_is_exact(spark):
    """The prefix filter loses no pair across components, whatever the components are."""
    docs = [(i, t) for i, t in corpus(3) if shingles(t)]
    sets = {i: shingles(t) for i, t in docs}
    alone = spark.createDataFrame([(i, i % 3 if i % 2 else i) for i in sets], "doc_id long, component long")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    pairs = neardup.pairs_across(neardup.shingle_sets(frame).join(alone, "doc_id"))
    found = {(r.a, r.b) for r in pairs.collect()}
    label = {i: i % 3 if i % 2 else i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if label[a] != label[b] and 100 * both >= 85 * len(sets[a] | sets[b]):
            assert (a, b) in found


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 150), (150, 120), (200, 199)]
    rows = neardup.star_components(spark.createDataFrame(chain, "a long, b long")).collect()
    label = {r.doc_id: r.component for r in rows}
    assert all(label[i] == 0 for i in range(1, 61)) and label[150] == label[120] == 100 and label[200] == 199


def test_nulls_repeats_empty_table_and_kept_columns(spark):
    schema = "doc_id long, text string, lang string, digest string"
    docs = spark.createDataFrame(
        [(5, "a b c d e f", "x", "d"), (5, "a b c d e f", "x", "d"), (7, "A b c d e f", "y", "d"), (None, "a b c d e f", "z", "d"), (9, None, "n", "d")],
        schema,
    )
    kept = neardup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.lang) for r in kept.collect()) == [(0, "z"), (5, "x"), (5, "x"), (9, "n")]
    empty = spark.createDataFrame([], schema)
    assert neardup.components(empty).count() == 0 and neardup.deduplicate(empty).count() == 0
