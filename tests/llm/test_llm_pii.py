import random
import re

import numpy as np
import pytest

from gleaner.llm import pii, pii_examples

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1]))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            found.append((2, *m.span()))
    return found + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def example(rng):
    filler = lambda: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(3, 9)))
    kind = rng.randrange(4)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    body = [
        f"{filler().split()[0]}.{number(2)}@mail{number(1)}.org", ".".join(str(rng.randrange(256)) for _ in range(4)), number(16),
        f"+1 ({number(3)}) 555-{number(4)}",
    ][kind].replace("é", "e")
    before = filler() + " "
    return (before + body + " " + filler())[: pii.WINDOW], [(kind, len(before), min(len(before) + len(body), pii.WINDOW))]


@pytest.fixture(scope="module")
def model():
    rng = random.Random(4)
    clean = [("no data 12 here at all, only words and 7 more", [])] * 40
    return pii.fit([example(rng) for _ in range(600)] + clean, steps=16 * -(-(600 + len(clean)) // pii.BATCH))


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    for _ in range(20000):
        text = "".join(rng.choice("ab1.2@-+ (5)7%0") for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == plain(text)
    card = "4111 1111-1111 1111"
    assert pii.base_spans(f"x {card} y 300.1.1.1 001.2.3.4") == plain(f"x {card} y 300.1.1.1 001.2.3.4")
    assert pii.base_spans(None) == pii.base_spans("") == []


def test_base_spans_of_long_runs_take_linear_time():
    assert pii.base_spans("a" * 200_000 + "1" * 200_000 + "@") == []
    assert len(pii.base_spans("1." * 100_000)) == 25_000


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    model = pii.Tagger.new(4)
    model.wx, model.wh = [w.astype(float) for w in model.wx], [w.astype(float) for w in model.wh]
    model.wo, model.bo, model.moves = model.wo.astype(float), model.bo.astype(float), model.moves.astype(float)
    for w in model.parameters():
        w += rng.standard_normal(w.shape) * 0.3
    x, mask = rng.integers(40, 60, (3, 6)).astype(np.uint8), np.ones((3, 6), np.float32)
    mask[1, 4:] = 0
    tags = rng.integers(0, pii.TAGS, (3, 6)) * (mask > 0)
    _, gradients = pii.loss_and_gradients(model, x, mask, tags)
    for w, g in zip(model.parameters(), gradients, strict=True):
        at = tuple(rng.integers(0, s) for s in w.shape) if w.shape[0] != 128 else (int(x[0, 2]), 3)
        kept = w[at]
        w[at] = kept + 1e-3
        up = pii.loss_and_gradients(model, x, mask, tags)[0]
        w[at] = kept - 1e-3
        down = pii.loss_and_gradients(model, x, mask, tags)[0]
        w[at] = kept
        assert abs((up - down) / 2e-3 - g[at]) < 1e-3


def test_best_path_is_the_best_of_all(model):
    from itertools import product

    x, mask = pii.packed(["a1.2@"])
    scores, _ = pii.emissions(model, x[:, :4], mask[:, :4])
    best = max(product(range(pii.TAGS), repeat=4), key=lambda p: sum(scores[t, 0, k] for t, k in enumerate(p))
               + sum(model.moves[a, b] for a, b in zip(p, p[1:], strict=False)))
    assert tuple(pii.best_paths(model, x[:, :4], mask[:, :4])[0][0]) == best


def test_tagger_finds_held_out_spans(model):
    rng = random.Random(99)
    cases = [example(rng) for _ in range(150)]
    cases = [(t, s) for t, s in cases if s[0][2] < len(t)]
    found = pii.added_spans(model, [t for t, _ in cases], [[]] * len(cases))
    right = sum(f == s for f, (_, s) in zip(found, cases, strict=True))
    wrong = sum(1 for f, (_, s) in zip(found, cases, strict=True) for x in f if x not in s)
    assert right >= 0.7 * len(cases) and wrong <= 0.05 * len(cases)


def test_windows_without_digits_add_nothing(model):
    rng = random.Random(3)
    texts = [" ".join(example(rng)[0] for _ in range(4)) + " word" * 60 + " " + example(rng)[0] for _ in range(20)]
    base = [[]] * len(texts)
    assert pii.added_spans(model, texts, base) == pii.added_spans(model, texts, base, every=True)


def test_every_window_is_decoded(model, monkeypatch):
    seen = []

    def paths(tagger, x, mask):
        seen.extend("".join(map(chr, row[on > 0])) for row, on in zip(x, mask, strict=True))
        return np.zeros(x.shape, np.int64), np.zeros(x.shape, np.float32)

    monkeypatch.setattr(pii, "best_paths", paths)
    texts = ["only words " * 30 + "and an end", "", "short", "a number 7 " * 9]
    assert pii.added_spans(model, texts, [[]] * len(texts)) == [[]] * len(texts)
    starts = [[*range(0, max(0, len(t) - pii.WINDOW), pii.STEP), max(0, len(t) - pii.WINDOW)] for t in texts if t]
    assert seen == [t[s : s + pii.WINDOW] for t, own in zip(filter(None, texts), starts, strict=True) for s in own]


def test_an_address_in_words_is_added(model, monkeypatch):
    text = "words before it, then anna at example.org and more words " + "that go on and on " * 5
    start, end = text.index("anna"), text.index(" and more")

    def paths(tagger, x, mask):
        tags = np.zeros(x.shape, np.int64)
        tags[0, start:end], tags[0, start] = 2, 1
        return tags, np.zeros(x.shape, np.float32)

    monkeypatch.setattr(pii, "best_paths", paths)
    assert pii.added_spans(model, [text], [[]]) == [[(0, start, end)]]


def test_windows_of_words_are_learnt_from(spark):
    docs = spark.createDataFrame([(1, "nothing but words in this text, " * 8)], "doc_id long, text string")
    windows = pii.labelled_windows(docs)
    assert len(windows) == 6 and all(spans == [] for _, spans in windows)


def test_best_paths_of_many_windows_equal_plain_decoding():
    rng = np.random.default_rng(6)
    tagger = pii.Tagger.new()
    for w in tagger.parameters():
        w += rng.standard_normal(w.shape).astype(np.float32) * 0.4
    tagger.bo[0] += 2.5  # some rows stay outside
    x, mask = pii.packed(["".join(chr(c) for c in rng.integers(32, 127, size)) for size in [80] * 60 + [*range(1, 80, 3)]])
    scores, _ = pii.emissions(tagger, x, mask)
    assert np.allclose(pii.tag_scores(tagger, x, mask).transpose(0, 2, 1), scores, atol=1e-4)
    tags, sure = pii.best_paths(tagger, x, mask)
    forward, ahead, total = pii.sums(tagger, scores, mask)
    outside = 0
    for row, length in enumerate(mask.sum(axis=1).astype(int)):
        best, back = scores[0, row], []
        for t in range(1, length):
            step = best[:, None] + tagger.moves
            back.append(step.argmax(axis=0))
            best = step.max(axis=0) + scores[t, row]
        path = [int(best.argmax())]
        for places in back[::-1]:
            path.append(int(places[path[-1]]))
        path = path[::-1]
        assert tags[row, :length].tolist() == path
        outside += not any(path)
        if any(path):
            want = [(forward + ahead)[t, row, k] - total[row] for t, k in enumerate(path)]
            assert np.allclose(sure[row, :length], want, atol=1e-3)
    assert 0 < outside < len(x)


def test_reconciling():
    join = [(0, 10, 40, -0.1, True), (0, 30, 60, -0.1, True)]
    assert pii.reconciled(join) == [(0, 10, 60)]
    rivals = [(1, 0, 10, 0.0, False), (2, 8, 30, 0.0, False), (1, 31, 35, 0.0, False)]
    assert pii.reconciled(rivals) == [(2, 8, 30), (1, 31, 35)]
    assert pii.reconciled([(1, 0, 10, -50.0, False)]) == []


def test_documents(spark, model):
    texts = [None, "", "mail a.b@c.de now", "mail a.b@c.de now", "word " * 30000 + "1.2.3.4", "5 5"]
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, base int, lang string")
    rows = {r.doc_id: r for r in pii.find(docs, model).collect()}
    assert [tuple(s) for s in rows[2].base] == [("email", 5, 13)] == [tuple(s) for s in rows[3].base]
    assert rows[0].base == rows[1].base == [] and [tuple(s) for s in rows[4].base] == [("ip", 150000, 150007)]
    frame = spark.createDataFrame([(1, "to a.b@c.de!", 12), (2, None, None)], "doc_id long, text string, n_chars long")
    assert [tuple(r) for r in pii.redact(frame, None).orderBy("doc_id").collect()] == [(1, "to [EMAIL]!", 11), (2, None, None)]
    assert pii.find(docs.limit(0), model).count() == 0
    assert pii.labelled_windows(docs.limit(0)) == [] and pii.fit([]) is None
    windows = pii.labelled_windows(docs)
    assert [(0, 5, 13)] in [s for _, s in windows] and all(t[a:b] for t, s in windows for _, a, b in s)


def test_windows_are_those_of_the_hash_order(spark):
    docs = spark.range(400).selectExpr("id", "concat('call +1 555 01', 10000 + id, ' or mail a', id, '@b.org now and then, ', repeat(concat('n', id, ' '), 60)) AS text").repartition(6)
    found = pii.labelled_windows(docs, limit=40)
    every = pii.labelled_windows(docs, limit=1_000_000)
    assert len(found) == 60 and len(every) > 800
    rows = [(text, bool(spans)) for text, spans in every]
    order = spark.createDataFrame(rows, "text string, some boolean").selectExpr("text", "some", "xxhash64(text) AS h").collect()
    assert all(r.h == pii.hashed(r.text) for r in order)
    for some, count in ((True, 40), (False, 20)):
        want = sorted((r.h, r.text) for r in order if r.some == some)[:count]
        assert [text for text, spans in found if bool(spans) == some] == [text for _, text in want]


def test_what_a_span_must_hold():
    good = [(0, "john at example dot org"), (0, "j.d (at) a [dot] b.org"), (0, "a @ b . de"), (1, "10 dot 0[.]0 . 1"), (2, "4111.1111.1111.1111"), (3, "0049 30 1234567"), (3, "+49/30/123456")]
    bad = [(0, "look at it"), (0, "the dot"), (1, "1.2.3"), (1, "1.2.3.400"), (1, "1.2.3.4.5"), (2, "4111.1111.1111.1112"), (2, "4111"), (3, "2024-01-02 10"), (3, "+49 30")]
    assert all(pii.holds(*x) for x in good) and not any(pii.holds(*x) for x in bad)


def test_made_examples_are_labelled_windows():
    carriers = ["some words of a text, and more of them in a line that is long enough 1234", "short", ""]
    made = pii_examples.examples(carriers, 500, pii.WINDOW, 5)
    assert made == pii_examples.examples(carriers, 500, pii.WINDOW, 5) and len(made) > 480
    for text, spans in made:
        assert len(text) <= pii.WINDOW and all(pii.holds(kind, text[s:e]) for kind, s, e in spans if kind != 3), (text, spans)
    plain = {kind for text, spans in made for kind, s, e in spans if (kind, s, e) in pii.base_spans(text)}
    missed = {kind for text, spans in made for kind, s, e in spans if not pii.base_spans(text)}
    assert plain == missed == set(range(4)) and any(not spans for _, spans in made)
    assert pii_examples.examples([], 10, pii.WINDOW, 5)


def test_disguised_values_are_found_and_others_left(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
    text = lambda: " ".join(rng.choice((word(), word(), word(), str(rng.randint(1, 2000)))) for _ in range(60))
    model = pii.learn(spark.createDataFrame([(i, text()) for i in range(60)], "doc_id long, text string"))
    texts, put = [], []
    while len(texts) < 200:
        kind = len(texts) % 4
        value = pii_examples.KINDS[kind](rng, rng.randrange(1 << 16))
        if not pii.base_spans(value):
            whole, at = pii_examples.put_in(rng, text(), value)
            texts.append(whole)
            put.append((kind, at, at + len(value)))
    found = pii.added_spans(model, texts, [pii.base_spans(t) for t in texts])
    near = lambda a, b: a[0] == b[0] and min(a[2], b[2]) - max(a[1], b[1]) >= 0.8 * (b[2] - b[1])
    hits = sum(any(near(span, want) for span in spans) for spans, want in zip(found, put, strict=True))
    assert hits >= 150 and sum(map(len, found)) - hits <= 6
    clean = [text() for _ in range(100)]
    assert sum(map(len, pii.added_spans(model, clean, [pii.base_spans(t) for t in clean]))) <= 1
