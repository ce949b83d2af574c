import math
import re
import textwrap
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gleaner.llm import licences, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, covered, lines, dup = Counter(windows), set(), set(), 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered.update(range(i, i + 8))
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, r, n < 20 or 100 * r > 30 * n


TEXTS = [
    None, "", " \t\n\r\x0b\x0c ", "one", "a b c d e f g h " * 3, "a b c d e f g h a b c d e f g h", "x\ny\nx\n x\n\n \nx", "#*$ %& <|> é😀 ü",
    " ".join(map(str, range(40))), " ".join(map(str, range(40))) + " " + " ".join(map(str, range(9, 21))), "x " * 30,
    "1 2 3 4 5 6 7 8 9 x y 1 2 3 4 5 6 7 8 9 z " * 2, "a b c d", "w " * 5000,
]


def test_counts_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for row in quality_rules.counts(docs).collect():
        assert tuple(row[n] for n in names) == plain_counts(TEXTS[row.doc_id]), TEXTS[row.doc_id]


def test_halves_of_windows_may_repeat_where_no_window_does(spark):
    texts = [
        "a b c d e f g h 1 a b c d 2 e f g h", "a b c d " * 2, "a b c d " * 3, "\x0b a\tb  c\r\nd\n\ne f g h\x0ca b c d e f g h \n", "a\u00a0b\u3000c \x1c d",
        " ".join(f"w{i % 7}" for i in range(40)), " ".join(f"w{i}" for i in range(7)), " ".join(f"w{i % 9 if i < 20 else i}" for i in range(60)), "a a a a a a a a", "a a a a a a a a a",
    ]
    docs = spark.createDataFrame([*enumerate(texts), (None, "")], "doc_id long, text string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = quality_rules.counts(docs)
    assert not [c for c in found.columns if c.startswith("_")] and found.count() == len(texts) + 1
    for row in found.filter("doc_id IS NOT NULL").collect():
        assert tuple(row[n] for n in names) == plain_counts(texts[row.doc_id]), texts[row.doc_id]


def test_likelihood_ratio_equals_brute_force(spark):
    texts = ["the cat sat on the mat %%% !!"] * 3 + ["THE!! CAT!! 12 é_x ???", None, "", "a"]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, llr double")
    trusted = spark.createDataFrame([(0,), (1,), (1,), (99,), (None,)], "doc_id long")
    buckets = 64
    token = re.compile(r"\w+|[^\w\s]+")
    grams = {i: (lambda t: [(x,) for x in t] + list(zip(t, t[1:], strict=False)))(token.findall(t or "")) for i, t in enumerate(texts)}
    every = sorted({g for gs in grams.values() for g in gs})
    cell = {}
    for size in (1, 2):
        rows = [g for g in every if len(g) == size]
        frame = spark.createDataFrame(rows, ", ".join(f"c{k} string" for k in range(size)))
        hashed = frame.select(*frame.columns, F.pmod(F.xxhash64(*frame.columns), F.lit(buckets)).alias("cell"))
        cell |= {tuple(r)[:-1]: r.cell for r in hashed.collect()}
    raw = Counter(cell[g] for gs in grams.values() for g in gs)
    target = Counter(cell[g] for i in (0, 1) for g in grams[i])
    share = lambda c, x: math.log((c[x] + 1) / (sum(c.values()) + buckets))
    weight = {x: round(1000 * (share(target, x) - share(raw, x))) for x in range(buckets)}
    found = {r.doc_id: r for r in quality_rules.judge(docs, trusted, buckets, 0.0).collect()}
    assert len(found) == len(texts)
    for i, gs in grams.items():
        want = sum(weight[cell[g]] for g in gs) / (1000 * len(gs)) if gs else 0.0
        assert abs(found[i].llr - want) < 1e-12 and found[i].kept is False


def test_weights_of_ngrams_do_not_run_together_as_the_corpus_grows(spark):
    text = lambda name: " ".join(f"{name}x{k}" for k in range(400))
    texts = [text(f"good{i % 60}") for i in range(600)] + [text(f"junk{i % 50}") for i in range(400)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trusted = spark.range(300).withColumnRenamed("id", "doc_id")
    # Each of 110 texts has 799 n-grams of its own: 87,890, five times what there once were cells.
    assert quality_rules.weights(docs, trusted).count() == 110 * 799
    found = {r.doc_id: r for r in quality_rules.judge(docs, trusted).collect()}
    assert len(found) == len(texts)
    assert all(found[i].kept for i in range(600)) and not any(found[i].kept for i in range(600, 1002))
    assert {found[i].llr for i in range(600, 1000)} == {found[600].llr}


def test_rare_ngrams_are_joined_as_frequent_ones_are_looked_up(spark, monkeypatch):
    rows = [(0, "a b c a b"), (1, "a b c a b"), (2, "x y z " * 9), (3, "a"), (4, "!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(0,)], "doc_id long")
    near = {r.doc_id: r.llr for r in quality_rules.scores(docs, trusted).collect()}
    monkeypatch.setattr(quality_rules, "SLOTS", 1)
    assert near == {r.doc_id: r.llr for r in quality_rules.scores(docs, trusted).collect()} and near[0] == near[1] > near[2]


def plain_verdicts(spark, texts, good, buckets):
    """(ratio, kept) of each text as the registered query defines them."""
    token = re.compile(r"\w+|[^\w\s]+")
    grams = [(lambda t: [(x,) for x in t] + list(zip(t, t[1:], strict=False)))(token.findall(t or "")) for t in texts]
    cell = {}
    for size in (1, 2):
        rows = sorted({g for gs in grams for g in gs if len(g) == size})
        frame = spark.createDataFrame(rows, ", ".join(f"c{k} string" for k in range(size)))
        hashed = frame.select(*frame.columns, F.pmod(F.xxhash64(*frame.columns), F.lit(buckets)).alias("cell"))
        cell |= {tuple(r)[:-1]: r.cell for r in hashed.collect()}
    raw, target = Counter(cell[g] for gs in grams for g in gs), Counter(cell[g] for i in good for g in grams[i])
    share = lambda c, x: math.log((c[x] + 1) / (sum(c.values()) + buckets))
    weight = {x: round(1000 * (share(target, x) - share(raw, x))) for x in raw}
    ratio = [sum(weight[cell[g]] for g in gs) / (len(gs) * 1000) if gs else 0.0 for gs in grams]
    passed = [not plain_counts(t)[5] for t in texts]
    middle = lambda values: sorted(values)[len(values) // 2]
    units = [round(1000 * r) for r, ok in zip(ratio, passed, strict=True) if ok]
    spread = max(quality_rules.LEAST_SPREAD, middle([abs(u - middle(units)) for u in units]))
    edge = (middle(units) - quality_rules.SPREADS * spread) / 1000
    return [(r, ok and r >= edge) for r, ok in zip(ratio, passed, strict=True)]


def test_the_registered_form_equals_brute_force(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    text = lambda seed, pool: " ".join(pool[(seed * 7 + k * k * (seed + 3)) % len(pool)] + ".!"[k % 2] * (k % 5 == 0) for k in range(25 + seed % 60))
    texts = [text(i, words) for i in range(150)] + [text(i, [f"z{i}{w}%" for w in words]) for i in range(30)] + [None, "", "one", "a " * 40]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n int").repartition(4)
    trusted = spark.range(60).withColumnRenamed("id", "doc_id")
    monkeypatch.setattr(quality_rules, "LEAST_CELLS", 64)
    buckets = quality_rules.cell_count(docs)
    assert buckets == sum(len(t or "") for t in texts) // quality_rules.CHARS_A_CELL > 64
    assert quality_rules.cell_count(docs.limit(1)) == 64
    want = plain_verdicts(spark, texts, range(60), buckets)
    assert 0 < sum(kept for _, kept in want) < 180
    for limit in (1 << 24, 0):  # looked up in an array, or joined
        monkeypatch.setattr(quality_rules, "ARRAY_CELLS", limit)
        found = {r.doc_id: (r.llr, r.kept) for r in quality_rules.judge(docs, trusted, buckets).collect()}
        assert [found[i][1] for i in range(len(texts))] == [kept for _, kept in want]
        assert all(abs(found[i][0] - ratio) < 1e-9 for i, (ratio, _) in enumerate(want))


def test_cells_are_counted_as_dataframe_functions_count_them(spark, monkeypatch):
    odd = ["\u00e9t\u00e9 \U0001f600\U0001f600! x_y 12\u00b2 \u4e2d\u6587", None, "", " \n", "a", "don't stop!! " * 50]
    texts = [f"some words of text {i % 7}, and {i}" for i in range(50)] + odd
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    trusted = docs.select("doc_id").filter("doc_id % 3 = 0")
    for buckets, held, block in ((1 << 16, 6_000_000, 1 << 16), (100_003, 40, 3)):
        monkeypatch.setattr(quality_rules, "HELD", held)
        monkeypatch.setattr(quality_rules, "BLOCK", block)
        want = {tuple(r) for r in quality_rules.weights(docs, trusted, buckets).collect()}
        weighed = quality_rules.cell_weights(quality_rules.cell_sums(docs, trusted, buckets), buckets)
        found = quality_rules.weight_rows(weighed, buckets).collect()
        assert len(found) == len(want) and {tuple(r) for r in found} == want
        array = quality_rules.weight_array(weighed, buckets)
        assert len(array) == buckets and all(array[cell] == weight for cell, _, weight in want)
        plan = quality_rules.scores_in_place(docs, array)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1  # that of the test's own repartition


def test_the_registered_form_runs_no_python_and_equals_the_arrow_form(spark, monkeypatch):
    odd = ["\u00e9t\u00e9 \U0001f600\U0001f600! x_y 12\u00b2 \u4e2d\u6587", None, "", " \n", "a", "don't stop!! " * 50, "don't stop!! " * 50]
    texts = [f"some words of text {i % 7}, and {i} " * (1 + i % 9) for i in range(200)] + odd
    docs = spark.createDataFrame([*enumerate(texts), (None, "some words"), (3, "some words"), (3, "some words")], "doc_id long, text string").repartition(3)
    trusted = docs.select("doc_id").filter("doc_id % 3 = 0")
    monkeypatch.setattr(quality_rules, "SAMPLE", 1.0)
    key = lambda r: (r[0] is None, *r)
    for buckets, share, keys in ((1 << 16, 1, 1 << 20), (100_003, 1024, 2), (100_003, 100_000, 1 << 20)):
        monkeypatch.setattr(quality_rules, "SHARE", share)
        monkeypatch.setattr(quality_rules, "LISTS_IN_MEMORY", (quality_rules.LISTS_IN_MEMORY[0], keys))
        before = spark.conf.get(quality_rules.LISTS_IN_MEMORY[0])
        found = quality_rules.scores(docs, trusted, buckets)
        assert spark.conf.get(quality_rules.LISTS_IN_MEMORY[0]) == before
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Arrow" not in plan and "Python" not in plan
        want = quality_rules.scores(docs, trusted, buckets, arrow=True).select(found.columns)
        assert sorted(map(tuple, found.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_frequent_cells_are_counted_and_others_listed(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "the " * 30 + f"w{i} of{i}") for i in range(60)] + [(None, None)], "doc_id long, text string").repartition(4)
    trusted = docs.select("doc_id").filter("doc_id < 20")
    monkeypatch.setattr(quality_rules, "SAMPLE", 1.0)
    buckets = 1 << 17
    plain = quality_rules.ngram_rows(docs, trusted, buckets).groupBy("cell").agg(F.count("*").alias("raw"), F.sum("target").alias("target"))
    want = {tuple(r) for r in plain.collect()}
    for share, alone in ((1, 2), (100_000, 2), (0.0001, 0)):  # "the" and "the the" have nearly all, until a cell must have more than there are
        monkeypatch.setattr(quality_rules, "SHARE", share)
        frequent = quality_rules.frequent_cells(docs, buckets)
        listed = quality_rules.listed_cells(quality_rules.ngram_rows(docs, trusted, buckets), frequent)
        rows = listed.collect()
        assert sum(r["key"] < 0 for r in rows) == frequent.count() and (frequent.count() >= alone if alone else frequent.count() == 0)
        assert all(not r["places"] for r in rows if r["key"] < 0)
        assert {r["cell"]: (r["raw"], r["target"]) for r in quality_rules.tally_of_lists(listed).collect()} == {c: (n, t) for c, n, t in want}
        plan = quality_rules.tally_of_lists(listed)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1


def test_lists_of_weights_have_gaps_filled(spark):
    wide = quality_rules.LIST
    rows = [(3, 1, -7), (0, 2, 5), (wide - 1, 1, 9), (wide, 4, -32000), (5 * wide + 2, 1, 1)]
    found = {r["piece"]: r["weights"] for r in quality_rules.weight_lists(spark.createDataFrame(rows, "cell long, raw long, weight int")).collect()}
    assert set(found) == {0, 1, 5} and found[1] == [-32000] and found[5] == [0, 0, 1]
    assert found[0] == [5, 0, 0, -7] + [0] * (wide - 5) + [9]


def test_pieces_hold_any_counts():
    cells = np.array([5, 5, 5, 70_000, 70_001, 131_071, 5, 400_000], np.int64)
    target = np.array([1, 0, 1, 0, 1, 1, 0, 0], np.int64)
    sums = {}
    for part in (slice(0, 5), slice(5, 8)):
        for piece, counts in quality_rules.packed_pieces(cells[part] * 2 + target[part], 1 << 16):
            quality_rules.add_piece(sums.setdefault(piece, np.zeros((2, 1 << 16), np.int64)), counts)
    got = {p * 65536 + int(i): (int(s[0, i]), int(s[1, i])) for p, s in sums.items() for i in np.flatnonzero(s[0])}
    assert got == {5: (4, 2), 70_000: (1, 0), 70_001: (1, 1), 131_071: (1, 1), 400_000: (1, 0)}


def test_rules_on_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    found = quality_rules.judge(docs, spark.createDataFrame([], "doc_id long"))
    assert found.count() == 0 and "Python" not in found._jdf.queryExecution().toString()
    found = quality_rules.judge(docs, spark.createDataFrame([], "doc_id long"), quality_rules.cell_count(docs))
    assert found.count() == 0


def test_canonical_forms(spark):
    mit = licences.TEXTS["MIT"]
    variants = [
        mit, mit.upper(), "Copyright (c) 2024 Somebody\n" + mit, mit.replace("sublicense", "sublicence").replace(",", " ,\n"),
        "© 1999 X\n  (C) Y\nAll rights reserved.\n" + mit + "\n\n",
    ]
    other = [mit + " extra", None, "", "...", licences.TEXTS["0BSD"], licences.TEXTS["ISC"], mit]
    texts = variants + other
    docs = spark.createDataFrame([(i, t, "y") for i, t in enumerate(texts)], "doc_id long, text string, digest string")
    found = {r.doc_id: r for r in licences.scan_documents(docs, licences.known_texts(spark), licences.known_notices(spark)).collect()}
    got = [found[i].licence_id for i in range(len(texts))]
    assert got == ["MIT"] * 5 + [None] * 4 + ["0BSD", "ISC", "MIT"]


def test_known_texts_at_any_width(spark):
    wrapped = [
        (name, "Copyright (c) 2024 Somebody\nCopyright 2019-2021 X\nCopyright © Y\nCopyright [yyyy] [name]\n\n"
         + "\n".join(textwrap.fill(line, width, break_on_hyphens=False) for line in text.split("\n")))
        for name, text in licences.TEXTS.items() for width in range(20, 121)
    ]
    # Some of these widths put the word at the start of a line.
    assert sum("\ncopyright" in text or "\nCOPYRIGHT" in text for _, text in wrapped) > 10
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(wrapped)], "doc_id long, text string")
    found = {r.doc_id: r.licence_id for r in licences.scan_documents(docs, licences.known_texts(spark), licences.known_notices(spark)).collect()}
    assert [found[i] for i in range(len(wrapped))] == [name for name, _ in wrapped]


def test_whole_texts_with_and_without_titles(spark):
    body = licences.TEXTS["MIT"].split("\n", 1)[1]
    grant = licences.BSD_GRANT.format("1. ", "2. ")
    apache, gpl = map(licences.long_text, ("Apache-2.0", "GPL-3.0"))
    rows = [
        ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 X\n\n" + body), ("MIT", "Copyright (c) 2020 X\n\n" + body),
        ("BSD-2-Clause", "Copyright (c) 2020, X\nAll rights reserved.\n\n" + grant + licences.BSD_WARRANTY), ("WTFPL", licences.WTFPL),
        ("Apache-2.0", apache), ("Apache-2.0", apache[: apache.index("APPENDIX")]), ("GPL-3.0", gpl), (None, gpl[:2000]), (None, grant),
        *((name, licences.long_text(name).upper()) for name in ("GPL-2.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0")),
    ]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r.licence_id for r in licences.scan_documents(docs, licences.known_texts(spark), licences.known_notices(spark)).collect()}
    assert [found[i] for i in range(len(rows))] == [name for name, _ in rows]


def test_notices_by_line(spark):
    texts = ["text\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0", "released UNDER the  mit licence", "not released under the MIT License", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.notices for r in licences.scan_documents(docs, licences.known_texts(spark), licences.known_notices(spark)).collect()}
    assert found == {0: "CC-BY-NC-4.0,MIT", 1: "MIT", 2: None, 3: None}
    assert licences.scan_documents(docs.limit(0), licences.known_texts(spark), licences.known_notices(spark)).count() == 0


def found_licences(spark, rows):
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r.licence_id for r in licences.scan_documents(docs, licences.known_texts(spark), licences.known_notices(spark)).collect()}
    return [found[i] for i in range(len(rows))]


def test_every_known_form_wrapped_and_refilled(spark):
    def paragraphs(text, width):
        return "\n\n".join(
            textwrap.fill(" ".join(part.split()), width, break_on_hyphens=False, break_long_words=False) for part in re.split(r"\n\s*\n", text) if part.strip()
        )

    rows = []
    for name, text in licences.known_forms():
        for width in (40, 50, 60, 72, 79, 100, 120):
            lines = "\n".join(textwrap.fill(line, width, break_on_hyphens=False, break_long_words=False) for line in text.split("\n"))
            rows += [(name, lines), (name, paragraphs(text, width))]
        rows.append((name, paragraphs(text, 1_000_000)))
    wrong = {(name, text[:60]) for (name, text), got in zip(rows, found_licences(spark, rows), strict=True) if got != name}
    assert not wrong


def test_notices_behind_marks_and_in_other_words(spark):
    body = licences.TEXTS["MIT"].split("\n", 1)[1]
    notices = (
        "Copyright John Doe 2020", "Copyright, 2020 X", "# Copyright (c) 2020 X", " * Copyright (c) X", "// Copyright 2020 X", "Portions Copyright (c) X",
        "Copyright <YEAR> <HOLDER>", "(c) 2020 Somebody, Inc.", "(C) John Doe", "© X and others", "Copyright year name", "All Rights Reserved.",
    )
    rows = [("MIT", f"{notice}\n\n{body}") for notice in notices]
    rows += [(None, f"Copyright holders agree to all of it\n{body}"), (None, f"(c) You must retain, in the Source form of any\n{body}")]
    assert found_licences(spark, rows) == [name for name, _ in rows]


def test_long_texts_come_out_of_a_zip(tmp_path):
    import subprocess
    import sys

    from gleaner import session

    archive = session.pack(tmp_path / "gleaner.zip")
    code = "from gleaner.llm import licences; print(licences.__file__, len(licences.known_forms()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(archive), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True, check=False)
    assert "gleaner.zip" in out.stdout and out.stdout.split()[-1] == str(len(licences.known_forms())), out.stderr
