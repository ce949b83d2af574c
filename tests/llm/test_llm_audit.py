import random
import re
from itertools import permutations

import pytest

from gleaner.llm import filter_audit


def plain_audit(docs, labels):
    smallest = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    failing = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": doc_id is not None and smallest[text] < doc_id,
        }
        failing.append((lang or "", doc_id, {x for x in fails if fails[x]}))
    out = {}
    for part in {lang for lang, _, _ in failing}:
        own = [(d, f) for lang, d, f in failing if lang == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for i, x in enumerate(order):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                shapley[x] += len(gone)
                out[part, "".join(order), i + 1] = [
                    len(left), len(gone), sum(x in f for _, f in own) - len(gone), sum(f == {x} for _, f in own),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def corpus(seed, size):
    rng = random.Random(seed)
    texts = [None, "", "A", "a # b", "x " * 120, " ".join(f"w{i}" for i in range(120)), " ".join(f"W{i}" for i in range(130)), " ü", " ".join(f"v{i}" for i in range(110)) + " $"]
    docs = [(rng.choice([i, None, 5]), rng.choice([*texts, f"text {i} | x"]), rng.choice(["en", "de", None, ""])) for i in range(size)]
    labels = [(rng.choice([i, None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(size) for _ in range(rng.randrange(3))]
    return docs, labels


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.mark.parametrize(("seed", "spread", "small"), [(1, False, True), (2, True, True), (3, True, False)])
def test_audit_equals_brute_force(spark, monkeypatch, seed, spread, small):
    if spread:
        monkeypatch.setattr(filter_audit, "COPIES", 5)
    if not small:
        monkeypatch.setattr(filter_audit, "BROADCAST_IDS", 0)
    docs, labels = corpus(seed, 250)
    rows = spark.createDataFrame([(*row, 1) for row in docs], "doc_id long, text string, lang string, h long").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(filter_audit.combinations(rows, marks)).collect()
    assert {(r.part, r.filter_order, r.step): [r[c] for c in COLUMNS] for r in found} == plain_audit(docs, labels)


def test_the_copies_of_one_text_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "COPIES", 50)
    docs = spark.range(1000).selectExpr("id AS doc_id", "'en' AS lang", "if(id % 3 = 0, 'one text', concat('other ', id)) AS text")
    ids = filter_audit._hashed(docs).select("doc_id", "h")
    found = filter_audit.copies(docs, ids)
    assert sorted(r.doc_id for r in found.collect()) == list(range(3, 1000, 3))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.combinations(docs, labels)).count() == 0
