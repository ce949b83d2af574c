import random
import re
from collections import Counter

import pytest

from gleaner.llm import phrases


def plain_counts(rows):
    counts = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", folded):
            words = re.findall("[^ \t]+", piece)
            counts[lang, 0, ""] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang, k, " ".join(words[i : i + k])] += 1
    return counts


def plain_ranking(counts, least, top):
    frequent = {key: n for key, n in counts.items() if key[1] and n >= least}
    out = []
    for lang in {key[0] for key in counts}:
        kept = []
        for (own, k, phrase), a in frequent.items():
            if own != lang or k < 2:
                continue
            words = phrase.split(" ")
            inside = lambda longer, words=words: any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
            if any(o == lang and n > k and 100 * b >= 80 * a and inside(p.split(" ")) for (o, n, p), b in frequent.items()):
                continue
            cuts = []
            for cut in range(1, k):
                l, r = (counts[lang, len(part), " ".join(part)] for part in (words[:cut], words[cut:]))  # noqa: E741
                cuts.append((2_000_000 * a // (l + r), cut, l, r))
            score, _, l, r = min(cuts)  # noqa: E741
            kept.append((-score, -a, phrase.encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, counts[lang, 0, ""], -score))
    return sorted(out)


def corpus(seed, size):
    rng = random.Random(seed)
    words = ["a", "B", "ß", "Éa", "the", "THE", "x#", "𝔘", "o", "\x00", " ", "n't", "zz"]
    breaks = [" ", "  ", "\t", ". ", "\n", ", ", "\x0b", "\r\n", "!", " "]
    rows = []
    for i in range(size):
        lang = rng.choice(["en", "de", None, "", "und"])
        text = "".join(rng.choice(words[: 4 + i % 9]) + rng.choice(breaks + [" "] * 20) for _ in range(rng.randrange(60)))
        rows.append((rng.choice([i, None, 3]), rng.choice([text, "the a Éa o zz o the a Éa o"]), lang))
    return [*rows, (0, None, "en"), (1, "", None), (2, " .. \n", "en")]


@pytest.mark.parametrize(("seed", "size", "least", "sample"), [(1, 200, 30, 8), (2, 120, 5, 3), (3, 80, 3, 1_000_000), (4, 80, 3, 1)])
def test_equal_to_brute_force_whatever_the_sample(spark, seed, size, least, sample):
    rows = corpus(seed, size)
    counts = plain_counts((lang, text) for _, text, lang in rows)
    docs = spark.createDataFrame([(*row, 5) for row in rows], "doc_id long, text string, lang string, n long").repartition(5)
    found = phrases.frequent(docs, least=least, sample=sample)
    got = [(r.lang, r.k, r.phrase, r.n) for r in found.collect()]
    assert sorted(got) == sorted((*key, n) for key, n in counts.items() if key[1] == 0 or n >= least)
    ranked = phrases.collocations(docs, 25, least=least, sample=sample)
    assert sorted(map(tuple, ranked.collect())) == plain_ranking(counts, least, 25)


def test_colliding_hashes_change_no_count(spark, monkeypatch):
    rows = corpus(5, 90)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = plain_counts((lang, text) for _, text, lang in rows)
    want = sorted((*key, n) for key, n in counts.items() if key[1] == 0 or n >= 4)
    # A map of a few bits: almost every hash collides with a proposed or a frequent one.
    monkeypatch.setattr(phrases, "MIN_BITS", 64)
    monkeypatch.setattr(phrases, "MAX_BITS", 64)
    monkeypatch.setattr(phrases, "BLOCK", 32)
    assert sorted((r.lang, r.k, r.phrase, r.n) for r in phrases.frequent(docs, least=4).collect()) == want


def test_a_further_pass_counts_only_what_the_older_map_did_not_take():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    chunk = " ".join(rng.choice(words) for _ in range(4000)).encode()
    seed = phrases._seed("en")
    each = {k: dict(zip(h.tolist(), n.tolist(), strict=True)) for k, h, n in phrases._tally(chunk, seed, None, None, 4)}

    def bits(share):
        out = phrases.np.zeros(1 << 17, "u1")
        for k in (1, 2, 3):
            for h in sorted(each[k])[: int(share * len(each[k]))]:
                at = h % (1 << 20)
                out[at // 8] |= 1 << at % 8
        return out

    flat = lambda found: [(k, h, n) for k, hashes, c in found for h, n in zip(hashes.tolist(), c.tolist(), strict=True)]
    old, new = bits(0.6), bits(1.0)
    first, more = flat(phrases._tally(chunk, seed, old, None, 4)), flat(phrases._tally(chunk, seed, new, old, 4))
    assert len(first) and len(more)
    assert sorted(first + more) == sorted((k, h, n) for k in each for h, n in each[k].items())


def test_heavy_parts_and_parts_of_a_ranking_change_nothing(spark):
    rows = corpus(6, 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = sorted(map(tuple, phrases.collocations(docs, 7, least=4).collect()))
    every = sorted(map(tuple, phrases.collocations(docs, 1000, least=4).collect()))
    assert [row for row in every if row[1] <= 7] == want and len(every) > 7 * 5
    found = phrases.frequent(docs, least=4)
    parts = found.filter("k = 1").selectExpr("lang", "phrase AS part", "explode(sequence(1, if(phrase = 'the', 3000, 1))) AS i")
    known = {(r.lang, r.phrase): r.n for r in found.filter("k = 1").collect()}
    looked = phrases._counts_of(parts, found).collect()
    assert len(looked) == parts.count() and all(r.f == known[r.lang, r.part] for r in looked)


@pytest.mark.parametrize("held", [100, 10_000])
def test_texts_are_cut_at_pieces(monkeypatch, held):
    monkeypatch.setattr(phrases, "CHUNK", 50)
    monkeypatch.setattr(phrases, "HELD", held)
    rows = [("en", b"a b c. " * 40), ("de", b""), ("en", b"x " * 60), ("fr", b"y"), ("de", b"z. z"), ("en", b"q")] * 3
    chunks = phrases._Chunks()
    found = [part for lang, text in rows for part in chunks.add(lang, text)] + list(chunks.rest())
    assert max(len(chunk) for _, chunk in found) < 180 and len(found) > 20 and list(chunks.rest()) == []
    words = lambda parts: sorted((lang, piece.split()) for lang, part in parts for piece in part.split(b"\n") if piece.split())
    assert words(found) == words([(lang, text.translate(phrases._FOLD)) for lang, text in rows])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.collocations(docs, 10).count() == 0
