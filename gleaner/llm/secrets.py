"""Secrets: base patterns, and a battery of randomness tests that adds keys no pattern names.

A candidate is a run of ``LEAST`` or more characters of the base64 alphabets (with its padding) that touches no base span and
has characters of two classes at least. Its encoding is inferred as the smallest alphabet that holds all its characters.
Three statistics are worked out on its symbols:

* the chi-squared statistic of a uniform alphabet,
* the number of runs of one character class (digits, small letters, capitals, signs),
* the serial correlation of neighbouring symbols.

Each gives two p-values. The first is that of the statistic for symbols drawn at random; the three are combined by
Fisher's method, and a candidate that is too unlikely (``CONFORM``) is not random. The second is the chance that ordinary
text of the same length, with the symbol pairs of the words of this corpus, looks as random as that; the three are combined
likewise. A short string can look random by chance, a long one hardly, so these values follow the length. They are judged by
the Benjamini-Hochberg rule at ``RATE`` within each encoding and class of lengths, so that among the spans added at most
that share is expected to be ordinary text, for short strings as for long ones.

The symbol pairs are counted over all documents (one small matrix), and so are the p-values (a histogram for each
encoding and class of lengths, ``BINS`` bins at most); p-values are rounded up to the next bin, which errs to the safe side.

Defined results: null and empty texts have no spans; offsets are code points, end exclusive; repeated rows give equal
spans; a corpus without any ordinary pair adds nothing; an empty table gives no row; other columns stay (``base``, ``added`` and
``candidates`` are replaced). Texts of any length are searched in linear time where they are; documents are read twice.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import map_batches
from gleaner.session import materialise

KINDS = ("assign", "access", "hex", "random")
RANDOM = KINDS.index("random")
#: Characters of a candidate at least.
LEAST = 20
#: Combined p-value below which symbols do not count as drawn at random.
CONFORM = 0.01
#: Share of ordinary text among the spans added.
RATE = 0.01
#: Lower ends of the classes of lengths.
LENGTHS = (LEAST, 24, 32, 40, 64, 128)
#: Bins of -log10 p, and their width.
BINS, WIDTH = 600, 0.05

_WORDS = ("password", "passwd", "secret", "token", "api_?key")
_ASSIGN = re.compile(
    "(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in _WORDS) + ")"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_HINT = re.compile(rb"password|passwd|secret|token|api_?key")
#: Both can only lie in runs of 16 such characters.
_LONG = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

Span = tuple[int, int, int]

_SYMBOLS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+-/_"
SIZE = len(_SYMBOLS)
_CLASS = np.array([0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3 for c in _SYMBOLS])
_CODE = np.full(256, SIZE, np.uint8)
_CODE[np.frombuffer(_SYMBOLS.encode(), np.uint8)] = np.arange(SIZE)
_IN_RUN = _CODE < SIZE
_IN_RUN[ord("=")] = True
#: The alphabets, smallest first, in their own order of symbols.
ENCODINGS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: The value of each symbol in each alphabet; -1: not in it.
_VALUE = np.array([[alphabet.find(c) for c in _SYMBOLS] for alphabet in ENCODINGS.values()])


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the base patterns, by start and kind."""
    found = []
    if _HINT.search(text.encode("utf-8", "surrogatepass").lower()):
        found += [(0, *m.span()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    for run in _LONG.finditer(text):
        found += [(1, *m.span()) for m in _ACCESS.finditer(text, *run.span()) if m.end() - m.start() >= 16]
        found += [(2, *m.span()) for m in _HEX.finditer(text, *run.span())]
    return sorted(found, key=lambda s: (s[1], s[0]))


# --- the battery ---


@dataclass
class Null:
    """Ordinary text over one alphabet: what the three statistics depend on."""

    same: float  # chance that two symbols are equal
    triple: float  # ... that three are
    change: float  # chance that the class changes from one symbol to the next
    serial: float  # correlation of neighbours
    known: bool = True


def _moments(pairs: np.ndarray, values: np.ndarray) -> Null:
    inside = np.flatnonzero(values >= 0)
    own = pairs[np.ix_(inside, inside)].astype(float)
    total = own.sum()
    if total < 1:
        return Null(1, 1, 0, 0, False)
    own /= total
    first, second, v = own.sum(1), own.sum(0), values[inside].astype(float)
    q = (first + second) / 2
    change = own[_CLASS[inside][:, None] != _CLASS[inside][None, :]].sum()
    mean1, mean2 = first @ v, second @ v
    spread = math.sqrt(max((first @ v**2 - mean1**2) * (second @ v**2 - mean2**2), 0))
    serial = (v @ own @ v - mean1 * mean2) / spread if spread > 0 else 0.0
    return Null(float((q**2).sum()), float((q**3).sum()), float(change), float(serial))


def nulls(pairs: np.ndarray) -> tuple[list[Null], list[Null]]:
    """For each encoding the moments of ordinary text, from counted pairs of symbols, and those of random symbols."""
    return [_moments(pairs, v) for v in _VALUE], [_moments(np.ones((SIZE, SIZE)), v) for v in _VALUE]


def _upper(z: float) -> float:
    """P(Z >= z) of a normal variable, never 0."""
    return max(0.5 * math.erfc(z / math.sqrt(2)), 1e-12)


def _at_least(k: int, n: int, share: float) -> float:
    """Chernoff's bound of P(X >= k) for a binomial variable, never 0; it holds at any length."""
    seen = k / n
    if seen <= share:
        return 1.0
    gap = seen * math.log(seen / share) + ((1 - seen) * math.log((1 - seen) / (1 - share)) if seen < 1 else 0.0)
    return max(math.exp(-n * gap), 1e-12)


def _fisher(*p: float) -> float:
    """The combined p-value of three independent ones: the upper tail of a chi-squared variable of six degrees."""
    x = -sum(map(math.log, p))
    return math.exp(-x) * (1 + x + x * x / 2)


def _equal_pairs(n: int, null: Null) -> tuple[float, float]:
    """Mean and spread of the number of equal pairs, on which the chi-squared statistic of n symbols depends linearly."""
    pairs = n * (n - 1) / 2
    variance = pairs * null.same * (1 - null.same) + n * (n - 1) * (n - 2) * (null.triple - null.same**2)
    return pairs * null.same, math.sqrt(max(variance, 1e-9))


@dataclass
class Verdict:
    encoding: int
    conform: float  # how well the symbols go with chance
    ordinary: float  # chance that ordinary text looks as random


def battery(token: str, ordinary: list[Null], chance: list[Null]) -> Verdict | None:
    """The tests of one candidate; None if no alphabet holds it or it is of one class of characters only."""
    symbols = _CODE[np.frombuffer(token.rstrip("=").encode(), np.uint8)]
    n = len(symbols)
    if n < LEAST or symbols.max() >= SIZE:
        return None
    classes = _CLASS[symbols]
    fits = np.flatnonzero((_VALUE[:, symbols] >= 0).all(axis=1))
    if not len(fits) or (classes == classes[0]).all():
        return None
    encoding = int(fits[0])
    null, even = ordinary[encoding], chance[encoding]
    values = _VALUE[encoding][symbols].astype(float)
    counts = np.bincount(symbols)
    equal = float((counts * (counts - 1)).sum() / 2)
    runs = int((classes[1:] != classes[:-1]).sum())
    a, b = values[:-1] - values[:-1].mean(), values[1:] - values[1:].mean()
    spread = math.sqrt(float((a @ a) * (b @ b)))
    serial = float(a @ b) / spread if spread > 0 else 1.0

    mean, sd = _equal_pairs(n, even)
    run_sd = math.sqrt((n - 1) * even.change * (1 - even.change))
    conform = _fisher(
        _upper((equal - mean) / sd),
        min(1.0, 2 * _upper(abs(runs - (n - 1) * even.change) / run_sd)),
        min(1.0, 2 * _upper(abs(serial + 1 / (n - 1)) * math.sqrt(n - 1))),
    )
    if not null.known:
        return Verdict(encoding, conform, 1.0)
    mean, sd = _equal_pairs(n, null)
    change = min(max(null.change, 1 / n), 1 - 1 / n)  # classes that never change in this corpus may do so by chance
    away = null.serial - serial if null.serial > 0 else serial - null.serial
    text = _fisher(
        _upper((mean - equal) / sd),
        _at_least(runs, n - 1, change),
        _upper(away * math.sqrt(n - 1) / max(1 - null.serial**2, 0.1)),
    )
    return Verdict(encoding, conform, text)


# --- over all documents ---


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a batch and where each begins (one more at the end)."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def _runs(inside: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; no run crosses a border."""
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0) != 0
    cut = borders[(borders > 0) & (borders < len(inside))]
    joined = cut[inside[cut] & inside[cut - 1]]
    points = np.flatnonzero(edge)
    starts, ends = points[::2], points[1::2]
    return np.sort(np.concatenate([starts, joined])), np.sort(np.concatenate([ends, joined]))


def pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of neighbouring symbols in runs that are too short to be a candidate, counted by task."""
    total = np.zeros(SIZE * SIZE, np.int64)
    for batch in batches:
        data, offsets = _buffer(batch.column("text"))
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        starts, ends = _runs(_IN_RUN[data], np.unique(offsets))
        short = ends - starts < LEAST
        starts, ends = starts[short], ends[short]
        # One step up where a run begins and one down before its last symbol: the sum marks the first of each pair.
        marks = np.zeros(len(data) + 1, np.int8)
        marks[starts] += 1
        marks[ends - 1] -= 1
        at = np.flatnonzero(np.cumsum(marks[:-1], dtype=np.int8))
        left, right = _CODE[data[at]].astype(np.int64), _CODE[data[at + 1]].astype(np.int64) if len(at) else np.zeros(0, np.int64)
        known = (left < SIZE) & (right < SIZE)
        total += np.bincount(left[known] * SIZE + right[known], minlength=SIZE * SIZE)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"pair": pa.array(seen, pa.int32()), "n": pa.array(total[seen], pa.int64())})


def ordinary_pairs(docs: DataFrame) -> np.ndarray:
    """The matrix of symbol pairs in the ordinary words of all documents; the driver gets one row per pair."""
    rows = map_batches(docs.select(F.coalesce("text", F.lit("")).alias("text")), pair_counts, "pair int, n long")
    out = np.zeros(SIZE * SIZE, np.int64)
    for row in rows.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[row["pair"]] = row["n"]
    return out.reshape(SIZE, SIZE)


def _candidates(text: str, base: list[Span], ordinary: list[Null], chance: list[Null]) -> Iterator[tuple[int, int, int, int, int]]:
    """(start, end, encoding, class of lengths, bin of the p-value) of all candidates; what does not go with chance is in the first bin."""
    # Base spans by start, and the furthest end up to each of them.
    starts = [start for _, start, _ in base]
    reach = np.maximum.accumulate([end for _, _, end in base]) if base else []
    for run in _LONG.finditer(text):
        for token in _TOKEN.finditer(text, *run.span()):
            start, end = token.span()
            before = bisect_left(starts, end)
            if end - start < LEAST or (before and reach[before - 1] > start):
                continue
            verdict = battery(token[0], ordinary, chance)
            if verdict:
                p = verdict.ordinary if verdict.conform >= CONFORM else 1.0
                yield start, end, verdict.encoding, bisect_right(LENGTHS, end - start) - 1, min(BINS - 1, int(-math.log10(max(p, 1e-300)) / WIDTH))


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_CANDIDATE = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "end", "encoding", "length", "bin")])


def candidates(docs: DataFrame, pairs: np.ndarray) -> DataFrame:
    """``docs`` with ``base`` spans and ``candidates`` in place of the text; all other columns stay."""
    ordinary, chance = nulls(pairs)
    rows = docs.drop("base", "candidates").withColumn("text", F.coalesce("text", F.lit("")))
    others = rows.drop("text")
    schema = T.StructType([*others.schema.fields, T.StructField("base", T.ArrayType(_SPAN)), T.StructField("candidates", T.ArrayType(_CANDIDATE))])

    def search(text: str, long: bool) -> tuple[list[dict], list[dict]]:
        base = base_spans(text)
        found = _candidates(text, base, ordinary, chance) if long else ()
        return (
            [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in base],
            [dict(zip(_CANDIDATE.names, row, strict=True)) for row in found],
        )

    types = [pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.struct([(n, pa.int64()) for n in _CANDIDATE.names]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _buffer(batch.column("text"))
            starts, ends = _runs(_IN_RUN[data[offsets[0] : offsets[-1]]], np.unique(offsets - offsets[0]))
            at = starts[ends - starts >= 16] + offsets[0]
            long = set((np.searchsorted(offsets, at, "right") - 1).tolist())
            base, found = [[]] * batch.num_rows, [[]] * batch.num_rows
            raw = data.tobytes()
            for i in range(batch.num_rows):
                own = raw[offsets[i] : offsets[i + 1]]
                if i in long or _HINT.search(own.lower()):
                    base[i], found[i] = search(own.decode("utf-8", "replace"), i in long)
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(base, types[0]), pa.array(found, types[1])], names=schema.names)

    return map_batches(rows, run, schema)


def accepted(found: DataFrame) -> dict[tuple[int, int], int]:
    """For each encoding and class of lengths the least bin that the Benjamini-Hochberg rule accepts."""
    counted = found.select(F.explode("candidates").alias("c")).groupBy("c.encoding", "c.length", "c.bin").count().collect()
    strata: dict[tuple[int, int], dict[int, int]] = {}
    for row in counted:
        strata.setdefault((row["encoding"], row["length"]), {})[row["bin"]] = row["count"]
    out = {}
    for key, bins in strata.items():
        total, above = sum(bins.values()), 0
        for place in sorted(bins, reverse=True):
            above += bins[place]
            # The greatest p-value of a bin stands for all of it.
            if 10 ** (-place * WIDTH) <= RATE * above / total:
                out[key] = place
    return out


def find(docs: DataFrame) -> DataFrame:
    """``docs`` without the text, with ``base`` and ``added``: arrays of (kind, start, end) by start and kind."""
    found = materialise(candidates(docs.drop("added"), ordinary_pairs(docs)), "candidates")
    least = accepted(found)
    strata = [(F.lit(key[0]), F.lit(key[1]), F.lit(place)) for key, place in sorted(least.items())]
    taken = lambda c: F.coalesce(*(
        F.when((c["encoding"] == e) & (c["length"] == n), c["bin"] >= place) for e, n, place in strata
    ), F.lit(False))
    spans = F.transform(F.filter("candidates", taken), lambda c: F.struct(F.lit(KINDS[RANDOM]).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return found.withColumn("added", spans).drop("candidates")
