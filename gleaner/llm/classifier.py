"""Quality classifier: histogram gradient-boosted trees over document statistics, in numpy.

``statistics`` turns each whole text into ``FEATURES`` numbers in one pass. ``fit`` bins them by quantiles of the
training rows and grows depth-wise trees on gradient histograms of the logistic loss; the trees are kept as flat
arrays, so a batch of rows is scored by indexing alone, one level at a time. Labels are learnt from at most
``MAX_ROWS`` labelled rows, chosen by a hash of their id; everything else covers all rows.

Defined results: null and empty texts have zeros as statistics and get a score as all others; repeated rows get equal
scores; labels other than 0 and 1 and labels without a document are not learnt; without any label, or with one value
only, the score is the share of that value with add-one smoothing; an empty table gives no row; other columns play no
part in a score. Rows are scored where they are; the model is about a hundred small arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import map_batches
from gleaner.operators.sampling import first_by
from gleaner.session import materialise

FEATURES = [
    "log_bytes", "log_words", "mean_word", "long_words", "short_words", "distinct_words", "top_word", "same_neighbours",
    "distinct_pairs", "log_lines", "mean_line", "dup_lines", "line_ends", "upper", "digits", "symbols", "punctuation",
    "marks", "pipes", "non_ascii", "upper_words", "symbol_words", "sentences", "max_word",
]
#: Labelled rows that training takes at most.
MAX_ROWS = 60_000
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
RIDGE = 1.0
LEAST = 20
_KIND = np.zeros((8, 256), bool)
for _row, _chars in enumerate(
    [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>@^~_=+{}[]\\/", b".,;:'\"()-", b"!?", b"|", bytes(range(128, 256)), b".!?"]
):
    _KIND[_row, list(_chars)] = True


def text_statistics(text: bytes) -> list[float]:
    """The statistics of one text, in the order of ``FEATURES``."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    size, n = len(text), len(words)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, digits, symbols, punctuation, marks, pipes, foreign, stops = (_KIND @ counts).tolist()
    lengths = np.fromiter(map(len, words), np.int64, n)
    distinct: dict[bytes, int] = {}
    for word in words:
        distinct[word] = distinct.get(word, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = [line for line in text.split(b"\n") if line.strip()]
    shouting = sum(map(bytes.isupper, words))
    plain = sum(map(bytes.isalpha, words))
    return [
        np.log1p(size), np.log1p(n), lengths.mean(), (lengths > 12).mean(), (lengths < 3).mean(), len(distinct) / n,
        max(distinct.values()) / n, same / n, pairs / max(n - 1, 1), np.log1p(len(lines)), n / len(lines),
        1 - len(set(lines)) / len(lines), sum(line.rstrip()[-1:] in b".!?" for line in lines) / len(lines), upper / size,
        digits / size, symbols / size, punctuation / size, marks / size, pipes / size, foreign / size, shouting / n,
        1 - plain / n, stops / n, np.log1p(lengths.max()),
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats): the statistics of every whole text as an array of floats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            table = np.array([text_statistics(t.as_py() or b"") for t in texts], np.float32).reshape(-1, len(FEATURES))
            offsets = pa.array(np.arange(len(table) + 1, dtype=np.int32) * len(FEATURES))
            stats = pa.ListArray.from_arrays(offsets, pa.array(table.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), stats], ["doc_id", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, stats array<float>")


@dataclass
class Forest:
    """Trees of one depth as flat arrays: node i of a tree has the children 2i + 1 and 2i + 2."""

    edges: list[np.ndarray]
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def binned(self, table: np.ndarray) -> np.ndarray:
        out = np.empty(table.shape, np.int16)
        for j, edges in enumerate(self.edges):
            out[:, j] = np.searchsorted(edges, table[:, j], side="left")
        return out

    def score(self, table: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        binned = self.binned(table)
        rows = np.arange(len(binned))
        total = np.full(len(binned), self.base)
        first_leaf = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(binned), np.int64)
            while len(node) and node[0] < first_leaf:
                node = 2 * node + 1 + (binned[rows, feature[node]] > threshold[node])
            total += value[node - first_leaf]
        return 1 / (1 + np.exp(-total))


def fit(table: np.ndarray, labels: np.ndarray) -> Forest:
    """Trees for rows of statistics and labels 0 and 1."""
    inner = 2**DEPTH - 1
    share = (labels.sum() + 1) / (len(labels) + 2)
    forest = Forest(
        [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) if len(column) else np.empty(0) for column in table.T],
        np.zeros((0, inner), np.int64), np.zeros((0, inner), np.int64), np.zeros((0, inner + 1)), float(np.log(share / (1 - share))),
    )
    if len(np.unique(labels)) < 2:
        return forest
    binned = forest.binned(table).astype(np.int64)
    total = np.full(len(labels), forest.base)
    trees = []
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-total))
        tree = _grow(binned, chance - labels, chance * (1 - chance), inner)
        total += tree[3]
        trees.append(tree[:3])
    forest.feature, forest.threshold, forest.value = (np.array(part) for part in zip(*trees, strict=True))
    return forest


def _grow(binned: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, inner: int) -> tuple:
    """One tree (features, thresholds, leaf values) and what it adds to each training row."""
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, BINS)
    node = np.zeros(len(binned), np.int64)
    width = binned.shape[1]
    for level in range(DEPTH):
        first, count = 2**level - 1, 2**level
        cell = (node - first)[:, None] * (width * BINS) + np.arange(width) * BINS + binned
        size = count * width * BINS
        shape = (count, width, BINS)
        g, h, n = (
            np.bincount(cell.ravel(), None if w is None else np.repeat(w, width), size).reshape(shape).cumsum(axis=2)
            for w in (gradient, curvature, None)
        )
        whole_g, whole_h, whole_n = g[:, :1, -1:], h[:, :1, -1:], n[:, :1, -1:]
        gain = g**2 / (h + RIDGE) + (whole_g - g) ** 2 / (whole_h - h + RIDGE) - whole_g**2 / (whole_h + RIDGE)
        gain = np.where((n >= LEAST) & (whole_n - n >= LEAST), gain, 0).reshape(count, -1)
        best = gain.argmax(axis=1)
        useful = gain[np.arange(count), best] > 1e-9
        feature[first : first + count] = np.where(useful, best // BINS, 0)
        threshold[first : first + count] = np.where(useful, best % BINS, BINS)
        node = 2 * node + 1 + (binned[np.arange(len(node)), feature[node]] > threshold[node])
    leaf = node - inner
    value = -RATE * np.bincount(leaf, gradient, inner + 1) / (np.bincount(leaf, curvature, inner + 1) + RIDGE)
    return feature, threshold, value, value[leaf]


def train(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Forest:
    """A forest from ``labels(doc_id, label)``; beyond ``max_rows`` rows those with the smallest id hash are taken."""
    rows = stats.join(labels.filter("label IN (0, 1)"), "doc_id").select("doc_id", "stats", F.col("label").cast("int"))
    taken = first_by(rows, max_rows, F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "label", "stats").toArrow()
    table = taken.column("stats").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return fit(table.reshape(-1, len(FEATURES)).astype(np.float32), taken.column("label").to_numpy().astype(np.float64))


def scored(stats: DataFrame, forest: Forest) -> DataFrame:
    """(doc_id, score) for every row of statistics."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(table))], ["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return map_batches(stats.select("doc_id", "stats"), run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every document, learnt from ``labels(doc_id, label)``."""
    stats = materialise(statistics(docs), "statistics")
    return scored(stats, train(stats, labels))
