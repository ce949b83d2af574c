"""Chunking: character windows, token windows, recursive splitting, semantic chunks."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import sentences, words
from gleaner.functions.vectors import list_lengths, md5_buckets, token_buckets

# Separators from coarse to fine.
SEPARATORS = ["\n\n", "\n", " ", ""]
TEXTS = 200  # texts that are split before their chunks are handed on


def fixed_windows(docs: DataFrame, size: int, overlap: int, keys: list[str], text: str = "text") -> DataFrame:
    """Character windows: ``keys, chunk_id, chunk_text, start``. Whole texts, no UDF, no shuffle.

    The windows are cut inside the row, so the exploded rows do not carry the text along.
    """
    step = size - overlap
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - overlap, F.lit(1)), F.lit(step))
    windows = F.when(F.length(text) > 0, F.transform(starts, lambda i: F.substr(text, i, F.lit(size))))
    return docs.select(*keys, F.posexplode(windows).alias("chunk_id", "chunk_text")).withColumn(
        "start", F.col("chunk_id") * step
    )


def token_windows(docs: DataFrame, size: int, overlap: int, keys: list[str], text: str = "text") -> DataFrame:
    """Windows of ``size`` words that overlap by ``overlap`` words."""
    step = size - overlap
    tokenised = docs.select(*keys, words(F.col(text)).alias("tokens"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("tokens") - overlap, F.lit(1)), F.lit(step))
    cut = F.transform(starts, lambda i: F.concat_ws(" ", F.slice("tokens", i, F.lit(size))))
    windows = F.when(F.size("tokens") > 0, cut)
    return tokenised.select(*keys, F.posexplode(windows).alias("chunk_id", "chunk_text")).withColumn(
        "start", F.col("chunk_id") * step
    )


def split_recursive(text: str, size: int, overlap: int, separators: list[str]) -> list[str]:
    """Split one text at the coarsest separator present and merge pieces up to ``size`` characters."""
    present = [s for s in separators if s == "" or s in text]
    separator = present[0] if present else ""
    finer = separators[separators.index(separator) + 1 :] if present else []
    pieces = [p for p in (text.split(separator) if separator else list(text)) if p]
    chunks: list[str] = []
    window: deque[str] = deque()
    width = 0

    def flush() -> None:
        merged = separator.join(window).strip()
        if merged:
            chunks.append(merged)

    for piece in pieces:
        if len(piece) >= size and finer:
            if window:
                flush()
                window, width = deque(), 0
            chunks.extend(split_recursive(piece, size, overlap, finer))
            continue
        gap = len(separator) if window else 0
        if window and width + gap + len(piece) > size:
            flush()
            while window and (width > overlap or width + len(separator) + len(piece) > size):
                width -= len(window.popleft()) + (len(separator) if window else 0)
        width += len(piece) + (len(separator) if window else 0)
        window.append(piece)
    if window:
        flush()
    return chunks


def recursive_chunks(
    docs: DataFrame, size: int = 500, overlap: int = 50, key: str = "doc_id", text: str = "text",
    separators: list[str] | None = None,
) -> DataFrame:
    """Recursive character splitting: ``key, chunk_id, chunk_text``. Narrow, one row at a time in Arrow batches."""
    order = separators or SEPARATORS

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few texts at a time: what a worker holds does not follow the size of the batch it is given.
            for start in range(0, batch.num_rows, TEXTS):
                some = batch.slice(start, TEXTS)
                chunks = [split_recursive(t, size, overlap, order) if t else [] for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(chunks, pa.list_(pa.string()))], [key, "chunks"])
        pa.default_memory_pool().release_unused()

    kind = docs.schema[key].dataType.simpleString()
    listed = docs.select(key, text).mapInArrow(split, f"`{key}` {kind}, chunks array<string>")
    return listed.select(key, F.posexplode("chunks").alias("chunk_id", "chunk_text"))


def child_chunks(parents: DataFrame, size: int = 200, overlap: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Small windows with a link to their parent: ``doc_id`` (of the child), ``parent_id``, ``chunk_text``."""
    children = fixed_windows(parents, size, overlap, [key], text)
    return children.select(
        F.concat_ws("#", F.col(key).cast("string"), F.col("chunk_id").cast("string")).alias("doc_id"),
        F.col(key).alias("parent_id"),
        "chunk_id",
        "chunk_text",
    )


def _cuts(counts: np.ndarray, percentile: float, buffer: int) -> np.ndarray:
    """Chunk number of each sentence of one text, from the sentences' bucket counts."""
    n = len(counts)
    if n < 2:
        return np.zeros(n, dtype=np.int32)
    # Counts add up, so a window's counts are a difference of running sums.
    running = np.vstack([np.zeros(counts.shape[1]), np.cumsum(counts, axis=0)])
    place = np.arange(n)
    windows = running[np.minimum(place + buffer + 1, n)] - running[np.maximum(place - buffer, 0)]
    lengths = np.sqrt((windows * windows).sum(axis=1, keepdims=True))
    units = windows / np.where(lengths > 0, lengths, 1.0)
    distances = np.round(1 - (units[1:] * units[:-1]).sum(axis=1), 6)
    limit = np.percentile(distances, percentile * 100)
    return np.cumsum(np.concatenate([[False], distances > limit]), dtype=np.int32)


def chunk_numbers(dims: int, percentile: float, buffer: int, hashing: str):
    """Arrow UDF: the sentences of a text, or for cheap hashes the token buckets of each, to chunk numbers per sentence."""

    def entries(per_text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if hashing == "md5":
            return md5_buckets(per_text, dims)
        return np.repeat(np.arange(len(per_text)), list_lengths(per_text)), per_text.flatten().to_numpy(zero_copy_only=False)

    @F.arrow_udf("array<int>")
    def number(texts: pa.Array) -> pa.Array:
        numbers = []
        for start in range(0, len(texts), TEXTS):
            part = texts.slice(start, TEXTS)
            per_text = part.flatten()
            rows, buckets = entries(per_text)
            slots = rows * dims + buckets
            counts = np.bincount(slots, minlength=len(per_text) * dims).reshape(-1, dims)
            edges = np.cumsum(list_lengths(part))[:-1]
            numbers += [_cuts(c, percentile, buffer) for c in np.split(counts, edges)]
        return pa.array(numbers, pa.list_(pa.int32()))

    return number


def semantic_chunks(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percentile: float = 0.95, buffer: int = 1,
    dims: int = 64, hashing: str = "xxhash64",
) -> DataFrame:
    """Cut a text where neighbouring sentence groups differ most: ``key, chunk_id, chunk_text, n_sentences``.

    A sentence group is a sentence with ``buffer`` neighbours on both sides. Cuts go where the cosine
    distance of two neighbouring groups is above the document's ``percentile`` of such distances. A
    document is one row from the scan to its chunks, so nothing is shuffled.
    """
    split = docs.select(key, sentences(F.col(text)).alias("sentences"))
    seen = F.col("sentences") if hashing == "md5" else F.transform("sentences", lambda s: token_buckets(words(s), dims, hashing))
    numbered = split.select(key, "sentences", chunk_numbers(dims, percentile, buffer, hashing)(seen).alias("numbers"))

    def chunk(n):
        length = F.size(F.filter("numbers", lambda x: x == n))
        part = F.slice("sentences", F.array_position("numbers", n).cast("int"), length)
        return F.struct(F.concat_ws(" ", part).alias("chunk_text"), length.cast("bigint").alias("n_sentences"))

    chunks = F.when(
        F.size("numbers") > 0, F.transform(F.sequence(F.lit(0), F.element_at("numbers", -1)), chunk)
    )
    return numbered.select(key, F.posexplode(chunks).alias("chunk_id", "chunk")).select(key, "chunk_id", "chunk.*")
