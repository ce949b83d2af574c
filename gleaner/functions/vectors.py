"""Vector columns: ``array<double>`` maths on the JVM, and hashed bag-of-words embeddings."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.text import words


TEXTS = 2000  # texts whose words are held at once


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))


def normalise(vector: Column) -> Column:
    """Unit length; a zero vector stays as it is.

    The length is bound by an outer one-element transform. Inside the inner lambda it would be
    computed again for every entry.
    """
    scaled = F.transform(
        F.array(norm(vector)),
        lambda length: F.when(length > 0, F.transform(vector, lambda x: x / length)).otherwise(vector),
    )
    return F.element_at(scaled, 1)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def shorten(vector: Column, dims: int) -> Column:
    """The first ``dims`` dimensions, brought back to unit length."""
    return normalise(F.slice(vector, 1, dims))


def quantise(vector: Column) -> Column:
    """8-bit codes of a unit vector: ``round(127 x)``."""
    return F.transform(vector, lambda x: F.round(x * 127).cast("tinyint"))


def dequantise(codes: Column) -> Column:
    return F.transform(codes, lambda c: c.cast("double") / 127)


def token_buckets(tokens: Column, dims: int, hashing: str = "xxhash64") -> Column:
    """Bucket number of each token.

    ``xxhash64`` is the cheap choice; ``md5`` gives the same buckets in every engine.
    """
    if hashing == "md5":
        return F.transform(
            tokens,
            lambda t: (F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % dims).cast("int"),
        )
    return F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(dims)).cast("int"))


def split_words(texts: pa.Array) -> pa.Array:
    """The words of each text of a batch, as :func:`gleaner.functions.text.words` has them, with empty ones at the edges."""
    texts = texts.cast(pa.string())
    if pc.any(pc.match_substring_regex(texts, "[\\x0b\\x0c]")).as_py():  # no white space here
        return pc.split_pattern_regex(texts, "[ \\t\\n\\r]+")
    return pc.ascii_split_whitespace(texts)


def md5_buckets(texts: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each word of a batch of texts, in order. A different word of the batch is hashed once."""
    lists = split_words(texts)
    rows = np.repeat(np.arange(len(texts)), list_lengths(lists))
    encoded = lists.flatten().dictionary_encode()
    different = encoded.dictionary
    if not len(different):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    _, offsets, data = different.buffers()
    ends = np.frombuffer(offsets, np.int32)[different.offset : different.offset + len(different) + 1]
    data, at = bytes(data or b""), ends.tolist()
    digests = b"".join([hashlib.md5(data[a:b]).digest() for a, b in zip(at, at[1:])])
    numbers = np.frombuffer(digests, ">u4")[::4].astype(np.int64) % dims
    numbers[ends[1:] == ends[:-1]] = -1
    buckets = numbers[encoded.indices.to_numpy()]
    return rows[buckets >= 0], buckets[buckets >= 0]


def list_lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _unit_counts(rows: np.ndarray, buckets: np.ndarray, n: int, dims: int) -> pa.Array:
    counts = np.bincount(rows * dims + buckets, minlength=n * dims).reshape(-1, dims).astype(np.float64)
    lengths = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    counts /= np.where(lengths > 0, lengths, 1.0)
    offsets = np.arange(0, (n + 1) * dims, dims, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts.ravel()))


def count_vectors(dims: int):
    """Arrow UDF: bucket numbers to a unit vector of bucket counts, a batch at a time."""

    @F.arrow_udf("array<double>")
    def to_vector(buckets: pa.Array) -> pa.Array:
        rows = np.repeat(np.arange(len(buckets)), list_lengths(buckets))
        return _unit_counts(rows, buckets.flatten().to_numpy(zero_copy_only=False), len(buckets), dims)

    return to_vector


def text_vectors(dims: int):
    """Arrow UDF: texts to unit vectors of the counts of their words' md5 buckets, some texts at a time."""

    @F.arrow_udf("array<double>")
    def to_vector(texts: pa.Array) -> pa.Array:
        parts = [texts.slice(start, TEXTS) for start in range(0, len(texts), TEXTS)] or [texts]
        return pa.concat_arrays([_unit_counts(*md5_buckets(part, dims), len(part), dims) for part in parts])

    return to_vector


def hashed_embedding(text: Column, dims: int = 64, hashing: str = "xxhash64") -> Column:
    """Deterministic embedding of a text's words. Narrow: no shuffle, one Arrow round trip.

    Words are hashed row by row where that is cheap; md5 is taken once for each different word of a batch.
    """
    if hashing == "md5":
        return text_vectors(dims)(text)
    return count_vectors(dims)(token_buckets(words(text), dims, hashing))
