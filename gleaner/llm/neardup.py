"""Near-duplicates by MinHash: universal hash minima, banding, signature verification, star components.

A document's set holds its distinct five-word shingles (A-Z in lower case; fewer words: the whole sequence as one;
no words: empty). Two documents are linked if their sets have a Jaccard similarity of at least ``SIMILARITY`` per cent;
a component is what links connect.

1. ``sketch``: one pass over the texts gives each document the size and digest of its set and ``HASHES`` minima.
2. Documents with equal sets fall together by digest; only the first of them goes on.
3. The minima of a band are a bucket key. A pair at the threshold shares none of the 32 bands of 4 minima with a
   probability of 6e-11. In every bucket the documents are compared with one pivot, the one whose buckets are the
   largest, so a bucket of n documents gives n - 1 pairs.
4. A pair whose minima agree too little goes (six standard deviations below the threshold); the others are confirmed
   on the full sets. Components come from alternating large-star and small-star rounds.
5. Buckets that still hold more than one component need more than a star. For their documents an exact prefix filter
   finds every remaining pair across components: shingles that lie in one component only cannot be shared across, the
   others are taken rarest first, and a pair is looked at only if it shares one of the first of both and the sizes and
   places still allow the threshold. Confirmed links are added and the components are made again.

No group is brought to one task: counts are combined before they move, hot keys are joined, and the skewed
partitions of these joins are split. What the steps share is written below ``spark.checkpoint.dir``.

Defined results: null, empty and blank texts have an empty set and are linked with nothing; a null ``doc_id`` is
linked with nothing and stays; rows with the same ``doc_id`` are one document and stay or go together; an empty table
gives no row; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import by_ids, map_batches
from gleaner.session import materialise

SHINGLE = 5
SIMILARITY = 85
HASHES = 128
ROWS = 4
#: Agreeing minima per pair from which on the full sets are compared: the threshold less six standard deviations.
MARGIN = int(HASHES * (SIMILARITY / 100 - 6 * (SIMILARITY / 100 * (1 - SIMILARITY / 100) / HASHES) ** 0.5))
SLICE_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _universal(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and addends of multiply-add hash functions modulo 2**64; their upper halves are universal."""
    numbers = np.random.default_rng(20240607).integers(0, 1 << 63, (2, count), dtype=np.uint64)
    return numbers[0] * np.uint64(2) + np.uint64(1), numbers[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_arrays(texts: list[bytes | None]) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    split = [(t or b"").lower().split() for t in texts]
    ends = np.cumsum([0, *map(len, split)])
    flat = np.empty(ends[-1], dtype=object)
    flat[:] = [w for words in split for w in words]
    words = pd.util.hash_array(flat, categorize=False) if len(flat) else np.empty(0, np.uint64)
    full = max(len(words) - SHINGLE + 1, 0)
    rolled = np.zeros(full, np.uint64)
    for k in range(SHINGLE):
        rolled = rolled * _ODD + words[k : k + full]
    rolled = _mix(rolled)
    found = []
    for start, end in zip(ends[:-1], ends[1:], strict=True):
        if end - start >= SHINGLE:
            found.append(np.unique(rolled[start : end - SHINGLE + 1]))
        elif end > start:
            short = np.uint64(end - start)  # keeps short sequences apart from shingles
            for w in words[start:end]:
                short = (short * _ODD + w) if short else w
            found.append(_mix(np.array([short + _ODD], np.uint64)))
        else:
            found.append(np.empty(0, np.uint64))
    return found


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes | None]]]:
    """Ids and texts in pieces of about ``SLICE_BYTES``."""
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        start, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text or b"")
            if size >= SLICE_BYTES or i == len(texts) - 1:
                yield batch.column(0)[start : i + 1], texts[start : i + 1]
                start, size = i + 1, 0


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The ``HASHES`` minima (32 bits each) of each set; all sets have members."""
    multiply, add = _universal(HASHES)
    members, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint32)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(members * multiply[k] + add[k], starts) >> np.uint64(32)
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, signature) per document; digest and signature are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for ids, texts in _slices(batches):
                sets = shingle_arrays(texts)
                some = [s for s in sets if len(s)]
                minima = iter(signatures(some) if some else [])
                rows = [(xxhash.xxh3_128_digest(s.tobytes()), next(minima).tobytes()) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array([r[0] for r in rows], pa.binary()),
                     pa.array([r[1] for r in rows], pa.binary())],
                    ["doc_id", "n_shingles", "digest", "signature"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles bigint, digest binary, signature binary"
    return map_batches(docs.select("doc_id", "text"), run, schema)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, shingles): the whole set of each document as sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for ids, texts in _slices(batches):
                sets = [s.view(np.int64) for s in shingle_arrays(texts)]
                offsets = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
                values = pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, values)], ["doc_id", "shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, shingles array<bigint>")


def bucket_members(sketches: DataFrame) -> DataFrame:
    """(key, doc_id, n): the documents of every bucket that holds n > 1 of them."""
    width = 4 * ROWS
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(HASHES // ROWS - 1)),
        lambda b: F.xxhash64(F.substring(F.col("signature"), b * width + 1, F.lit(width)), b),
    )
    rows = sketches.select("doc_id", F.explode(keys).alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    return rows.join(sizes, "key")


def star_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of the documents of each bucket with its pivot: the document with the most bucket fellows."""
    weight = members.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    pivots = members.join(weight, "doc_id").groupBy("key").agg(
        F.max(F.struct("weight", (-F.col("doc_id")).alias("id"))).alias("top")
    ).select("key", (-F.col("top.id")).alias("pivot"))
    pairs = members.join(pivots, "key").filter("doc_id <> pivot")
    return pairs.select(F.least("doc_id", "pivot").alias("a"), F.greatest("doc_id", "pivot").alias("b")).distinct()


def similar_signatures(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs whose sizes allow the threshold and whose minima agree in at least ``MARGIN`` places."""
    side = lambda x: sketches.select(
        F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in (2, 3)
            )
            agree = (one == other).sum(axis=1) >= MARGIN
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(agree))

    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * SIMILARITY
    )
    kind = pairs.schema["a"].dataType.simpleString()
    return map_batches(both.select("a", "b", "s_a", "s_b"), run, f"a {kind}, b {kind}")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = both.withColumn("shared", F.size(F.array_intersect("s_a", "s_b")))
    union = F.size("s_a") + F.size("s_b") - F.col("shared")
    return shared.filter(100 * F.col("shared") >= SIMILARITY * union).select("a", "b")


def star_components(links: DataFrame) -> DataFrame:
    """(doc_id, component): for every document with a link the smallest id it reaches.

    Each round takes a large-star and a small-star step and is written to the shared folder; it ends when a round
    changes nothing, then every edge leads to the smallest id.
    """
    def smallest(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.min("v").alias("m"))

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges, before = materialise(edges, "stars"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = smallest(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.filter("u <> v").distinct(), "stars")
        least = smallest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")


def pairs_across(rows: DataFrame) -> DataFrame:
    """All pairs (a, b) of different components that can reach the threshold, by an exact prefix filter.

    ``rows(doc_id, component, shingles)``. A superset of the similar pairs; none of them is missing.
    """
    items = rows.select("doc_id", "component", F.size("shingles").alias("size"), F.explode("shingles").alias("token"))
    spread = items.groupBy("token", "component").agg(F.count("*").alias("n"))
    tokens = spread.groupBy("token").agg(
        F.sum("n").alias("df"), F.max(F.struct("n", "component"))["component"].alias("major"), F.count("*").alias("parts"),
    ).filter("parts > 1")
    # The shingles that nobody outside can share come first in the order; the others follow, rarest first.
    useful = items.join(tokens, "token").groupBy("doc_id", "component", "size").agg(
        F.array_sort(F.collect_list(F.struct("df", "token", "major"))).alias("useful")
    )
    need = F.ceil(F.col("size") * SIMILARITY / F.lit(100))
    skipped = F.col("size") - F.size("useful")
    prefix = (F.col("size") - need + 1 - skipped).cast("int")
    heads = useful.withColumns({"skipped": skipped, "prefix": prefix}).filter("prefix > 0").select(
        "doc_id", "component", "size", "skipped", F.posexplode(F.slice("useful", F.lit(1), F.col("prefix"))).alias("i", "t")
    ).select("doc_id", "component", "size", (F.col("size") - F.col("skipped") - F.col("i")).alias("left"),
             F.col("t.token").alias("token"), F.col("t.major").alias("major"))
    heads = materialise(heads, "heads")
    # Of two components one is not the token's largest: that side is asked, so the largest never meets itself.
    asks = heads.filter(F.col("component") != F.col("major")).select(
        "token", F.col("doc_id").alias("x"), F.col("component").alias("cx"), F.col("size").alias("nx"), F.col("left").alias("lx")
    )
    met = asks.join(heads, "token").filter(
        (F.col("cx") != F.col("component"))
        & (F.lit(100 + SIMILARITY) * F.least("lx", "left") >= SIMILARITY * (F.col("nx") + F.col("size")))
    )
    return met.select(F.least("x", "doc_id").alias("a"), F.greatest("x", "doc_id").alias("b")).distinct()


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``; kept: the first document of its component."""
    sketches = materialise(sketch(docs), "sketches")
    with_set = sketches.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = materialise(with_set.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "classes")
    repeats = with_set.join(classes.filter("n > 1"), "digest").filter("doc_id <> first").select("doc_id")
    firsts = by_ids(with_set, repeats, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    members = materialise(bucket_members(firsts), "members")
    firsts = by_ids(with_set, members, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    close = materialise(similar_signatures(star_pairs(members), firsts), "pairs")

    def sets_of(ids: DataFrame) -> DataFrame:
        rows = by_ids(docs.select("doc_id", "text"), ids, "doc_id", "left_semi")
        return materialise(shingle_sets(rows).dropDuplicates(["doc_id"]), "sets")

    named = close.select(F.col("a").alias("doc_id")).unionByName(close.select(F.col("b").alias("doc_id")))
    links = materialise(confirmed(close, sets_of(named)), "links")
    labels = star_components(links)

    labelled = members.join(labels, "doc_id", "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
    open_keys = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    unsettled = materialise(
        labelled.join(open_keys.select("key"), "key", "left_semi").select("doc_id", "component").distinct(), "unsettled"
    )
    sets = sets_of(unsettled)
    across = materialise(pairs_across(sets.join(unsettled, "doc_id")), "pairs")
    more = confirmed(across, sets)
    final = star_components(links.unionByName(more))

    roots = classes.join(final, classes["first"] == final["doc_id"], "left").select(
        "digest", F.coalesce("component", "first").alias("root")
    )
    found = sketches.select("doc_id", "n_shingles", "digest").join(roots, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that follow an earlier one of their component."""
    gone = components(docs).filter(~F.col("kept")).select("doc_id")
    return by_ids(docs, gone, "doc_id", "left_anti")
