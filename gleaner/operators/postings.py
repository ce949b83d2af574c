"""A stored inverted index with block bounds, and BM25 search that leaves out blocks that cannot matter.

**Layout.** Documents are numbered in the order of their ids and cut into shards of that order. The postings of a term in
a shard are cut into blocks of at most ``BLOCK`` documents; a row of the index is one block, with the highest BM25 gain of
any of its documents (``top``). Blocks are stored in one folder per bucket of terms, sorted by term, so a search reads the
folders of the terms it asks for, and inside them the row groups that can hold these terms.

**Search.** The blocks of the asked terms are brought together by shard. There each query goes through the shard in windows
of documents, the window with the highest possible score first: the bound of a window is the sum of the weighted tops of the
blocks that reach into it. Windows are scored exactly until the bound of the next one is below the query's current k-th
score, so the postings of all later windows are never scored. The result is the exact top-k.

A shard holds at most ``SHARD_DOCS`` documents, so a term that every document has is spread over all shards. A larger
query set is searched in blocks of queries; the weights that are broadcast are counted first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.functions.text import words
from gleaner.functions.vectors import list_lengths
from gleaner.operators.blocks import SCORE_DIGITS
from gleaner.operators.lexical import B, K1, build_index
from gleaner.operators.ordinal import numbered
from gleaner.session import materialise

BLOCK = 128
WINDOW = 256
SHARD_DOCS = 50_000
SHARDS = 64  # a small corpus is cut into about this many
LEAST_SHARD = 1000
BUCKETS = 64
TASK_WORDS = 4_000_000  # running words whose postings one task sorts
BLOCK_SCHEMA = "bucket int, term string, shard long, block int, first long, last long, top double, nums array<long>, tfs array<int>, dls array<int>"


@dataclass(frozen=True)
class PostingIndex:
    """``blocks`` (see ``BLOCK_SCHEMA``), ``docs(num, doc_id)``, ``terms(term, df, idf)`` and the constants they were built with."""

    blocks: DataFrame
    docs: DataFrame
    terms: DataFrame
    avgdl: float
    shard_docs: int
    k1: float
    b: float


def _gain(tf: np.ndarray, dl: np.ndarray, k1: float, b: float, avgdl: float) -> np.ndarray:
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))


def _gathered(shard_docs: int):
    """Batches of (num, dl, terms, counts), numbers rising, to one row per term and shard: first number, then numbers, counts and lengths.

    What moves are lists and not single postings; a number is held as its distance from the first.
    """
    schema = pa.schema([("bucket", pa.int32()), ("term", pa.string()), ("first", pa.int64()), ("packed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, num = batch.column("terms"), batch.column("num").to_numpy()
            own = np.repeat(np.arange(batch.num_rows), list_lengths(lists))
            encoded = lists.flatten().dictionary_encode()
            tf = batch.column("counts").flatten().to_numpy(zero_copy_only=False)
            code = encoded.indices.to_numpy().astype(np.int64)
            shard = num // shard_docs
            key = code + (shard - shard.min(initial=0))[own] * max(1, len(encoded.dictionary))
            # A batch is in the order of numbers already where it comes from one file; other ones are sorted.
            order = np.argsort(key, kind="stable") if (num[1:] > num[:-1]).all() else np.lexsort((num[own], key))
            key, own, code, tf = key[order], own[order], code[order], tf[order]
            cut = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
            ends = np.append(cut[1:], len(key)).astype(np.int64)
            first = num[own[cut]]
            entries = np.empty((len(key), 3), np.int32)
            entries[:, 0] = num[own] - np.repeat(first, ends - cut)
            entries[:, 1], entries[:, 2] = tf, batch.column("dl").to_numpy()[own]
            offsets = pa.array(np.append(cut, len(key)) * entries.itemsize * 3, pa.int32())
            packed = pa.Array.from_buffers(pa.binary(), len(cut), [None, offsets.buffers()[1], pa.py_buffer(entries)])
            terms = encoded.dictionary.take(pa.array(code[cut]))
            yield pa.RecordBatch.from_arrays([pa.nulls(len(cut), pa.int32()), terms, pa.array(first), packed], schema=schema)

    return run


def _cut(k1: float, b: float, avgdl: float, shard_docs: int):
    """Sorted lists (bucket, term, first, packed) to blocks; the last term of a batch waits for the next batch."""
    schema = pa.schema([
        ("bucket", pa.int32()), ("term", pa.string()), ("shard", pa.int64()), ("block", pa.int32()), ("first", pa.int64()), ("last", pa.int64()),
        ("top", pa.float64()), ("nums", pa.list_(pa.int64())), ("tfs", pa.list_(pa.int32())), ("dls", pa.list_(pa.int32())),
    ])

    def blocks(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        term, first, packed = (rows.column(name).combine_chunks() for name in ("term", "first", "packed"))
        first = first.to_numpy()
        size = pc.binary_length(packed).to_numpy().astype(np.int64) // 12
        reach = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
        entries = np.frombuffer(packed.buffers()[2], np.uint8)[reach[0] : reach[-1]].view(np.int32).reshape(-1, 3)
        num, tf, dl = entries[:, 0] + np.repeat(first, size), entries[:, 1], entries[:, 2]
        lists = np.flatnonzero(_borders(term, first // shard_docs))
        row = np.repeat(np.cumsum(_borders(term, first // shard_docs)) - 1, size)
        starts = (np.cumsum(size) - size)[lists]
        # Lists of several batches may lie across each other where a file was read in pieces.
        if not ((num[1:] > num[:-1]) | (row[1:] != row[:-1])).all():
            order = np.lexsort((num, row))
            num, tf, dl = num[order], tf[order], dl[order]
        place = np.arange(len(num)) - np.repeat(starts, np.diff(np.append(starts, len(num))))
        cut = np.flatnonzero(place % BLOCK == 0)
        ends = np.append(cut[1:], len(num)) - 1
        held = pa.array(lists[row[cut]])
        offsets = pa.array(np.append(cut, len(num)), pa.int32())
        return pa.RecordBatch.from_arrays([
            rows.column("bucket").combine_chunks().take(held), term.take(held), pa.array(num[cut] // shard_docs), pa.array((place[cut] // BLOCK).astype(np.int32)),
            pa.array(num[cut]), pa.array(num[ends]), pa.array(np.maximum.reduceat(_gain(tf, dl, k1, b, avgdl), cut)),
            pa.ListArray.from_arrays(offsets, pa.array(num)), pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(tf))),
            pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(dl))),
        ], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            new = _borders(rows.column("term").combine_chunks(), rows.column("first").to_numpy() // shard_docs)
            last = int(np.flatnonzero(new)[-1]) if len(new) else 0
            if last:
                yield blocks(rows.slice(0, last))
                held = rows.slice(last).to_batches()
        if held and (rows := pa.Table.from_batches(held)).num_rows:
            yield blocks(rows)

    return run


def _borders(term: pa.Array, shard: np.ndarray) -> np.ndarray:
    """Where the term or the shard differs from the row before; the first row is a border."""
    out = np.ones(len(term), bool)
    if len(term) > 1:
        differ = pc.not_equal(term.slice(1), term.slice(0, len(term) - 1)).to_numpy(zero_copy_only=False)
        out[1:] = differ | (shard[1:] != shard[:-1])
    return out


def build(corpus: DataFrame, path: str, text: str = "text", k1: float = K1, b: float = B) -> PostingIndex:
    """Index ``corpus(doc_id, <text>)`` below ``path``; :func:`load` reads it in any session.

    ``doc_id`` is unique and not null; a null text has no terms.
    """
    spark = corpus.sparkSession
    counted = build_index(corpus, text, ordered=True)
    docs = numbered(counted.docs, "num")
    shard_docs = min(SHARD_DOCS, max(LEAST_SHARD, -(-counted.n_docs // SHARDS)))
    lists = docs.select("num", "dl", "terms", "counts").mapInArrow(_gathered(shard_docs), "bucket int, term string, first long, packed binary")
    placed = lists.withColumns({"bucket": F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int"), "shard": F.floor(F.col("first") / shard_docs)})
    # A task has whole lists of (term, shard): a common term is spread over as many tasks as there are shards. There are as
    # many tasks as the corpus has words for, so that none sorts more in a larger one.
    tasks = max(spark.sparkContext.defaultParallelism, -(-int(counted.n_docs * counted.avgdl) // TASK_WORDS))
    ordered = placed.repartition(tasks, "bucket", "shard").sortWithinPartitions("bucket", "term", "first").select("bucket", "term", "first", "packed")
    cut = ordered.mapInArrow(_cut(k1, b, counted.avgdl, shard_docs), BLOCK_SCHEMA)
    cut.sortWithinPartitions("bucket", "term", "shard", "block").write.partitionBy("bucket").parquet(f"{path}/blocks")
    docs.select("num", "doc_id").write.parquet(f"{path}/docs")
    counted.terms.write.parquet(f"{path}/terms")
    sizes = [(float(counted.avgdl), shard_docs, k1, b)]
    spark.createDataFrame(sizes, "avgdl double, shard_docs long, k1 double, b double").coalesce(1).write.parquet(f"{path}/sizes")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> PostingIndex:
    sizes = spark.read.parquet(f"{path}/sizes").first()
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    return PostingIndex(blocks, read("docs"), read("terms"), sizes.avgdl, sizes.shard_docs, sizes.k1, sizes.b)


def postings(index: PostingIndex) -> DataFrame:
    """``(term, doc_id, tf)`` out of the stored blocks."""
    entries = index.blocks.select("term", F.inline(F.arrays_zip(F.col("nums").alias("num"), F.col("tfs").alias("tf"))))
    return entries.join(index.docs, "num").select("term", "doc_id", F.col("tf").cast("bigint").alias("tf"))


@dataclass(frozen=True)
class Asked:
    """The query side: a vocabulary, and the terms and weights of each query as slices of two arrays."""

    ids: list
    vocabulary: list[str]
    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray


def _asked(weights: pa.Table) -> Asked:
    frame = weights.to_pandas()
    codes, vocabulary = pd.factorize(frame["term"], sort=True)
    queries, ids = pd.factorize(frame["query_id"], sort=True)
    order = np.lexsort((codes, queries))
    starts = np.searchsorted(queries[order], np.arange(len(ids) + 1))
    return Asked(list(ids), list(vocabulary), starts, codes[order], frame["weight"].to_numpy()[order])


class Shard:
    """The blocks of the asked terms of one shard."""

    def __init__(self, blocks: pa.Table, vocabulary: list[str], width: int, gain):
        blocks = blocks.combine_chunks()
        codes = pc.index_in(blocks.column("term"), value_set=pa.array(vocabulary, pa.string())).to_numpy()
        first = blocks.column("first").to_numpy()
        order = np.lexsort((first, codes))
        blocks = blocks.take(pa.array(order))
        codes, self.base, self.width, self.gain = codes[order], int(first.min()) // width * width, width, gain
        first, last = (blocks.column(name).to_numpy() - self.base for name in ("first", "last"))
        flat = lambda name: blocks.column(name).combine_chunks().flatten().to_numpy()
        self.num, self.tf, self.dl = flat("nums") - self.base, flat("tfs"), flat("dls")
        terms = np.repeat(codes.astype(np.int64), list_lengths(blocks.column("nums").combine_chunks()))
        #: Postings are sorted by term and document, so a slice of a term's documents is found by this key.
        self.key = terms * width + self.num
        self.present, rows = np.unique(codes, return_inverse=True)
        windows = -(-width // WINDOW)
        self.tops = np.zeros((len(self.present), windows))
        reach = last // WINDOW - first // WINDOW + 1
        at = np.repeat(first // WINDOW, reach) + np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach)
        np.maximum.at(self.tops, (np.repeat(rows, reach), at), np.repeat(blocks.column("top").to_numpy(), reach))

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The terms that occur here, their weights, and the highest possible score in each window."""
        place = np.searchsorted(self.present, terms)
        here = (place < len(self.present)) & (self.present[np.minimum(place, len(self.present) - 1)] == terms)
        # A document need not have a term of negative weight.
        return terms[here], weights[here], np.maximum(weights[here], 0) @ self.tops[place[here]]

    def score(self, terms: np.ndarray, weights: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of all documents of some windows that have one of the terms."""
        low = (terms[:, None] * self.width + windows[None, :] * WINDOW).ravel()
        high = (terms[:, None] * self.width + np.minimum((windows[None, :] + 1) * WINDOW, self.width)).ravel()
        start, stop = np.searchsorted(self.key, low), np.searchsorted(self.key, high)
        size = stop - start
        at = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        value = self.gain(self.tf[at], self.dl[at]) * np.repeat(np.repeat(weights, len(windows)), size)
        docs, inverse = np.unique(self.num[at], return_inverse=True)
        return docs, np.round(np.bincount(inverse, value, len(docs)), SCORE_DIGITS)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int, int]:
        """The ``k`` best (document, score), and how many windows were scored out of how many that have a term."""
        terms, weights, bound = self.bounds(terms, weights)
        docs, scores, edge = np.empty(0, np.int64), np.empty(0), 0.0
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        done, step = 0, 2
        # A bound may lie below its own score by a rounding step.
        while done < len(order) and bound[order[done]] + 10**-SCORE_DIGITS >= edge:
            some = order[done : done + step]
            some = some[bound[some] + 10**-SCORE_DIGITS >= edge]
            done, step = done + len(some), step * 2
            found, value = self.score(terms, weights, some)
            good = (value > 0) & (value >= edge)
            docs, scores = np.concatenate([docs, found[good]]), np.concatenate([scores, value[good]])
            kept = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[kept], scores[kept]
            edge = scores[-1] if len(scores) == k else 0.0
        return docs + self.base, scores, done, len(order)


def query_weights(index: PostingIndex, queries: DataFrame, text: str = "text") -> DataFrame:
    """``(query_id, term, weight)``: idf times the word's count in the query; words that no document has drop out."""
    asked = queries.select("query_id", F.explode(words(F.col(text))).alias("term")).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))
    # Stored first: with its size known, it is broadcast to the vocabulary rather than shuffled with it.
    weighed = materialise(asked, "asked").join(index.terms, "term")
    return weighed.select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("weight"))


def search(index: PostingIndex, queries: DataFrame, k: int = 4, text: str = "text", max_query_rows: int = 200_000) -> DataFrame:
    """Top-k by Okapi BM25, ``(query_id, doc_id, score, rank)``; documents with a positive score only, ties by id."""
    return _ranked(index, candidates(index, queries, k, text, max_query_rows), k)


def candidates(index: PostingIndex, queries: DataFrame, k: int, text: str = "text", max_query_rows: int = 200_000) -> DataFrame:
    """The ``k`` best of every shard: ``(query_id, num, score, scored, windows)``.

    ``scored`` of the shard's ``windows`` that have a term of the query were scored.
    """
    spark = queries.sparkSession
    weights = materialise(query_weights(index, queries, text), "weights")
    pieces = max(1, -(-weights.count() // max_query_rows))
    found = None
    for piece in range(pieces):
        some = weights if pieces == 1 else weights.filter(F.pmod(F.xxhash64("query_id"), F.lit(pieces)) == piece)
        hits = materialise(_search_block(index, some, k), "shard-hits")
        found = hits if found is None else found.unionByName(hits)
    return found


def _search_block(index: PostingIndex, weights: DataFrame, k: int) -> DataFrame:
    table = weights.toArrow()
    asked, id_type = weights.sparkSession.sparkContext.broadcast(_asked(table)), table.schema.field("query_id").type
    schema = f"query_id {weights.schema['query_id'].dataType.simpleString()}, num long, score double, scored int, windows int"
    terms = weights.select("term").distinct()
    buckets = [row[0] for row in terms.select(F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int")).distinct().collect()]
    blocks = index.blocks.filter(F.col("bucket").isin(buckets)).join(terms, "term", "left_semi").drop("bucket", "block")
    width, k1, b, avgdl = index.shard_docs, index.k1, index.b, index.avgdl

    def shard_hits(own_blocks: pa.Table) -> pa.Table:
        side = asked.value
        shard = Shard(own_blocks, side.vocabulary, width, lambda tf, dl: _gain(tf, dl, k1, b, avgdl))
        ids, found = [], []
        for i, query in enumerate(side.ids):
            own = slice(side.starts[i], side.starts[i + 1])
            docs, scores, scored, windows = shard.best(side.terms[own], side.weights[own], k)
            ids += [query] * len(docs)
            found.append(np.stack([docs, np.full(len(docs), scored), np.full(len(docs), windows), scores.view(np.int64)]))
        num, scored, windows, scores = np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)
        return pa.table({
            "query_id": pa.array(ids, id_type), "num": num, "score": scores.view(np.float64),
            "scored": scored.astype(np.int32), "windows": windows.astype(np.int32),
        })

    return blocks.groupBy("shard").applyInArrow(shard_hits, schema)


def _ranked(index: PostingIndex, hits: DataFrame, k: int) -> DataFrame:
    """Numbers are in the order of ids, so ties go to the smaller id."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("num"))
    best = materialise(hits.select("query_id", "num", "score", F.row_number().over(order).alias("rank")).filter(F.col("rank") <= k), "best")
    return materialise(best.join(index.docs, "num").select("query_id", "doc_id", "score", "rank"), "hits")
