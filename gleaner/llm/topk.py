"""Exact top-k search by inner product: term-at-a-time accumulation into dense score arrays.

Vectors are rows of whole numbers; a dimension is a term. Each task turns a slice of the candidates into postings
(for each term the places and weights of the candidates that have it), and each query row, kept sparse, scatters its
weight times the postings of its terms into one dense array of scores. A partition selection keeps the best k of the
slice and merges them with the best so far; the tasks' bests are merged by a ranking per query.

Queries are asked in blocks: a block is collected (at most ``BLOCK_BYTES`` of weights), sent to the executors and
meets every candidate in one pass, so neither side is ever whole in one place and no pair of rows is emitted. The
work is candidates x queries x terms, as it is for every exhaustive search.

Defined results: vectors that are null or hold null or non-finite components take no part; a row never finds rows of
its own id; repeated candidate rows are candidates each; of repeated query ids the smallest vector asks; a query with
fewer candidates than k returns all; equal scores rank by smaller id; vectors of another length than the query's are
no candidates for it (the missing terms would be undefined); empty tables give no row. Scores have to fit 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from gleaner.llm.common import map_batches
from gleaner.session import materialise

BLOCK_BYTES = 16 << 20
#: Scores held at once in a task.
SLICE_SCORES = 1 << 21


def whole_numbers(vectors: DataFrame, scale: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, terms): floor(scale * x) of every component; rows with null or non-finite components are left out."""
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.col(vector).isNotNull() & F.col(key).isNotNull() & F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf"))
    )
    return vectors.filter(finite).select(
        F.col(key).alias("id"), F.transform(x, lambda v: F.floor(v * scale)).alias("terms")
    )


def top_k(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, score) from (id, terms) tables; both sides may be the same rows."""
    asked = materialise(
        queries.groupBy("id").agg(F.min("terms").alias("terms")).withColumn("size", F.size("terms")), "queries"
    )
    spark = candidates.sparkSession
    sizes = {row["size"]: row["n"] for row in asked.groupBy("size").agg(F.count("*").alias("n")).collect()}
    found = None
    for size, count in sorted(sizes.items()):
        per_block = max(1, BLOCK_BYTES // (8 * max(size, 1)))
        blocks = -(-count // per_block)
        same = candidates.filter(F.size("terms") == size).select("id", "terms")
        # A hash deals the queries out evenly; twice the blocks keep each of them below its bound.
        blocks = 1 if blocks == 1 else 2 * blocks
        for block in range(blocks):
            part = asked.filter((F.col("size") == size) & (F.pmod(F.xxhash64("id"), F.lit(blocks)) == block))
            rows = part.orderBy("id").select("id", "terms").toArrow()
            if rows.num_rows:
                ids = rows.column("id").to_numpy()
                weights = _matrix(rows.column("terms").combine_chunks(), size)
                asking = spark.sparkContext.broadcast((ids, weights))
                # Stored before the next block is collected: one block at a time is on the driver and the executors.
                best = materialise(_pass(same, asking, size, k), "best")
                asking.destroy()
                found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score bigint")
    order = W.Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score"
    )


def _matrix(terms: pa.Array, size: int) -> np.ndarray:
    return terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(terms), size)


def _pass(candidates: DataFrame, block, size: int, k: int) -> DataFrame:
    """The best k of each task for each query of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, weights = block.value
        best = Best(len(ids), k)
        step = max(1, SLICE_SCORES // len(ids))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                places = part.column(0).to_numpy()
                scores = accumulate(weights, postings(_matrix(part.column(1), size)), len(places))
                scores_of_own = ids[:, None] == places[None, :]
                best.merge(scores, places, scores_of_own)
        yield from best.rows(ids)

    return map_batches(candidates, run, "query_id bigint, id bigint, score bigint")


def postings(matrix: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each term the places that have it and their weights."""
    found = []
    for column in matrix.T:
        at = np.flatnonzero(column)
        found.append((at, column[at]))
    return found


def accumulate(weights: np.ndarray, lists: list[tuple[np.ndarray, np.ndarray]], places: int) -> np.ndarray:
    """Dense scores (queries x places): term at a time, each query row scatters its weight times the postings."""
    scores = np.zeros((len(weights), places), np.int64)
    for term, (at, held) in enumerate(lists):
        if len(at) == 0:
            continue
        every = len(at) == places
        for query in np.flatnonzero(weights[:, term]):
            row = scores[query]
            if every:
                row += weights[query, term] * held
            else:
                row[at] += weights[query, term] * held
    return scores


class Best:
    """The best k (score, id) so far of each query; equal scores by smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.held = [(np.empty(0, np.int64), np.empty(0, np.int64))] * queries

    def merge(self, scores: np.ndarray, places: np.ndarray, own: np.ndarray) -> None:
        for query, (old_scores, old_ids) in enumerate(self.held):
            new, ids = scores[query], places
            allowed = ~own[query]
            if len(old_scores) == self.k:
                allowed &= new >= old_scores[-1]
            at = np.flatnonzero(allowed)
            if len(at):
                self.held[query] = select(
                    np.concatenate([old_scores, new[at]]), np.concatenate([old_ids, ids[at]]), self.k
                )

    def rows(self, queries: np.ndarray) -> Iterator[pa.RecordBatch]:
        counts = [len(s) for s, _ in self.held]
        if sum(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(queries, counts)), pa.array(np.concatenate([i for _, i in self.held])),
                 pa.array(np.concatenate([s for s, _ in self.held]))], ["query_id", "id", "score"],
            )


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores in order; a partition finds the k-th score, then only rows from it on are sorted."""
    if len(scores) > k:
        kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        scores, ids = scores[kept], ids[kept]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]
