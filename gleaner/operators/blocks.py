"""Exact top-k scoring of a query set against a corpus without producing all pairs.

Each task scores whole Arrow batches against a block of queries and keeps only its best ``k`` hits
per query, so what is shuffled is ``tasks x queries x k`` rows and never ``corpus x queries``.

* The query side is taken to the tasks as a broadcast only if it has been counted and has at most
  ``max_query_rows``. The corpus is then scanned in place, with no shuffle.
* A larger query side is cut into blocks and the corpus into tiles. Each (tile, block) pair is a
  co-group of bounded size; tiles come from a hash of the document id, so no tile can be hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.session import materialise

SCORE_DIGITS = 6
MATRIX_CELLS = 4_000_000  # upper bound of documents x queries scored at once in a task
TILE_ROWS = 50_000


@dataclass(frozen=True)
class Scorer:
    """How to score: ``prepare`` reads a query block, ``score`` rates a batch of documents.

    ``score`` gives a documents x queries matrix or, where most pairs share nothing, the pairs that do as three arrays
    (document, query, score); pairs that are not named count as below ``floor``.
    """

    prepare: Callable[[pa.Table], Any]
    query_ids: Callable[[Any], pd.Index]
    score: Callable[[Any, pa.RecordBatch], np.ndarray | tuple[np.ndarray, np.ndarray, np.ndarray]]
    floor: float = -np.inf


class _Best:
    """The best ``k`` hits of each query so far.

    Hits below a query's current k-th score are turned away; the others gather in a buffer that is cut back to ``k`` per
    query whenever it has grown to twice what it has to hold.
    """

    def __init__(self, queries: int, k: int):
        self.k, self.room = k, 2 * queries * k + 100_000
        self.edge = np.full(queries, -np.inf)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, query: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        good = score >= self.edge[query]
        if good.any():
            self.parts.append((query[good], doc[good], score[good]))
            self.size += int(good.sum())
            if self.size > self.room:
                self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        if not self.parts:
            return None
        query, doc, score = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((pd.factorize(doc, sort=True)[0], -score, query))
        query = query[order]
        first = np.searchsorted(query, query)
        place = np.arange(len(query)) - first
        kept = place < self.k
        last = place == self.k - 1
        self.edge[query[last]] = score[order][last]
        self.parts = [(query[kept], doc[order][kept], score[order][kept])]
        self.size = int(kept.sum())
        return self.parts[0]


def _batch_candidates(scorer: Scorer, state: Any, batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, document, score) of the pairs of a batch that can be among the best ``k``."""
    found = scorer.score(state, batch)
    if isinstance(found, tuple):
        docs, queries, scores = found
        scores = np.round(scores, SCORE_DIGITS)
        wanted = scores > scorer.floor
        docs, queries, scores = docs[wanted], queries[wanted], scores[wanted]
    else:
        matrix = np.round(found, SCORE_DIGITS)
        wanted = matrix > scorer.floor
        if len(matrix) > k:
            wanted &= matrix >= np.partition(matrix, len(matrix) - k, axis=0)[len(matrix) - k]
        docs, queries = np.nonzero(wanted)
        scores = matrix[docs, queries]
    return queries, batch.column("doc_id").to_pandas().to_numpy()[docs], scores


def _task_topk(scorer: Scorer, state: Any, batches: Iterator[pa.RecordBatch], k: int) -> pd.DataFrame | None:
    ids = scorer.query_ids(state).to_numpy()
    best = _Best(len(ids), k)
    step = max(1, MATRIX_CELLS // max(1, len(ids)))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            best.add(*_batch_candidates(scorer, state, batch.slice(start, step), k))
    held = best.cut()
    return held and pd.DataFrame({"query_id": ids[held[0]], "doc_id": held[1], "score": held[2]})


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _numbers(count: str) -> Column:
    """One row for each of ``0 .. count-1``."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))


def _hit_schema(corpus: DataFrame, queries: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("doc_id", corpus.schema["doc_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _to_arrow(rows: pd.DataFrame | None, schema: pa.Schema) -> pa.Table:
    if rows is None:
        return schema.empty_table()
    return pa.Table.from_pandas(rows, schema=schema, preserve_index=False)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    kinds = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string(), T.DoubleType(): pa.float64()}
    return pa.schema([(f.name, kinds[f.dataType]) for f in schema.fields])


def topk(
    corpus: DataFrame, queries: DataFrame, scorer: Scorer, k: int, max_query_rows: int = 200_000
) -> DataFrame:
    """Best ``k`` documents per query: ``(query_id, doc_id, score, rank)``, ties broken by id.

    The search runs here and its hits are stored: they are read several times by what follows, and
    their known size lets the planner broadcast them to the corpus instead of shuffling the corpus.
    """
    schema = _hit_schema(corpus, queries)
    arrow_schema = _arrow_schema(schema)
    queries = materialise(queries, "queries")
    n_queries = queries.count()
    if n_queries <= max_query_rows:
        shipped = corpus.sparkSession.sparkContext.broadcast(scorer.prepare(queries.toArrow()))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _to_arrow(_task_topk(scorer, shipped.value, batches, k), arrow_schema).to_batches()

        return materialise(_ranked(corpus.mapInArrow(scan, schema), k), "hits")

    whole = F.lit(0).cast("bigint")
    return topk_by_key(
        corpus.withColumn("cell", whole), queries.withColumn("cell", whole), "cell", scorer, k, max_query_rows
    )


def topk_by_key(
    corpus: DataFrame, queries: DataFrame, key: str, scorer: Scorer, k: int, max_query_rows: int = 200_000
) -> DataFrame:
    """Best ``k`` per query where a query meets only the documents that share its ``key`` value.

    Every key value is cut into tiles of documents and blocks of queries according to its own counts,
    so that no group outgrows a task however the rows are spread over the keys.
    """
    schema = _hit_schema(corpus, queries)
    arrow_schema = _arrow_schema(schema)
    pieces = materialise(
        corpus.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).alias("tiles")).join(
            queries.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / max_query_rows).alias("blocks")), key
        ),
        "pieces",
    )
    tiled = corpus.join(pieces, key).withColumns(
        {"tile": F.pmod(F.xxhash64("doc_id"), "tiles"), "block": _numbers("blocks")}
    )
    blocked = queries.join(pieces, key).withColumns(
        {"block": F.pmod(F.xxhash64("query_id"), "blocks"), "tile": _numbers("tiles")}
    )

    def score_group(docs: pa.Table, block: pa.Table) -> pa.Table:
        if not docs.num_rows or not block.num_rows:
            return arrow_schema.empty_table()
        return _to_arrow(_task_topk(scorer, scorer.prepare(block), iter(docs.to_batches()), k), arrow_schema)

    keys = [key, "tile", "block"]
    grouped = tiled.drop("tiles", "blocks").groupBy(*keys).cogroup(blocked.drop("tiles", "blocks").groupBy(*keys))
    return materialise(_ranked(grouped.applyInArrow(score_group, schema), k), "hits")
