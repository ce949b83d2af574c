"""Vector search: exact block scoring, cell-partitioned search, two-stage search, diversification."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.functions.vectors import as_double, dequantise, hashed_embedding, normalise, quantise, shorten
from gleaner.operators.blocks import TILE_ROWS, Scorer, topk, topk_by_key
from gleaner.operators.sampling import first_by
from gleaner.session import materialise, scratch_path

BROADCAST_VALUES = 8_000_000  # 64 MB of doubles


def _matrix(vectors: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else flat.reshape(0, 1)


def _prepare(block: pa.Table) -> dict:
    return {
        "ids": pd.Index(block.column("query_id").to_pandas()),
        "vectors": _matrix(block.column("vector"), block.num_rows),
    }


def _score(state: dict, batch: pa.RecordBatch) -> np.ndarray:
    return _matrix(batch.column("vector"), batch.num_rows) @ state["vectors"].T


DOT = Scorer(_prepare, lambda state: state["ids"], _score)


def embed(corpus: DataFrame, text: str = "text", dims: int = 64, hashing: str = "xxhash64") -> DataFrame:
    """Add the hashed ``vector`` of a text column."""
    return corpus.withColumn("vector", hashed_embedding(F.col(text), dims, hashing))


def unit_vectors(table: DataFrame, key: str, vector: str = "embedding", dims: int | None = None) -> DataFrame:
    """A vector table ``(key, vector)`` of unit ``array<double>`` vectors.

    With ``dims`` given, a vector of another length fails the job instead of scoring wrongly.
    """
    raw: Column = as_double(F.col(vector))
    if dims:
        raw = F.when(F.size(raw) == dims, raw).otherwise(
            F.raise_error(F.concat(F.lit(f"expected {dims} dimensions, got "), F.size(raw).cast("string")))
            .cast("array<double>")
        )
    return table.select(key, normalise(raw).alias("vector"))


def dense(corpus: DataFrame, queries: DataFrame, k: int = 10, dims: int = 64) -> DataFrame:
    """Exact cosine top-k of ``queries(query_id, vector)`` in ``corpus(doc_id, vector)``, unit vectors."""
    return topk(
        corpus.select("doc_id", "vector"), queries.select("query_id", "vector"), DOT, k,
        max_query_rows=max(1, BROADCAST_VALUES // dims),
    )


def nearest_cells(vectors: DataFrame, key: str, centroids: DataFrame, probes: int) -> DataFrame:
    """The ``probes`` nearest cells of each vector: ``(key, cell)``. ``centroids(cell, vector)``."""
    cells = topk(
        centroids.select(F.col("cell").alias("doc_id"), "vector"),
        vectors.select(F.col(key).alias("query_id"), "vector"),
        DOT, probes, max_query_rows=TILE_ROWS,
    )
    return cells.select(F.col("query_id").alias(key), F.col("doc_id").alias("cell"))


def train_cells(vectors: DataFrame, n_cells: int, rounds: int = 12, sample: int = 50_000, seed: int = 3) -> DataFrame:
    """``(cell, vector)``: centroids of a spherical k-means over at most ``sample`` vectors, taken by a hash of the id.

    Only the sample is fitted; every vector is assigned afterwards. Fewer vectors than cells give as many cells.
    """
    taken = first_by(vectors.select("doc_id", "vector"), sample, F.xxhash64(F.lit(seed), F.col("doc_id")), "doc_id").toArrow()
    points = _matrix(taken.column("vector"), taken.num_rows)
    chosen = np.random.default_rng(seed).permutation(len(points))[:n_cells]
    centres = points[np.sort(chosen)]
    for _ in range(rounds if len(points) else 0):
        nearest = np.argmax(points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), centres)
    rows = [(cell, centre.tolist()) for cell, centre in enumerate(centres)] if len(points) else []
    return vectors.sparkSession.createDataFrame(rows, "cell bigint, vector array<double>")


def assign_cells(vectors: DataFrame, key: str, centroids: DataFrame) -> DataFrame:
    """Index build: each vector with its nearest cell (the smallest on ties), stored in one folder per cell.

    The roles are swapped against ``nearest_cells``: the centroid set, whose size in bytes is checked first, is the
    query side, so the corpus is scanned in place.
    """
    centroids = materialise(centroids.select("cell", "vector"), "centroids")
    values = centroids.agg(F.sum(F.size("vector"))).first()[0] or 0
    if values > BROADCAST_VALUES:
        assigned = vectors.join(nearest_cells(vectors, key, centroids, 1), key)
    else:
        found = centroids.orderBy("cell").toArrow()
        cells = found.column("cell").to_numpy()
        matrix = vectors.sparkSession.sparkContext.broadcast(_matrix(found.column("vector"), found.num_rows))

        @F.arrow_udf("bigint")
        def nearest(batch: pa.Array) -> pa.Array:
            scores = np.round(_matrix(batch, len(batch)) @ matrix.value.T, 6)
            return pa.array(cells[scores.argmax(axis=1)])

        assigned = vectors.withColumn("cell", nearest("vector"))
    path = scratch_path(vectors.sparkSession, "cells")
    assigned.write.partitionBy("cell").parquet(path)
    return vectors.sparkSession.read.schema(assigned.schema).parquet(path)


def cell_search(
    indexed: DataFrame, queries: DataFrame, centroids: DataFrame, k: int, probes: int = 2
) -> DataFrame:
    """Approximate top-k over a cell index: a query meets only the documents of its nearest cells.

    Only the folders of probed cells are read. Cells are tiled by their own size, so one that holds a third of the
    corpus is scored by many tasks.
    """
    near = materialise(nearest_cells(queries, "query_id", centroids, probes), "probes")
    probed = [row.cell for row in near.select("cell").distinct().collect()]
    asked = queries.join(near, "query_id")
    return topk_by_key(
        indexed.filter(F.col("cell").isin(probed)).select("cell", "doc_id", "vector"),
        asked.select("cell", "query_id", "vector"), "cell", DOT, k,
    )


def rescore(hits: DataFrame, corpus: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Exact scores of given (query, document) pairs, then the best ``k``."""
    pairs = (
        hits.select("query_id", "doc_id")
        .join(corpus.select("doc_id", F.col("vector").alias("d")), "doc_id")
        .join(queries.select("query_id", F.col("vector").alias("q")), "query_id")
    )
    score = F.aggregate(F.zip_with("q", "d", lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    return rerank(pairs.select("query_id", "doc_id", F.round(score, 6).alias("score")), k)


def rerank(scored: DataFrame, k: int, score: str = "score") -> DataFrame:
    """Order scored pairs by ``score`` and keep the best ``k`` (re-ranking after a wide fetch)."""
    order = W.partitionBy("query_id").orderBy(F.desc(score), F.asc("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def shortened_search(corpus: DataFrame, queries: DataFrame, k: int, coarse_dims: int, fetch: int) -> DataFrame:
    """Search on shortened vectors, then exact scores for the ``fetch`` best of each query."""
    coarse = dense(
        corpus.select("doc_id", shorten(F.col("vector"), coarse_dims).alias("vector")),
        queries.select("query_id", shorten(F.col("vector"), coarse_dims).alias("vector")),
        fetch, coarse_dims,
    )
    return rescore(coarse, corpus, queries, k)


def quantised_search(corpus: DataFrame, queries: DataFrame, k: int, dims: int = 64) -> DataFrame:
    """Search over 8-bit codes of the corpus; the query vectors keep full precision."""
    coded = corpus.select("doc_id", dequantise(quantise(F.col("vector"))).alias("vector"))
    return dense(coded, queries, k, dims)


def _code_matrix(codes: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    # Sums of products of 8-bit codes are whole numbers that a float holds exactly up to 2**24, a double beyond.
    matrix = _matrix(codes, n)
    return matrix.astype(np.float32 if matrix.shape[1] * 127**2 < 1 << 24 else np.float64)


CODES = Scorer(
    lambda block: {"ids": pd.Index(block.column("query_id").to_pandas()), "vectors": _code_matrix(block.column("codes"), block.num_rows)},
    lambda state: state["ids"],
    lambda state, batch: _code_matrix(batch.column("codes"), batch.num_rows) @ state["vectors"].T,
)


def code_search(corpus: DataFrame, queries: DataFrame, k: int, fetch: int, dims: int = 64) -> DataFrame:
    """Search on 8-bit codes: products of whole numbers find ``fetch`` documents a query, exact scores rank them.

    Both sides are quantised; the corpus' full vectors are read for the fetched documents only.
    """
    coded = lambda frame, key: frame.select(key, quantise(F.col("vector")).alias("codes"))
    found = topk(coded(corpus, "doc_id"), coded(queries, "query_id"), CODES, fetch, max_query_rows=max(1, BROADCAST_VALUES // dims))
    return rescore(found, corpus, queries, k)


def blend(queries: DataFrame, texts: DataFrame, mode: str = "average") -> DataFrame:
    """Hypothetical-document search: replace each query vector by that of a supplied text, or average.

    Both sides are ``(query_id, vector)``; queries without a text keep their own vector.
    """
    joined = queries.join(texts.select("query_id", F.col("vector").alias("extra")), "query_id", "left")
    if mode == "replace":
        vector = F.coalesce("extra", "vector")
    else:
        mean = F.zip_with("vector", "extra", lambda x, y: (x + y) / 2)
        vector = F.when(F.col("extra").isNull(), F.col("vector")).otherwise(normalise(mean))
    return joined.select("query_id", vector.alias("vector"))


def diversify(candidates: DataFrame, k: int = 5, balance: float = 0.5) -> DataFrame:
    """Maximal marginal relevance over fetched hits ``(query_id, doc_id, score, vector)``.

    The group of a query is its fetch size, which the search before it has already bounded.
    """
    fields = {f.name: f.dataType.simpleString() for f in candidates.schema.fields}
    schema = f"query_id {fields['query_id']}, doc_id {fields['doc_id']}, score double, rank int"

    def greedy(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["score", "doc_id"], ascending=[False, True]).reset_index(drop=True)
        vectors = np.vstack(group["vector"].to_numpy())
        relevance = group["score"].to_numpy()
        closest = np.full(len(group), 0.0)
        chosen: list[int] = []
        while len(chosen) < min(k, len(group)):
            value = np.round(balance * relevance - (1 - balance) * closest, 9)
            value[chosen] = -np.inf
            pick = int(np.argmax(value))
            similarity = vectors @ vectors[pick]
            closest = similarity if not chosen else np.maximum(closest, similarity)
            chosen.append(pick)
        out = group.loc[chosen, ["query_id", "doc_id", "score"]]
        return out.assign(rank=np.arange(1, len(out) + 1, dtype=np.int32))

    return candidates.groupBy("query_id").applyInPandas(greedy, schema)
