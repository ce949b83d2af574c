"""Combining ranked lists: multi-query union, parent roll-up, rank fusion, multi-index concatenation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RRF_CONSTANT = 60  # fixed value


def _rank(df: DataFrame, *order: Column, k: int | None = None) -> DataFrame:
    ranked = df.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k) if k else ranked


def cut(hits: DataFrame, top_k: int) -> DataFrame:
    """Hits up to rank ``top_k``."""
    return hits.filter(F.col("rank") <= top_k)


def variant_union(hits: DataFrame, variants: DataFrame) -> DataFrame:
    """Unique union of the hits of several phrasings of a question, in first-seen order.

    ``hits.query_id`` is a variant; ``variants(variant_id, query_id, variant_no)`` maps it to its question.
    """
    seen = (
        hits.withColumnRenamed("query_id", "variant_id")
        .join(variants, "variant_id")
        .groupBy("query_id", "doc_id")
        .agg(F.min(F.struct("variant_no", "rank")).alias("first"), F.max("score").alias("score"))
    )
    ranked = _rank(seen, F.asc("first.variant_no"), F.asc("first.rank"), F.asc("doc_id"))
    return ranked.select("query_id", "doc_id", "score", "rank")


def parents_of(hits: DataFrame, parent_type: str = "bigint") -> DataFrame:
    """Distinct parents of child hits, in the order of their first child.

    A child's id starts with its parent's (``parent#n``), so no chunk table has to be read again.
    """
    rolled = (
        hits.withColumn("parent_id", F.substring_index("doc_id", "#", 1).cast(parent_type))
        .groupBy("query_id", "parent_id")
        .agg(F.min("rank").alias("first"), F.max("score").alias("score"))
        .withColumnRenamed("parent_id", "doc_id")
    )
    return _rank(rolled, F.asc("first"), F.asc("doc_id")).select("query_id", "doc_id", "score", "rank")


def equal_weights(members: DataFrame) -> DataFrame:
    """Weights ``1/n`` over the available members: ``members(retriever_type, available)``.

    Unavailable members drop out and the rest share the weight; with one left it keeps its own order
    under fusion, with none the result is empty. The member table has one row per retriever.
    """
    alive = members.filter("available")
    count = alive.agg(F.count(F.lit(1))).scalar()
    return alive.select("retriever_type", (F.lit(1.0) / count).alias("weight"))


def fuse(hits: DataFrame, weights: DataFrame, k: int | None = None, constant: int = RRF_CONSTANT) -> DataFrame:
    """Weighted reciprocal-rank fusion of ``hits(retriever_type, query_id, doc_id, rank)``.

    Repeated documents of a member count once, at their best rank.
    """
    once = hits.groupBy("retriever_type", "query_id", "doc_id").agg(F.min("rank").alias("rank"))
    fused = (
        once.join(weights, "retriever_type")
        .groupBy("query_id", "doc_id")
        .agg(F.round(F.sum(F.col("weight") / (F.col("rank") + constant)), 9).alias("score"))
    )
    return _rank(fused, F.desc("score"), F.asc("doc_id"), k=k)


def concatenate(hits: DataFrame, quotas: DataFrame, limit: int = 5) -> DataFrame:
    """Multi-index search: ``quota`` hits of each index, indexes in order, the first ``limit`` overall.

    ``quotas(retriever_type, position, quota)``.
    """
    taken = hits.join(quotas, "retriever_type").filter(F.col("rank") <= F.col("quota"))
    return _rank(
        taken.withColumnRenamed("rank", "own_rank"), F.asc("position"), F.asc("own_rank"), k=limit
    ).select("query_id", "doc_id", "retriever_type", "score", "rank")
