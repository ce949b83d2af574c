"""Comparison and reporting over tall metric tables ``(retriever_type, metric, value)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.operators.catalog import lookup

# The columns of the comparison table, and the axes of its charts.
COMPARISON_METRICS = ["success_rate", "avg_latency_ms", "precision", "recall", "f1", "mrr", "ndcg"]
CHARTS = {
    "relevance": ["precision", "recall", "f1"],
    "latency": ["avg_latency_ms"],
    "radar": ["precision", "recall", "f1", "mrr", "ndcg"],
}
LOWER_IS_BETTER = ["avg_latency_ms", "noise_sensitivity", "judged_noise_sensitivity"]


def direction(metric: Column) -> Column:
    """1 where higher is better, -1 where lower is better."""
    return F.when(metric.isin(LOWER_IS_BETTER), -1).otherwise(1)


def tall(wide: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Wide metrics to tall rows with the value as text to four decimals."""
    cast = wide.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics])
    rows = cast.unpivot(keys, metrics, "metric", "value")
    return rows.withColumn("shown", F.format_string("%.4f", F.col("value")))


def wide(rows: DataFrame, metrics: list[str] | None = None, prefix: str | None = "judged_") -> DataFrame:
    """Comparison row per retriever, default 0. Judged columns appear only if some run has them.

    The column list is at most the set of metric names, found by one small aggregate.
    """
    columns = list(metrics or COMPARISON_METRICS)
    if prefix:
        judged = rows.filter(F.startswith("metric", F.lit(prefix))).select("metric").distinct().orderBy("metric")
        columns += [row.metric for row in judged.collect() if row.metric != prefix + "available"]
    pivoted = rows.groupBy("retriever_type").pivot("metric", columns).agg(F.first("value"))
    return pivoted.fillna(0.0, columns)


def best_per_metric(rows: DataFrame, order: str = "retriever_type") -> DataFrame:
    """Best retriever per metric, by the metric's direction; ties go to the first by ``order``."""
    ranked = W.partitionBy("metric").orderBy(F.desc(F.col("value") * direction(F.col("metric"))), F.asc(order))
    return (
        rows.withColumn("place", F.row_number().over(ranked))
        .filter("place = 1")
        .select("metric", "retriever_type", "value")
    )


def overall(rows: DataFrame, directed: bool = False) -> DataFrame:
    """Mean over a retriever's metrics, best first; ``directed`` counts lower-is-better ones negatively."""
    value = F.col("value") * direction(F.col("metric")) if directed else F.col("value")
    scored = rows.groupBy("retriever_type").agg(F.avg(value).alias("overall"), F.count("value").alias("n_metrics"))
    return scored.orderBy(F.desc("overall"), F.asc("retriever_type"))


def chart_series(rows: DataFrame) -> DataFrame:
    """Data of the charts: ``(chart, series, x, y)``; bars are grouped by metric, the radar by retriever."""
    memberships = {m: ",".join(c for c, axes in CHARTS.items() if m in axes) for m in COMPARISON_METRICS}
    charts = F.split(lookup(memberships, F.col("metric")), ",")
    spread = rows.select("retriever_type", "metric", "value", F.explode(F.filter(charts, lambda c: c != "")).alias("chart"))
    radar = F.col("chart") == "radar"
    return spread.select(
        "chart",
        F.when(radar, F.col("retriever_type")).otherwise(F.col("metric")).alias("series"),
        F.when(radar, F.col("metric")).otherwise(F.col("retriever_type")).alias("x"),
        F.col("value").alias("y"),
    )


def run_summary(details: DataFrame, run_id: str, as_of: Column, versions: dict[str, str]) -> DataFrame:
    """One row per run: retrievers evaluated, dataset size, id, time and versions."""
    names = F.array_join(F.array_sort(F.collect_set("retriever_type")), ",")
    return details.agg(
        names.alias("retrievers"),
        F.count_distinct("question_id").alias("dataset_size"),
    ).withColumns(
        {
            "run_id": F.lit(run_id),
            "run_ts": as_of,
            **{f"version_{name}": F.lit(value) for name, value in versions.items()},
        }
    )
