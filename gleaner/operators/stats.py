"""Dataset statistics and loading reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def test_set_stats(examples: DataFrame) -> DataFrame:
    """Example count, key presence (vacuously true on no rows) and non-empty shares."""
    has_context = F.coalesce(F.size("context") > 0, F.lit(False))
    has_answer = F.coalesce(F.trim("answer") != "", F.lit(False))
    return examples.agg(
        F.count(F.lit(1)).alias("example_count"),
        F.coalesce(F.bool_and(F.col("context").isNotNull()), F.lit(True)).alias("has_context"),
        F.coalesce(F.bool_and(F.col("answer").isNotNull()), F.lit(True)).alias("has_answers"),
        F.avg(has_context.cast("double")).alias("context_share"),
        F.avg(has_answer.cast("double")).alias("answer_share"),
    )


def load_report(requested: DataFrame, loaded: DataFrame, key: str, by: str) -> DataFrame:
    """Requested, loaded, failed and documents per loader. ``loaded`` may hold many documents per key."""
    per_key = loaded.groupBy(by, key).agg(F.count(F.lit(1)).alias("documents"))
    joined = requested.select(by, key).join(per_key, [by, key], "left")
    return joined.groupBy(by).agg(
        F.count(F.lit(1)).alias("requested"),
        F.count("documents").alias("loaded"),
        F.count_if(F.col("documents").isNull()).alias("failed"),
        F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"),
    )


def load_failures(requested: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Requested keys that were not loaded."""
    missing = requested.select(key).distinct().join(loaded.select(key), key, "left_anti")
    return missing.withColumn("error", F.lit("not found"))


def counts_with_total(docs: DataFrame, by: str) -> DataFrame:
    """Documents per source and a ``Total`` row."""
    rolled = docs.rollup(by).agg(F.count(F.lit(1)).alias("documents"), F.grouping_id().alias("level"))
    return rolled.select(F.when(F.col("level") == 1, F.lit("Total")).otherwise(F.col(by)).alias(by), "documents")


def key_coverage(rows: DataFrame, column: str = "metadata", by: list[str] | None = None) -> DataFrame:
    """How many rows carry each map key with a value: ``key, present, total, coverage_pct``.

    The row total rides along as a NULL key, so the table is read and shuffled once.
    """
    groups = by or []
    filled = F.map_keys(F.map_filter(column, lambda _, v: v.isNotNull()))
    marked = rows.select(*groups, F.explode(F.concat(F.array(F.lit(None).cast("string")), filled)).alias("key"))
    counted = marked.groupBy(*groups, "key").agg(F.count(F.lit(1)).alias("present"))
    totals = counted.filter(F.col("key").isNull()).select(*groups, F.col("present").alias("total"))
    keyed = counted.filter(F.col("key").isNotNull())
    if groups:
        joined = keyed.join(totals, groups)
    else:
        joined = keyed.withColumn("total", totals.select("total").scalar())
    return joined.withColumn("coverage_pct", F.col("present") * 100.0 / F.col("total"))


def download_report(items: DataFrame) -> DataFrame:
    """Download counts from a ``status`` column; the total leaves failures out."""
    good, skipped = (F.count_if(F.col("status") == s) for s in ("successful", "skipped"))
    return items.agg(
        good.alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        skipped.alias("skipped"),
        (good + skipped).alias("total"),
    )


def load_summary(pages: DataFrame, file: str) -> DataFrame:
    """Pages and distinct files of a load."""
    return pages.agg(F.count(F.lit(1)).alias("page_count"), F.count_distinct(file).alias("file_count"))


def loader_comparison(docs: DataFrame) -> DataFrame:
    """Metadata keys by loader with their counts, and each loader's mean content length.

    ``docs(loader_type, page_content, metadata)``.
    """
    coverage = key_coverage(docs, "metadata", ["loader_type"])
    lengths = docs.groupBy("loader_type").agg(F.avg(F.length("page_content")).alias("avg_length"))
    return coverage.join(lengths, "loader_type").select("loader_type", "key", "present", "total", "avg_length")
