"""Run events as a stream: tumbling roll-up, sliding insights, incremental ingest, monitoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner import schemas
from gleaner.session import path_exists


def event_stream(
    spark: SparkSession, folder: str, glob: str, schema: T.StructType | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """Event files of a folder as a stream, with event time as a timestamp.

    ``files_per_trigger`` bounds the work of one micro-batch; no result of this module depends on it.
    """
    reader = spark.readStream.schema(schema or schemas.RUN_EVENT).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def payload(events: DataFrame, schema: str = "k int") -> DataFrame:
    """Parse the JSON payload of the events."""
    return events.withColumn("payload", F.from_json("props", schema))


def windowed(events: DataFrame, width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Count and sum of ``value`` per window and event type, and the latest event time among them."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    grouped = events.groupBy(window.alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.count("value").alias("n_values"),
        F.max("ts").alias("last_event"),
    )
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n", "total", "n_values",
        "last_event",
    )


def merged_windows(parts: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Whole windows from partial ones, every window and every late event included.

    ``closed`` tells whether the latest event lies at least ``delay`` after the end of the window; an open window
    may still grow when more events come.
    """
    whole = parts.groupBy("window_start", "window_end", "event_type").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("n_values").alias("n_values")
    )
    latest = parts.agg(F.max("last_event")).scalar()
    return whole.select(
        "window_start", "window_end", "event_type", "n", "total",
        (F.col("total") / F.nullif(F.col("n_values"), F.lit(0))).alias("mean"),
        F.coalesce(F.col("window_end") <= latest - F.expr(f"INTERVAL {delay}"), F.lit(False)).alias("closed"),
    )


def rollup(events: DataFrame, width: str = "1 hour", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Count, sum and mean of ``value`` per window and event type of a batch."""
    return merged_windows(windowed(events, width, slide), delay)


def rollup_available(
    stream: DataFrame, path: str, width: str = "1 hour", slide: str | None = None, delay: str = "10 minutes"
) -> DataFrame:
    """Roll up what is there now, exactly once, and return all windows so far.

    Each micro-batch adds its partial sums per window below ``path``; sums are merged when they are read, so a late
    event is added to its window whenever it comes, and the result is that of :func:`rollup` over all events however
    they were cut into files and micro-batches. A repeated micro-batch overwrites its own part.
    """
    spark = stream.sparkSession

    def add(batch: DataFrame, batch_id: int) -> None:
        part = windowed(batch, width, slide)
        part.write.mode("overwrite").parquet(f"{path}/data/run={_run_of(batch)}/batch={batch_id}")

    _process(stream, add, f"{path}/state")
    schema = windowed(spark.createDataFrame([], stream.schema), width, slide).schema
    if not path_exists(spark, f"{path}/data"):
        return merged_windows(spark.createDataFrame([], schema), delay)
    return merged_windows(spark.read.schema(schema).parquet(f"{path}/data"), delay)


def _process(stream: DataFrame, action: Callable[[DataFrame, int], None], state: str) -> None:
    query = stream.writeStream.foreachBatch(action).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()


def _run_of(batch: DataFrame) -> str:
    """The id of the running query: it stays with its checkpoint and is new for a new one."""
    return batch.sparkSession._jsparkSession.sparkContext().getLocalProperty("sql.streaming.queryId")


def run_available(stream: DataFrame, path: str) -> DataFrame:
    """Process what is there now in append mode, exactly once, and return the written table."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{path}/data").option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/data")


def ingest_changed(
    stream: DataFrame, target: str, state: str, key: str, content: list[str], order: list[str] | None = None
) -> None:
    """Append rows that are new or whose content differs from the key's latest version in the target.

    Versions are numbered by ``version``, one number per micro-batch that wrote something. Of several rows of a key
    in one micro-batch the last by ``order``, then by all columns, counts. A null key is a key like others. Parts are kept by query and micro-batch: a
    repeated micro-batch overwrites its own part only, and a query with a new checkpoint adds to what is there.
    """
    digest = F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in content]), 256)
    columns = stream.columns
    stored = [("digest", T.StringType()), ("version", T.LongType()), ("run", T.StringType()), ("batch", T.LongType())]
    schema = T.StructType([*stream.schema.fields, *(T.StructField(n, t) for n, t in stored)])

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, _run_of(batch)
        whole = F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order or [])), *columns)
        last = batch.groupBy(F.col(key).alias("the_key")).agg(F.max(whole).alias("row")).select("row.*").select(columns)
        fresh, version = last.withColumn("digest", digest), 0
        if path_exists(spark, target):
            others = spark.read.schema(schema).parquet(target).filter((F.col("run") != run) | (F.col("batch") != batch_id))
            version = (others.agg(F.max("version")).first()[0] or 0) + 1
            known = others.groupBy(F.col(key).alias("known_key")).agg(F.max_by("digest", "version").alias("known"))
            fresh = fresh.join(known, F.col(key).eqNullSafe(F.col("known_key")), "left").drop("known_key").filter(~F.col("digest").eqNullSafe(F.col("known"))).drop("known")
        fresh.withColumn("version", F.lit(version).cast("long")).write.mode("overwrite").parquet(f"{target}/run={run}/batch={batch_id}")

    _process(stream, merge, state)


def flag_regressions(windows: DataFrame, baseline: DataFrame, threshold: float, direction: Column) -> DataFrame:
    """Windows whose mean is worse than the baseline run by more than ``threshold`` (relative).

    Types of one side only stay, named by ``missing_in``; without a baseline, or with one of 0, ``change`` is NULL and
    nothing is flagged.
    """
    base = baseline.select("event_type", F.col("mean").alias("baseline"), F.lit(True).alias("in_baseline"))
    joined = windows.withColumn("in_windows", F.lit(True)).join(base, "event_type", "full")
    change = (F.col("mean") - F.col("baseline")) / F.nullif(F.abs("baseline"), F.lit(0.0))
    missing = F.when(F.col("in_baseline").isNull(), "baseline").when(F.col("in_windows").isNull(), "windows")
    return joined.withColumns({"change": change, "missing_in": missing}).withColumn(
        "regressed", F.coalesce(F.col("change") * direction < -threshold, F.lit(False))
    ).drop("in_baseline", "in_windows")
