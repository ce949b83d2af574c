"""Stream queries: the events table read as a file stream, results written in append mode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.plans.registry import Tables, query
from gleaner.streaming import events as ev


def stream(t: Tables) -> DataFrame:
    return ev.event_stream(t.spark, t.folder, "events.parquet")


NUDGE = 1e-9  # moves exact halves off the rounding edge, where engines differ


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name) + NUDGE, 4) for name in ("total", "mean")})


def pieces(t: Tables, name: str, count: int = 5) -> DataFrame:
    """The events as a stream of ``count`` files in no order of time, one file per micro-batch."""
    folder = t.scratch(name)
    for piece in range(count):
        part = t.events.filter(F.pmod(F.col("event_id"), F.lit(count)) == piece)
        part.coalesce(1).write.mode("append").parquet(f"{folder}/{piece}")
    return ev.event_stream(t.spark, f"{folder}/*", "*.parquet", files_per_trigger=1)


@query("run_events", "SELECT event_type, (props::JSON->>'k')::INTEGER % 10 AS bucket, count(*) AS n FROM events GROUP BY ALL")
def run_events(t: Tables) -> DataFrame:
    parsed = ev.payload(stream(t)).select("event_type", (F.col("payload.k") % 10).alias("bucket"))
    written = ev.run_available(parsed, t.scratch("run-events"))
    return written.groupBy("event_type", "bucket").agg(F.count(F.lit(1)).alias("n"))


HOURS = """w AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value) + 1e-9, 4) AS total, round(avg(value) + 1e-9, 4) AS mean FROM events GROUP BY ALL),
hours AS (SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, event_type, n, total, mean,
window_start + INTERVAL '1 hour' <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events) AS closed FROM w)"""


@query("event_rollup", f"WITH {HOURS} SELECT * FROM hours")
def event_rollup(t: Tables) -> DataFrame:
    """Hourly windows from a stream of several files out of order: every window, late events included."""
    return _rounded(ev.rollup_available(pieces(t, "events"), t.scratch("rollup")))


@query("event_rollup_batch", f"WITH {HOURS} SELECT * FROM hours")
def event_rollup_batch(t: Tables) -> DataFrame:
    """The same roll-up on the table as a batch."""
    return _rounded(ev.rollup(t.events.withColumn("ts", F.col("ts").cast("timestamp"))))


@query("feedback_windows", """WITH d AS (SELECT unnest(range(0, 7)) AS k), e AS (SELECT date_trunc('day', ts)::TIMESTAMP - to_days(k::INTEGER) AS window_start, event_type, value FROM events, d),
w AS (SELECT window_start, window_start + INTERVAL '7 days' AS window_end, event_type, count(*) AS n, round(sum(value) + 1e-9, 4) AS total, round(avg(value) + 1e-9, 4) AS mean FROM e GROUP BY ALL)
SELECT *, window_end <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events) AS closed FROM w""")
def feedback_windows(t: Tables) -> DataFrame:
    """Insights over the last seven days, sliding by one day."""
    return _rounded(ev.rollup_available(stream(t), t.scratch("feedback"), "7 days", "1 day"))


@query("incremental_ingest", """SELECT doc_id, md5(text) AS text_print, CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END::BIGINT AS version FROM documents
UNION ALL SELECT doc_id, md5(text || '!'), 1 FROM documents WHERE doc_id % 3 = 0 AND doc_id % 5 <> 0
UNION ALL SELECT doc_id, md5(text), 2 FROM documents WHERE doc_id % 6 = 0 AND doc_id % 5 <> 0""")
def incremental_ingest(t: Tables) -> DataFrame:
    """Four loads of one folder: all but every fifth document; then these new ones with changed and unchanged rows; then
    some changed back; then the whole folder again under a new checkpoint, which adds nothing."""
    target, state, folder = t.scratch("ingest"), t.scratch("ingest-state"), t.scratch("ingest-in")
    docs = t.documents.select("doc_id", "text")
    new, changed, back = F.col("doc_id") % 5 == 0, F.col("doc_id") % 3 == 0, F.col("doc_id") % 6 == 0
    edited = F.when(changed & ~new, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    loads = [docs.filter(~new), docs.withColumn("text", edited), docs.filter(back)]
    schema = "doc_id bigint, text string, load int"
    for number, load in enumerate(loads):
        load.withColumn("load", F.lit(number)).write.mode("append").parquet(folder)
        ev.ingest_changed(t.spark.readStream.schema(schema).parquet(folder), target, state, "doc_id", ["text"], ["load"])
    again = t.spark.readStream.schema(schema).parquet(folder)
    ev.ingest_changed(again, target, t.scratch("ingest-state"), "doc_id", ["text"], ["load"])
    stored = t.spark.read.schema("doc_id bigint, text string, version bigint").parquet(target)
    return stored.select("doc_id", F.md5("text").alias("text_print"), "version")


@query("metric_monitoring", f"""WITH {HOURS}, base AS (SELECT event_type, round(avg(value) + 1e-9, 4) AS baseline FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY event_type)
SELECT window_start, event_type, mean, baseline, round((mean - baseline) / baseline, 4) + 0.0 AS change, coalesce((mean - baseline) / baseline > 0.2, false) AS regressed,
CASE WHEN baseline IS NULL THEN 'baseline' END AS missing_in
FROM hours LEFT JOIN base USING (event_type)""")
def metric_monitoring(t: Tables) -> DataFrame:
    """Hourly latency against the first half of the month; higher is worse."""
    windows = _rounded(ev.rollup_available(stream(t), t.scratch("monitoring")))
    means = t.events.filter("ts < '2024-01-16'").groupBy("event_type").agg(F.round(F.avg("value") + NUDGE, 4).alias("mean"))
    flagged = ev.flag_regressions(windows, means, 0.2, F.lit(-1))
    return flagged.select("window_start", "event_type", "mean", "baseline", (F.round("change", 4) + F.lit(0.0)).alias("change"), "regressed", "missing_in")
