"""Streams: watermark, replays and changed content."""

import datetime as dt

from pyspark.sql import functions as F

from gleaner import schemas
from gleaner.streaming import events as ev


def write(spark, path, rows):
    frame = spark.createDataFrame(rows, schemas.RUN_EVENT)
    frame.coalesce(1).write.mode("append").parquet(path)


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def test_rollup_is_the_same_however_events_arrive(spark, tmp_path):
    rows = [(1, at(1), 1, "a", 2.0, "{}"), (2, at(5), 1, "a", 9.0, "{}"), (3, at(1, 30), 1, "a", 4.0, "{}"), (4, at(3), 1, "b", 1.0, "{}"),
            (5, at(1, 59), 1, "a", None, "{}")]
    whole = spark.createDataFrame(rows, schemas.RUN_EVENT).withColumn("ts", F.col("ts").cast("timestamp"))
    want = sorted(map(tuple, ev.rollup(whole).collect()))
    assert [r[3:] for r in want] == [(3, 6.0, 3.0, True), (1, 1.0, 1.0, True), (1, 9.0, 9.0, False)]
    for per_file, per_trigger in ((5, None), (1, 1), (1, 2), (1, None), (2, 1)):
        folder, out = str(tmp_path / f"in-{per_file}-{per_trigger}"), str(tmp_path / f"out-{per_file}-{per_trigger}")
        for start in range(0, len(rows), per_file):
            write(spark, folder, rows[start : start + per_file])
            got = ev.rollup_available(ev.event_stream(spark, folder, "*.parquet", files_per_trigger=per_trigger), out)
        assert sorted(map(tuple, got.collect())) == want


def test_rollup_of_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert ev.rollup_available(ev.event_stream(spark, str(tmp_path / "in"), "*.parquet"), str(tmp_path / "out")).count() == 0


def test_ingest_adds_only_new_or_changed(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")

    def run(rows, state="state"):
        if rows:
            spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("doc_id long, text string").parquet(folder)
        ev.ingest_changed(stream, target, str(tmp_path / state), "doc_id", ["text"])
        return sorted((r.version, r.doc_id, r.text) for r in spark.read.parquet(target).select("doc_id", "text", "version").collect())

    first = [(0, 1, "a"), (0, 2, "b")]
    assert run([(1, "a"), (2, "b"), (2, "b")]) == first
    second = [*first, (1, 2, "changed"), (1, 3, "c")]
    assert run([(1, "a"), (2, "changed"), (3, "c")]) == second
    third = [*second, (2, 2, "b"), (2, 4, None)]
    assert run([(2, "b"), (4, None)]) == third
    assert run([]) == third and run([(4, None), (3, "c")]) == third
    fourth = [*third, (3, None, "n")]
    key = lambda rows: sorted(rows, key=str)
    spark.createDataFrame([(None, "n")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(folder)
    for _ in range(2):
        stream = spark.readStream.schema("doc_id long, text string").parquet(folder)
        ev.ingest_changed(stream, target, str(tmp_path / "state"), "doc_id", ["text"])
        spark.createDataFrame([(None, "n")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(folder)
    stored = spark.read.parquet(target).select("version", "doc_id", "text").collect()
    assert key(map(tuple, stored)) == key(fourth)
    # A new checkpoint reads all files again; nothing that was there is lost.
    spark.createDataFrame([(9, "z")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(folder)
    ev.ingest_changed(spark.readStream.schema("doc_id long, text string").parquet(folder), target, str(tmp_path / "other"), "doc_id", ["text"])
    assert set(fourth) <= {(r.version, r.doc_id, r.text) for r in spark.read.parquet(target).collect()}


def test_regressions_are_flagged_by_direction(spark):
    windows = spark.createDataFrame([("a", 13.0), ("b", 7.0)], "event_type string, mean double")
    base = spark.createDataFrame([("a", 10.0), ("b", 10.0)], "event_type string, mean double")
    worse_high = ev.flag_regressions(windows, base, 0.2, F.lit(-1)).collect()
    assert {r.event_type: r.regressed for r in worse_high} == {"a": True, "b": False}


def test_one_sided_and_zero_baselines_stay(spark):
    windows = spark.createDataFrame([("a", 13.0), ("b", 7.0)], "event_type string, mean double")
    base = spark.createDataFrame([("a", 0.0), ("c", 10.0)], "event_type string, mean double")
    rows = {r.event_type: (r.change, r.regressed, r.missing_in) for r in ev.flag_regressions(windows, base, 0.2, F.lit(-1)).collect()}
    assert rows == {"a": (None, False, None), "b": (None, False, "baseline"), "c": (None, False, "windows")}
