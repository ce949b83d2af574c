"""Sinks: JSON, Parquet, CSV and partitioned result stores. All writes stay distributed."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.shaping import json_order, pruned_json
from gleaner.session import scratch_path

UNION_CONF = "spark.sql.unionOutputPartitioning"
ISO = "yyyy-MM-dd'T'HH:mm:ss"


def save_json(docs: DataFrame, path: str, mode: str = "error") -> None:
    """Documents as JSON lines, dates in ISO form."""
    docs.write.mode(mode).options(dateFormat="yyyy-MM-dd", timestampFormat=ISO, timestampNTZFormat=ISO).json(path)


def save_formats(docs: DataFrame, path: str, formats: list[str], mode: str = "error") -> list[str]:
    """One copy per format below ``path``; returns the paths."""
    written = []
    for name in formats:
        target = f"{path}/{name}"
        if name == "json":
            save_json(docs, target, mode)
        else:
            docs.write.mode(mode).format(name).save(target)
        written.append(target)
    return written


def store_results(metrics: DataFrame, path: str, run_ts: Column, full: DataFrame | None = None) -> None:
    """Append a run's metrics, partitioned by retriever and run; the full hits only when given."""
    stamped = metrics.withColumn("run_ts", run_ts)
    stamped.write.partitionBy("retriever_type", "run_ts").mode("append").json(f"{path}/metrics")
    if full is not None:
        full.withColumn("run_ts", run_ts).write.partitionBy("retriever_type", "run_ts").mode("append").json(f"{path}/results")


def save_comparison(table: DataFrame, path: str, mode: str = "error") -> None:
    """The comparison table (one row per retriever) as a single CSV file."""
    table.coalesce(1).write.mode(mode).option("header", True).csv(path)


def hub_records(docs: DataFrame) -> DataFrame:
    """``(page_content, metadata_json)`` with empty metadata values left out."""
    return docs.select("page_content", pruned_json(F.col("metadata")).alias("metadata_json"))


def save_test_set(examples: DataFrame, path: str, mode: str = "error") -> int:
    """The test set as Parquet; returns the number of samples written."""
    examples.write.mode(mode).parquet(path)
    return examples.sparkSession.read.parquet(path).count()


def save_graph(nodes: DataFrame, relationships: DataFrame, path: str, mode: str = "error") -> None:
    """Nodes and relationships as JSON lines; parent folders are made by the writer."""
    nodes.write.mode(mode).json(f"{path}/nodes")
    relationships.write.mode(mode).json(f"{path}/relationships")


def save_graph_file(nodes: DataFrame, relationships: DataFrame, path: str, files: int = 1, mode: str = "error") -> None:
    """Nodes and relationships as ``files`` JSON objects ``{"nodes": [...], "relationships": [...]}``, one a file.

    Each file is written as a stream by one task, so more files are written faster; null fields are left out. The rows are
    stored by file first, so that a task reads its nodes and then its relationships without sorting them.
    """
    spark, stored = nodes.sparkSession, []
    for name, rows in (("nodes", nodes), ("relationships", relationships)):
        lines = rows.select(F.to_json(F.struct(*rows.columns)).alias("text")).withColumn("file", F.pmod(F.xxhash64("text"), F.lit(files)).cast("int"))
        lines.write.partitionBy("file").parquet(place := scratch_path(spark, f"{name}-lines"))
        stored.append(spark.read.schema("text string, file int").parquet(place))
    lists = [rows.select("file", F.lit(i).alias("list"), "text") for i, rows in enumerate(stored)]
    own = lambda i: reduce(DataFrame.unionByName, [rows.filter(F.col("file") == i).drop("file") for rows in lists])
    dealt = reduce(DataFrame.unionByName, [own(i).coalesce(1) for i in range(files)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        openings, now, first = ['{"nodes": [', '], "relationships": [', "]}"], 0, True
        yield pa.RecordBatch.from_pydict({"value": openings[:1]})
        for batch in batches:
            out = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i < now:
                    raise ValueError("a node came after the relationships")
                if i > now:
                    out.append(openings[1])
                    now, first = i, True
                out.append(text if first else f",{text}")
                first = False
            yield pa.RecordBatch.from_pydict({"value": out})
        yield pa.RecordBatch.from_pydict({"value": openings[now + 1 :]})

    # The files are one partition each: a union of single partitions must not become a single one.
    held = spark.conf.get(UNION_CONF, None)
    spark.conf.set(UNION_CONF, "false")
    try:
        dealt.mapInArrow(run, "value string").write.mode(mode).text(path)
    finally:
        spark.conf.unset(UNION_CONF) if held is None else spark.conf.set(UNION_CONF, held)


def save_metadata_csv(table: DataFrame, path: str, mode: str = "error") -> None:
    """A metadata table as CSV; map, array and struct columns become JSON text."""
    flat = [
        F.to_json(json_order(F.col(f.name)) if f.dataType.typeName() == "map" else F.col(f.name)).alias(f.name)
        if f.dataType.typeName() in ("map", "array", "struct")
        else F.col(f.name)
        for f in table.schema.fields
    ]
    table.select(*flat).write.mode(mode).options(header=True, quote='"', escape='"').csv(path)
