"""Query registry and access to the input tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import path_exists, scratch_path, ship_package

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Paths of what ``Tables.stored`` wrote, by application, folder and name.
_stored: dict[tuple[str, str, str], str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL counterpart (None: no SQL expresses it)."""

    def add(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


class Tables:
    """The parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str, *columns: str) -> DataFrame:
        """A table for CPU-heavy work: spread over the cores when its files give too few partitions.

        A table that already has a partition per core is left alone, so large inputs are not shuffled.
        """
        df = getattr(self, name).select(*columns) if columns else getattr(self, name)
        cores = self.spark.sparkContext.defaultParallelism
        return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def stored[T](self, name: str, build: Callable[[str], T], load: Callable[[str], T]) -> T:
        """What ``build`` wrote for these tables earlier in this application, read by ``load``; built now if it is not there.

        The note of it lasts as long as the scratch folder does: after ``release`` it is built again.
        """
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key in _stored and path_exists(self.spark, _stored[key]):
            return load(_stored[key])
        path = self.scratch(name)
        found = build(path)
        _stored[key] = path
        return found

    @cached_property
    def corpus(self) -> DataFrame:
        return self.spread("documents", "doc_id", "text")

    @cached_property
    def questions(self) -> DataFrame:
        return self.benchmark.select(F.col("item_id").alias("query_id"), "text")
