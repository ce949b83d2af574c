"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.session import materialise

#: Ids sent to every executor at most (about 16 bytes each); beyond that the join is a shuffled one.
BROADCAST_IDS = 2_000_000
#: Rows that a Python worker gets at once; texts can be long, so this bounds what tasks hold on both sides.
BATCH_ROWS = 1000
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: A word: a run of characters other than the space and the controls 9 to 13.
WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def by_ids(rows: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join of wide ``rows`` with a one-column table of ids.

    The ids are stored and counted first: up to ``BROADCAST_IDS`` they are broadcast, so the wide rows stay
    where they are; a larger table takes the shuffled join. Both give the same rows.
    """
    stored = materialise(ids.select(key).distinct(), "ids")
    small = stored.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(stored) if small else stored, key, how)


def map_batches(
    rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` in batches of at most ``BATCH_ROWS`` rows; a worker gives unused memory back when its task ends."""
    conf = rows.sparkSession.conf
    if not 0 < int(conf.get(BATCH_CONF)) <= BATCH_ROWS:
        conf.set(BATCH_CONF, str(BATCH_ROWS))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(bounded, schema)
