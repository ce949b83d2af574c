"""Global row numbers without sorting the whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.session import materialise

#: ``monotonically_increasing_id`` has the number of the row inside its partition in so many low bits.
PART_BITS = 33


def with_ordinal(df: DataFrame, keys: list[str], name: str = "ordinal") -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order of ``keys`` (which have to identify a row).

    Rows are range-partitioned once and sorted there; see :func:`numbered`.
    """
    return numbered(materialise(placed(df.repartitionByRange(*keys).sortWithinPartitions(*keys)), "ranged"), name)


def placed(df: DataFrame) -> DataFrame:
    """``df`` with the ``place`` of each row: its partition and its number inside it. No row moves."""
    return df.withColumn("place", F.monotonically_increasing_id())


def numbered(rows: DataFrame, name: str = "ordinal") -> DataFrame:
    """Stored rows with a ``place``, numbered 0, 1, 2, ... in that order; the place goes.

    The offsets of the partitions come from a running sum over one row per partition, stored so that the planner knows
    how few they are.
    """
    part = F.shiftright("place", PART_BITS)
    running = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    offsets = materialise(sizes.select("part", F.coalesce(F.sum("size").over(running), F.lit(0)).alias("offset")), "offsets")
    inside = F.col("place").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    return rows.withColumn("part", part).join(offsets, "part").withColumn(name, inside + F.col("offset")).drop("part", "place", "offset")


def batch_id(ordinal: Column, size: int) -> Column:
    """Number of the fixed-size batch an ordinal falls in."""
    return F.floor(ordinal / size).cast("bigint")
