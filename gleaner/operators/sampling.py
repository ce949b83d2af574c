"""A bounded sample by hash that never moves more than a few times its size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

MARGIN = 1000


def first_by(rows: DataFrame, limit: int, order: Column, *ties: str) -> DataFrame:
    """The ``limit`` rows with the smallest ``order``, a 64-bit hash; equal hashes by ``ties``.

    A plain top-n sends up to ``limit`` rows of every partition to one task. Here the rows are counted first, and only those
    below a bound of the hash, about twice the limit and ``MARGIN`` more, take part. A hash that many rows share makes the
    sample smaller, never larger.
    """
    share = (2 * limit + MARGIN) / max(rows.count(), 1)
    some = rows.filter(order < int(share * 2**64) - 2**63) if share < 1 else rows
    return some.orderBy(order, *ties).limit(limit)
