"""Positions of rows in a sorted table without a single-task window.

Rows are range-partitioned, sorted and written to the shared folder with their partition's
number and their place in it.  Counts per partition (one row each) or per partition and group
then shift those places.  Equal rows are told apart by the place they were read from, so that
many copies of one row are spread over partitions too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termweave.llm.common import staged

_BITS = 33  # of monotonically_increasing_id: partition above, place below


def _ordered(df: DataFrame, order: list[Column], tag: str) -> DataFrame:
    """``df`` written in order, with ``part`` (partition) and ``place`` (from 0 in it)."""
    keys = [*order, F.col("read_at").asc()]
    flat = (df.withColumn("read_at", F.monotonically_increasing_id())
            .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("read_at"))
    at = F.monotonically_increasing_id()
    return staged(flat.select("*", at.alias("at")).select(
        "*", F.shiftright("at", _BITS).alias("part"),
        F.col("at").bitwiseAND(F.lit((1 << _BITS) - 1)).alias("place")).drop("at"), tag)


def _before(group: list[str], n: str = "n") -> Column:
    """Sum of ``n`` over the earlier partitions of the group."""
    w = Window.partitionBy(*group) if group else Window.partitionBy()
    return F.coalesce(F.sum(n).over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def numbered(df: DataFrame, order: list[Column], out: str, tag: str = "numbered") -> DataFrame:
    """``df`` with ``out``: dense position from 0 in ``order``.  ``df`` must be a bare scan of a
    written table, so that a repeated task reads its rows in the same order."""
    x = _ordered(df, order, tag)
    counts = x.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per partition
    starts = counts.select("part", _before([]).alias("start"))
    return x.join(F.broadcast(starts), "part").withColumn(out, F.col("start") + F.col("place")).drop(
        "part", "place", "start")


def ranked(df: DataFrame, group: str, order: list[Column], out: str, tag: str = "ranked") -> DataFrame:
    """``df`` with ``out``: position from 0 in ``order`` inside each ``group`` (a column without
    nulls).  A group may hold any share of the rows.  ``df`` as in ``numbered``."""
    x = _ordered(df, [F.col(group).asc(), *order], tag)
    runs = staged(x.groupBy("part", group).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), tag)
    starts = runs.select("part", group, (_before([group]) - F.col("first")).alias("start"))
    return x.join(starts, ["part", group]).withColumn(out, F.col("start") + F.col("place")).drop(
        "part", "place", "start")
