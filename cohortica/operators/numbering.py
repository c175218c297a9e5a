"""Gapless row numbers, and running sums over sorted rows, without a window over all rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """df cut off from its lineage in the folder that spark.checkpoint.dir names; in local mode without one, in a folder of our own."""
    spark, sc = df.sparkSession, df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            named = tempfile.mkdtemp(prefix="cohortica-")
        sc.setCheckpointDir(named)
    return df.checkpoint()


def spread(df: DataFrame, *key: str) -> DataFrame:
    """df dealt by key to as many partitions as the session shuffles to.

    For rows that are few bytes but much work, which adaptive execution would put into one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def in_ranges(df: DataFrame, *order: str | Column, ranges: int | None = None) -> DataFrame:
    """df sorted in ranges, with range (ascending) and place (0, 1, ... within its range); fixed, so that it may be read again.

    Equal rows may be split over ranges by further columns of order; ranges: as many as the session shuffles to, if not given.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return checkpointed(dealt.select("*", F.spark_partition_id().alias("range"), within.alias("place")))


def number_rows(df: DataFrame, *order: str | Column, name: str = "row_id", first: int = 1, ranges: int | None = None) -> DataFrame:
    """df with the number of each row in order, from `first` without gaps: sorted ranges, their counts, and the number within.

    Nulls stand where order puts them; rows that order doesn't tell apart get their numbers in any order. An empty table stays empty.
    """
    if taken := {"range", "place", name} & set(df.columns):
        raise ValueError(f"columns named {', '.join(sorted(taken))} are in the way")
    dealt = in_ranges(df, *order, ranges=ranges)
    counts = dealt.groupBy("range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("range", (before + first).alias("start"))  # a row for each range
    return dealt.join(F.broadcast(starts), "range").select(*df.columns, (F.col("start") + F.col("place")).alias(name))


def bind_columns(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """left and right side by side, the first row in one's order with the first in the other's, and so on.

    Both are numbered without gaps and joined by number, so neither goes through one task. An error if one
    has more rows than the other, or if they share a column's name. Orders must tell all rows apart for a result that stays the same.
    """
    if shared := set(left.columns) & set(right.columns):
        raise ValueError(f"both have columns named {', '.join(sorted(shared))}")
    a, b = number_rows(left, *left_order, name="__row"), number_rows(right, *right_order, name="__row")
    # numbers are gapless, so unequal counts show in the last
    n, m = (d.agg(F.coalesce(F.max("__row"), F.lit(0))).first()[0] for d in (a, b))
    if n != m:
        raise ValueError(f"{n} rows beside {m}")
    return a.join(b, "__row").drop("__row")
