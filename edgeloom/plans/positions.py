"""Numbering and running totals over a whole table without gathering it in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from edgeloom.plans.rounds import setting, shuffle_partitions, written


def dense_positions(df: DataFrame, keys: list[str | Column], name: str = "pos") -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order of ``keys``, which must be unique together.

    Rows are range-partitioned, sorted and written with their range and their place in it,
    because a second run of the sort could cut the ranges elsewhere.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The id function counts from partition << 33 within each partition.
    row = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    tagged, _ = written(ordered.select("*", F.spark_partition_id().alias("_range"), row.alias("_row")))
    # One row per partition, so the unpartitioned window is over a list of bounded size.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        tagged.groupBy("_range").agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    numbered = tagged.join(F.broadcast(sizes), "_range")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_row")).alias(name))


def first_positions(
    df: DataFrame, keys: list[str | Column], limit: int | None, name: str = "pos"
) -> DataFrame:
    """Number the first ``limit`` rows in the order of ``keys``, or all rows.

    A small limit is a top-k, of which each partition passes on at most ``limit`` rows.
    """
    if limit is not None and limit <= setting(df.sparkSession, "topRows"):
        place = F.row_number().over(Window.orderBy(*keys)) - 1  # over the kept rows only
        return df.orderBy(*keys).limit(limit).withColumn(name, place.cast("bigint"))
    numbered = dense_positions(df, keys, name)
    return numbered if limit is None else numbered.where(F.col(name) < limit)


def bucket_width(df: DataFrame, rows: int) -> int:
    """Width that cuts ``rows`` dense positions into at most one bucket per shuffle partition."""
    return max(10_000, math.ceil(rows / shuffle_partitions(df.sparkSession)))


def running_totals(df: DataFrame, pos: str, value: str, name: str, rows: int) -> DataFrame:
    """Sum of ``value`` over all smaller positions, for dense positions below ``rows``.

    Totals run within buckets of positions; the bucket sums, one row per bucket and no more
    than there are shuffle partitions, run once on their own.
    """
    bucket = F.floor(F.col(pos) / bucket_width(df, rows))
    tagged = df.withColumn("_bucket", bucket)
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        tagged.groupBy("_bucket").agg(F.sum(value).alias("_sum"))
        .select("_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = (
        Window.partitionBy("_bucket").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    )
    total = F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    joined = tagged.join(F.broadcast(starts), "_bucket")
    return joined.select(*df.columns, total.alias(name))
