"""Joins that hold when one key carries a large share of the rows.

A key is hot when it has more rows than an average shuffle partition. The counts add up to
the row count, so there are at most as many hot keys as shuffle partitions: that list is
small whatever the data size and can be broadcast. A lookup table is broadcast only if its
rows have been counted and are few.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from edgeloom.plans.rounds import setting, shuffle_partitions


@dataclass(frozen=True)
class HotKeys:
    """Hot keys with the number of parts each is split into; ``frame`` is None if none."""

    frame: DataFrame | None = None

    def _parts(self, df: DataFrame, key: str) -> DataFrame:
        hot = F.broadcast(self.frame.withColumnRenamed("_key", key))
        return df.join(hot, key, "left")

    def spread(self, df: DataFrame, key: str, by: Column) -> DataFrame:
        """Give each row of a hot key one of its parts, chosen by the hash of ``by``."""
        if self.frame is None:
            return df.withColumn("_part", F.lit(0).cast("bigint"))
        part = F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")), F.lit(0))
        return self._parts(df, key).withColumn("_part", part).drop("_parts")

    def replicate(self, df: DataFrame, key: str) -> DataFrame:
        """Copy the row of a hot key once per part."""
        if self.frame is None:
            return df.withColumn("_part", F.lit(0).cast("bigint"))
        last = F.coalesce(F.col("_parts") - 1, F.lit(0))
        parts = F.explode(F.sequence(F.lit(0).cast("bigint"), last))
        return self._parts(df, key).withColumn("_part", parts).drop("_parts")


def hot_keys(counts: DataFrame, key: str, rows: int) -> HotKeys:
    """Find the hot keys in ``counts(key, n)``, where the ``n`` add up to ``rows``."""
    spark = counts.sparkSession
    floor = setting(spark, "hotRows")
    if rows <= floor:
        return HotKeys()
    most = max(floor, math.ceil(rows / shuffle_partitions(spark)))
    found = (
        counts.where(F.col("n") > most)
        .select(F.col(key).alias("_key"), F.ceil(F.col("n") / most).alias("_parts"))
    )
    # No more rows than shuffle partitions: see the module text.
    listed = found.collect()
    if not listed:
        return HotKeys()
    return HotKeys(spark.createDataFrame(listed, found.schema))


def measured_hot_keys(df: DataFrame, key: str, rows: int) -> HotKeys:
    """As :func:`hot_keys`, counting the keys of ``df`` only if it is large enough."""
    if rows <= setting(df.sparkSession, "hotRows"):
        return HotKeys()
    return hot_keys(df.groupBy(key).agg(F.count("*").alias("n")), key, rows)


def sampled_hot_keys(df: DataFrame, key: str, rows: int) -> HotKeys:
    """As :func:`measured_hot_keys`, from as many rows as hold about a hundred of a hot key: no row for each key is shuffled.

    A key near the limit may be taken for hot or not; that only decides where its rows go.
    """
    spark = df.sparkSession
    floor = setting(spark, "hotRows")
    if rows <= floor:
        return HotKeys()
    share = min(1.0, 100 / max(floor, math.ceil(rows / shuffle_partitions(spark))))
    drawn = df.select(key).sample(share, seed=17).groupBy(key)
    return hot_keys(drawn.agg(F.round(F.count("*") / F.lit(share)).cast("bigint").alias("n")), key, rows)


def lookup(
    facts: DataFrame,
    key: str,
    table: DataFrame,
    hot: HotKeys = HotKeys(),
    by: str | Column | None = None,
    how: str = "inner",
    rows: int | None = None,
) -> DataFrame:
    """Join ``facts[key]`` to ``table(id, ...)``, whose ids are unique.

    A table known to have few ``rows`` goes to the facts. Otherwise both are shuffled: the
    rows of a hot key are spread over several tasks and its table row is copied to each. A table known
    to have more doesn't pass through the driver, even if its files are small.
    """
    renamed = table.withColumnRenamed("id", key)
    if rows is not None and rows <= setting(facts.sparkSession, "broadcastRows"):
        return facts.join(F.broadcast(renamed), key, how)
    renamed = renamed if rows is None else renamed.hint("merge")
    if hot.frame is None:
        return facts.join(renamed, key, how)
    by = F.struct(*facts.columns) if by is None else F.col(by) if isinstance(by, str) else by
    spread = hot.spread(facts, key, by)
    return spread.join(hot.replicate(renamed, key), [key, "_part"], how).drop("_part")


def pairs_within(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Pairs ``first < second`` of distinct ``value`` that share ``key``.

    ``rows(key, value)`` holds no duplicates. A large group is cut into blocks 0 to b - 1, and its
    pairs into tiles of two blocks ``i <= j``: a row stands left in the tiles of its own block
    and later ones, and right in those of its own and earlier ones. So a task meets two blocks.
    """
    tiles = pair_tiles(rows, key, value)
    if tiles is None:
        left = rows.withColumnRenamed(value, "first")
        right = rows.withColumnRenamed(value, "second")
        return left.join(right, key).where(F.col("first") < F.col("second")).select(key, "first", "second")
    left, right = tiles
    met = left.withColumnRenamed(value, "a").join(right.withColumnRenamed(value, "b"), [key, "_i", "_j"])
    met = met.where((F.col("_i") < F.col("_j")) | (F.col("a") < F.col("b")))
    return met.select(key, F.least("a", "b").alias("first"), F.greatest("a", "b").alias("second"))


def pair_tiles(rows: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame] | None:
    """Left and right rows with their tiles ``_i, _j``; None if no group needs a cut."""
    most = setting(rows.sparkSession, "pairRows")
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    size = counts.agg(F.max("n").alias("top"), F.sum("n").alias("rows")).first()
    if (size["top"] or 0) <= most:
        return None
    hot = hot_keys(counts, key, size["rows"])
    sized = lookup(rows, key, counts.withColumnRenamed(key, "id"), hot, value)
    blocks = F.ceil(F.col("n") / most)
    cut = sized.withColumn("_block", F.pmod(F.xxhash64(F.col(value)), blocks)).withColumn("_last", blocks - 1)
    left = cut.select(key, value, F.col("_block").alias("_i"), F.explode(F.sequence("_block", "_last")).alias("_j"))
    first = F.lit(0).cast("bigint")
    right = cut.select(key, value, F.explode(F.sequence(first, F.col("_block"))).alias("_i"), F.col("_block").alias("_j"))
    return left, right
