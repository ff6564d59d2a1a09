"""Sharding by balanced label propagation.

Documents with equal texts are linked, through a node that stands for their text. Every
document starts in the shard of a hash, so shards start even. In each round a linked document
wishes itself into the shard that holds most of its neighbours, or one of the fullest few if
its group is too large for one shard. Wishes are granted as far as quotas allow: moves between two
shards that balance each other, and moves into a shard's free room. A group is granted or refused
as a whole, and groups that need several shards document by document.

Linked documents may fill a shard up to its quota. Documents without links go where room is
left. In the end each shard gets exactly its number of rows; linked ones are the last to leave.

All of it is DataFrame joins and aggregates. A round's state holds the linked documents only;
tables of shard pairs have at most ``shards ** 2`` rows, and what the driver reads has one row per shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from edgeloom.llm.common import column_of, table
from edgeloom.plans.rounds import Rounds, written

ROUNDS = 8
BUCKET_ROWS = 20_000


def _share(*of) -> Column:
    """A number from 0 up to 1 that depends on ``of``."""
    return F.pmod(F.xxhash64(*of), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _wishes(state: DataFrame, quota: int, turn: int) -> DataFrame:
    """``state`` with the shard that each document wishes for."""
    cells = state.groupBy("link", "shard").agg(F.count("*").alias("here"), F.first("n").alias("n"))
    ranked = F.sort_array(F.collect_list(F.struct(  # at most one entry per shard
        (-F.col("here")).alias("less"), F.xxhash64("link", "shard").alias("tie"), "shard"
    )))
    # A group too large for a shard gets one more every other round, where the first ones are taken by others.
    shards_for = F.ceil(F.first("n") / F.lit(quota))
    need = F.when(shards_for > 1, shards_for + F.lit(turn // 2)).otherwise(F.lit(1)).cast("int")
    best = cells.groupBy("link").agg(F.slice(ranked, F.lit(1), need)["shard"].alias("best"))
    joined = state.join(best, "link")
    pick = (F.pmod(F.xxhash64("row", F.lit(turn)), F.size("best")) + 1).cast("int")
    wish = F.when(F.array_contains("best", F.col("shard")), F.col("shard")).otherwise(F.element_at("best", pick))
    return joined.select(
        "row", "link", "n", "shard", wish.alias("wish"), (F.size("best") > 1).alias("wide")
    )


def _grants(wished: DataFrame, quota: int) -> DataFrame:
    """``shard, wish, granted``: the share of wishes for each way between two shards."""
    load = wished.groupBy(F.col("shard").alias("wish")).agg(F.count("*").alias("load"))
    ways = wished.where("shard <> wish").groupBy("shard", "wish").agg(F.count("*").alias("asked"))
    back = ways.select(F.col("wish").alias("shard"), F.col("shard").alias("wish"), F.col("asked").alias("back"))
    swaps = ways.join(back, ["shard", "wish"], "left").join(load, "wish", "left")
    matched = F.least("asked", F.coalesce("back", F.lit(0)))
    left = swaps.select(
        "shard", "wish", "asked", matched.alias("matched"), (F.col("asked") - matched).alias("rest"),
        F.greatest(F.lit(0), F.lit(quota) - F.coalesce("load", F.lit(0))).alias("room"),
    )
    into = F.sum("rest").over(Window.partitionBy("wish"))  # at most one row per shard
    extra = F.when(into > 0, F.least("rest", F.col("room") * F.col("rest") / into)).otherwise(F.lit(0.0))
    granted = ((F.col("matched") + extra) / F.col("asked")).alias("granted")
    return left.select("shard", "wish", granted)


def propagate(linked: DataFrame, shards: int, quota: int, rounds: int = ROUNDS) -> DataFrame:
    """``row, shard`` of the linked rows ``linked(row, link, n)`` after label propagation."""
    spark = linked.sparkSession
    with Rounds(spark) as kept:
        start = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
        state = linked.select("row", "link", "n", start.alias("shard"))
        for turn in range(rounds):
            wished, facts = kept.written(
                _wishes(state, max(1, quota), turn), open=F.count_if(F.col("shard") != F.col("wish"))
            )
            if not facts["open"]:
                state = wished
                break
            granted = F.broadcast(_grants(wished, quota))  # at most shards ** 2 rows
            draw = F.when(F.col("wide"), _share("row", F.lit(turn))).otherwise(_share("link", F.lit(turn)))
            moves = draw < F.coalesce("granted", F.lit(0.0))
            state = wished.join(granted, ["shard", "wish"], "left").select(
                "row", "link", "n", F.when(moves, F.col("wish")).otherwise(F.col("shard")).alias("shard")
            )
        return written(state.select("row", "shard"))[0]


def _placed(rows: DataFrame, shards: int, total: int) -> DataFrame:
    """Exact quotas: ``rows(..., row, shard, last)`` with ``shard`` and ``slot`` of the outcome."""
    buckets = max(1, math.ceil(total / shards / BUCKET_ROWS))
    tagged = rows.withColumn("bucket", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(buckets)))
    keys = ["shard", "last", "bucket"]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("row")) - 1
    before = Window.partitionBy("shard").orderBy("last", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = tagged.groupBy(*keys).agg(F.count("*").alias("n")).select(
        *keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    counted = {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # one per shard
    load = [counted.get(s, 0) for s in range(shards)]
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    leave, arrive, gone, come = [], [], 0, 0
    for s in range(shards):
        leave.append(gone)
        arrive.append(come)
        gone += max(0, load[s] - quota[s])
        come += max(0, quota[s] - load[s])

    def listed(values: list[int]) -> Column:
        return F.array(*[F.lit(v).cast("bigint") for v in values])

    here = (F.col("shard") + 1).cast("int")
    place = F.col("start") + F.col("nth")
    over = place - F.element_at(listed(quota), here)
    rank = F.element_at(listed(leave), here) + over
    # The last shard whose arrivals start at or before this rank and that takes some.
    takes = [s for s in range(shards) if quota[s] > load[s]]
    nth_taker = F.size(F.filter(listed([arrive[s] for s in takes]), lambda x: x <= F.col("rank"))) if takes else F.lit(1)
    to = F.element_at(listed(takes or [0]), nth_taker.cast("int"))
    numbered = tagged.withColumn("nth", nth).join(starts, keys)
    ranked = numbered.withColumn("place", place).withColumn("over", over).withColumn("rank", rank)
    moved = ranked.withColumn("to", F.when(F.col("over") < 0, F.col("shard").cast("bigint")).otherwise(to))
    at = (F.col("to") + 1).cast("int")
    slot = F.when(F.col("over") < 0, F.col("place")).otherwise(
        F.element_at(listed(load), at) + F.col("rank") - F.element_at(listed(arrive), at)
    )
    return moved.select(*[c for c in rows.columns if c not in ("row", "shard", "last")],
                        F.col("to").cast("int").alias("shard"), slot.alias("slot"))


def shard(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text",
          rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, shard, slot``.

    The numbers of rows of any two shards differ by one at most; slots count from 0 in each.
    ``size`` is 16 plus the text's bytes. Null texts are linked to each other and have no bytes;
    empty ones likewise. Repeated rows are rows of one group. Other columns are not looked at.
    """
    content = column_of(docs, text).cast("string")
    bytes_of = F.coalesce(content, F.lit("")).cast("binary")
    rows, facts = written(docs.select(
        column_of(docs, doc_id).alias("doc_id"), (F.octet_length(bytes_of) + 16).cast("bigint").alias("size"),
        F.crc32(bytes_of).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(content, 256)), F.lit(b"")).alias("link"),
        F.monotonically_increasing_id().alias("row"),
    ), rows=F.count("*"))
    total = facts["rows"]
    groups = rows.groupBy("link").agg(F.count("*").alias("n")).where("n > 1")
    linked = rows.select("row", "link").join(groups, "link")
    labels = propagate(linked, shards, total // shards, rounds)
    start = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    # Documents without links come last in their shard, so they are the first to go elsewhere.
    state, _ = written(rows.drop("link").join(labels, "row", "left").select(
        "doc_id", "size", "text_crc32", "row", F.col("shard").isNull().alias("last"),
        F.coalesce("shard", start).alias("shard"),
    ))
    return _placed(state, shards, total)


def op9_sharding(spark, folder: str) -> DataFrame:
    placed = shard(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
