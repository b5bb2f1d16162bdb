"""Minimax contiguous partition of documents into shards.

Documents with equal texts form an atomic group.  Groups lie in the order of their smallest document id and are
cut into at most ``shards`` consecutive runs so that the largest run is as small as any such cut allows: the
smallest capacity is found by binary search, each trial being checked greedily (fill a shard until the next group
would not fit), and the cut is made at the capacity found.

The sizes stay distributed.  The driver only sees sums over ranges of the group order, a bounded number of them:
a trial walks these sums, and where a cut falls inside a range the result is known up to that range.  Ranges that
matter are divided further, by one aggregation a round, until every cut lies between two groups.  Slots are counted
from per-file sums, so no task numbers more than one file of rows.

Edge cases: a null text is an empty text (size 1).  Repeated rows and equal texts share a shard; ties of the order
are broken by the text's CRC and size.  A null document id sorts first.  An empty table gives an empty result.
Extra columns are left out.  Fewer groups than shards leave the last shards empty.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecospark.llm.common import documents_of, materialize, scratch_path

#: Ranges that one round divides a range into, and at most so many ranges are divided in a round.
PARTS, AT_ONCE = 256, 64
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


class Ranges:
    """Sums of group sizes over consecutive ranges of the order key; each is (first key, last key, sum, largest,
    groups)."""

    def __init__(self, rows: list[tuple[int, int, int, int, int]]):
        self.rows = sorted(rows)
        self.edges = [0, *accumulate(r[2] for r in self.rows)]
        self.total = self.edges[-1]
        self.largest = max((r[3] for r in self.rows), default=0)

    def walk(self, capacity: int, shards: int, generous: bool) -> tuple[bool, list[int]]:
        """Whether greedy filling ends within ``shards``, and the ranges in which cuts fall.

        Inside a range only its sum is known.  ``generous`` lets a shard end exactly at its capacity there,
        otherwise it ends before the range: the truth lies between the two."""
        at, inside = 0, []
        for _ in range(shards):
            if at >= self.total:
                return True, inside
            stop = min(at + capacity, self.total)
            k = bisect_right(self.edges, stop) - 1  # the ranges before k end within the shard
            if k < len(self.rows) and self.edges[k] < stop and self.rows[k][4] > 1:
                inside.append(k)
                at = stop if generous else max(at, self.edges[k])
            else:
                at = max(at, self.edges[k])
        return at >= self.total, inside

    def smallest(self, shards: int, generous: bool) -> int:
        low, high = max(self.largest, -(-self.total // shards)), self.total
        while low < high:
            mid = (low + high) // 2
            if self.walk(mid, shards, generous)[0]:
                high = mid
            else:
                low = mid + 1
        return low


def _ranges(groups: DataFrame, wanted: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Sums over ``PARTS`` equal parts of each wanted range of the key, without the empty parts."""
    part: Column = F.lit(None).cast("long")
    for n, (low, high) in enumerate(wanted):
        step = max(1, -(-(high - low + 1) // PARTS))
        slot = F.expr(f"CAST((CAST(`key` AS DECIMAL(20,0)) - {low}BD) div {step}BD AS BIGINT) + {n * PARTS}")
        part = F.when((F.col("key") >= low) & (F.col("key") <= high), slot).otherwise(part)
    rows = groups.withColumn("part", part).where("part IS NOT NULL").groupBy("part").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.sum("size").alias("total"),
        F.max("size").alias("largest"), F.count(F.lit(1)).alias("n")).collect()
    return [(r["low"], r["high"], int(r["total"]), int(r["largest"]), r["n"]) for r in rows]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity and the last key of every shard but the last, for groups ``key`` (long, unique) and
    ``size`` (positive).  Each round divides the ranges in which the cuts of the open trials fall."""
    bounds = groups.agg(F.min("key"), F.max("key")).first()
    if bounds[0] is None:
        return 0, []
    ranges = Ranges(_ranges(groups, [(bounds[0], bounds[1])]))
    while True:
        sure, hoped = ranges.smallest(shards, generous=False), ranges.smallest(shards, generous=True)
        open_ = set()
        for capacity in {hoped, sure, (hoped + sure) // 2}:
            for generous in (True, False):
                open_.update(ranges.walk(capacity, shards, generous)[1])
        if not open_:
            break
        chosen = sorted(open_, key=lambda k: -ranges.rows[k][2])[:AT_ONCE]
        fine = _ranges(groups, [ranges.rows[k][:2] for k in chosen])
        ranges = Ranges([r for k, r in enumerate(ranges.rows) if k not in set(chosen)] + fine)
    capacity, cuts, at = sure, [], 0
    while at < ranges.total:
        k = bisect_right(ranges.edges, at + capacity) - 1
        at = ranges.edges[k]
        if at < ranges.total:
            cuts.append(ranges.rows[k - 1][1])
    return capacity, cuts


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: every document with its shard and its gapless place in it."""
    spark = docs.sparkSession
    rows = documents_of(docs, id_col, text_col).select(
        "doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32(F.encode("text", "utf-8")).alias("text_crc32"),
        F.md5("text").alias("same"))
    rows = materialize(rows, "shard-rows")
    groups = materialize(rows.groupBy("same").agg(F.coalesce(F.min("doc_id"), F.lit(_LOW)).alias("first"),
                                                  F.sum("size").alias("size")), "shard-groups")
    # groups that share a smallest id (repeated ids with different texts) go together: their order is the same
    _, cuts = minimax_cuts(groups.groupBy(F.col("first").alias("key")).agg(F.sum("size").alias("size")), shards)
    shard = F.lit(0)
    for n, last in enumerate(cuts):
        shard = F.when(F.col("first") > last, n + 1).otherwise(shard)
    placed = rows.join(groups.select("same", "first", shard.cast("int").alias("shard")), "same")
    path = scratch_path(spark, "shard-order")
    placed.select("doc_id", "size", "text_crc32", "shard", "first").repartitionByRange("shard", "first", "doc_id", "text_crc32") \
        .sortWithinPartitions("shard", "first", "doc_id", "text_crc32", "size") \
        .withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.schema("doc_id long, size long, text_crc32 long, shard int, first long, row long").parquet(path)
    # the rows of a task are numbered in order; a shard's rows before a task's are a sum over tasks (a few rows each)
    runs = placed.groupBy("shard", F.shiftright("row", 33).alias("task")).agg(
        F.min("row").alias("from"), F.count(F.lit(1)).alias("n"))
    runs = runs.selectExpr("shard", "task", "`from` - coalesce(sum(n) OVER (PARTITION BY shard ORDER BY task "
                           "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base")
    return placed.withColumn("task", F.shiftright("row", 33)).join(runs, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("base")).alias("slot"))
