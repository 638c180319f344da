"""Longest-processing-time sharding: groups that must stay together go, by falling size, to the least-loaded shard."""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch_dir, small_table, stored, table

SHARDS = 40
#: Rows of one shard, or groups of one size, that are numbered together.
SLOT_ROWS = 100_000
#: Groups of one size, for each shard, that the heap takes one by one.
BY_ONE = 4
#: Sizes whose schedule is held on the driver at once.
SIZES_AT_ONCE = 50_000


class Schedule:
    """Longest-processing-time scheduling, fed with sizes from the largest down: each group goes to the least-loaded and
    then lowest shard, from a heap. Groups of one size are alike, so only how many of them a shard takes is told."""

    def __init__(self, shards: int):
        self.heap = [(0, k) for k in range(shards)]

    def place(self, size: int, count: int) -> list[int]:
        """How many of `count` groups of that size each shard takes."""
        took = [0] * len(self.heap)
        if size > 0 and count > BY_ONE * len(took):
            # All but the last rounds at once: shard k takes groups while its load is below a level.
            low, high = self.heap[0][0], max(load for load, _ in self.heap) + size * count
            below = lambda level: sum(max(0, -(-(level - load) // size)) for load, _ in self.heap)
            while low < high:
                level = (low + high + 1) // 2
                low, high = (level, high) if below(level) <= count else (low, level - 1)
            for load, k in self.heap:
                took[k] = max(0, -(-(low - load) // size))
            self.heap = [(load + size * took[k], k) for load, k in self.heap]
            heapq.heapify(self.heap)
        for _ in range(count - sum(took) if size > 0 else 0):
            load, k = self.heap[0]
            took[k] += 1
            heapq.heapreplace(self.heap, (load + size, k))
        if size <= 0:
            took[self.heap[0][1]] = count
        return took


def schedule_sizes(sizes: DataFrame, shards: int) -> DataFrame:
    """(bytes, upto): for each size of `sizes` (bytes, n groups) the running counts of its groups by shard.

    The sizes come to the driver one after another, from the largest down, and go back in tables of SIZES_AT_ONCE, so
    that it holds the shards' loads and a bounded number of sizes."""
    spark, plan, path = sizes.sparkSession, Schedule(shards), f"{scratch_dir(sizes.sparkSession)}/shard-schedule-{uuid.uuid4().hex}"
    held: tuple[list, list] = ([], [])

    def flush() -> None:
        small_table(spark, {"bytes": (held[0], pa.int64()), "upto": (held[1], pa.list_(pa.int64()))}).write.mode("append").parquet(path)
        held[0].clear()
        held[1].clear()

    for row in sizes.orderBy(F.desc("bytes")).toLocalIterator(prefetchPartitions=True):
        upto, total = [], 0
        for n in plan.place(row["bytes"], row["n"]):
            upto.append(total := total + n)
        held[0].append(row["bytes"])
        held[1].append(upto)
        if len(held[0]) >= SIZES_AT_ONCE:
            flush()
    flush()
    return spark.read.schema("bytes long, upto array<long>").parquet(path)


def numbered(rows: DataFrame, by: str, order: list[str], name: str, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """The rows of a stored table with a long column `name`, gapless from 0 for each value of `by`.

    The rows of one value are dealt into chunks by a hash of the ordering columns and of what else tells equal rows
    apart; each chunk is numbered by itself and starts after the chunks before it, so that a third of all rows is not
    numbered in one task.
    """
    chunks = max(64, -(-rows.count() // slot_rows))
    rows = rows.withColumn("__tp_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    before = Window.partitionBy(by).orderBy("__tp_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(by, "__tp_chunk").agg(F.count("*").alias("__tp_n")).withColumn("__tp_start", F.coalesce(F.sum("__tp_n").over(before), F.lit(0))).drop("__tp_n")
    rank = F.row_number().over(Window.partitionBy(by, "__tp_chunk").orderBy(*order)).cast("long")
    return rows.withColumn("__tp_rank", rank).join(starts, [by, "__tp_chunk"]).withColumn(name, F.col("__tp_start") + F.col("__tp_rank") - 1).drop("__tp_chunk", "__tp_rank", "__tp_start")


def assign_shards(rows: DataFrame, group: Column, size: Column, shards: int = SHARDS) -> DataFrame:
    """The rows with an int column `shard`; rows whose `group` values are equal share a shard.

    All groups are scheduled by falling size, those of one size in the order of their hashes. `group` null counts as a
    value of its own; no row is dropped, and an empty table gives an empty table. The group's 64-bit hash stands for it:
    if two groups share one, they stay together, which the law allows.
    """
    rows = rows.withColumns({"__tp_group": F.xxhash64(group), "__tp_size": size})
    groups = stored(rows.groupBy("__tp_group").agg(F.sum("__tp_size").alias("bytes")), "shard-groups")
    plan = schedule_sizes(groups.groupBy("bytes").agg(F.count("*").alias("n")), shards)
    ranked = numbered(groups, "bytes", ["__tp_group"], "__tp_nth").join(plan, "bytes")
    shard = F.size(F.filter("upto", lambda n: n <= F.col("__tp_nth"))).cast("int")
    placed = stored(ranked.select("__tp_group", shard.alias("shard")), "shard-of-group")
    return rows.drop("shard").join(placed, "__tp_group").drop("__tp_group", "__tp_size")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every row of `docs` (doc_id, text; more columns are ignored).

    Law `bytes`: the shards' sizes are near equal, as far as groups of equal texts, which stay together, allow it.
    Size is the UTF-8 bytes of the text and 16 more; a null text counts no bytes and the checksum of no bytes. Null
    and repeated doc_ids and repeated rows are rows like others; `nth`, a row's place as it was first read, tells them
    apart in the stored table. `grown_shard` belongs to another law: null.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", "text").select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64("text").alias("content"), F.col("text").isNull().alias("none"), F.monotonically_increasing_id().alias("nth"))
    placed = stored(assign_shards(rows, F.struct("content", "none"), F.col("size"), shards), "shard-rows")
    out = numbered(placed, "shard", ["doc_id", "content", "nth"], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
