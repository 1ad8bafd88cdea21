"""Sharding by longest-processing-time scheduling.

Documents with equal texts form a group that stays together. Groups, largest first, go to the least loaded shard. Groups of one size are
interchangeable, so a run of them is scheduled at once: how many of it each shard takes follows from the loads by arithmetic, and a heap
settles the rest. The driver so sees one row per distinct size, of which there are at most the square root of twice all bytes, and every
group is scheduled, at every scale. Within a run, groups are numbered where they lie, and a group's number tells its shard.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import spill

#: Runs of at most so many sizes are broadcast, with a number a shard for each; more are shuffled, groups dealt over SALTS.
BROADCAST_RUNS, SALTS = 20_000, 32
#: Groups that hold more than this share of all rows are told apart, and meet their rows by a broadcast: there are no more than its inverse.
HOT_SHARE = 1 / 2000


def least_loaded(units: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Unit name -> shard: largest unit first, each to the shard with the least bytes so far; ties by name and by shard number."""
    loads = [(0, s) for s in range(shards)]
    out = {}
    for name, size in sorted(units, key=lambda u: (-u[1], u[0])):
        load, s = heapq.heappop(loads)
        out[name] = s
        heapq.heappush(loads, (load + size, s))
    return out


def schedule_runs(runs: list[tuple[int, int]], shards: int) -> dict[int, list[int]]:
    """Size -> how many units of it each shard takes, as least_loaded() gives them out one by one. runs: (size, number of units), sizes positive."""
    loads, out = [0] * shards, {}
    for size, many in sorted(runs, reverse=True):
        taken = [0] * shards
        if many > 4 * shards:
            # all units that are taken while some shard's load is below the level; the highest level that does not take too many
            below = lambda level: [max(0, -(-(level - x) // size)) for x in loads]  # noqa: B023, E731
            low, high = min(loads), max(loads) + size * (many // shards + 2)
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if sum(below(mid)) <= many else (low, mid - 1)
            taken = below(low)
        heap = [(x + size * n, s) for s, (x, n) in enumerate(zip(loads, taken, strict=True))]
        heapq.heapify(heap)
        for _ in range(many - sum(taken)):
            load, s = heapq.heappop(heap)
            taken[s] += 1
            heapq.heappush(heap, (load + size, s))
        loads = [x + size * n for x, n in zip(loads, taken, strict=True)]
        out[size] = taken
    return out


def _numbered(rows: DataFrame, of: str, order: list[str], chunks: int, name: str) -> DataFrame:
    """rows with a gapless number from 0 within each value of a column: within small chunks by hash, on top of the rows of the chunks before."""
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    counts = rows.groupBy(of, "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy(of).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(of, "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy(of, "chunk").orderBy(*order)
    return rows.join(starts, [of, "chunk"]).withColumn(name, (F.col("start") + F.row_number().over(inside) - 1).cast("long")).drop("chunk", "start")


def shard_documents(docs: DataFrame, shards: int = 24, chunk_rows: int = 20_000, broadcast_runs: int = BROADCAST_RUNS) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 8, and 8 for a null text. Null texts form one group, empty texts another; both have the
    checksum of no bytes. Repeated rows and null doc_ids get slots of their own. slot numbers the rows of a shard from 0 without gaps.
    grown_shard is null, as the law is "bytes". An empty table gives no rows. Other columns of docs are not read.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)), F.lit(b"null")).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    base = spill(base, "shard_base")  # rows keep their numbers
    groups = spill(base.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "shard_groups")
    runs = [(r.bytes, r.n) for r in groups.groupBy("bytes").agg(F.count("*").alias("n")).collect()]  # one row a distinct size
    rows = base.count()
    ends = [(size, [sum(taken[: s + 1]) for s in range(shards)]) for size, taken in schedule_runs(runs, shards).items()]
    table = spark.createDataFrame(ends, "bytes long, ends array<long>")
    groups = _numbered(groups, "bytes", ["key"], max(1, math.ceil(max((n for _, n in runs), default=0) / chunk_rows)), "place")
    if len(ends) <= broadcast_runs:
        groups = groups.join(F.broadcast(table), "bytes")
    else:
        table = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        groups = groups.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(table, ["bytes", "salt"])
    groups = spill(groups.select("key", "rows", F.size(F.filter("ends", lambda e: e <= F.col("place"))).alias("shard")), "shard_places")
    hot = F.col("rows") > HOT_SHARE * rows
    large = groups.where(hot).select("key", F.col("shard").alias("large_shard"))
    sharded = base.join(F.broadcast(large), "key", "left")
    sharded = sharded.where("large_shard IS NOT NULL").withColumnRenamed("large_shard", "shard").unionByName(sharded.where("large_shard IS NULL").drop("large_shard").join(groups.where(~hot).select("key", "shard"), "key"))
    out = _numbered(spill(sharded.drop("key"), "sharded"), "shard", ["doc_id", "row"], max(1, math.ceil(rows / (shards * chunk_rows))), "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
