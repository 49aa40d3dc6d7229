"""Operator 8: shards by longest-processing-time scheduling.

Rows with equal texts form a group that must stay together. Groups are taken
by size, largest first, and each goes to the least loaded shard through a heap.
Groups of one size are interchangeable, so the schedule only needs how many
groups there are of each size: that histogram is what reaches the driver (a
corpus of B bytes has at most sqrt(2 B) different group sizes). A class of many
equal groups is dealt by water-filling, which is what the heap would do one by
one. The schedule returns as runs (size, first rank, shard) that a group picks
up by its rank within its size.

Ranks and slots are numbered in two steps (counts per hash bucket, then
positions inside the bucket), so no task sorts all groups of one size or a
whole shard.

Law ``bytes``: shard loads differ by at most the largest group (sizes near
equal). Defined results: a null text has size 1 and shares the group of the
empty text (CRC 0); rows with a null id are sharded like any other; repeated
rows stay in one shard with different slots; ties are broken by text hash, then
by id; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .frames import materialize

SHARDS = 16
#: A class of more equal groups than this per shard is water-filled instead of passing the heap one by one.
HEAP_ROUNDS = 4
#: Rows that one numbering bucket holds on average.
BUCKET_ROWS = 50_000


def deal(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Schedule (size, count) classes: (size, first rank, past rank, shard) runs covering every rank of every size."""
    heap = [(0, s) for s in range(shards)]
    runs = []
    for size, count in sorted(classes, reverse=True):
        got = [0] * shards
        left = count
        if left > HEAP_ROUNDS * shards:
            load = {s: v for v, s in heap}
            lo, hi = min(load.values()), max(load.values()) + size * (left // shards + 1)
            while lo < hi:  # the highest level that the class can fill completely
                mid = (lo + hi + 1) // 2
                if sum(max(0, (mid - v + size - 1) // size) for v in load.values()) <= left:
                    lo = mid
                else:
                    hi = mid - 1
            for s, v in load.items():
                got[s] = max(0, (lo - v + size - 1) // size)
            left -= sum(got)
            heap = [(v + got[s] * size, s) for s, v in load.items()]
            heapq.heapify(heap)
        for _ in range(left):
            v, s = heap[0]
            got[s] += 1
            heapq.heapreplace(heap, (v + size, s))
        first = 0
        for s, n in enumerate(got):
            if n:
                runs.append((size, first, first + n, s))
                first += n
    return runs


def numbered(df: DataFrame, within: str, order: list[str], bucket: Column, out: str, buckets: int) -> DataFrame:
    """``df`` with gapless numbers from 0 inside each ``within`` value, bucket by bucket."""
    df = df.withColumn("_b", F.pmod(bucket, F.lit(buckets)))
    n = df.groupBy(within, "_b").agg(F.count("*").alias("_n"))
    # one row per (value, bucket): bounded by values x buckets, sorted per value
    start = n.withColumn("_start", F.coalesce(F.sum("_n").over(W.partitionBy(within).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    pos = df.withColumn("_pos", F.row_number().over(W.partitionBy(within, "_b").orderBy(*order)) - 1)
    return pos.join(start, [within, "_b"]).withColumn(out, (F.col("_start") + F.col("_pos")).cast("long")).drop("_b", "_start", "_pos")


def assign(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs``."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), F.sha2(body, 256).alias("grp")), "shard_rows")
    n_rows = rows.count()
    buckets = n_rows // BUCKET_ROWS + 1
    groups = materialize(rows.groupBy("grp").agg(F.sum("size").alias("load")), "shard_groups")
    classes = [(int(r["load"]), int(r["n"])) for r in groups.groupBy("load").agg(F.count("*").alias("n")).collect()]
    plan = spark.createDataFrame(deal(classes, shards), "load long, first long, past long, shard int")
    ranked = numbered(groups, "load", ["grp"], F.xxhash64("grp"), "rank", buckets)
    placed = (ranked.join(plan, (ranked["load"] == plan["load"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past")))
              .select("grp", "shard"))
    out = rows.join(placed, "grp")
    return (numbered(out, "shard", ["doc_id", "grp"], F.xxhash64("doc_id", "grp"), "slot", buckets)
            .select("doc_id", "size", "text_crc32", "shard", "slot"))
