"""DataFrame helpers of the operators: scratch tables, size-derived partition counts, components."""

from __future__ import annotations

import pickle

import numpy as np
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize, scratch_path  # noqa: F401
from .kernels import as_i64


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Arrow batches of at most ``rows`` rows and about 4 MB, so that a batch of texts stays small in JVM and worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession, obj: object) -> Broadcast:
    """Broadcast an object of a class of this package by value; read it with ``unpack``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(obj))


def unpack(held: Broadcast) -> object:
    return pickle.loads(held.value)


class BitFilter:
    """A set of 64-bit hashes as a bit table of given size; a false hit is possible, a miss is not."""

    def __init__(self, bits: int, words: dict[int, int]):
        self.words = np.zeros(bits // 64, np.int64)
        if words:
            self.words[np.fromiter(words.keys(), np.int64)] = np.fromiter(words.values(), np.int64)

    def has(self, h: np.ndarray) -> np.ndarray:
        h = as_i64(h)
        return (self.words[(h >> 6) % len(self.words)] >> (h % 64)) & 1 == 1


def bit_filter(hashes: DataFrame, bits: int) -> BitFilter:
    """Filter of the column ``h``: OR-ed per word in Spark, at most bits / 64 rows reach the driver."""
    rows = (hashes.select(F.expr(f"pmod(shiftright(h, 6), {bits // 64})").alias("w"),
                          F.expr("shiftleft(1L, CAST(pmod(h, 64) AS INT))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")).collect())
    return BitFilter(bits, {r["w"]: r["b"] for r in rows})


def partitions_for(spark: SparkSession, n_bytes: int, target: int = 16 << 20) -> int:
    """Buckets that hold about ``target`` bytes each, never fewer than the shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), int(n_bytes // target) + 1)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge table: (node, comp), comp the smallest node.

    Every round each node takes the smallest label among itself and its
    neighbours and then the label of that label; labels are written to the
    shared folder per round, so lost executors only repeat the current round.
    Self-loops and repeated edges do no harm; an empty table gives none.
    """
    both = materialize(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v")))
        .where("u IS NOT NULL AND v IS NOT NULL").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.least(F.first("u"), F.min("v")).alias("comp")), "labels")
    while True:
        seen = (both.join(labels.select(F.col("node").alias("v"), F.col("comp").alias("near")), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("near").alias("near")))
        step = labels.join(seen, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        new = materialize(step.join(jump, "comp").select("node", "old", F.least("comp", "root").alias("comp")), "labels")
        if new.where("comp <> old").isEmpty():
            return new.select("node", "comp")
        labels = new.select("node", "comp")
