"""Sinks: feature export (K1), station dimension (K2), dedup append with rotation
(K3), predictions / results (K4, K5), full history (K7), ingest metrics (K8),
and the checked reader of processed tables (S8).

Writers take explicit paths; callers place them under shared storage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import resolve_alias
from ..operators.setops import dedup_keep_first
from ..session import list_names, materialize, path_exists, remove_path, scratch_path
from ..schema import KEY

LAT_ALIASES = ["lat", "latitude", "Lat"]
LON_ALIASES = ["lon", "lng", "longitude", "Lon"]


def _exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def export_feature_tables(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K1 write: one dataset partitioned by ``split`` (train / test).

    Rounding (K1) is applied by the feature-table plan; ``fmt='csv'`` writes
    header CSV for tools that need text.
    """
    w = df.write.mode("overwrite").partitionBy("split")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def station_dimension(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """K2: station_id, name (+ lat, lon via alias resolution), first row per station."""
    cols = ["name"]
    lat, lon = resolve_alias(df, LAT_ALIASES), resolve_alias(df, LON_ALIASES)
    sel = [F.col("station_id"), F.col("name")]
    if lat:
        sel.append(F.col(lat).alias("lat"))
        cols.append("lat")
    if lon:
        sel.append(F.col(lon).alias("lon"))
        cols.append("lon")
    d = df.select(*sel, F.col(ts).alias("_t"))
    out = dedup_keep_first(d.where(F.col("station_id").isNotNull()), ["station_id"], ["_t"])
    return out.select("station_id", *cols)


def export_station_dim(df: DataFrame, path: str) -> None:
    station_dimension(df).write.mode("overwrite").parquet(path)


@dataclass
class AppendResult:
    n_batch: int
    n_new: int
    n_total: int

    @property
    def n_dup(self) -> int:
        return self.n_batch - self.n_new


METRICS_SCHEMA = "batch_id long, n_batch long, n_new long, n_dup long, n_total long"


def staged_keys(batch: DataFrame, path: str, order: Sequence[str], key: Sequence[str] = tuple(KEY),
                ts: str = "datetime", partition: str = "date") -> tuple[DataFrame, list]:
    """One row per key of ``batch``, the first by ``order``, written to ``path`` in a single run of its plan.

    Returned with the partition values, taken from the folder names.
    """
    one = dedup_keep_first(batch.withColumn(partition, F.to_date(ts)), list(key), list(order))
    one.write.mode("overwrite").partitionBy(partition).parquet(path)
    spark = batch.sparkSession
    return spark.read.schema(one.schema).parquet(path), partition_dates(spark, path, partition)


def partition_dates(spark: SparkSession, path: str, partition: str = "date") -> list:
    """Dates of a table partitioned by ``partition``, from its folder names; None stands for the null partition."""
    names = [n.split("=", 1)[1] for n in list_names(spark, path) if n.startswith(f"{partition}=")]
    return [None if n == "__HIVE_DEFAULT_PARTITION__" else date.fromisoformat(n) for n in names]


def absent(rows: DataFrame, path: str, dates: Sequence, key: Sequence[str] = tuple(KEY), partition: str = "date") -> DataFrame:
    """The ``rows`` (of the partitions ``dates``) whose key is not in the table yet.

    Only these partitions are read back for the anti-join (partition
    pruning), never the whole history. Rows without a time fall into the null
    partition like any other.
    """
    spark = rows.sparkSession
    if not _exists(spark, path):
        return rows
    touched = F.col(partition).isin([d for d in dates if d is not None])
    old = spark.read.parquet(path).where(touched | F.col(partition).isNull()).select(*[F.col(k).alias(f"_k_{k}") for k in key])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return rows.join(old, cond, "left_anti")


def append_dedup(batch: DataFrame, path: str, order: Sequence[str], key: Sequence[str] = tuple(KEY),
                 ts: str = "datetime", partition: str = "date",
                 max_records_per_file: int | None = None, drop: Sequence[str] = (),
                 n_before: int | None = None) -> AppendResult:
    """K3: append the rows of ``batch`` whose key is not in the table yet.

    The plan of ``batch`` runs once: its first row of each key is staged by
    date in the shared scratch folder, and everything else (counts, the dates
    touched, the anti-join, the append) reads that stage. ``maxRecordsPerFile``
    bounds file size (the rotation of the reference without renaming files);
    existing files are never rewritten. ``order`` decides which of several
    rows of a key is the first; ``drop`` names helper columns that are not
    stored. ``n_before`` is the size of the table when the caller keeps it,
    else it is counted.
    """
    spark = batch.sparkSession
    stage = scratch_path(spark, "append")
    one, dates = staged_keys(batch, stage, order, key, ts, partition)
    new = materialize(absent(one, path, dates, key, partition).drop(*drop), "append")
    n_batch, n_new = one.count(), new.count()
    remove_path(spark, stage)
    if n_before is None:
        n_before = spark.read.parquet(path).count() if _exists(spark, path) else 0
    write_new(new, path, partition, max_records_per_file)
    return AppendResult(n_batch, n_new, n_before + n_new)


def write_new(new: DataFrame, path: str, partition: str = "date", max_records_per_file: int | None = None) -> None:
    if new.isEmpty():
        return
    w = new.write.mode("append").partitionBy(partition)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(path)


def metrics_row(spark: SparkSession, batch_id: int, r: AppendResult) -> DataFrame:
    """K8: one metrics row per appended batch."""
    return spark.createDataFrame([(int(batch_id), r.n_batch, r.n_new, r.n_dup, r.n_total)], METRICS_SCHEMA)


def export_predictions(df: DataFrame, path: str) -> None:
    """K4: test rows + residual_pred, taux_pred, erreur_absolue."""
    df.write.mode("overwrite").parquet(path)


def export_results(results: DataFrame, importance: DataFrame | None, path: str) -> None:
    """K5: leaderboard and importance tables (both small)."""
    results.coalesce(1).write.mode("overwrite").parquet(f"{path}/results")
    if importance is not None:
        importance.coalesce(1).write.mode("overwrite").parquet(f"{path}/importance")


def export_full_history(df: DataFrame, path: str, ts: str = "datetime") -> None:
    """K7: consolidated history partitioned by date, sorted by station and time
    inside each file. Range partitioning on (date, station, time) keeps a
    hot station-day splittable; no global single-task sort."""
    (df.withColumn("date", F.to_date(ts))
     .repartitionByRange("date", "station_id", ts)
     .sortWithinPartitions("station_id", ts)
     .write.mode("overwrite").partitionBy("date").parquet(path))


class MissingInput(FileNotFoundError):
    pass


def load_checked(spark: SparkSession, path: str, required: Sequence[str] = (),
                 optional: bool = False, fmt: str = "parquet") -> DataFrame | None:
    """Read a processed table; a missing required table or column fails,
    a missing optional table returns None."""
    if not _exists(spark, path):
        if optional:
            return None
        raise MissingInput(f"missing input table {path}")
    df = spark.read.format(fmt).option("header", True).load(path) if fmt == "csv" \
        else spark.read.format(fmt).load(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingInput(f"{path}: missing columns {missing}")
    return df
