"""Context of a running ingest: station info and weather that keep arriving.

A poll takes the context known when its micro-batch runs, not when the query
was started. Landed info and weather documents are therefore sources of the
same stream as the status documents: each micro-batch first adds the new ones
to tables partitioned by date, then reads back the few dates that its own
polls need. Nothing is listed or read twice, and no batch scans the history.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import partition_dates
from ..sources import snapshots as S

# Columns of a stream that carries context rows beside the status rows.
KIND, INFO, WEATHER = "_kind", "_info", "_weather"


def info_rows(docs: DataFrame) -> DataFrame:
    """(datetime, station_id, _info): one row per station of an info document, not yet reduced."""
    e = docs.select(S.document_time(F.col("last_updated"), F.col(S.POLL_TIME)).alias("datetime"), F.posexplode("data.stations").alias("pos", "s"))
    return e.select("datetime", F.col("s.station_id").cast("int").alias("station_id"),
                    F.struct("pos", "s.name", "s.lat", "s.lon", "s.capacity").alias(INFO), F.lit("info").alias(KIND))


def weather_rows(docs: DataFrame) -> DataFrame:
    """(datetime, _weather): one row per weather document."""
    return docs.select(S.document_time(F.col("time"), F.col(S.POLL_TIME)).alias("datetime"),
                       F.struct("current.apparent_temperature", "current.weather_code").alias(WEATHER), F.lit("weather").alias(KIND))


class ContextTables:
    """Tables ``info`` and ``weather`` below ``base``, partitioned by the date of their documents.

    Rows may be written twice when a batch is replayed; readers reduce them
    (smallest weather of a time, last info of a station), so that does no harm.
    """

    def __init__(self, base: str):
        self.base = base.rstrip("/")

    def add(self, batch: DataFrame) -> DataFrame:
        """Store the context rows of a micro-batch; returns its status rows."""
        for kind, payload in (("info", INFO), ("weather", WEATHER)):
            if payload in batch.columns:
                rows = batch.where((F.col(KIND) == kind) & F.col("datetime").isNotNull())
                (rows.select("datetime", *["station_id"] * (kind == "info"), f"{payload}.*", F.to_date("datetime").alias("date"))
                 .write.mode("append").partitionBy("date").parquet(f"{self.base}/{kind}"))
        return batch.where(F.col(KIND) == "status").drop(KIND, INFO, WEATHER)

    def _read(self, spark: SparkSession, kind: str, days: Sequence[date | None], newest: bool) -> DataFrame | None:
        """Rows of the ``days``, of the last date before each of them, and with ``newest`` of the newest date."""
        have = [d for d in partition_dates(spark, f"{self.base}/{kind}") if d is not None]
        wanted = {d for d in days if d is not None}
        need = (wanted & set(have)) | {max(e) for d in wanted if (e := [x for x in have if x < d])} | set(have[-1:] if newest else [])
        if not need:
            return None
        return spark.read.parquet(f"{self.base}/{kind}").where(F.col("date").isin(sorted(need)))

    def weather(self, spark: SparkSession, days: Sequence[date | None]) -> DataFrame | None:
        """S5 for polls of ``days``: one row per weather time."""
        rows = self._read(spark, "weather", days, False)
        if rows is None:
            return None
        value = F.struct("apparent_temperature", "weather_code")
        return rows.groupBy("datetime").agg(F.min(value).alias("w")).select("datetime", "w.*")

    def info(self, spark: SparkSession, days: Sequence[date | None]) -> DataFrame | None:
        """S4 for polls of ``days``: the last info of each station in their dates, the date before and the newest one."""
        rows = self._read(spark, "info", days, True)
        if rows is None:
            return None
        docs = rows.select(F.col("datetime").alias("_t"), F.col("pos").alias("_pos"), F.struct("station_id", "name", "lat", "lon", "capacity").alias("s"))
        return S.last_info(docs)
