"""Registered streaming queries (ST1-ST4).

Each one lands documents derived from the given tables, drains a
Structured Streaming query with ``availableNow`` into a sink under the shared
checkpoint folder and returns the sink read back as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profiles as PR
from ..operators import split as SP
from ..session import materialize, scratch_path
from ..sources import calendars as CAL
from ..sources.tables import readings, table
from ..streaming import ingest as ST
from ..streaming.context import ContextTables
from . import sqltext as Q
from .catalog import output, register
from .features import _ft_sql, final_rounding, lagged_features
from .ingest import RECORD_COLUMNS, RECORDS_BODY, RECORDS_SQL, info_documents, land_text, status_documents, weather_documents


# Landed files per micro-batch of the registered queries (a drop has one file per task that wrote it).
FILES_PER_BATCH = 8


def land_status_weekly(r: DataFrame, path: str) -> None:
    """Status documents in one drop per week, the weeks in reverse order, then a repeat of the last week.

    Most documents so arrive weeks late and the repeat must be dropped.
    """
    docs = status_documents(r).withColumn("_w", F.floor(F.datediff(F.to_date("datetime"), F.lit("1970-01-01")) / 7))
    weeks = sorted((x[0] for x in docs.select("_w").distinct().collect()), reverse=True)  # one value per week
    for w in weeks + weeks[:1]:
        land_text(docs.where(F.col("_w") == w), path)


def _context(spark: SparkSession, sf_dir: str, r: DataFrame):
    """Landing folders of the info and weather documents, and the calendars."""
    base = scratch_path(spark, "context")
    vac, hol = CAL.calendars_from_events(table(spark, sf_dir, "events"))
    return land_text(info_documents(r), f"{base}/info"), land_text(weather_documents(r), f"{base}/weather"), vac, hol


def _sink(spark: SparkSession, stream: DataFrame, transform=None, **options) -> DataFrame:
    target, metrics, ckpt = (scratch_path(spark, n) for n in ("append_target", "append_metrics", "append_ckpt"))
    ST.append_sink(stream, target, metrics, ckpt, transform=transform, **options).awaitTermination()
    return spark.read.parquet(target)


def _ingest(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    r = readings(spark, sf_dir)
    status_dir = scratch_path(spark, "status_stream")
    land_status_weekly(r, status_dir)
    info_dir, weather_dir, vac, hol = _context(spark, sf_dir, r)
    context = ContextTables(scratch_path(spark, "context_tables"))
    enrich = ST.snapshot_enrichment(context.info, context.weather, vac, hol)
    return _sink(spark, ST.snapshot_stream(spark, status_dir, FILES_PER_BATCH, info_dir, weather_dir), enrich, context=context, **options)


@register("stream_snapshot_ingest", RECORDS_SQL)
def q_stream_ingest(spark, sf_dir):
    return output(_ingest(spark, sf_dir).select(*RECORD_COLUMNS))


@register("stream_dedup", f"""WITH {Q.READINGS}
SELECT station_id, datetime, bikes_mechanical, bikes_ebike, numdocksavailable,
       {Q.truthy('is_renting')} AS is_renting FROM readings""")
def q_stream_dedup(spark, sf_dir):
    r = readings(spark, sf_dir)
    status_dir = scratch_path(spark, "status_stream")
    land_status_weekly(r, status_dir)
    return output(_sink(spark, ST.snapshot_stream(spark, status_dir, FILES_PER_BATCH)).drop("date"))


@register("stream_append_rotate", f"""WITH {Q.READINGS},
rec AS ({RECORDS_BODY})
SELECT *, CAST(datetime AS DATE) AS date FROM rec""")
def q_stream_append(spark, sf_dir):
    return output(_ingest(spark, sf_dir, max_records_per_file=5000))


@register("stream_trend_score", _ft_sql(
    "SELECT reading_id, station_trend_avg, morning_evening_ratio, temp_anomalie, lag_res_240min, residual "
    "FROM ft WHERE split = 'test'"))
def q_stream_trend(spark, sf_dir):
    lagged = materialize(lagged_features(readings(spark, sf_dir)), "lagged")
    with_split, _ = SP.temporal_split(lagged)
    prof = PR.fit_profiles(with_split.where(F.col("split") == "train"))
    # New readings arrive as files: the test period, landed in three drops.
    landing = scratch_path(spark, "new_readings")
    test = with_split.where(F.col("split") == "test").drop("split")
    day = F.dayofmonth("datetime")
    for cond in (day <= 10, (day > 10) & (day <= 20), day > 20):
        test.where(cond).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(test.schema).option("maxFilesPerTrigger", 2).parquet(landing)
    scored = ST.trend_score(stream, prof)
    sink = scratch_path(spark, "score_sink")
    ST.run_to_parquet(scored, sink, scratch_path(spark, "score_ckpt"))
    out = final_rounding(spark.read.parquet(sink))
    return out.select("reading_id", "station_trend_avg", "morning_evening_ratio", "temp_anomalie",
                      "lag_res_240min", "residual")
