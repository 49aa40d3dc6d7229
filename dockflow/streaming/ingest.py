"""Structured Streaming: snapshot ingest (ST1), dedup (ST2), append sink with
metrics (ST3), online trend scoring (ST4).

The reference polls an API every five minutes and rewrites a whole CSV;
here landed JSON documents are a file stream, context is joined per
micro-batch, and the sink appends only the keys that the table does not hold,
idempotently per query and micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import profiles as PR
from ..session import list_names, read_text, remove_path, write_text
from ..sinks import writers as W
from ..sources import snapshots as S
from . import context as C

# Helper column: when and from which file a row arrived; decides which of several rows of a key is the first.
ARRIVAL = "_arrival"
# A context table, or what gives the one for a session and the days of a batch.
Context = DataFrame | Callable[[SparkSession, list], DataFrame | None] | None


def status_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream of landed status documents (explicit schema, no inference)."""
    r = spark.readStream.schema(S.STATUS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.json(path).withColumn(S.POLL_TIME, F.col("_metadata.file_modification_time"))


def _document_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).json(path).withColumn(S.POLL_TIME, F.col("_metadata.file_modification_time"))


def snapshot_stream(spark: SparkSession, status_dir: str, max_files_per_trigger: int | None = None,
                    info_dir: str | None = None, weather_dir: str | None = None) -> DataFrame:
    """ST1, streaming part: landed snapshots exploded to station rows, tagged with their arrival.

    With ``info_dir`` or ``weather_dir`` the context documents that land there
    travel in the same stream (see ``ContextTables``).
    """
    docs = status_stream(spark, status_dir, max_files_per_trigger)
    arrival = F.struct(F.col(S.POLL_TIME).alias("t"), F.col("_metadata.file_path").alias("f"))
    rows = S.explode_status(docs.withColumn(ARRIVAL, arrival), keep=(ARRIVAL,))
    if not (info_dir or weather_dir):
        return rows
    rows = rows.withColumn(C.KIND, F.lit("status"))
    if info_dir:
        rows = rows.unionByName(C.info_rows(_document_stream(spark, info_dir, S.INFO_SCHEMA)), allowMissingColumns=True)
    if weather_dir:
        rows = rows.unionByName(C.weather_rows(_document_stream(spark, weather_dir, S.WEATHER_SCHEMA)), allowMissingColumns=True)
    return rows


def snapshot_enrichment(info: Context, weather: Context, vacation: DataFrame | None,
                        holidays: DataFrame | None) -> Callable[[DataFrame, list], DataFrame]:
    """ST1, per micro-batch: station, weather (as of the poll) and calendar context.

    ``info`` and ``weather`` are tables, or functions of the session and the
    batch's days that give the table to use, such as those of ``ContextTables``.
    """
    from ..plans.ingest import build_records

    def enrich(rows: DataFrame, days: list) -> DataFrame:
        known = [c(rows.sparkSession, days) if callable(c) else c for c in (info, weather)]
        return build_records(rows, *known, vacation, holidays, keep=("date",))
    return enrich


def append_sink(stream: DataFrame, target: str, metrics_path: str, checkpoint: str,
                max_records_per_file: int | None = None, available_now: bool = True,
                processing_time: str = "5 minutes", context: C.ContextTables | None = None,
                transform: Callable[[DataFrame, list], DataFrame] | None = None) -> StreamingQuery:
    """ST2 + ST3: ``foreachBatch`` -> exact dedup against the table, append, metrics row.

    A key is dropped only when the target (or the batch) really holds it: no
    watermark, so late documents are kept however old they are, and the only
    state is the table itself, of which a batch reads the dates it touches.

    Everything runs once per batch: its sources are read into a stage of one
    row per key (``context`` rows go to their tables first), the keys that
    the table lacks are transformed from there into a second stage, and that
    one is appended. ``transform`` gets the new rows and their dates and
    returns a row for each.

    Replays are exact. The second stage and the counts are complete in a
    folder of their own (named by checkpoint and batch id) before the append,
    and the metrics row comes last. A replay after a crash finds that folder:
    it appends what is missing and records the stored counts. A recorded batch
    is consumed and nothing else. The table's size is carried from batch to
    batch, one small file per query.
    """
    name = checkpoint.rstrip("/")
    totals = f"{metrics_path.rstrip('/')}/_totals"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = quote(name, safe="")
        log = f"{metrics_path}/query={query}"
        staged = f"{name}-staged/batch={batch_id}"
        if W._exists(spark, f"{log}/batch={batch_id}/_SUCCESS"):
            batch.write.format("noop").mode("overwrite").save()     # the stream's state must still be committed
            done = spark.read.schema(W.METRICS_SCHEMA).parquet(f"{log}/batch={batch_id}").first()
            write_text(spark, f"{totals}/{query}", str(done["n_total"]))
            remove_path(spark, staged)
            return
        counted = read_text(spark, f"{staged}/counts")
        if counted is None:
            rows = context.add(batch) if context else batch
            order = [ARRIVAL] if ARRIVAL in rows.columns else list(rows.columns)
            keys, days = W.staged_keys(rows, f"{staged}/keys", order)
            new = W.absent(keys, target, days).drop(ARRIVAL)
            (transform(new, days) if transform else new).write.mode("overwrite").parquet(f"{staged}/rows")
            missing = spark.read.parquet(f"{staged}/rows")
            n_batch, n_new = keys.count(), missing.count()           # of parquet footers
            write_text(spark, f"{staged}/counts", f"{n_batch} {n_new}")
        else:
            n_batch, n_new = map(int, counted.split())
            staged_rows = spark.read.parquet(f"{staged}/rows")
            days = [r[0] for r in staged_rows.select("date").distinct().collect()]
            missing = W.absent(staged_rows, target, days)
            batch.write.format("noop").mode("overwrite").save()
        if n_batch:
            W.write_new(missing, target, max_records_per_file=max_records_per_file)
            before = max([int(read_text(spark, f"{totals}/{q}") or 0) for q in list_names(spark, totals) if not q.endswith((".new", ".crc"))], default=0)
            res = W.AppendResult(n_batch, n_new, before + n_new)
            W.metrics_row(spark, batch_id, res).write.mode("overwrite").parquet(f"{log}/batch={batch_id}")
            write_text(spark, f"{totals}/{query}", str(res.n_total))
        remove_path(spark, staged)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def read_metrics(spark: SparkSession, metrics_path: str) -> DataFrame:
    """K8 rows of every query and batch of a sink."""
    return spark.read.schema(W.METRICS_SCHEMA).option("recursiveFileLookup", True).parquet(metrics_path)


def trend_score(stream: DataFrame, prof: PR.Profiles) -> DataFrame:
    """ST4: fitted profiles applied to new readings (stream-static left joins).

    Gives ratio, temperature anomaly, trend with its fallbacks and the
    residual target; ``taux_predit = trend + residual`` at serving time.
    """
    out = PR.apply_ratio(stream, prof)
    out = PR.apply_normal(out, prof)
    out = PR.apply_trend(out, prof)
    if "lag_240min" in stream.columns:
        return PR.residual_target(out)
    from ..functions import round_half_even
    return out.withColumn("residual", round_half_even(F.col("capacity_status_calc")
                                                      - F.col("station_trend_avg"), 2))


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Drain a stream into a parquet sink (append mode) with ``availableNow``."""
    q = (stream.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
