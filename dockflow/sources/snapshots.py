"""Nested JSON sources: status snapshots (S3), station info (S4), weather.

Schemas are explicit (no inference). Status entries carry the bike counts as
an array of one-key maps, ``[{"mechanical": n}, {"ebike": n}]``; the dock
count appears under two key names across API versions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Column of a document frame with the time it was polled (the landed file's time).
POLL_TIME = "_poll_time"

STATUS_STATION = T.StructType([
    T.StructField("station_id", T.LongType()),
    T.StructField("num_bikes_available_types", T.ArrayType(T.MapType(T.StringType(), T.IntegerType()))),
    T.StructField("num_docks_available", T.IntegerType()),
    T.StructField("numDocksAvailable", T.IntegerType()),
    T.StructField("is_renting", T.IntegerType()),
])
STATUS_SCHEMA = T.StructType([
    T.StructField("last_updated", T.StringType()),
    T.StructField("data", T.StructType([T.StructField("stations", T.ArrayType(STATUS_STATION))])),
])
INFO_STATION = T.StructType([
    T.StructField("station_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("capacity", T.IntegerType()),
])
INFO_SCHEMA = T.StructType([
    T.StructField("last_updated", T.StringType()),
    T.StructField("data", T.StructType([T.StructField("stations", T.ArrayType(INFO_STATION))])),
])
WEATHER_SCHEMA = T.StructType([
    T.StructField("time", T.StringType()),
    T.StructField("current", T.StructType([
        T.StructField("apparent_temperature", T.DoubleType()),
        T.StructField("weather_code", T.IntegerType()),
    ])),
])


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Batch read of landed JSON documents (one per line) with a fixed schema.

    ``num_docks_available`` and ``numDocksAvailable`` differ beyond case, so
    both stay separate fields without a case-sensitive session.
    """
    return spark.read.schema(schema).json(path).withColumn(POLL_TIME, F.col("_metadata.file_modification_time"))


def document_time(text: Column, fallback: Column | None) -> Column:
    """Time of a document: ISO text or epoch seconds / milliseconds, else the fallback
    (when the document was polled). Unreadable text counts as absent."""
    number = text.try_cast("double")
    epoch = F.timestamp_micros((F.when(number > 1e11, number * 1e3).otherwise(number * 1e6)).cast("long"))
    known = F.coalesce(epoch, text.try_cast("timestamp"))
    return known if fallback is None else F.coalesce(known, fallback)


def last_key_in_map_array(arr: Column, key: str) -> Column:
    """Value of the last map holding ``key`` in an array of maps, default 0."""
    last = F.aggregate(arr, F.lit(None).cast("int"), lambda acc, m: F.coalesce(m[key], acc))
    return F.coalesce(last, F.lit(0))


def coalesce_renamed(*cols: str, default=0) -> Column:
    """First non-NULL of several key spellings, else ``default``."""
    return F.coalesce(*[F.col(c) for c in cols], F.lit(default))


def explode_status(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """S3: one row per station and snapshot, with P14 and P15 applied.

    ``is_renting`` defaults to 1 when absent and becomes a boolean ``== 1``.
    The snapshot time is the ``last_updated`` of the document (ISO or epoch);
    a document without one takes the time it was polled (``_poll_time``).
    """
    polled = F.col(POLL_TIME) if POLL_TIME in docs.columns else None
    s = docs.select(document_time(F.col("last_updated"), polled).alias("datetime"),
                    F.explode("data.stations").alias("s"), *keep)
    arr = F.col("s.num_bikes_available_types")
    return s.select(
        F.col("s.station_id").cast("int").alias("station_id"),
        "datetime",
        last_key_in_map_array(arr, "mechanical").alias("bikes_mechanical"),
        last_key_in_map_array(arr, "ebike").alias("bikes_ebike"),
        coalesce_renamed("s.num_docks_available", "s.numDocksAvailable").alias("numdocksavailable"),
        (F.coalesce(F.col("s.is_renting"), F.lit(1)) == 1).alias("is_renting"), *keep,
    )


def station_info_dim(docs: DataFrame) -> DataFrame:
    """Station dimension from info documents; the last duplicate wins.

    Position inside a document and the document time order the duplicates;
    ``max_by`` keeps the winner in one hash aggregation (partial aggregation
    before the shuffle, so a station repeated everywhere does not pile up in
    one task). Missing fields take the reference defaults.
    """
    polled = F.col(POLL_TIME) if POLL_TIME in docs.columns else None
    return last_info(docs.select(document_time(F.col("last_updated"), polled).alias("_t"),
                                 F.posexplode("data.stations").alias("_pos", "s")))


def last_info(e: DataFrame) -> DataFrame:
    """S4 over exploded documents (_t, _pos, s): the last info of each station, with defaults."""
    rec = F.struct(
        F.coalesce(F.col("s.name"), F.lit("")).alias("name"),
        F.coalesce(F.col("s.lat"), F.lit(0.0)).alias("lat"),
        F.coalesce(F.col("s.lon"), F.lit(0.0)).alias("lon"),
        F.coalesce(F.col("s.capacity"), F.lit(0)).alias("capacity"))
    order = F.struct(F.col("_t"), F.col("_pos"))
    g = (e.where(F.col("s.station_id").isNotNull())
         .groupBy(F.col("s.station_id").cast("int").alias("station_id"))
         .agg(F.max_by(rec, order).alias("r")))
    return g.select("station_id", "r.*")


def weather_context(docs: DataFrame) -> DataFrame:
    """(datetime, apparent_temperature, weather_code), one row per weather time.

    Documents may repeat a time; the smallest values of it stay, so the
    context never multiplies status rows.
    """
    polled = F.col(POLL_TIME) if POLL_TIME in docs.columns else None
    rows = docs.select(document_time(F.col("time"), polled).alias("datetime"),
                       F.struct(F.col("current.apparent_temperature").alias("apparent_temperature"),
                                F.col("current.weather_code").alias("weather_code")).alias("w"))
    return rows.where("datetime IS NOT NULL").groupBy("datetime").agg(F.min("w").alias("w")).select("datetime", "w.*")


def weather_at(times: DataFrame, weather: DataFrame, bucket_minutes: int = 60) -> DataFrame:
    """The latest weather at or before each of the distinct ``times`` (datetime).

    An as-of merge: polls and weather form one tagged sequence, and inside a
    bucket of ``bucket_minutes`` each poll takes the last weather before it.
    A poll ahead of the first weather of its bucket takes the carry: the last
    weather of the buckets before, found along the buckets of a day and then
    along the days. Each row is read once and sorted within its bucket, so
    the cost is linear whatever the density; only one row a day is ordered
    as a whole.
    """
    return _last_before(_tagged(times, weather, bucket_minutes), bucket_minutes)


def _tagged(times: DataFrame, weather: DataFrame, bucket_minutes: int = 60) -> DataFrame:
    """(datetime, w, bucket): polls (w null) and weather as one table, written once."""
    from ..session import materialize
    kind = T.StructType([T.StructField("t", T.TimestampType()), T.StructField("apparent_temperature", T.DoubleType()),
                         T.StructField("weather_code", T.IntegerType())])
    polls = times.select("datetime").where("datetime IS NOT NULL").distinct().withColumn("w", F.lit(None).cast(kind))
    known = weather.select("datetime", F.struct(F.col("datetime").alias("t"), F.col("apparent_temperature").cast("double").alias("apparent_temperature"),
                                                F.col("weather_code").cast("int").alias("weather_code")).alias("w"))
    bucket = F.floor(F.unix_micros(F.col("datetime")) / (int(bucket_minutes) * 60_000_000))
    return materialize(polls.unionByName(known).withColumn("bucket", bucket), "asof")


def _last_before(merged: DataFrame, bucket_minutes: int = 60) -> DataFrame:
    """(datetime, apparent_temperature, weather_code) of the polls in ``_tagged``."""
    width = int(bucket_minutes) * 60_000_000
    up_to = Window.partitionBy("bucket").orderBy("datetime", F.col("w").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    own = merged.withColumn("own", F.last("w", ignorenulls=True).over(up_to)).where("w IS NULL")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    buckets = (merged.groupBy("bucket").agg(F.max("w").alias("w"))
               .withColumn("day", F.to_date(F.timestamp_micros(F.col("bucket") * width))))
    days = buckets.groupBy("day").agg(F.max("w").alias("w"))
    days = days.select("day", F.last("w", ignorenulls=True).over(before(Window.orderBy("day"))).alias("earlier"))
    carry = F.last("w", ignorenulls=True).over(before(Window.partitionBy("day").orderBy("bucket")))
    buckets = buckets.select("bucket", "day", carry.alias("carry")).join(days, "day").select("bucket", F.coalesce("carry", "earlier").alias("carry"))
    return (own.join(buckets, "bucket").select("datetime", F.coalesce("own", "carry").alias("w"))
            .select("datetime", "w.apparent_temperature", "w.weather_code"))


def enrich_status(status: DataFrame, info: DataFrame | None) -> DataFrame:
    """Status LEFT JOIN info; absent station -> name '', lat/lon NULL, capacity 0.

    The info dimension has one row per station, so its size is bounded by the
    station count; it is broadcast after a size check.
    """
    from ..operators.joins import join_bounded
    if info is None:
        return status.withColumns({"name": F.lit(""), "lat": F.lit(None).cast("double"),
                                   "lon": F.lit(None).cast("double"), "capacity": F.lit(0)})
    j = join_bounded(status, info.withColumn("_hit", F.lit(True)), "station_id", "left")
    return (j.withColumns({"name": F.when(F.col("_hit"), F.col("name")).otherwise(F.lit("")),
                           "capacity": F.when(F.col("_hit"), F.col("capacity")).otherwise(F.lit(0))})
            .drop("_hit"))


def attach_weather(status: DataFrame, weather: DataFrame | None, times: DataFrame | None = None) -> DataFrame:
    """S5 applied: the weather current at the poll, default 0.0 / 0 when there is none yet.

    ``times`` holds the poll times where they come cheaper than from
    ``status`` (one row per document). Batch frames only (the stream applies
    it per micro-batch).
    """
    from ..operators.joins import join_bounded
    if weather is None:
        return status.withColumns({"apparent_temperature": F.lit(0.0), "weather_code": F.lit(0)})
    merged = _tagged(status if times is None else times, weather)
    # the tagged table's count, from parquet footers, bounds the result without running the merge twice
    j = join_bounded(status, _last_before(merged), "datetime", "left", proven_rows=merged.count())
    return j.withColumns({"apparent_temperature": F.coalesce("apparent_temperature", F.lit(0.0)),
                          "weather_code": F.coalesce("weather_code", F.lit(0))})
