"""The source pipelines bound to the driver tables: messages made from ``events``
are landed as topic files, read in micro-batches and merged; some are faulty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.functions.timefn import iso_z
from envlake.plans.driver_tables import table
from envlake.plans.maintenance import logged
from envlake.streaming.ingest import SourceSpec, run_available, scratch_dir, total_counts
from envlake.streaming.pipelines import airnow_spec, nws_spec, open_meteo_spec
from envlake.streaming.replay import topic_files
from envlake.streaming.store import read_table


def _ingest(spark: SparkSession, root: str, events: DataFrame, value: Column, topic: str, *specs: SourceSpec) -> None:
    """Land the messages in three stretches of time, and run the pipelines after each:
    a topic is read in order, which a folder of files landed at once is not."""
    msgs = events.select(F.col("user_id").cast("string").alias("key"), value.alias("value"), F.lit(topic).alias("topic"),
                         (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    files = -(-topic_files(events) // 3)
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    for spec in specs:
        spec.buckets = 8
    for i in range(3):
        since, until = F.lit(lo + (hi - lo) * i / 3), F.lit(lo + (hi - lo) * (i + 1) / 3)
        part = msgs.where((F.col("timestamp") >= since) & ((F.col("timestamp") < until) if i < 2 else F.lit(True)))
        (part.repartitionByRange(files, "timestamp").write.mode("append")
         .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{root}/topic"))
        for spec in specs:
            run_available(spark, spec, f"{root}/topic", f"{root}/checkpoint-{spec.name}")


def _dead(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    return spark.read.parquet(spec.dlq_path).select(F.col("offset"), F.col("error"))


def _airnow_value() -> Column:
    event = F.to_json(F.struct(
        F.when(F.col("event_id") % 41 == 0, F.lit("")).otherwise(F.concat(F.lit("a"), (F.col("user_id") % 300).cast("string"), F.lit(":"),
                                                            F.col("event_type"))).alias("event_id"),
        F.lit("airnow").alias("source"), F.concat(F.lit("area "), (F.col("user_id") % 50).cast("string")).alias("reporting_area"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_issue"),
        F.when(F.col("event_id") % 97 == 0, F.lit("never")).otherwise(F.date_format(F.date_add("ts", 1), "yyyy-MM-dd")).alias("date_forecast"),
        F.floor("value").alias("aqi"), (F.col("user_id") % 6 + 1).alias("category_number"),
        F.struct(F.col("event_id").alias("n")).alias("raw_data")))
    return F.when(F.col("event_id") % 89 == 0, F.substring(event, 1, 40)).otherwise(event)


def ingest_airnow(spark: SparkSession, d: str) -> DataFrame:
    """The staging table after all messages; latest per event id, first start kept."""
    root = scratch_dir(spark, "ingest-airnow")
    spec = airnow_spec(f"{root}/table", f"{root}/dlq")
    _ingest(spark, root, table(spark, d, "events"), _airnow_value(), "airnow", spec)
    return read_table(spark, spec.table_path).select(
        "event_id", "date_issue_dtz", "date_forecast_dtz", "reporting_area", "aqi", "category_number", "raw_data",
        "effective_start_at_dtz", "is_current", "last_updated_at_dtz")


def ingest_airnow_dead(spark: SparkSession, d: str) -> DataFrame:
    """What that pipeline dead-lettered: the message's place, the error and its text."""
    root = scratch_dir(spark, "ingest-airnow")
    spec = airnow_spec(f"{root}/table", f"{root}/dlq")
    _ingest(spark, root, table(spark, d, "events"), _airnow_value(), "airnow", spec)
    return spark.read.parquet(spec.dlq_path).select("key", "original_topic", "partition", "offset", "error")


def ingest_nws(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_dir(spark, "ingest-nws")
    start = F.date_trunc("hour", F.col("ts"))
    value = F.to_json(F.struct(
        F.concat(F.lit("n"), (F.col("user_id") % 300).cast("string"), F.lit(":"), F.col("event_type")).alias("event_id"),
        F.lit("nws.hourly_forecast").alias("event_type"), F.lit("api").alias("source"), F.lit("office").alias("office"),
        F.lit("grid").alias("grid_id"), (F.col("user_id") % 50).alias("grid_x"), F.lit("7").alias("grid_y"),
        F.when(F.col("event_id") % 97 == 0, F.lit("soon")).otherwise(iso_z(start)).alias("start_time"),
        iso_z(start + F.expr("INTERVAL 1 HOUR")).alias("end_time"), (F.col("event_id") % 2 == 0).alias("is_daytime"),
        F.col("value").alias("temperature"), F.lit("C").alias("temperature_unit"),
        F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("value") / 2).alias("wind_speed"),
        F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("string")).otherwise(iso_z(F.col("ts"))).alias("ingested_at_dtz")))
    spec = nws_spec(f"{root}/table", f"{root}/dlq")
    _ingest(spark, root, table(spark, d, "events"), value, "nws", spec)
    return read_table(spark, spec.table_path).select(
        "event_id", "grid_x", "grid_y", "start_time", "end_time", "is_daytime", "temperature", "temperature_unit",
        "wind_speed", "ingested_at_dtz", "last_updated_at_dtz")


def ingest_open_meteo(spark: SparkSession, d: str) -> DataFrame:
    """Both kinds share the topic; weather without a temperature and unknown kinds
    are dead-lettered, and reported here with the stored rows."""
    root = scratch_dir(spark, "ingest-open-meteo")
    kind = F.when(F.col("event_id") % 83 == 0, F.lit("tide")).when(F.col("event_type") == "click", F.lit("air_quality")).otherwise(F.lit("weather"))
    start = F.date_trunc("hour", F.col("ts"))
    value = F.to_json(F.struct(
        F.concat(F.lit("o"), (F.col("user_id") % 300).cast("string"), F.lit(":"), F.col("event_type")).alias("event_id"),
        kind.alias("data_kind"), F.lit("forecast").alias("record_type"), F.lit(60).alias("record_frequency_min"),
        iso_z(start).alias("open_meteo_start_time"), iso_z(start + F.expr("INTERVAL 1 HOUR")).alias("open_meteo_end_time"),
        (F.col("user_id") % 90).cast("double").alias("latitude"), F.lit(1.5).alias("longitude"),
        iso_z(F.col("ts")).alias("ingested_at_dtz"),
        F.when((kind != "air_quality") & (F.col("event_id") % 79 != 0), F.col("value")).alias("temperature"),
        F.when(kind == "air_quality", F.col("value")).alias("pm2_5")))
    specs = {k: open_meteo_spec(k, f"{root}/table-{k}", f"{root}/dlq-{k}") for k in ("weather", "air_quality")}
    _ingest(spark, root, table(spark, d, "events"), value, "open_meteo", *specs.values())
    out = []
    for k, val in (("weather", "temperature"), ("air_quality", "pm2_5")):
        spec = specs[k]
        out.append(read_table(spark, spec.table_path).select(
            F.lit(k).alias("kind"), "event_id", "open_meteo_start_time", "latitude", F.col(val).alias("measured"),
            "ingested_at_dtz", "last_updated_at_dtz", F.lit(None).cast("long").alias("offset"), F.lit(None).cast("string").alias("error")))
        none = F.lit(None).cast
        out.append(_dead(spark, spec).select(
            F.lit(f"dead {k}").alias("kind"), none("string").alias("event_id"), none("timestamp").alias("open_meteo_start_time"),
            none("double").alias("latitude"), none("double").alias("measured"), none("timestamp").alias("ingested_at_dtz"),
            none("timestamp").alias("last_updated_at_dtz"), "offset", "error"))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def ingest_counts(spark: SparkSession, d: str) -> DataFrame:
    """What the AirNow pipeline's batches counted over three runs, and how many of its runs
    the run log holds as successful."""
    root = scratch_dir(spark, "ingest-counts")
    spec = airnow_spec(f"{root}/table", f"{root}/dlq")
    spec.counts_path = f"{root}/counts"
    logged(spark, f"{root}/runs", "airnow", "all", lambda: _ingest(spark, root, table(spark, d, "events"), _airnow_value(), "airnow", spec))
    runs = spark.read.parquet(f"{root}/runs").where("state = 'success' and end_time >= start_time").agg(F.count("*").alias("runs"))
    return total_counts(spark, spec.counts_path).select("read", "malformed", "dead_lettered", "merged").crossJoin(runs)  # one row each


QUERIES = {f.__name__: f for f in (ingest_airnow, ingest_airnow_dead, ingest_nws, ingest_open_meteo, ingest_counts)}

_ISO_DAY = "CAST(date_trunc('day', ts) AS TIMESTAMP)"
_NEWEST = "ORDER BY ts, user_id % 4, event_id"
_LAST = "row_number() OVER (PARTITION BY k ORDER BY ts DESC, user_id % 4 DESC, event_id DESC) AS rn, count(*) OVER (PARTITION BY k) AS times"

ORACLE_SQL = {
    "ingest_airnow": f"""
WITH e AS (SELECT *, CASE WHEN event_id % 41 = 0
                 THEN 'airnow:area ' || (user_id % 50) || ':' || strftime(ts, '%Y-%m-%d') || ':' || strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d')
                 ELSE 'a' || (user_id % 300) || ':' || event_type END AS k
           FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0),
r AS (SELECT *, {_LAST}, min(ts) OVER (PARTITION BY k) AS first_ts FROM e)
SELECT k AS event_id, {_ISO_DAY} AS date_issue_dtz, {_ISO_DAY} + INTERVAL 1 DAY AS date_forecast_dtz,
       'area ' || (user_id % 50) AS reporting_area, CAST(floor(value) AS BIGINT) AS aqi, user_id % 6 + 1 AS category_number,
       '{{"n":' || event_id || '}}' AS raw_data, first_ts AS effective_start_at_dtz, TRUE AS is_current,
       CASE WHEN times > 1 THEN ts END AS last_updated_at_dtz
FROM r WHERE rn = 1""",
    "ingest_airnow_dead": """
SELECT CAST(user_id AS VARCHAR) AS key, 'airnow' AS original_topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
       'type:date_forecast' AS error FROM events WHERE event_id % 97 = 0 AND event_id % 89 <> 0""",
    "ingest_counts": """
SELECT count(*) AS read, count(*) FILTER (event_id % 89 = 0) AS malformed, count(*) FILTER (event_id % 97 = 0 AND event_id % 89 <> 0) AS dead_lettered,
       count(*) FILTER (event_id % 97 <> 0 AND event_id % 89 <> 0) AS merged, CAST(1 AS BIGINT) AS runs FROM events""",
    "ingest_nws": f"""
WITH e AS (SELECT *, 'n' || (user_id % 300) || ':' || event_type AS k, date_trunc('hour', ts) AS h FROM events WHERE event_id % 97 <> 0),
r AS (SELECT *, {_LAST}, last_value(CASE WHEN event_id % 3 <> 0 THEN ts END IGNORE NULLS) OVER (PARTITION BY k {_NEWEST}
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS ing FROM e)
SELECT k AS event_id, user_id % 50 AS grid_x, CAST(7 AS BIGINT) AS grid_y, h AS start_time, h + INTERVAL 1 HOUR AS end_time,
       event_id % 2 = 0 AS is_daytime, value AS temperature, 'C' AS temperature_unit,
       CASE WHEN event_id % 5 <> 0 THEN value / 2 END AS wind_speed, ing AS ingested_at_dtz,
       CASE WHEN times > 1 THEN ts END AS last_updated_at_dtz
FROM r WHERE rn = 1""",
    "ingest_open_meteo": f"""
WITH e AS (SELECT *, CASE WHEN event_id % 83 = 0 THEN 'tide' WHEN event_type = 'click' THEN 'air_quality' ELSE 'weather' END AS kind,
                  'o' || (user_id % 300) || ':' || event_type AS k FROM events),
good AS (SELECT * FROM e WHERE kind = 'air_quality' OR (kind = 'weather' AND event_id % 79 <> 0)),
r AS (SELECT *, {_LAST.replace('PARTITION BY k', 'PARTITION BY kind, k')} FROM good)
SELECT kind, k AS event_id, date_trunc('hour', ts) AS open_meteo_start_time, CAST(user_id % 90 AS DOUBLE) AS latitude,
       value AS measured, ts AS ingested_at_dtz, CASE WHEN times > 1 THEN ts END AS last_updated_at_dtz,
       CAST(NULL AS BIGINT) AS "offset", CAST(NULL AS VARCHAR) AS error
FROM r WHERE rn = 1
UNION ALL
SELECT 'dead weather', NULL, NULL, NULL, NULL, NULL, NULL, event_id,
       CASE WHEN kind = 'tide' THEN 'literal:data_kind' ELSE 'missing:temperature' END
FROM e WHERE kind = 'tide' OR (kind = 'weather' AND event_id % 79 = 0)""",
}
