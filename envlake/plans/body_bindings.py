"""Response bodies made from ``events`` (one a user and day), landed as files, published to
a topic and ingested from it into the staging table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.plans.driver_tables import table
from envlake.streaming.bodies import BODY, BodyFeed
from envlake.streaming.ingest import run_available, scratch_dir
from envlake.streaming.pipelines import airnow_spec, nws_spec, open_meteo_spec
from envlake.streaming.store import read_table


def _through(spark: SparkSession, d: str, service: str, item: Column, body: Column, spec, topic: str) -> tuple[DataFrame, DataFrame]:
    """Land the bodies, publish them, ingest the topic: the table and the rejects. Some
    bodies are cut short."""
    root = scratch_dir(spark, f"bodies-{service}")
    day = F.datediff(F.col("ts"), F.lit("2020-01-01").cast("date"))
    ev = table(spark, d, "events").select("*", day.alias("day"), item.alias("item"))
    got = ev.groupBy("user_id", "day").agg(F.max("ts").alias("fetched_at"), F.transform(
        F.array_sort(F.collect_list(F.struct("event_id", "item"))), lambda x: x["item"]).alias("items"))
    text = F.when(F.col("user_id") % 31 == 0, F.substr(body, F.lit(1), F.length(body) - 3)).otherwise(body)
    cols = {"body_id": F.col("user_id") * 10_000 + F.col("day"), "service": F.lit(service), "latitude": (F.col("user_id") % 80).cast("double"),
            "longitude": F.lit(1.5), "timezone": F.when(F.col("user_id") % 2 == 0, "America/New_York").otherwise("UTC"), "office": F.lit("office"),
            "grid_id": F.lit("grid"), "grid_x": (F.col("user_id") % 50).cast("int"), "grid_y": F.lit(7), "fetched_at": F.col("fetched_at"), "body": text}
    got.select(*[cols[c.split()[0]].alias(c.split()[0]) for c in BODY.split(", ")]).write.option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{root}/landed")
    feed = BodyFeed(service, topic, f"{root}/topic", f"{root}/rejects")
    feed.run_available(spark, f"{root}/landed", f"{root}/publish")
    spec = spec(f"{root}/table", f"{root}/dlq")
    spec.buckets = 8
    run_available(spark, spec, f"{root}/topic", f"{root}/ingest")
    return read_table(spark, spec.table_path), spark.read.parquet(feed.rejects_path)


def _with_rejects(rows: DataFrame, bad: DataFrame) -> DataFrame:
    return rows.withColumns({"rejected_body": F.lit(None).cast("bigint"), "pos": F.lit(None).cast("int"), "error": F.lit(None).cast("string")}).unionByName(
        bad.select(F.col("body_id").alias("rejected_body"), "pos", "error"), allowMissingColumns=True)


def bodies_airnow(spark: SparkSession, d: str) -> DataFrame:
    """Lists of forecast items; an item with an unreadable AQI goes alone."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd")
    item = F.struct(iso("ts").alias("DateIssue"), iso(F.date_add("ts", 1)).alias("DateForecast"),
                    F.concat(F.lit("area "), (F.col("user_id") % 50).cast("string")).alias("ReportingArea"),
                    F.when(F.col("event_id") % 53 == 0, "high").otherwise(F.floor("value").cast("string")).alias("AQI"),
                    F.struct((F.col("user_id") % 6 + 1).alias("Number"), F.col("event_type").alias("Name")).alias("Category"),
                    F.when(F.col("event_id") % 2 == 0, "True").otherwise("no").alias("ActionDay"))
    rows, bad = _through(spark, d, "airnow", item, F.to_json("items"), airnow_spec, "airnow")
    return _with_rejects(rows.select("event_id", "reporting_area", "date_issue_dtz", "date_forecast_dtz", "aqi", "category_number", "category_name",
                                     "action_day", "effective_start_at_dtz", "last_updated_at_dtz"), bad)


def bodies_nws(spark: SparkSession, d: str) -> DataFrame:
    """Periods of hourly forecasts, flattened to a record a period."""
    start = F.date_trunc("hour", F.col("ts"))
    z = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    quantity = lambda v, unit: F.struct(v.alias("value"), F.lit(unit).alias("unitCode"))
    item = F.struct(z(start).alias("startTime"), z(start + F.expr("INTERVAL 1 HOUR")).alias("endTime"), (F.col("event_id") % 2 == 0).alias("isDaytime"),
                    F.col("event_type").alias("shortForecast"), quantity(F.col("value"), "C").alias("temperature"),
                    F.when(F.col("event_id") % 5 != 0, quantity(F.col("value") / 2, "km_h")).alias("windSpeed"))
    body = F.to_json(F.struct(F.struct(F.col("items").alias("periods")).alias("properties")))
    rows, bad = _through(spark, d, "nws", item, body, nws_spec, "nws")
    return _with_rejects(rows.select("grid_x", "start_time", "end_time", "is_daytime", "short_forecast", "temperature", "temperature_unit", "wind_speed",
                                     "wind_speed_unit", "last_updated_at_dtz"), bad)


def bodies_open_meteo(spark: SparkSession, d: str) -> DataFrame:
    """Hourly arrays in local time, one shorter than the hours, and for some the current
    conditions. The hours of one body differ; the local hour that a clock skips is not asked for."""
    item = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("t"), F.col("value").alias("v"))
    pick = lambda f: F.transform("items", lambda x: x[f])
    last = F.element_at("items", -1)
    now = F.struct(last["t"].alias("time"), last["v"].alias("pm10"))
    body = F.to_json(F.struct(
        F.struct(pick("t").alias("time"), pick("v").alias("pm2_5"), F.slice(pick("v"), 1, F.size("items") - 1).alias("ozone")).alias("hourly"),
        F.struct(F.lit("ug").alias("pm2_5")).alias("hourly_units"), F.when(F.col("user_id") % 3 == 0, now).alias("current"),
        F.struct(F.lit("mg").alias("pm10")).alias("current_units")))
    rows, bad = _through(spark, d, "air_quality", item, body, lambda t, q: open_meteo_spec("air_quality", t, q), "open_meteo")
    return _with_rejects(rows.select("record_type", "record_frequency_min", "latitude", "open_meteo_start_time", "open_meteo_end_time", "pm2_5", "pm2_5_unit", "ozone", "pm10",
                                     "pm10_unit", "ingested_at_dtz", "last_updated_at_dtz"), bad)


QUERIES = {f.__name__: f for f in (bodies_airnow, bodies_nws, bodies_open_meteo)}

_EV = """e AS (SELECT *, datediff('day', DATE '2020-01-01', CAST(ts AS DATE)) AS day, user_id * 10000 + datediff('day', DATE '2020-01-01', CAST(ts AS DATE)) AS body,
  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) - 1 AS pos, count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS n,
  max(ts) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS seen FROM events)"""
_NEW = "row_number() OVER (PARTITION BY {k} ORDER BY seen DESC, body DESC, pos DESC) AS rn, count(*) OVER (PARTITION BY {k}) AS times"
_CUT = "SELECT DISTINCT {none}, body, -1, 'malformed_body' FROM e WHERE user_id % 31 = 0"

ORACLE_SQL = {
    "bodies_airnow": f"""
WITH {_EV}, i AS (SELECT *, 'area ' || (user_id % 50) AS area, CAST(date_trunc('day', ts) AS TIMESTAMP) AS di FROM e WHERE user_id % 31 <> 0 AND event_id % 53 <> 0),
r AS (SELECT *, {_NEW.format(k='area, di')}, min(seen) OVER (PARTITION BY area, di) AS first_at FROM i)
SELECT 'airnow:' || replace(area, ' ', '') || ':' || strftime(di, '%Y-%m-%d') || ':' || strftime(di + INTERVAL 1 DAY, '%Y-%m-%d') AS event_id, area AS reporting_area,
       di AS date_issue_dtz, di + INTERVAL 1 DAY AS date_forecast_dtz, CAST(floor(value) AS BIGINT) AS aqi, user_id % 6 + 1 AS category_number, event_type AS category_name,
       event_id % 2 = 0 AS action_day, first_at AS effective_start_at_dtz, CASE WHEN times > 1 THEN seen END AS last_updated_at_dtz,
       CAST(NULL AS BIGINT) AS rejected_body, CAST(NULL AS INTEGER) AS pos, CAST(NULL AS VARCHAR) AS error FROM r WHERE rn = 1
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, body, pos, 'type:AQI' FROM e WHERE user_id % 31 <> 0 AND event_id % 53 = 0
UNION ALL {_CUT.format(none=', '.join(['NULL'] * 10))}""",
    "bodies_nws": f"""
WITH {_EV}, i AS (SELECT *, user_id % 50 AS x, date_trunc('hour', ts) AS h FROM e WHERE user_id % 31 <> 0), r AS (SELECT *, {_NEW.format(k='x, h')} FROM i)
SELECT x AS grid_x, h AS start_time, h + INTERVAL 1 HOUR AS end_time, event_id % 2 = 0 AS is_daytime, event_type AS short_forecast, value AS temperature, 'C' AS temperature_unit,
       CASE WHEN event_id % 5 <> 0 THEN value / 2 END AS wind_speed, CASE WHEN event_id % 5 <> 0 THEN 'km_h' END AS wind_speed_unit,
       CASE WHEN times > 1 THEN seen END AS last_updated_at_dtz, CAST(NULL AS BIGINT) AS rejected_body, CAST(NULL AS INTEGER) AS pos, CAST(NULL AS VARCHAR) AS error
FROM r WHERE rn = 1 UNION ALL {_CUT.format(none=', '.join(['NULL'] * 10))}""",
    "bodies_open_meteo": f"""
WITH {_EV}, i AS (
  SELECT body, pos, seen, 'forecast' AS rt, 60 AS freq, user_id, CAST(user_id % 80 AS DOUBLE) AS lat, date_trunc('second', ts) AS loc, value AS pm2, CASE WHEN pos < n - 1 THEN value END AS oz,
         CAST(NULL AS DOUBLE) AS pm10 FROM e WHERE user_id % 31 <> 0
  UNION ALL SELECT body, -1, seen, 'current', 15, user_id, CAST(user_id % 80 AS DOUBLE), date_trunc('second', ts), NULL, NULL, value FROM e WHERE user_id % 31 <> 0 AND user_id % 3 = 0 AND pos = n - 1),
u AS (SELECT *, CASE WHEN user_id % 2 = 0 THEN CAST(timezone('America/New_York', CAST(loc AS TIMESTAMP)) AT TIME ZONE 'UTC' AS TIMESTAMP) ELSE CAST(loc AS TIMESTAMP) END AS s FROM i),
r AS (SELECT *, {_NEW.format(k='rt, lat, s')} FROM u)
SELECT rt AS record_type, CAST(freq AS INTEGER) AS record_frequency_min, lat AS latitude, s AS open_meteo_start_time, s + freq * INTERVAL 1 MINUTE AS open_meteo_end_time, pm2 AS pm2_5,
       CASE WHEN rt = 'forecast' THEN 'ug' END AS pm2_5_unit, oz AS ozone, pm10, CASE WHEN rt = 'current' THEN 'mg' END AS pm10_unit, seen AS ingested_at_dtz,
       CASE WHEN times > 1 THEN seen END AS last_updated_at_dtz, CAST(NULL AS BIGINT) AS rejected_body, CAST(NULL AS INTEGER) AS pos, CAST(NULL AS VARCHAR) AS error
FROM r WHERE rn = 1 UNION ALL {_CUT.format(none=', '.join(['NULL'] * 12))}""",
}
