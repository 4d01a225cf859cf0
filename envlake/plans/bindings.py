"""Registered queries: every operator family bound to the driver tables.

Each function takes (spark, sf_dir) and returns a DataFrame over the whole tables.
Run literals (``as_of`` and batch cut-offs) are single global aggregates read once.
Those that show stored state (``upsert_*``, ``scd2_*``, ``ingest_*``,
``openaq_load``, ``stream_replay``) run their batches while they are built; all
others are lazy. The equivalent DuckDB SQL for each query lives in
:mod:`envlake.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.functions import (as_bool, canonical_name, float_or_null, great_circle_km, iso_z,
                               join_nonempty, local_to_utc, normalize_measurement, nws_gridpoint_name,
                               open_meteo_event_id, parse_utc, snake_case, strict_float)
from envlake.functions.clean import Rule, adjusted_aqi, aqi_flags, aqi_repair, is_valid, quality_status, range_clean
from envlake.functions.ids import airnow_event_id, nws_event_id
from envlake.operators import quality as Q
from envlake.operators.dedupe import first_per_key
from envlake.operators.geo import link_or_create, nearest_geo
from envlake.operators.nearest_time import nearest_in_time
from envlake.operators.scd2 import scd2_step
from envlake.operators.upsert import ORDER_COL, upsert_by_key
from envlake.operators.validate import EventSpec, validate
from envlake.plans import body_bindings, driver_tables as D
from envlake.plans import ingest_bindings, openaq_bindings, suite_bindings
from envlake.plans import marts as M
from envlake.sources.nws import periods_to_events
from envlake.sources.openaq import sensor_map
from envlake.session import stored
from envlake.sources.publish import to_messages

T = D.table


def _days(n: int):
    return F.make_dt_interval(F.lit(n))


# ------------------------------------------------------------------ O1, G1
def _latest(spark: SparkSession, d: str, now: dt.datetime) -> DataFrame:
    since = now - dt.timedelta(days=1)   # the mart's recency, on the raw column
    return M.latest_by_location(D.measurements(spark, d, since), D.locations(spark, d), D.sensors(spark, d, since),
                                D.bridge(spark, d), D.licenses(spark, d), now, event_type=D.LATEST_TYPE)


def latest_by_location(spark: SparkSession, d: str) -> DataFrame:
    return _latest(spark, d, D.events_as_of(spark, d))


PIVOT_PARAMS = {"click": "latest_click", "view": "latest_view", "purchase": "latest_purchase"}


def latest_pivot(spark, d):
    now = D.events_as_of(spark, d)
    return M.openaq_recent_pivot(_latest(spark, d, now), now, params=PIVOT_PARAMS)


# ------------------------------------------------------------------ O2, O3
def _om_rows(spark, d, event_type: str, record_type: str) -> DataFrame:
    """events of one type -> Open-Meteo-shaped rows located at the user's region; the
    windows of one start end after one or two hours."""
    ev = T(spark, d, "events").where(F.col("event_type") == event_type)
    c = T(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = T(spark, d, "nation").select("n_nationkey", "n_regionkey")
    loc = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
        F.col("c_custkey").alias("user_id"), F.col("n_regionkey").cast("double").alias("latitude"),
        F.lit(0.0).alias("longitude"))
    start = F.date_trunc("hour", F.col("ts"))
    return ev.join(loc, "user_id").select(
        F.concat(F.lit(f"{event_type}:"), F.col("event_id").cast("string")).alias("event_id"),
        F.lit(record_type).alias("record_type"), start.alias("open_meteo_start_time"),
        (start + F.make_dt_interval(F.lit(0), F.col("event_id") % 2 + 1)).alias("open_meteo_end_time"), "latitude", "longitude",
        F.col("ts").alias("ingested_at_dtz"), F.col("value").alias("temperature"),
        F.lit("C").alias("temperature_unit"), F.col("value").alias("pm2_5"), F.lit("ug/m3").alias("pm2_5_unit"))


def current_snapshot(spark, d):
    """One place, as in the original: the latest row of either side."""
    w, a = (_om_rows(spark, d, k, "current").where("latitude = 0") for k in ("view", "click"))
    return M.current_conditions(w, a, wcols=["temperature", "temperature_unit"], acols=["pm2_5", "pm2_5_unit"])


def current_by_location(spark, d):
    w, a = _om_rows(spark, d, "view", "current"), _om_rows(spark, d, "click", "current")
    return M.current_conditions(w, a, per_location=True, wcols=["temperature", "temperature_unit"],
                                acols=["pm2_5", "pm2_5_unit"])


def latest_forecast(spark, d):
    w, a = _om_rows(spark, d, "view", "forecast"), _om_rows(spark, d, "click", "forecast")
    return M.latest_forecast(w, a, wcols=["temperature", "temperature_unit"], acols=["pm2_5", "pm2_5_unit"])


# ----------------------------------------------------------------------- H2
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def distinct_on_first(spark, d):
    o = T(spark, d, "orders")
    return first_per_key(o, ["o_custkey", "o_orderpriority"],
                         [("o_orderdate", "asc_nulls_last"), ("o_orderkey", "asc_nulls_last")], keep="first")


def distinct_on_last(spark, d):
    o = T(spark, d, "orders")
    return first_per_key(o, ["o_custkey", "o_orderpriority"],
                         [("o_orderdate", "asc_nulls_last"), ("o_orderkey", "asc_nulls_last")], keep="last")


# ----------------------------------------------------------------------- O4
def _stg_airnow_from_orders(spark, d, today: dt.date) -> DataFrame:
    """orders -> forecasts for today, tomorrow and the day after at the customer's place;
    every seventh is no longer current."""
    o = T(spark, d, "orders")
    cat = F.substring("o_orderpriority", 1, 1).cast("int")
    a = o.select(
        F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("event_id"), F.col("o_custkey").alias("location_id"),
        (F.lit(today).cast("timestamp") + F.make_dt_interval((F.col("o_orderkey") % 3).cast("int"))).alias("date_forecast_dtz"),
        F.col("o_orderstatus").alias("parameter_name"),
        (F.floor(F.col("o_totalprice") / F.lit(800.0)).cast("int") - F.lit(25)).alias("aqi"),
        cat.alias("category_number"), F.col("o_orderpriority").alias("category_name"),
        (F.col("o_orderstatus") == "F").alias("action_day"), F.col("o_orderpriority").alias("discussion"),
        (F.col("o_orderkey") % 7 != 0).alias("is_current"))
    from envlake.plans.staging import stg_airnow_air_quality_forecast
    return stg_airnow_air_quality_forecast(a)


def _stg_weather_from_events(spark, d, now: dt.datetime) -> DataFrame:
    """events -> hourly forecasts of the next 60 hours at the user's place (some in the past)."""
    from envlake.plans.staging import stg_weather_hourly_forecast
    ev = T(spark, d, "events")
    st = F.lit(now).cast("timestamp") + F.make_dt_interval(F.lit(0), (F.col("event_id") % 64 - 4).cast("int"))
    w = ev.select(
        F.concat(F.lit("wx:"), F.col("event_id").cast("string")).alias("event_id"), F.col("user_id").alias("location_id"),
        F.lit("nws.hourly_forecast").alias("event_type"), st.alias("start_time"),
        (st + F.expr("INTERVAL 1 HOUR")).alias("end_time"),
        (F.col("value") * 2 - 60).alias("temperature"), F.lit("wmoUnit:degC").alias("temperature_unit"),
        F.col("event_type").alias("temperature_trend"), F.col("value").alias("relative_humidity"),
        F.lit("wmoUnit:percent").alias("relative_humidity_unit"), (F.col("value") / 2).alias("dewpoint"),
        F.lit("wmoUnit:degC").alias("dewpoint_unit"), (F.col("value") * 4).alias("wind_speed"),
        F.lit("wmoUnit:km_h-1").alias("wind_speed_unit"), F.lit("NW").alias("wind_direction"),
        (F.col("value") * 5).alias("wind_gust"), F.lit("wmoUnit:km_h-1").alias("wind_gust_unit"),
        (F.col("user_id") % 101).cast("double").alias("probability_of_precipitation"),
        F.lit("wmoUnit:percent").alias("probability_of_precipitation_unit"),
        F.col("event_type").alias("short_forecast"), F.col("props").alias("detailed_forecast"))
    return stg_weather_hourly_forecast(w)


MEASURED_PARAMS = dict(zip(("click", "view", "purchase"), M.MEASURED))


def daily_hourly_join(spark, d):
    now = D.events_as_of(spark, d)
    return M.air_weather_forecast(_stg_airnow_from_orders(spark, d, now.date()), _stg_weather_from_events(spark, d, now),
                                  _latest(spark, d, now), now, params=MEASURED_PARAMS)


# ------------------------------------------------------------------ F9 / O5
def nearest_time_global(spark, d):
    ev = T(spark, d, "events")
    views = ev.where(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    purchases = ev.where(F.col("event_type") == "purchase")
    out = M.bike_forecast(views, purchases, ts_col="ts", meas_ts="ts", meas_cols=("value",))
    return out.withColumn("time_diff_seconds", F.round("time_diff_seconds", 6))


def nearest_time_per_key(spark, d):
    ev = T(spark, d, "events")
    views = ev.where(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    purchases = ev.where(F.col("event_type") == "purchase")
    out = nearest_in_time(views, purchases, ["user_id"], "ts", "ts", ["event_id", "value"],
                          right_tiebreak="event_id")
    return out.withColumn("diff_seconds", F.round("diff_seconds", 6))


# ------------------------------------------------------------------ I1-I5
# Fixed values of this binding: line-item plausibility rules.
LINEITEM_RULES = (Rule("l_quantity", 1, 45, "quantity_out_of_range", "quantity_clean"),
                  Rule("l_discount", 0, 0.08, "discount_out_of_range", "discount_clean"),
                  Rule("l_tax", 0, 0.06, "tax_out_of_range", "tax_clean"))


def range_clean_flags(spark, d):
    li = T(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     *[(range_clean(r.column, r.low, r.high) + F.lit(0.0)).alias(r.clean_name)
                       for r in LINEITEM_RULES],
                     quality_status(LINEITEM_RULES).alias("quality_status"),
                     is_valid(LINEITEM_RULES).alias("is_valid"))


def category_repair(spark, d):
    p = T(spark, d, "part")
    base = p.select("p_partkey", (F.col("p_size") * 12 - 50).alias("aqi"),
                    (F.regexp_extract("p_brand", r"#(\d+)", 1).cast("int") % 7).alias("category_number"))
    c = base.withColumn("aqi_clean", aqi_repair("aqi", "category_number"))
    st, ok = aqi_flags("aqi_clean")
    return c.select("p_partkey", "aqi", "category_number", "aqi_clean", st.alias("quality_status"),
                    ok.alias("is_valid"), adjusted_aqi("aqi_clean", "category_number").alias("adjusted_aqi"),
                    adjusted_aqi(F.lit(-1), "category_number").alias("adjusted_minus_one"))


# ------------------------------------------------------------- I7, J6-J8
def measurement_normalize(spark, d):
    ev = T(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    raw = (F.when(F.col("event_id") % 7 == 0, (-F.col("value")).cast("string"))
           .when(F.col("event_id") % 11 == 0, F.lit("n/a"))
           .when(F.col("event_id") % 13 == 0, F.lit(None).cast("string"))
           .otherwise(k))
    e = ev.select("event_id", raw.alias("raw"), k.alias("k"))
    v, ok, st = normalize_measurement("raw")
    return e.select("event_id", v.alias("value_normalized"), ok.alias("is_valid"), st.alias("quality_status"),
                    as_bool(F.col("k")).alias("k_flag"), float_or_null("raw").alias("lenient_value"),
                    strict_float("raw", zero_is_null=True).alias("strict_value"))


# ---------------------------------------------------------------- J1, J3, J4
def time_parse_mixed(spark, d):
    ev = T(spark, d, "events")
    ts = F.col("ts")
    m = F.col("event_id") % 5
    s = (F.when(m == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
         .when(m == 1, F.concat(F.date_format(ts + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"),
                                F.lit("+02:00")))
         .when(m == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
         .when(m == 3, F.date_format(ts, "yyyy-MM-dd"))
         .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")))
    zone = (F.when(F.col("user_id") % 3 == 0, F.lit("UTC"))
            .when(F.col("user_id") % 3 == 1, F.lit("America/Chicago")).otherwise(F.lit("Europe/Berlin")))
    e = ev.select("event_id", s.alias("s"), zone.alias("zone"),
                  F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("local_text"))
    parsed, err = parse_utc("s", e.schema["s"].dataType)
    return e.select("event_id", "s", parsed.alias("parsed_utc"), err.alias("parse_error"),
                    iso_z(parsed).alias("iso"), local_to_utc("local_text", "zone").alias("local_utc"))


# ---------------------------------------------------------------- J9-J13
def event_ids(spark, d):
    ev = T(spark, d, "events")
    c = T(spark, d, "customer")
    n = T(spark, d, "nation")
    j = ev.join(c, ev["user_id"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
    hour = F.date_trunc("hour", F.col("ts"))
    camel = F.concat(F.col("event_type"), F.initcap("c_mktsegment"))
    return j.select(
        "event_id",
        open_meteo_event_id("weather", "forecast", D.customer_lat(), D.customer_lon(), hour).alias("om_id"),
        airnow_event_id(F.concat_ws(" ", "n_name", "c_mktsegment"), F.to_date("ts").cast("string"),
                        F.date_add(F.to_date("ts"), 1).cast("string")).alias("airnow_id"),
        nws_event_id("n_name", "c_nationkey", F.col("user_id") % 100, iso_z(hour),
                     iso_z(hour + F.expr("INTERVAL 1 HOUR"))).alias("nws_id"),
        snake_case(camel).alias("snake"),
        join_nonempty(F.col("c_name"), F.lit("  "), F.col("n_name")).alias("joined"),
        canonical_name(F.col("c_name"), F.lit(""), F.when(F.col("c_nationkey") % 2 == 0, F.col("n_name")),
                       F.col("c_nationkey").cast("string"), F.col("c_custkey")).alias("canonical"),
        nws_gridpoint_name("n_name", "c_nationkey", F.col("user_id") % 100).alias("grid_name"))


# ------------------------------------------------------------------ C5-C8
def parallel_arrays(spark, d):
    from envlake.sources.open_meteo import zip_by_position
    e = T(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("a"),
                                         F.slice("embedding", 1, 40).alias("b"))
    return zip_by_position(e, "a", {"a": "v1", "b": "v2"}, keep_cols=("vec_id",)) \
        .select("vec_id", "pos", F.col("v1").cast("double").alias("v1"), F.col("v2").cast("double").alias("v2"))


# ------------------------------------------------------- C3, C4, C14-C17
def flatten_quantities(spark, d):
    p = T(spark, d, "part")
    start = F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.lit(0), F.col("p_partkey") % 1000)
    q = lambda v, lo, hi, u: F.struct(v.cast("double").alias("value"), lo.cast("double").alias("minValue"),  # noqa
                                      hi.cast("double").alias("maxValue"), F.lit(u).alias("unitCode"))
    period = F.struct(
        iso_z(start).alias("startTime"), iso_z(start + F.expr("INTERVAL 1 HOUR")).alias("endTime"),
        (F.col("p_size") % 2 == 0).alias("isDaytime"), F.col("p_type").alias("temperatureTrend"),
        F.lit("N").alias("windDirection"), F.col("p_name").alias("shortForecast"),
        F.col("p_brand").alias("detailedForecast"),
        q(F.col("p_size"), F.col("p_size") - 1, F.lit(None), "wmoUnit:degC").alias("temperature"),
        q(F.col("p_partkey") % 100, F.lit(None), F.lit(None), "wmoUnit:percent").alias("probabilityOfPrecipitation"),
        F.when(F.col("p_size") % 3 != 0, q(F.col("p_size") * 2, F.lit(0), F.lit(100), "wmoUnit:percent"))
        .alias("relativeHumidity"),
        F.lit(None).alias("dewpoint"),
        q(F.col("p_size") % 7, F.lit(0), F.col("p_size") % 7 + 2, "wmoUnit:km_h-1").alias("windSpeed"),
        F.lit(None).alias("windGust"))
    raw = F.to_json(F.struct(F.struct(F.array(period).alias("periods")).alias("properties")))
    meta = F.struct(F.col("p_brand").alias("grid_id"), (F.col("p_partkey") % 50).cast("int").alias("grid_x"),
                    F.col("p_size").alias("grid_y"), F.lit("office").alias("office"))
    src = p.select("p_partkey", raw.alias("raw"), meta.alias("meta"),
                   F.lit(dt.datetime(2024, 1, 1, 12, 0, 0)).alias("ingest_dt"))
    ev = periods_to_events(src, keep_cols=("p_partkey",))
    return ev.select("p_partkey", "event_id", "start_time", "temperature", "temperature_min", "temperature_max",
                     "temperature_unit", "probability_of_precipitation", "relative_humidity",
                     "relative_humidity_max", "dewpoint", "wind_speed", "wind_speed_max", "wind_speed_unit",
                     "wind_gust", "is_daytime", "ingested_at")


# ---------------------------------------------------------------- C10, G5
def sensor_map_dedupe(spark, d):
    li = T(spark, d, "lineitem")
    return sensor_map(li, "l_orderkey", "l_returnflag", "l_linenumber", ["l_partkey", "l_quantity"],
                      tiebreak=["l_partkey", "l_quantity"])


# -------------------------------------------------------------- C13, H4, H5
def nearest_top1(spark, d):
    """Every nation asks for its nearest supplier; some distances are absent."""
    from envlake.sources.openaq import nearest_location
    s = T(spark, d, "supplier")
    n = T(spark, d, "nation")
    dist = F.when(F.col("s_suppkey") % 5 != 0, F.abs(F.col("s_acctbal") - F.col("n_nationkey") * F.lit(400.0)))
    cand = n.join(s, n["n_nationkey"] == s["s_nationkey"]).select("n_nationkey", F.col("s_suppkey").alias("id"), dist.alias("distance"))
    return nearest_location(cand, "n_nationkey").withColumnRenamed("id", "s_suppkey")


# ------------------------------------------------ D1-D4, A2, B4, C2, C22, E11
def _messages(spark, d) -> DataFrame:
    """Event messages, some of them faulty: absent, wrongly typed and null fields,
    text that is cut short or goes on after its end, and JSON that is no object."""
    ev = T(spark, d, "events")
    eid = F.col("event_id")
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    area = (F.when(eid % 89 == 0, F.lit("")).when(eid % 79 == 0, F.lit(', "reporting_area": 7'))
            .when(eid % 73 == 0, F.lit(', "reporting_area": null')).when(eid % 71 == 0, F.lit(', "reporting_area": ["u"]'))
            .otherwise(F.concat(F.lit(', "reporting_area": "u'), F.col("user_id").cast("string"), F.lit('"'))))
    whole = F.floor("value").cast("string")
    aqi = (F.when(eid % 83 == 0, F.lit('"abc"')).when(eid % 67 == 0, F.concat(whole, F.lit(".5")))
           .when(eid % 61 == 0, text(whole)).otherwise(whole))
    day = F.when(eid % 59 == 0, F.lit("2")).when(eid % 7 == 0, F.lit('"Yes"')).when(eid % 5 == 0, F.lit("0")).otherwise(F.lit("true"))
    raw = F.when(eid % 53 == 0, F.lit('"text"')).otherwise(F.lit('{"a":1}'))
    good = F.concat(F.lit('{"event_id": "e'), eid.cast("string"), F.lit('", "source": "events"'), area,
                    F.lit(', "aqi": '), aqi, F.lit(', "category_number": '), (F.col("user_id") % 6 + 1).cast("string"),
                    F.lit(', "action_day": '), day, F.lit(', "raw_data": '), raw, F.lit(', "extra": 1}'))
    value = (F.when(eid % 97 == 0, F.lit("not json {")).when(eid % 101 == 0, F.concat(good, F.lit(" x")))
             .when(eid % 103 == 0, F.substring(good, 1, 30)).when(eid % 107 == 0, F.lit("5"))
             .when(eid % 109 == 0, F.lit('["e"]')).otherwise(good))
    return ev.select(F.col("event_id").alias("offset"), F.lit("events.airnow").alias("topic"),
                     F.col("user_id").cast("string").alias("key"), (F.col("user_id") % 4).cast("int").alias("partition"),
                     value.alias("value"))


MESSAGE_SPEC = EventSpec("events_airnow", {"event_id": "string", "source": "string", "reporting_area": "string",
                                           "aqi": "int", "category_number": "int", "action_day": "boolean",
                                           "raw_data": "object"},
                         required=("event_id", "source", "reporting_area"))
MESSAGE_KEEP = ("offset", "topic", "key", "partition")


def validate_split(spark, d):
    return validate(_messages(spark, d), MESSAGE_SPEC, keep_cols=("offset",)).valid


def malformed_messages(spark, d):
    """What is no JSON at all is counted and skipped: the messages, for comparison."""
    return validate(_messages(spark, d), MESSAGE_SPEC, keep_cols=("offset",)).malformed.drop("error")


def dead_letters(spark, d):
    from envlake.streaming.dlq import dead_letter_records
    rejected = validate(_messages(spark, d), MESSAGE_SPEC, keep_cols=MESSAGE_KEEP).rejected
    return dead_letter_records(rejected, batch_ts=F.lit(dt.datetime(2024, 1, 1)))


def dead_letter_topic(spark, d):
    """Dead letters as messages of the ``.dlq`` topic."""
    from envlake.streaming.dlq import dead_letter_messages
    return dead_letter_messages(dead_letters(spark, d))


# ----------------------------------------------------------------- B1-B3, H7
def publish_payload(spark, d):
    n = T(spark, d, "nation")
    r = T(spark, d, "region")
    c = T(spark, d, "customer")
    a = to_messages(n, key_col="n_nationkey", value_cols=["n_nationkey", "n_name", "n_regionkey"], topic="nation")
    b = to_messages(r, key_col=None, value_cols=["r_regionkey", "r_name"], topic="region")
    cc = to_messages(c, key_col="c_custkey", value_cols=["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
                     topic="customer")
    return a.unionByName(b).unionByName(cc)


# ------------------------------------------------------- K1-K5, K12, F12
def _batches(ev: DataFrame, lo: dt.datetime):
    c1, c2 = lo + dt.timedelta(days=10), lo + dt.timedelta(days=20)
    return [ev.where(F.col("ts") < F.lit(c1)),
            ev.where((F.col("ts") >= F.lit(c1)) & (F.col("ts") < F.lit(c2))),
            ev.where(F.col("ts") >= F.lit(c2))]


def _events_lo(spark, d) -> dt.datetime:
    m = D.scalar(T(spark, d, "events").agg(F.min("ts")))
    return dt.datetime(m.year, m.month, m.day)


def upsert_last_wins(spark, d):
    ev = T(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value")
    base = None
    for b in _batches(ev, _events_lo(spark, d)):
        b = b.withColumn("first_ts", F.col("ts"))
        base = upsert_by_key(base, b, ["user_id", "event_type"], ["ts", "event_id"],
                             policy={"first_ts": "keep"}, columns=["event_id", "ts", "value", "first_ts"])
        base = stored(base)      # each merged batch is a stored table
    return base.drop(ORDER_COL)


def upsert_coalesce(spark, d):
    ev = T(spark, d, "events").select(
        "user_id", "event_type", "event_id", "ts",
        F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("value"))
    base = None
    for b in _batches(ev, _events_lo(spark, d)):
        b = b.withColumn("last_updated_at_dtz", F.col("ts"))
        base = upsert_by_key(base, b, ["user_id", "event_type"], ["ts", "event_id"],
                             policy={"value": "coalesce", "last_updated_at_dtz": "touch"},
                             clock_col="ts", columns=["event_id", "value", "last_updated_at_dtz"])
        base = stored(base)
    return base.drop(ORDER_COL)


# ------------------------------------------------------------------ K6-K11
def _order_batches(o: DataFrame, lo: dt.datetime, hi: dt.datetime):
    span = (hi - lo) / 3
    c1, c2 = lo + span, lo + 2 * span
    return [o.where(F.col("o_orderdate") < F.lit(c1)),
            o.where((F.col("o_orderdate") >= F.lit(c1)) & (F.col("o_orderdate") < F.lit(c2))),
            o.where(F.col("o_orderdate") >= F.lit(c2))]


def _scd2(spark, d, key, tracked, batches=None):
    """Batches applied one after another, as a store would: the current rows are
    rewritten by each step, closed versions are only appended."""
    o = T(spark, d, "orders")
    lo, hi = o.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    parts = _order_batches(o, lo, hi)
    current, closed = None, []
    for i in batches or range(len(parts)):
        step = scd2_step(current, parts[i], key, tracked, ["o_orderdate", "o_orderkey"], "o_orderdate", "sk", "orders_dim",
                         touch_cols=["last_updated_at_dtz"], extra_cols=["o_orderkey"])
        step = stored(step)
        current = step.where("is_current")
        closed.append(step.where("not is_current"))
    return reduce(DataFrame.unionByName, closed, current).drop("sk", "_order")


def scd2_dimension(spark, d):
    return _scd2(spark, d, ["o_custkey"], ["o_orderstatus", "o_orderpriority"])


def scd2_bridge(spark, d):
    return _scd2(spark, d, ["o_custkey", "o_orderpriority"], ["o_orderstatus"])


def scd2_replay(spark, d):
    """The second batch is delivered twice and the first again at the end: the
    dimension is that of the feed applied once."""
    return _scd2(spark, d, ["o_custkey"], ["o_orderstatus", "o_orderpriority"], batches=(0, 1, 1, 2, 0))


def scd2_cascade(spark, d):
    """Sensor-like child dimension whose tracked attribute is the parent (customer
    status) version current at each event: a parent re-version opens new child
    versions. Parent and child are stored and take the feed in three batches."""
    from envlake.operators.scd2 import versions_and_step
    from envlake.session import side_by_side
    o = T(spark, d, "orders")
    lo, hi = o.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    order = ["o_orderdate", "o_orderkey"]
    parent = child = None
    closed = []
    for b in _order_batches(o, lo, hi):
        b = b.select("o_custkey", "o_orderstatus", "o_orderpriority", *order)
        at, parents = versions_and_step(parent, b, ["o_custkey"], ["o_orderstatus"], order, "o_orderdate", "sk", "parent_dim",
                                        current_version=("effective_start_at_dtz", "o_orderkey"), extra_cols=["o_orderkey"])
        at = at.select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey",
                       F.col("version_order.o_orderkey").alias("location_version"))
        step = scd2_step(child, at, ["o_custkey", "o_orderpriority"], ["location_version"], order, "o_orderdate", "sk",
                         "child_dim", extra_cols=["o_orderkey"])
        step, parents = side_by_side([lambda x=x: stored(x) for x in (step, parents)])
        child, parent = step.where("is_current"), parents.where("is_current")
        closed.append(step.where("not is_current"))
    return reduce(DataFrame.unionByName, closed, child).drop("sk", "_order")


# ------------------------------------------------------------- L1-L3, K13, E8
def _customers_xy(spark, d):
    return T(spark, d, "customer").select("c_custkey", D.customer_lat().alias("latitude"),
                                          D.customer_lon().alias("longitude"))


def _suppliers_xy(spark, d):
    return T(spark, d, "supplier").select("s_suppkey", D.supplier_lat().alias("latitude"),
                                          D.supplier_lon().alias("longitude"))


def haversine_pairs(spark, d):
    c = T(spark, d, "customer")
    n = T(spark, d, "nation").select("n_nationkey", (F.lit(40.0) + F.col("n_nationkey") * F.lit(0.02)).alias("nlat"),
                                     (F.lit(-90.0) + F.col("n_nationkey") * F.lit(0.02)).alias("nlon"))
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    return j.select("c_custkey", "n_nationkey", F.round(great_circle_km(
        D.customer_lat(), D.customer_lon(), F.col("nlat"), F.col("nlon")), 6).alias("distance_km"))


def nearest_geo_q(spark, d):
    m = nearest_geo(_customers_xy(spark, d), _suppliers_xy(spark, d), "c_custkey", "s_suppkey")
    return m.select("c_custkey", "match_id", F.round("distance_km", 6).alias("distance_km"))


def geo_link(spark, d):
    """Every fifth customer is linked already and keeps its point; the others come in the
    order of their key, and a created point is told by the customer that it was created for."""
    c = _customers_xy(spark, d)
    linked = c.where("c_custkey % 5 = 0").select("c_custkey", (-F.col("c_custkey")).alias("s_suppkey"))
    links, _ = link_or_create(c, _suppliers_xy(spark, d), "c_custkey", "s_suppkey", linked=linked)
    by = links.where("created").select(F.col("s_suppkey").alias("point"), F.col("c_custkey").alias("created_by"))
    j = links.join(by, links["s_suppkey"] == by["point"], "left")
    return j.select("c_custkey", F.when(F.col("created_by").isNull(), F.col("s_suppkey")).alias("linked_id"), "created_by", "created")


def geo_new_points(spark, d):
    """The points created when customers come in the order of their key."""
    _, new_points = link_or_create(_customers_xy(spark, d), _suppliers_xy(spark, d), "c_custkey", "s_suppkey")
    return new_points.select("latitude", "longitude")


def forecast_by_geo(spark, d):
    """The forecast mart over linked places: the three sides' locations are customers, and those
    within a kilometre share a supplier's place or one created for them (Q9, L3)."""
    now = D.events_as_of(spark, d)
    links, _ = link_or_create(_customers_xy(spark, d), _suppliers_xy(spark, d), "c_custkey", "s_suppkey", max_km=1.0)
    links = stored(links.select("c_custkey", "s_suppkey"), "links")
    return M.air_weather_forecast(_stg_airnow_from_orders(spark, d, now.date()), _stg_weather_from_events(spark, d, now),
                                  _latest(spark, d, now), now, params=MEASURED_PARAMS, links=[links] * 3)


# --------------------------------------------------------- O8, E8, E9, F10
def window_read(spark, d):
    lo = _events_lo(spark, d)
    ev = T(spark, d, "events")
    cxy = _customers_xy(spark, d).withColumnRenamed("c_custkey", "user_id")

    def rows(kind, valname):
        e = ev.where(F.col("event_type") == kind).join(cxy, "user_id")
        st = F.date_trunc("hour", F.col("ts"))
        return e.select(F.col("event_id").alias("wx_event_id") if kind == "view" else F.col("event_id").alias(
            "air_event_id"), st.alias("open_meteo_start_time"),
            (st + F.expr("INTERVAL 1 HOUR")).alias("open_meteo_end_time"), F.lit("forecast").alias("record_type"),
            "latitude", "longitude", F.col("value").alias(valname))
    w, a = rows("view", "temperature"), rows("click", "pm2_5")
    return M.window_read(w, a, 40.25, -89.75, lo, hours_ahead=24 * 31, tolerance=0.1,
                         air_order=("air_event_id",), wcols=["wx_event_id", "temperature"],
                         acols=["air_event_id", "pm2_5"])


# ---------------------------------------------------------------- M1-M9, B8
LINEITEM_CHECKS = [Q.Check("not_null", "l_orderkey"), Q.Check("between", "l_quantity", 1, 45, mostly=0.9),
                   Q.Check("between", "l_discount", 0, 0.08, mostly=0.99),
                   Q.Check("in_set", "l_returnflag", values=("A", "N")),
                   Q.Check("not_null", "l_shipdate")]
CUSTOMER_CHECKS = [Q.Check("between", "c_acctbal", 0, None, mostly=0.9),
                   Q.Check("in_set", "c_mktsegment", values=("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY",
                                                             "HOUSEHOLD")),
                   Q.Check("not_null", "c_name")]
EVENTS_CHECKS = [Q.Check("between", "value", 0, None), Q.Check("not_null", "props"),
                 Q.Check("accepted_values", "event_type", values=("click", "view", "purchase", "signup"),
                         mostly=0.7)]


def quality_suite(spark, d):
    return (Q.run_suite(T(spark, d, "lineitem"), "lineitem", LINEITEM_CHECKS)
            .unionByName(Q.run_suite(T(spark, d, "customer"), "customer", CUSTOMER_CHECKS))
            .unionByName(Q.run_suite(T(spark, d, "events"), "events", EVENTS_CHECKS)))


def unique_check(spark, d):
    return Q.unique_violations(T(spark, d, "orders"), ["o_custkey", "o_orderdate"])


def accepted_range_q(spark, d):
    c = T(spark, d, "customer")
    return Q.accepted_range(c, "c_acctbal", min_value=0).select("c_custkey", "c_acctbal")


def accepted_range_both(spark, d):
    li = T(spark, d, "lineitem")
    return Q.accepted_range(li, "l_quantity", 5, 45).select("l_orderkey", "l_linenumber", "l_quantity")


def model_checks(spark, d):
    """The declared checks on every staging view and mart bound here."""
    from envlake.plans.staging import stg_openaq_measurements
    now = D.events_as_of(spark, d)
    bound = {
        "stg_openaq_measurements_by_location": stg_openaq_measurements(D.measurements(spark, d).drop("value_clean")),
        "stg_weather_hourly_forecast": _stg_weather_from_events(spark, d, now),
        "stg_airnow_air_quality_forecast": _stg_airnow_from_orders(spark, d, now.date()),
        "fct_openaq_latest_by_location": _latest(spark, d, now),
        "fct_open_meteo_current_weather_air_conditions": current_by_location(spark, d),
        "fct_open_meteo_latest_weather_air_forecast": latest_forecast(spark, d),
        "fct_air_weather_forecast": daily_hourly_join(spark, d)}
    return reduce(DataFrame.unionByName, [Q.model_checks(n, df) for n, df in bound.items()])


def volume_anomaly(spark, d):
    return Q.volume_anomalies(T(spark, d, "events"), "ts")


# ---------------------------------------------------------------------- B10
def backfill_flags(spark, d):
    from envlake.plans.maintenance import backfill_quality
    ev = T(spark, d, "events")
    eid = F.col("event_id")
    t = ev.select("event_id",
                  F.when(eid % 10 == 0, F.lit(None).cast("double"))
                  .when(eid % 7 == 0, -F.col("value")).otherwise(F.col("value")).alias("value"),
                  F.when(eid % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("value_normalized"),
                  F.when(eid % 4 == 0, F.lit(None).cast("boolean")).otherwise(F.lit(True)).alias("is_valid"),
                  F.when(eid % 2 == 0, F.lit("legacy")).alias("quality_status"))
    return backfill_quality(t)


# ----------------------------------------------------------- A1, B5, N1-N6
def stream_replay(spark, d):
    from envlake.streaming.replay import replay_events_as_stream
    return replay_events_as_stream(spark, T(spark, d, "events"))


def mart_refresh(spark, d):
    """Two marts refreshed together, then a refresh that leaves one empty, which is refused:
    what readers see of each afterwards."""
    from envlake.plans.maintenance import publish_marts, read_mart
    from envlake.streaming.ingest import scratch_dir
    path = scratch_dir(spark, "marts")
    marts = {"latest_by_location": latest_by_location(spark, d), "current_by_location": current_by_location(spark, d)}
    publish_marts(spark, path, marts)
    refused = False
    try:
        publish_marts(spark, path, {"latest_by_location": marts["latest_by_location"].limit(1), "current_by_location": marts["current_by_location"].where("false")})
    except RuntimeError:
        refused = True
    one = [read_mart(spark, path, n).agg(F.count("*").alias("live_rows")).select(F.lit(n).alias("mart"), "live_rows", F.lit(refused).alias("refused")) for n in marts]
    return one[0].unionByName(one[1])


QUERIES = {
    "latest_by_location": latest_by_location,
    "latest_pivot": latest_pivot,
    "current_snapshot": current_snapshot,
    "current_by_location": current_by_location,
    "latest_forecast": latest_forecast,
    "distinct_on_first": distinct_on_first,
    "distinct_on_last": distinct_on_last,
    "daily_hourly_join": daily_hourly_join,
    "nearest_time_global": nearest_time_global,
    "nearest_time_per_key": nearest_time_per_key,
    "range_clean_flags": range_clean_flags,
    "category_repair": category_repair,
    "measurement_normalize": measurement_normalize,
    "time_parse_mixed": time_parse_mixed,
    "event_ids": event_ids,
    "parallel_arrays": parallel_arrays,
    "flatten_quantities": flatten_quantities,
    "sensor_map_dedupe": sensor_map_dedupe,
    "nearest_top1": nearest_top1,
    "validate_split": validate_split,
    "malformed_messages": malformed_messages,
    "dead_letters": dead_letters,
    "dead_letter_topic": dead_letter_topic,
    "publish_payload": publish_payload,
    "upsert_last_wins": upsert_last_wins,
    "upsert_coalesce": upsert_coalesce,
    "scd2_dimension": scd2_dimension,
    "scd2_bridge": scd2_bridge,
    "scd2_replay": scd2_replay,
    "scd2_cascade": scd2_cascade,
    "haversine_pairs": haversine_pairs,
    "nearest_geo": nearest_geo_q,
    "geo_link": geo_link,
    "geo_new_points": geo_new_points,
    "forecast_by_geo": forecast_by_geo,
    "window_read": window_read,
    "mart_refresh": mart_refresh,
    "quality_suite": quality_suite,
    "unique_check": unique_check,
    "accepted_range": accepted_range_q,
    "accepted_range_both": accepted_range_both,
    "model_checks": model_checks,
    "volume_anomaly": volume_anomaly,
    "backfill_flags": backfill_flags,
    "stream_replay": stream_replay,
    **ingest_bindings.QUERIES,
    **suite_bindings.QUERIES,
    **openaq_bindings.QUERIES,
    **body_bindings.QUERIES,
}
