"""NWS hourly forecast payloads -> one event per period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envlake.functions.ids import nws_event_id, snake_case_name
from envlake.functions.timefn import iso_z, parse_utc

QUANT = T.StructType([T.StructField("value", T.DoubleType()), T.StructField("minValue", T.DoubleType()),
                      T.StructField("maxValue", T.DoubleType()), T.StructField("unitCode", T.StringType())])
# Quantitative period fields flattened into four columns each.
QUANT_FIELDS = ["temperature", "probabilityOfPrecipitation", "relativeHumidity", "dewpoint", "windSpeed",
                "windGust"]
PERIOD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("startTime", "endTime")]
    + [T.StructField("isDaytime", T.BooleanType())]
    + [T.StructField(n, T.StringType()) for n in ("temperatureTrend", "windDirection", "shortForecast",
                                                  "detailedForecast")]
    + [T.StructField(n, QUANT) for n in QUANT_FIELDS])
RAW = T.StructType([T.StructField("properties", T.StructType([
    T.StructField("periods", T.ArrayType(PERIOD))]))])
META = T.StructType([T.StructField("grid_id", T.StringType()), T.StructField("grid_x", T.IntegerType()),
                     T.StructField("grid_y", T.IntegerType()), T.StructField("office", T.StringType())])


def flatten_quantity(struct_col: str, name: str) -> list:
    """``{value,minValue,maxValue,unitCode}`` -> ``<snake>``, ``_min``, ``_max``,
    ``_unit`` (NULL struct -> NULLs)."""
    b = snake_case_name(name)
    return [F.col(f"{struct_col}.value").alias(b), F.col(f"{struct_col}.minValue").alias(f"{b}_min"),
            F.col(f"{struct_col}.maxValue").alias(f"{b}_max"), F.col(f"{struct_col}.unitCode").alias(f"{b}_unit")]


def periods_to_events(df: DataFrame, raw_col: str = "raw", meta_col: str = "meta",
                      ingest_col: str = "ingest_dt", keep_cols: tuple = (), pos_col: str | None = None) -> DataFrame:
    """``raw`` is the parsed payload struct (or JSON text), ``meta`` the grid
    struct. One output row per forecast period, with its place as ``pos_col``."""
    raw = F.from_json(F.col(raw_col), RAW) if isinstance(df.schema[raw_col].dataType, T.StringType) \
        else F.col(raw_col)
    e = df.select(*keep_cols, F.col(meta_col).alias("__m"), F.col(ingest_col).alias("__ing"),
                  F.posexplode_outer(raw.getField("properties").getField("periods")).alias("__pos", "__p")) \
        .where(F.col("__p").isNotNull())
    ing = iso_z(F.date_trunc("second", F.col("__ing")))
    cols = [
        *keep_cols, *([F.col("__pos").alias(pos_col)] if pos_col else []),
        nws_event_id("__m.grid_id", "__m.grid_x", "__m.grid_y", "__p.startTime", "__p.endTime").alias("event_id"),
        F.lit("nws.hourly_forecast").alias("event_type"), ing.alias("ingested_at"),
        F.lit("api.weather.gov").alias("source"), F.col("__m.office").alias("office"),
        F.col("__m.grid_id").alias("grid_id"), F.col("__m.grid_x").alias("grid_x"),
        F.col("__m.grid_y").alias("grid_y"), F.col("__p.startTime").alias("start_time"),
        F.col("__p.endTime").alias("end_time"), F.col("__p.isDaytime").alias("is_daytime"),
        F.col("__p.temperatureTrend").alias("temperature_trend"),
        F.col("__p.windDirection").alias("wind_direction"), F.col("__p.shortForecast").alias("short_forecast"),
        F.col("__p.detailedForecast").alias("detailed_forecast")]
    for q in QUANT_FIELDS:
        cols += flatten_quantity(f"__p.{q}", q)
    cols.append(ing.alias("ingested_at_dtz"))
    return e.select(*cols)


def event_to_record(ev: DataFrame, zero_is_null: bool = False, keep_cols: tuple = ()) -> DataFrame:
    """NWS event -> ``stg.weather_hourly_forecast`` record: times parsed to UTC,
    fallback id, numbers coerced. Adds ``error`` (first failing guard)."""
    from envlake.functions.coerce import strict_float, strict_float_error
    from envlake.functions.ids import fallback_id
    st, st_err = parse_utc("start_time", ev.schema["start_time"].dataType)
    en, en_err = parse_utc("end_time", ev.schema["end_time"].dataType)
    ing, _ = parse_utc("ingested_at_dtz", ev.schema["ingested_at_dtz"].dataType)
    nums = []
    for q in QUANT_FIELDS:
        b = snake_case_name(q)
        for c in (b, f"{b}_min", f"{b}_max"):
            nums.append(strict_float(c, ev.schema[c].dataType, zero_is_null=zero_is_null).alias(c))
        nums.append(F.col(f"{b}_unit"))
    err = (F.when(st_err, F.lit("type:start_time")).when(st.isNull(), F.lit("missing:start_time"))
           .when(en_err, F.lit("type:end_time")))
    for q in QUANT_FIELDS:
        for c in (snake_case_name(q), f"{snake_case_name(q)}_min", f"{snake_case_name(q)}_max"):
            err = err.when(strict_float_error(c, ev.schema[c].dataType), F.lit(f"type:{c}"))
    return ev.select(
        *keep_cols, fallback_id("event_id", "grid_id", "grid_x", "grid_y", "start_time").alias("event_id"),
        "event_type", "source", "office", "grid_id", "grid_x", "grid_y", st.alias("start_time"),
        en.alias("end_time"), "is_daytime", "temperature_trend", "wind_direction", "short_forecast",
        "detailed_forecast", *nums, ing.alias("ingested_at_dtz"), err.alias("error"))
