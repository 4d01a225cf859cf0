"""Open-Meteo payloads (C5-C8): parallel hourly arrays zipped by position,
current-condition events, local time -> UTC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envlake.functions.coerce import as_bool, falsy_default, safe_get
from envlake.functions.ids import open_meteo_event_id
from envlake.functions.timefn import iso_z, local_to_utc


def zip_by_position(df: DataFrame, driver_array: str, arrays: Mapping[str, str],
                    keep_cols: Sequence[str] = ()) -> DataFrame:
    """One row per element of ``driver_array``; every other array is read at the
    same position with ``get`` (NULL past its end - unlike ``arrays_zip``,
    which would pad to the longest array)."""
    e = df.select(*keep_cols, *[F.col(a) for a in arrays if a != driver_array],
                  F.col(driver_array).alias("__drv"),
                  F.posexplode(F.col(driver_array)).alias("pos", "__val"))
    out = [F.col(c) for c in keep_cols] + [F.col("pos")]
    for a, name in arrays.items():
        out.append((F.col("__val") if a == driver_array else safe_get(a, F.col("pos"))).alias(name))
    return e.select(*out)


# Payload variable -> event field, as in the published events.
WEATHER_VARS = {"temperature_2m": "temperature", "relative_humidity_2m": "rel_humidity",
                "dew_point_2m": "dew_point", "apparent_temperature": "apparent_temperature",
                "precipitation_probability": "precipitation_prob", "precipitation": "precipitation",
                "cloud_cover": "cloud_cover", "wind_speed_10m": "wind_speed", "wind_gusts_10m": "wind_gusts",
                "wind_direction_10m": "wind_direction", "is_day": "is_day"}
AIR_VARS = {"pm2_5": "pm2_5", "pm10": "pm10", "us_aqi": "us_aqi", "ozone": "ozone", "uv_index": "uv_index"}


def _field(struct_col: str, name: str, df: DataFrame, missing_type: str) -> Column:
    """Field of a payload struct, or a typed NULL when the payload lacks it."""
    t = df.schema
    for part in struct_col.split("."):
        t = t[part].dataType
    return F.col(f"{struct_col}.{name}") if name in t.fieldNames() else F.lit(None).cast(missing_type)


def hourly_events(df: DataFrame, kind: str, record_type: str = "forecast", frequency_min: int = 60,
                  raw_col: str = "raw", lat_col: str = "latitude", lon_col: str = "longitude",
                  tz_col: str = "timezone", ingest_col: str = "ingest_dt", keep_cols: tuple = (), pos_col: str | None = None) -> DataFrame:
    """Hourly payload (``raw.hourly`` arrays + ``raw.hourly_units``) -> events.
    ``kind`` is 'weather' or 'air_quality'; ``pos_col`` names the hour's place."""
    vars_ = WEATHER_VARS if kind == "weather" else AIR_VARS
    hourly = f"{raw_col}.hourly"
    # The arrays are zipped before they are exploded: carried along whole, they would be copied for every hour.
    times = F.coalesce(F.col(f"{hourly}.time"), F.array().cast("array<string>"))
    arrays = {v: _field(hourly, v, df, "array<double>") for v in vars_}
    hours = F.slice(F.arrays_zip(times.alias("__t"), *[F.coalesce(a, F.array().cast(df.select(a).schema[0].dataType)).alias(v) for v, a in arrays.items()]), 1, F.size(times))
    e = df.select(*keep_cols, lat_col, lon_col, tz_col, ingest_col, F.col(f"{raw_col}.hourly_units").alias("__u"), F.posexplode(hours).alias("pos", "__h"))
    names = e.schema["__h"].dataType.fieldNames()
    e = e.withColumn("__t", F.col("__h")[names[0]])
    return _project(e, kind, record_type, frequency_min, vars_, lambda v: F.col("__h")[names[1 + list(vars_).index(v)]],
                    lat_col, lon_col, tz_col, ingest_col, df.schema[raw_col].dataType["hourly_units"].dataType,
                    [*keep_cols, *([F.col("pos").alias(pos_col)] if pos_col else [])])


def current_events(df: DataFrame, kind: str, raw_col: str = "raw", lat_col: str = "latitude",
                   lon_col: str = "longitude", tz_col: str = "timezone", ingest_col: str = "ingest_dt", keep_cols: tuple = (),
                   pos_col: str | None = None) -> DataFrame:
    """``raw.current`` -> one 15-minute ``current`` event per payload (only when present)."""
    vars_ = WEATHER_VARS if kind == "weather" else AIR_VARS
    rt = df.schema[raw_col].dataType
    if "current" not in rt.fieldNames():
        return None
    cur = f"{raw_col}.current"
    e = df.where(F.col(cur).isNotNull()).select(
        *keep_cols, lat_col, lon_col, tz_col, ingest_col,
        (F.col(f"{raw_col}.current_units") if "current_units" in rt.fieldNames() else F.lit(None)).alias("__u"),
        *[_field(cur, v, df, "double").alias(f"__c_{v}") for v in vars_], F.col(f"{cur}.time").alias("__t"))
    ut = rt["current_units"].dataType if "current_units" in rt.fieldNames() else None
    return _project(e, kind, "current", 15, vars_, lambda v: F.col(f"__c_{v}"), lat_col, lon_col, tz_col,
                    ingest_col, ut, [*keep_cols, *([F.lit(-1).alias(pos_col)] if pos_col else [])])


def _project(e, kind, record_type, freq, vars_, value_of, lat_col, lon_col, tz_col, ingest_col, units_type, first=()):
    start = local_to_utc(F.col("__t"), F.col(tz_col))
    end = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(freq))
    unit_names = units_type.fieldNames() if units_type is not None else []
    cols = [*first, open_meteo_event_id(kind, record_type, F.col(lat_col), F.col(lon_col), start).alias("event_id"),
            F.lit(kind).alias("data_kind"), F.lit(record_type).alias("record_type"),
            F.lit(freq).alias("record_frequency_min"), iso_z(start).alias("open_meteo_start_time"),
            iso_z(end).alias("open_meteo_end_time"), F.col(lat_col).alias("latitude"),
            F.col(lon_col).alias("longitude")]
    for v, name in vars_.items():
        val = value_of(v)
        cols.append((as_bool(val, None) if name == "is_day" else val).alias(name))
        if name != "is_day":
            cols.append((F.col(f"__u.{v}") if v in unit_names else F.lit(None).cast("string")).alias(f"{name}_unit"))
    cols.append(iso_z(F.col(ingest_col)).alias("ingested_at_dtz"))
    return e.select(*cols)


def payload_events(df: DataFrame, kind: str, **kw) -> DataFrame:
    """Current event (if any) followed by hourly events, as one DataFrame."""
    h = hourly_events(df, kind, **kw)
    c = current_events(df, kind, **{k: v for k, v in kw.items() if k not in ("record_type", "frequency_min")})
    return h if c is None else c.unionByName(h, allowMissingColumns=True)


def route_by_kind(events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(weather, air_quality, unroutable): kind = ``data_kind`` unless empty,
    else ``record_type``; anything else goes to the dead-letter side."""
    kind = falsy_default("data_kind", "record_type")
    k = events.withColumn("__kind", kind)
    return (k.where(F.col("__kind") == "weather").drop("__kind"),
            k.where(F.col("__kind") == "air_quality").drop("__kind"),
            k.where(~F.coalesce(F.col("__kind").isin("weather", "air_quality"), F.lit(False)))
             .withColumn("error", F.lit("unknown_kind")).drop("__kind"))


def event_to_record(ev: DataFrame, kind: str, keep_cols: tuple = ()) -> DataFrame:
    """Open-Meteo event -> staging record: ISO times parsed to UTC, numbers
    coerced leniently, a missing event id rebuilt from its parts, NOT NULL
    columns guarded (``error`` set instead of failing the batch)."""
    from envlake.functions.coerce import float_or_null
    from envlake.functions.timefn import parse_utc
    from envlake.functions.ids import fallback_id
    st, st_err = parse_utc("open_meteo_start_time")
    en, _ = parse_utc("open_meteo_end_time")
    ing, _ = parse_utc("ingested_at_dtz")
    vars_ = WEATHER_VARS if kind == "weather" else AIR_VARS
    vals = []
    for name in vars_.values():
        if name == "is_day":
            vals.append(F.col("is_day"))
        else:
            vals += [float_or_null(name).alias(name), F.col(f"{name}_unit")]
    eid = fallback_id("event_id", F.lit("open-meteo"), F.lit(kind), "record_type", "latitude", "longitude",
                      "open_meteo_start_time")
    err = (F.when(st.isNull() | st_err, F.lit("missing:open_meteo_start_time"))
           .when(F.col("latitude").isNull() | F.col("longitude").isNull(), F.lit("missing:coordinates")))
    if kind == "weather":
        err = err.when(F.col("temperature").isNull(), F.lit("missing:temperature"))
    return ev.select(*keep_cols, eid.alias("event_id"), "record_type", F.col("record_frequency_min").cast("int"),
                     st.alias("open_meteo_start_time"), en.alias("open_meteo_end_time"), "latitude", "longitude",
                     *vals, ing.alias("ingested_at_dtz"), err.alias("error"))
