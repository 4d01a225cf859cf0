"""Declarative data-quality checks.

All expectations of one table compile to ONE aggregate (a single scan with
partial aggregation); uniqueness needs a grouped count and is a second job.
Results are a DataFrame ``(table_name, check, column_name, n, nonnull, unexpected,
unexpected_ratio, success)`` - nothing is collected to the driver.

``mostly``: success when ``1 - unexpected/nonnull >= mostly``; an all-NULL
column succeeds (counts are over non-NULL values).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str            # not_null | between | in_set | accepted_values | unique
    column: str
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    mostly: float = 1.0


def _unexpected(ch: Check) -> Column:
    c = F.col(ch.column)
    if ch.kind == "not_null":
        return c.isNull()
    if ch.kind == "between":
        cond = F.lit(False)
        if ch.low is not None:
            cond = cond | (c < F.lit(ch.low))
        if ch.high is not None:
            cond = cond | (c > F.lit(ch.high))
        return c.isNotNull() & cond
    if ch.kind in ("in_set", "accepted_values"):
        return c.isNotNull() & ~c.isin(*[v for v in ch.values if v is not None])
    raise ValueError(ch.kind)


def run_suite(df: DataFrame, table_name: str, checks: list[Check]) -> DataFrame:
    """Evaluate all checks; one result row per check. All but uniqueness share one
    pass; each ``unique`` check is a grouped count of its column, in which every row
    whose value occurs again is unexpected."""
    plain = [ch for ch in checks if ch.kind != "unique"]
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, ch in enumerate(plain):
        aggs.append(F.count(F.col(ch.column)).alias(f"__nn{i}"))
        aggs.append(F.count(F.when(_unexpected(ch), F.lit(1))).alias(f"__u{i}"))
    row = df.agg(*aggs)
    parts = [_result(table_name, ch, F.col("__n"), F.col(f"__nn{i}"), F.col(f"__u{i}")) for i, ch in enumerate(plain)]
    out = row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")
    for ch in checks:
        if ch.kind == "unique":
            known = F.col(ch.column).isNotNull()
            per = df.groupBy(ch.column).agg(F.count(F.lit(1)).alias("__c"))
            one = per.agg(F.coalesce(F.sum("__c"), F.lit(0)).alias("__n"), F.coalesce(F.sum(F.when(known, F.col("__c"))), F.lit(0)).alias("__nn"),
                          F.coalesce(F.sum(F.when(known & (F.col("__c") > 1), F.col("__c"))), F.lit(0)).alias("__u"))
            out = out.unionByName(one.select(_result(table_name, ch, F.col("__n"), F.col("__nn"), F.col("__u")).alias("r")).select("r.*"))
    return out


def _result(table_name: str, ch: Check, n: Column, nonnull: Column, unexpected: Column) -> Column:
    base = n if ch.kind == "not_null" else nonnull
    ratio = F.when(base > 0, unexpected / base).otherwise(F.lit(0.0))
    return F.struct(
        F.lit(table_name).alias("table_name"), F.lit(ch.kind).alias("check"), F.lit(ch.column).alias("column_name"),
        n.alias("n"), nonnull.alias("nonnull"), unexpected.alias("unexpected"), F.round(ratio, 6).alias("unexpected_ratio"),
        ((F.lit(1.0) - ratio) >= F.lit(ch.mostly)).alias("success"))


def unique_violations(df: DataFrame, cols: list[str], where: Column | None = None) -> DataFrame:
    """Key values (non-NULL) that occur more than once, with their count."""
    d = df.where(where) if where is not None else df
    nn = None
    for c in cols:
        nn = F.col(c).isNotNull() if nn is None else nn & F.col(c).isNotNull()
    return d.where(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``child`` whose key (``on``: child column -> parent column), where it is
    not NULL, stands in no row of ``parent``: an anti join, which keeps no foreign key for us."""
    keys = parent.select(*[F.col(p).alias(f"__p{i}") for i, p in enumerate(on.values())]).distinct()
    cond, known = F.lit(True), F.lit(True)
    for i, c in enumerate(on):
        cond, known = cond & (child[c] == keys[f"__p{i}"]), known & F.col(c).isNotNull()
    return child.where(known).join(keys, cond, "left_anti")


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None,
                   combine: str = "or") -> DataFrame:
    """Rows outside the accepted range: below ``min_value`` or above ``max_value``.

    The original macro joins the two conditions with AND, so that with both bounds
    nothing can violate; ``combine='and'`` gives that. NULL never violates."""
    c = F.col(column)
    conds = []
    if min_value is not None:
        conds.append(c < F.lit(min_value))
    if max_value is not None:
        conds.append(c > F.lit(max_value))
    if not conds:
        return df.limit(0)
    cond = conds[0]
    for x in conds[1:]:
        cond = (cond & x) if combine == "and" else (cond | x)
    return df.where(cond)


def volume_anomalies(df: DataFrame, ts_col: str, trailing: int = 14, z_limit: float = 3.0,
                     grain: str = "day") -> DataFrame:
    """Row count per time bucket and its z-score against the ``trailing``
    previous buckets; ``is_anomaly`` when |z| > ``z_limit``. The window runs over
    the per-bucket counts, never over raw rows, and in one task: a year is 365 rows at
    the default ``grain`` and half a million at ``minute``, the finest to use."""
    from pyspark.sql import Window
    counts = df.groupBy(F.date_trunc(grain, F.col(ts_col)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("bucket").rowsBetween(-trailing, -1)
    mean = F.avg("n").over(w)
    sd = F.stddev_samp("n").over(w)
    out = counts.select("bucket", "n", mean.alias("trailing_mean"), sd.alias("trailing_stddev"))
    z = F.when(F.col("trailing_stddev") > 0,
               (F.col("n") - F.col("trailing_mean")) / F.col("trailing_stddev"))
    return out.select("bucket", "n", F.round("trailing_mean", 6).alias("trailing_mean"),
                      F.round("trailing_stddev", 6).alias("trailing_stddev"), F.round(z, 6).alias("z_score"),
                      F.coalesce(F.abs(z) > F.lit(z_limit), F.lit(False)).alias("is_anomaly"))


# The three staging-table suites (not-null and unique columns, ranges
# with their ``mostly`` share, allowed values; NULL is always allowed in a set).
NWS_SUITE = [
    Check("unique", "event_id"),
    *[Check("not_null", c) for c in ("event_id", "source", "office", "grid_id", "grid_x", "grid_y", "start_time", "end_time")],
    Check("in_set", "is_daytime", values=(True, False)),
    Check("between", "temperature", -60, 60, mostly=0.99),
    Check("between", "relative_humidity", 0, 100, mostly=0.99),
    Check("between", "probability_of_precipitation", 0, 100, mostly=0.99),
    Check("between", "wind_speed", 0, 250, mostly=0.99)]
AIRNOW_SUITE = [
    Check("unique", "event_id"),
    *[Check("not_null", c) for c in ("event_id", "source", "date_issue_dtz", "date_forecast_dtz", "reporting_area", "state_code",
                                     "latitude", "longitude", "parameter_name", "aqi", "category_number", "category_name",
                                     "raw_data", "effective_start_at_dtz")],
    Check("in_set", "action_day", values=(True, False)),
    Check("between", "aqi", -1, 500, mostly=0.99),
    Check("between", "category_number", 1, 6),
    Check("in_set", "category_name", values=("Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy",
                                             "Very Unhealthy", "Hazardous"))]
OPENAQ_SUITE = [
    Check("unique", "event_id"),
    *[Check("not_null", c) for c in ("event_id", "openaq_locations_id", "openaq_sensors_id", "datetime_utc", "value", "source",
                                     "source_version", "event_type", "ingested_at_dtz")],
    Check("between", "value_normalized", 0, None),
    Check("in_set", "is_valid", values=(True, False)),
    Check("in_set", "quality_status", values=("negative_value", "missing_value", "non_numeric_value"))]


# What the staging views and marts declare (range, allowed and unique
# columns). A range is violated below its low or above its high bound.
_TEMPERATURE = Check("between", "temperature", -150, 150)
_OPEN_METEO = (_TEMPERATURE, Check("between", "pm2_5", 0, None), Check("between", "us_aqi", 0, None))
_VALID = Check("accepted_values", "is_valid", values=(True, False))
MODEL_CHECKS = {
    "stg_openaq_measurements_by_location": (Check("unique", "event_id"), Check("not_null", "event_id"), Check("between", "value_clean", 0, None), _VALID),
    "stg_weather_hourly_forecast": (Check("between", "temperature_clean", -80, 80), Check("between", "relative_humidity_clean", 0, 100),
                                    Check("between", "probability_of_precipitation_clean", 0, 100), Check("between", "wind_speed_clean", 0, 300), _VALID),
    "stg_airnow_air_quality_forecast": (Check("between", "aqi_clean", 0, 500), _VALID),
    "fct_openaq_latest_by_location": (Check("between", "measurement_value", 0, None),),
    "fct_open_meteo_current_weather_air_conditions": _OPEN_METEO,
    "fct_open_meteo_latest_weather_air_forecast": _OPEN_METEO,
    "fct_air_weather_forecast": (Check("between", "latest_measured_pm25", 0, None), Check("between", "latest_measured_relative_humidity", 0, 100),
                                 _TEMPERATURE, Check("between", "probability_of_precipitation", 0, 100)),
}


def model_checks(name: str, df: DataFrame) -> DataFrame:
    """The declared checks of a view or mart. A check on a column that it does not have
    fails, with every row unexpected."""
    out = run_suite(df, name, [ch for ch in MODEL_CHECKS[name] if ch.column in df.columns])
    for ch in MODEL_CHECKS[name]:
        if ch.column not in df.columns:
            n, none = F.col("__n"), F.lit(0).cast("long")
            one = df.agg(F.count(F.lit(1)).alias("__n")).select(_result(name, ch, n, none, n).alias("r")).select("r.*")
            out = out.unionByName(one.withColumns({"unexpected_ratio": F.lit(1.0), "success": F.lit(False)}))
    return out


def suite_verdict(results: DataFrame) -> DataFrame:
    """Per table: overall success and the failed checks, sorted and comma-joined (one
    small aggregate over the results table)."""
    return results.groupBy("table_name").agg(
        F.min(F.col("success").cast("int")).cast("boolean").alias("success"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("success"), F.concat_ws(":", "check", "column_name")))), ",").alias("failed"))
