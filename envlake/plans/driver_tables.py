"""Environmental-shaped views derived from the driver's TPC-H-like tables.

The driver tables are not environmental data, so each operator family is bound
to them through these derivations (all lazy DataFrame expressions, so their
work grows with the tables). Coordinates come from integer arithmetic on keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.functions.clean import normalize_measurement
from envlake.functions.ids import measurement_event_id
from envlake.session import apply_conf

# Fixed values for the bindings (mirrored in the oracle SQL).
LATEST_TYPE = "events.latest"
ERROR_TYPE = "events.error"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_conf(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scalar(df: DataFrame):
    """One bounded value (a global aggregate) for use as a run literal."""
    return df.first()[0]


def events_as_of(spark: SparkSession, sf_dir: str) -> dt.datetime:
    return scalar(table(spark, sf_dir, "events").agg(F.max("ts")))


def customer_lat() -> F.Column:
    return F.lit(40.0) + (F.col("c_custkey") * F.lit(7919)) % F.lit(5000) / F.lit(10000.0)


def customer_lon() -> F.Column:
    return F.lit(-90.0) + (F.col("c_custkey") * F.lit(104729)) % F.lit(5000) / F.lit(10000.0)


def supplier_lat() -> F.Column:
    return F.lit(40.0) + (F.col("s_suppkey") * F.lit(7907)) % F.lit(5000) / F.lit(10000.0)


def supplier_lon() -> F.Column:
    return F.lit(-90.0) + (F.col("s_suppkey") * F.lit(15485863)) % F.lit(5000) / F.lit(10000.0)


def events_since(spark, sf_dir, since: dt.datetime | None) -> DataFrame:
    """events, from ``since`` on: a bound on the raw column, which reaches the scan."""
    ev = table(spark, sf_dir, "events")
    return ev if since is None else ev.where(F.col("ts") >= F.lit(since).cast("timestamp"))


def measurements(spark, sf_dir, since: dt.datetime | None = None) -> DataFrame:
    """events -> stg.openaq_measurements_by_location shape (location=user,
    sensor=event type, time truncated to the hour so ties exist). A reader that wants
    hours from ``since`` on passes it: a truncated time is never later than the raw one."""
    ev = events_since(spark, sf_dir, since)
    et = F.when(F.col("event_type") == "error", F.lit(ERROR_TYPE)).otherwise(F.lit(LATEST_TYPE))
    t = F.date_trunc("hour", F.col("ts"))
    v, ok, st = normalize_measurement(F.col("value"))
    return ev.select(
        measurement_event_id(F.col("user_id"), F.col("event_type"), et, t).alias("event_id"),
        F.col("user_id").alias("openaq_locations_id"), F.col("event_type").alias("openaq_sensors_id"),
        t.alias("datetime_utc"), F.col("value"), v.alias("value_normalized"), v.alias("value_clean"),
        ok.alias("is_valid"), st.alias("quality_status"), F.lit("events").alias("source"),
        et.alias("event_type"), F.lit("1").alias("source_version"), F.col("ts").alias("ingested_at_dtz"))


def locations(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    # Every location has a closed version beside the current one.
    v = c.withColumn("is_current", F.explode(F.array(F.lit(True), F.lit(False))))
    return v.join(n, v["c_nationkey"] == n["n_nationkey"]).select(
        F.col("c_custkey").alias("openaq_locations_id"), F.col("c_custkey").alias("locations_id_sk"),
        F.when(F.col("is_current"), F.col("c_name")).otherwise(F.lit("closed")).alias("name"), F.col("n_nationkey").cast("string").alias("country_code"),
        F.col("n_name").alias("country_name"), F.col("c_mktsegment").alias("owner_name"),
        F.lit("tpch").alias("provider_name"), customer_lat().alias("latitude"),
        customer_lon().alias("longitude"), "is_current")


def sensors(spark, sf_dir, since: dt.datetime | None = None) -> DataFrame:
    ev = events_since(spark, sf_dir, since)
    return ev.select("event_type").distinct().select(
        F.col("event_type").alias("openaq_sensors_id"), F.col("event_type").alias("parameter_name"),
        F.upper("event_type").alias("parameter_display_name"), F.lit("count").alias("parameter_units"),
        F.lit(True).alias("is_current"))


def bridge(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
        F.col("c_custkey").alias("locations_id_sk"), F.col("n_regionkey").alias("license_id_sk"),
        F.col("n_name").alias("license_attribution_name"),
        F.concat(F.lit("attr:"), F.col("n_name")).alias("license_attribution_url"),
        F.lit(dt.datetime(2020, 1, 1)).alias("license_date_from_dtz"),
        F.lit(None).cast("timestamp").alias("license_date_to_dtz"), F.lit(True).alias("is_current"))


def licenses(spark, sf_dir) -> DataFrame:
    r = table(spark, sf_dir, "region")
    k = F.col("r_regionkey")
    return r.select(
        k.alias("license_id_sk"), F.col("r_name").alias("name"),
        (k % 2 == 0).alias("commercial_use_allowed"), (k % 3 == 0).alias("attribution_required"),
        (k < 2).alias("share_alike_required"), F.lit(True).alias("modification_allowed"),
        (k != 4).alias("redistribution_allowed"),
        F.concat(F.lit("license:"), F.lower("r_name")).alias("source_url"), F.lit(True).alias("is_current"))
