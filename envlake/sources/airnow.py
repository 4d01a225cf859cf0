"""AirNow forecast items -> events -> staging records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envlake.functions.ids import airnow_event_id, fallback_id
from envlake.functions.timefn import parse_utc
from envlake.operators.validate import parsed

ITEM = T.StructType([
    T.StructField("DateIssue", T.StringType()), T.StructField("DateForecast", T.StringType()),
    T.StructField("ReportingArea", T.StringType()), T.StructField("StateCode", T.StringType()),
    T.StructField("Latitude", T.DoubleType()), T.StructField("Longitude", T.DoubleType()),
    T.StructField("ParameterName", T.StringType()), T.StructField("AQI", T.StringType()),
    T.StructField("Category", T.StructType([T.StructField("Number", T.StringType()),
                                            T.StructField("Name", T.StringType())])),
    T.StructField("ActionDay", T.StringType()), T.StructField("Discussion", T.StringType())])


def items_to_events(df: DataFrame, items_col: str = "items", keep_cols: tuple = ()) -> tuple[DataFrame, DataFrame]:
    """A JSON array of forecast items (text) -> (events, rejected items).

    ``ActionDay`` may be a JSON boolean or text: ``true``/``"True"`` -> true,
    other text -> false, absent -> NULL. A missing reporting area becomes
    ``unknown``. An item that is not an object, or whose AQI / category number
    is not an integer, is rejected alone; the rest of its batch is kept. A body that
    is not a JSON array is rejected whole, as item -1."""
    d = parsed(df.select(*keep_cols, F.col(items_col).alias("__body")), "__body", "__v")
    d = d.withColumn("__is_array", F.coalesce(F.schema_of_variant("__v").startswith("ARRAY"), F.lit(False)))
    items = d.where("__is_array").select(
        *keep_cols, F.posexplode(F.try_variant_get("__v", "$", "array<variant>")).alias("item_pos", "__item"))
    # What is exploded is computed once; else an item is read again for each of its fields.
    e = items.select(*keep_cols, "item_pos", F.coalesce(F.schema_of_variant("__item").startswith("OBJECT"), F.lit(False)).alias("__is_object"),
                     F.explode(F.array(F.to_json("__item"))).alias("__raw"))
    p = e.select(*keep_cols, "item_pos", "__raw", F.explode(F.array(F.when(F.col("__is_object"), F.from_json(F.col("__raw"), ITEM)))).alias("__i"))
    unread = d.where("not __is_array").select(*keep_cols, F.lit(-1).alias("item_pos"), F.lit("malformed_body").alias("error"),
                                              F.col("__body").alias("raw_value"))
    aqi = F.trim(F.col("__i.AQI")).try_cast("int")
    cat = F.trim(F.col("__i.Category.Number")).try_cast("int")
    err = (F.when(F.col("__i").isNull(), F.lit("malformed_item"))
           .when(F.col("__i.AQI").isNotNull() & aqi.isNull(), F.lit("type:AQI"))
           .when(F.col("__i.Category.Number").isNotNull() & cat.isNull(), F.lit("type:Category.Number")))
    p = p.withColumn("error", err)
    area = F.coalesce(F.col("__i.ReportingArea"), F.lit("unknown"))
    act = F.lower(F.trim(F.col("__i.ActionDay")))
    events = p.where(F.col("error").isNull()).select(
        *keep_cols, "item_pos",
        airnow_event_id(area, F.col("__i.DateIssue"), F.col("__i.DateForecast")).alias("event_id"),
        F.lit("airnow").alias("source"), F.col("__i.DateIssue").alias("date_issue"),
        F.col("__i.DateForecast").alias("date_forecast"), area.alias("reporting_area"),
        F.col("__i.StateCode").alias("state_code"), F.col("__i.Latitude").alias("latitude"),
        F.col("__i.Longitude").alias("longitude"), F.col("__i.ParameterName").alias("parameter_name"),
        aqi.alias("aqi"), cat.alias("category_number"), F.col("__i.Category.Name").alias("category_name"),
        F.when(act.isNull(), F.lit(None).cast("boolean")).otherwise(act == F.lit("true")).alias("action_day"),
        F.col("__i.Discussion").alias("discussion"), F.col("__raw").alias("raw_data"))
    rejected = p.where(F.col("error").isNotNull()).select(*keep_cols, "item_pos", "error",
                                                          F.col("__raw").alias("raw_value"))
    return events, rejected.unionByName(unread)


def event_to_record(ev: DataFrame, clock_col: str | None = None, keep_cols: tuple = ()) -> DataFrame:
    """AirNow event -> ``stg.airnow_air_quality_forecast`` record (fallback id,
    dates parsed to UTC midnight, raw record kept as JSON text)."""
    di, _ = parse_utc("date_issue", T.StringType())
    dfc, dfc_err = parse_utc("date_forecast", T.StringType())
    clock = F.col(clock_col) if clock_col else F.current_timestamp()
    return ev.select(
        *keep_cols,
        fallback_id("event_id", F.lit("airnow"), "reporting_area", "date_issue", "date_forecast").alias("event_id"),
        "source", di.alias("date_issue_dtz"), dfc.alias("date_forecast_dtz"), "reporting_area", "state_code",
        "latitude", "longitude", "parameter_name", "aqi", "category_number", "category_name", "action_day",
        "discussion", F.coalesce(F.col("raw_data"), F.lit("null")).alias("raw_data"),
        clock.alias("effective_start_at_dtz"), F.lit(None).cast("timestamp").alias("effective_end_at_dtz"),
        F.lit(True).alias("is_current"),
        F.when(dfc_err, F.lit("type:date_forecast")).alias("error"))
