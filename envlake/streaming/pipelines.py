"""The source pipelines (A6, B5, C14-C17, K1-K5): what each topic's events must
look like, the staging record made of them, and how records of one key merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envlake.functions.coerce import falsy_default
from envlake.operators import validate as V
from envlake.sources import airnow, nws, open_meteo
from envlake.streaming.ingest import MESSAGE_COLS, SourceSpec

#: What a record keeps of its message.
_KEPT = (*MESSAGE_COLS, "raw_value")

_TOUCHED = "last_updated_at_dtz"


def _with_touch(records: DataFrame) -> DataFrame:
    return records.withColumn(_TOUCHED, F.lit(None).cast("timestamp"))


def airnow_spec(table_path: str, dlq_path: str) -> SourceSpec:
    """AirNow forecasts by event id: the newest wins, the first start time stays."""
    def to_record(valid: DataFrame) -> DataFrame:
        return _with_touch(airnow.event_to_record(valid, clock_col="timestamp", keep_cols=_KEPT))
    return SourceSpec(name="airnow", event=V.AIRNOW_EVENT, key=["event_id"], table_path=table_path, dlq_path=dlq_path,
                      policy={"effective_start_at_dtz": "keep", _TOUCHED: "touch"}, to_record=to_record)


def nws_spec(table_path: str, dlq_path: str) -> SourceSpec:
    """Hourly forecasts by event id: the newest wins, an absent ingest time keeps the stored one."""
    def to_record(valid: DataFrame) -> DataFrame:
        return _with_touch(nws.event_to_record(valid, keep_cols=_KEPT))
    return SourceSpec(name="nws", event=V.NWS_EVENT, key=["event_id"], table_path=table_path, dlq_path=dlq_path,
                      policy={"ingested_at_dtz": "coalesce", _TOUCHED: "touch"}, to_record=to_record)


def open_meteo_kind() -> Column:
    """A message's kind: ``data_kind`` unless empty, else ``record_type``."""
    return falsy_default(F.get_json_object("value", "$.data_kind"), F.get_json_object("value", "$.record_type"))


def open_meteo_spec(kind: str, table_path: str, dlq_path: str) -> SourceSpec:
    """Weather or air-quality rows of the one topic both share. Messages of another
    or no kind go the weather way, where their literal is rejected."""
    air = F.coalesce(open_meteo_kind() == "air_quality", F.lit(False))

    def to_record(valid: DataFrame) -> DataFrame:
        return _with_touch(open_meteo.event_to_record(valid, kind, keep_cols=_KEPT))
    return SourceSpec(name=f"open_meteo_{kind}", key=["event_id"], table_path=table_path, dlq_path=dlq_path,
                      event=V.OPEN_METEO_WEATHER_EVENT if kind == "weather" else V.OPEN_METEO_AIR_EVENT,
                      policy={_TOUCHED: "touch"}, to_record=to_record, takes=~air if kind == "weather" else air)
