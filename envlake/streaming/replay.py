"""Replay of the driver ``events`` table through the streaming ingest (A1,
B5, N1-N6): events are landed as JSON-lines topic files, read with
``availableNow`` in several micro-batches and merged by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.operators.upsert import ORDER_COL
from envlake.operators.validate import EventSpec
from envlake.streaming.ingest import SourceSpec, run_available, scratch_dir
from envlake.streaming.store import PART, read_table

EVENTS_SPEC = EventSpec("events", {"event_id": "int", "ts": "timestamp", "user_id": "int", "event_type": "string",
                                   "value": "double", "props": "string"},
                        required=("event_id", "ts", "user_id", "event_type"))


#: Messages of one landed topic file.
FILE_MESSAGES = 50_000


def topic_files(events: DataFrame, rows: int = FILE_MESSAGES) -> int:
    """Files to land, from the number of messages (24 at least, to have batches of several)."""
    return max(24, -(-events.count() // rows))


def land_as_topic(events: DataFrame, path: str, files: int) -> None:
    """Write events as topic messages (key, JSON value, topic, partition, offset, timestamp)."""
    msgs = events.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"),
                           "user_id", "event_type", "value", "props")).alias("value"),
        F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    msgs.repartitionByRange(files, "timestamp").write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def replay_events_as_stream(spark: SparkSession, events: DataFrame, files: int | None = None,
                            files_per_batch: int | None = None) -> DataFrame:
    """The table after the whole topic was read, in three batches unless told otherwise."""
    root = scratch_dir(spark, "replay")
    files = files or topic_files(events)
    files_per_batch = files_per_batch or -(-files // 3)
    land_as_topic(events, f"{root}/topic", files)
    spec = SourceSpec(name="events", event=EVENTS_SPEC, key=["user_id", "event_type"],
                      table_path=f"{root}/table", dlq_path=f"{root}/dlq", order_cols=["ts", "event_id"],
                      clock_col=None, buckets=8)
    spec.to_record = lambda v: v.select("user_id", "event_type", "event_id", "ts", "value")
    run_available(spark, spec, f"{root}/topic", f"{root}/checkpoint", max_files_per_trigger=files_per_batch)
    return read_table(spark, spec.table_path).drop(ORDER_COL, PART)
