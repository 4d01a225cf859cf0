"""Landed response bodies to topic (A5, B1, B2, C1-C8): a stream of whole bodies is
normalised to events, which are published as topic messages.

A fetcher lands one JSON line a response: what was asked for (place, zone, grid), when,
and the body as text. A body that is no JSON, or not of its service's shape, is rejected
whole, an AirNow item alone; the rest is published. Everything is written to the
micro-batch's own folder, so a repeated batch publishes nothing twice. On the file topic a
message's offset is its place, ``body_id`` and item; a broker numbers by itself.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from envlake.operators.validate import parsed
from envlake.sources import airnow, nws, open_meteo
from envlake.sources.publish import to_messages

BODY = ("body_id bigint, service string, latitude double, longitude double, timezone string, office string, grid_id string, "
        "grid_x int, grid_y int, fetched_at timestamp, body string")
#: Items of one body, as a power of two: a message's offset is ``body_id << ITEM_BITS`` plus its place.
ITEM_BITS = 20
_KEEP = ("body_id", "fetched_at")
_FIELDS = {"weather": open_meteo.WEATHER_VARS, "air_quality": open_meteo.AIR_VARS}


def _open_meteo_schema(kind: str) -> str:
    kinds = {v: "bigint" if v == "is_day" else "double" for v in _FIELDS[kind]}
    units = ", ".join(f"{v}: string" for v in kinds)
    return (f"hourly struct<time: array<string>, {', '.join(f'{v}: array<{t}>' for v, t in kinds.items())}>, hourly_units struct<{units}>, "
            f"current struct<time: string, {', '.join(f'{v}: {t}' for v, t in kinds.items())}>, current_units struct<{units}>")


def body_events(bodies: DataFrame, service: str) -> tuple[DataFrame, DataFrame]:
    """Bodies of ``airnow``, ``nws``, ``weather`` or ``air_quality`` (Open-Meteo) as events with
    ``body_id, fetched_at, pos``, and what was rejected: ``body_id, fetched_at, pos, error,
    raw_value`` (``pos`` -1: the whole body)."""
    if service == "airnow":
        events, bad = airnow.items_to_events(bodies, "body", keep_cols=_KEEP)
        # The item as it came is an object of the message, not its text.
        return events.withColumnRenamed("item_pos", "pos").withColumn("raw_data", F.parse_json("raw_data")), bad.withColumnRenamed("item_pos", "pos")
    part = "$.properties.periods" if service == "nws" else "$.hourly.time"
    listed = F.try_variant_get("__v", part, "array<variant>").isNotNull()
    current = F.try_variant_get("__v", "$.current.time", "string").isNotNull() if service != "nws" else F.lit(False)
    d = parsed(bodies, "body", "__v")
    d = d.withColumn("__error", F.when(F.col("__v").isNull(), "malformed_body").when(~(listed | current), f"missing:{part[2:]}"))
    bad = d.where("__error is not null").select(*_KEEP, F.lit(-1).alias("pos"), F.col("__error").alias("error"), F.col("body").alias("raw_value"))
    d = d.where("__error is null").drop("__v", "__error")
    if service == "nws":
        d = d.withColumn("meta", F.struct("grid_id", "grid_x", "grid_y", "office"))
        return nws.periods_to_events(d, "body", "meta", "fetched_at", keep_cols=_KEEP, pos_col="pos"), bad
    # Exploded, so that a body is read once and not for each of its arrays.
    d = d.select("*", F.explode(F.array(F.from_json("body", _open_meteo_schema(service)))).alias("raw"), F.col("fetched_at").alias("__asked"))
    return open_meteo.payload_events(d, service, ingest_col="__asked", keep_cols=_KEEP, pos_col="pos"), bad


@dataclass
class BodyFeed:
    """One service's bodies, and where its messages and rejects go."""

    service: str
    topic: str
    topic_path: str
    rejects_path: str
    key_col: str = "event_id"
    counts: list = field(default_factory=list)

    def publish(self, spark: SparkSession, batch: DataFrame, batch_id: int) -> dict:
        """Publish one micro-batch; returns, and appends to ``counts``, how many messages were
        published and how many items or bodies were rejected."""
        # Read twice and not kept: bodies would fill the executors' memory.
        events, bad = body_events(batch.where(F.col("service") == self.service), self.service)
        sent, lost = Observation(f"s-{uuid.uuid4().hex}"), Observation(f"r-{uuid.uuid4().hex}")
        carried = [*_KEEP, "pos"]
        held = events.withColumn("__m", F.struct(*carried))
        msgs = to_messages(held, self.key_col, [c for c in events.columns if c not in carried], self.topic, extra=["__m"])
        msgs = msgs.select("key", "value", "topic", F.lit(0).alias("partition"),
                           (F.shiftleft(F.col("__m.body_id"), ITEM_BITS) + F.col("__m.pos") + 1).alias("offset"), F.col("__m.fetched_at").alias("timestamp"))
        (msgs.observe(sent, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
         .json(f"{self.topic_path}/batch_id={batch_id}"))
        bad.observe(lost, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.rejects_path}/batch_id={batch_id}")
        self.counts.append({"batch_id": batch_id, "published": sent.get["n"], "rejected": lost.get["n"]})
        return self.counts[-1]

    def run_available(self, spark: SparkSession, landed: str, checkpoint: str) -> None:
        """Publish all bodies landed since the last run."""
        q = (spark.readStream.schema(BODY).json(landed).writeStream.foreachBatch(lambda df, bid: self.publish(spark, df, bid))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
