"""Publishing rows as topic messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def to_messages(df: DataFrame, key_col: str | None, value_cols: Sequence[str], topic: str,
                unknown_key: str = "unknown", extra: Sequence[str] = ()) -> DataFrame:
    """``key`` = key column as text (``unknown`` when NULL; NULL when no key
    column), ``value`` = compact JSON of ``value_cols`` with NULL fields kept. Columns
    ``extra`` come along, to place the message by."""
    key = (F.coalesce(F.col(key_col).cast("string"), F.lit(unknown_key)) if key_col
           else F.lit(None).cast("string"))
    value = F.to_json(F.struct(*[F.col(c) for c in value_cols]), {"ignoreNullFields": "false"})
    return df.select(key.alias("key"), value.alias("value"), F.lit(topic).alias("topic"), *extra)


def write_messages(msgs: DataFrame, path_or_servers: str, fmt: str = "json", topic: str | None = None) -> int:
    """Write messages to Kafka (``fmt='kafka'``, needs the connector on the
    classpath) or to JSON-lines files with the same columns; returns how many."""
    sent = Observation()
    msgs = msgs.observe(sent, F.count(F.lit(1)).alias("n"))
    if fmt == "kafka":
        w = msgs.write.format("kafka").option("kafka.bootstrap.servers", path_or_servers)
        if topic:
            w = w.option("topic", topic)
        w.save()
    else:
        msgs.write.mode("append").json(path_or_servers)
    return sent.get["n"]
