"""The OpenAQ sink: one commit a batch, killed and delivered again, and its dead letters."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from envlake.streaming import openaq_load as L
from envlake.streaming.store import commit

SCHEMA = "key string, value string, topic string, partition int, offset long, timestamp timestamp"


def message(n, loc=1, name="Quay", attr="City", units="ug", value=4.0, utc=None, text=None):
    body = {"location": {"id": loc, "name": name}, "licenses": [{"openaq_license_id": 5, "name": "open", "license_attribution_name": attr}],
            "sensors": [{"id": 70 + loc, "parameter": {"name": "no2", "units": units}}],
            "latest": {"results": [{"locationsId": loc, "sensorsId": 70 + loc, "datetime": {"utc": utc or f"2025-05-{n:02d}T00:00:00Z"}, "value": value}]},
            "meta": {"source": "openaq", "version": "v3"}}
    return (str(loc), text or json.dumps(body), "air", 0, n, dt.datetime(2025, 5, n))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def state(spark, path):
    out = {}
    for name, key in L.DIMENSIONS.items():
        cols = [*(k for k in key if not k.endswith("_sk")), "effective_start_at_dtz", "effective_end_at_dtz", "is_current"]
        out[name] = sorted(map(str, L.dimension(spark, path, name).select(*cols).collect()))
    out["m"] = sorted(map(str, L.measurements(spark, path).select("event_id", "value", "quality_status", "last_updated_at_dtz").collect()))
    return out


ONE = [message(1), message(2, loc=2), message(3, name="Pier"), message(4, text="{"), message(5, loc=3, text='{"location": {"id": "x"}}')]
TWO = [message(6, attr="County"), message(7, loc=2, units="ppm"), message(8, value="n/a", utc="2025-05-01T00:00:00Z"), message(9, loc=4)]


def test_kill_between_two_tables_and_deliver_again(spark, tmp_path, monkeypatch):
    calm, path = L.OpenAQSink(str(tmp_path / "calm"), str(tmp_path / "calm-dlq")), str(tmp_path / "s")
    for i, rows in enumerate((ONE, TWO)):
        calm.process_batch(spark, frame(spark, rows), i, "q")
    want = state(spark, calm.store_path)

    sink = L.OpenAQSink(path, str(tmp_path / "dlq"), dlq_topic_path=str(tmp_path / "topic"))
    first = sink.process_batch(spark, frame(spark, ONE), 0, "q")
    assert first == {"batch_id": 0, "read": 5, "malformed": 1, "dead_lettered": 1, "merged": 3}
    before = state(spark, path)

    def dies(s, p, writes, batch=None):
        w = writes["openaq_sensors"]   # its rows are lost after other tables' rows were written
        w.rows = w.rows.withColumn("parameter_name", F.when(F.col("openaq_sensors_id") > 0, F.raise_error(F.lit("killed"))).otherwise("").cast("string"))
        return commit(s, p, writes, batch)
    with monkeypatch.context() as m:
        m.setattr(L, "commit", dies)
        with pytest.raises(Exception, match="killed"):
            sink.process_batch(spark, frame(spark, TWO), 1, "q")
    assert state(spark, path) == before != want
    for _ in range(2):   # again after the restart, and once more
        sink.process_batch(spark, frame(spark, TWO), 1, "q")
        assert state(spark, path) == want
    sink.process_batch(spark, frame(spark, ONE), 0, "other")   # the whole topic anew
    sink.process_batch(spark, frame(spark, TWO), 1, "other")
    assert state(spark, path) == want

    letters = spark.read.parquet(sink.dlq_path).collect()
    assert [(r.offset, r.error) for r in letters] == [(5, "invalid:location.id")]
    topic = spark.read.json(str(tmp_path / "topic")).collect()
    assert [(r.key, r.topic) for r in topic] == [("3", "air.dlq")]


def test_versions_follow_the_location(spark, tmp_path):
    path = str(tmp_path / "s")
    for i, rows in enumerate((ONE, TWO)):
        L.OpenAQSink(path, str(tmp_path / "dlq")).process_batch(spark, frame(spark, rows), i)
    loc = {(r.openaq_locations_id, r.name, r.is_current) for r in L.dimension(spark, path, "openaq_locations").collect()}
    assert loc == {(1, "Quay", False), (1, "Pier", False), (1, "Quay", True), (2, "Quay", True), (4, "Quay", True)}
    sensors = L.dimension(spark, path, "openaq_sensors").where("openaq_sensors_id = 71")
    assert sensors.count() == 3 and sensors.where("is_current").count() == 1   # one a location's version
    m = {r.event_id.split(":")[-3][-13:] + r.event_id[:2]: r for r in L.measurements(spark, path).collect()}
    again = [r for r in m.values() if r.quality_status == "non_numeric_value"]
    assert len(m) == 6 and len(again) == 1 and again[0].value is None and again[0].last_updated_at_dtz == dt.datetime(2025, 5, 8)
    held = {r["constraint"]: r.violations for r in L.constraint_violations(spark, path).collect()}
    # Two versions a start cannot be here: messages are a day apart.
    assert len(held) == 11 and set(held.values()) == {0}


def test_orphans(spark):
    from envlake.operators.quality import orphans
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 12)], "c long, p long")
    parent = spark.createDataFrame([(10,), (10,), (12,)], "id long")
    assert [r.c for r in orphans(child, parent, {"p": "id"}).collect()] == [2]
