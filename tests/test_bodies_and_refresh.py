"""Bodies to topic, and marts that are switched after their gate."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from envlake.plans.maintenance import logged, publish_marts, read_mart
from envlake.streaming.bodies import BODY, BodyFeed
from envlake.streaming.ingest import keep_counts, total_counts

AT = dt.datetime(2025, 7, 9, 18, 30)


def bodies(spark, *rows):
    return spark.createDataFrame([(i, s, 40.5, -73.25, "America/New_York", "OKX", "OKX", 30, 31, AT, text) for i, (s, text) in enumerate(rows)], BODY)


def published(spark, feed):
    return [(r.offset, json.loads(r.value)) for r in spark.read.schema("offset bigint, value string").json(feed.topic_path).orderBy("offset").collect()]


def test_a_repeated_batch_publishes_once(spark, tmp_path):
    feed = BodyFeed("airnow", "air", str(tmp_path / "t"), str(tmp_path / "r"))
    items = [{"ReportingArea": "Bay", "DateIssue": "2025-07-09", "DateForecast": "2025-07-10", "AQI": 40}, {"AQI": "bad"}]
    batch = bodies(spark, ("airnow", json.dumps(items)), ("airnow", "[{"), ("nws", "{}"), ("airnow", "[]"), ("airnow", None))
    for _ in range(2):
        assert feed.publish(spark, batch, 0) == {"batch_id": 0, "published": 1, "rejected": 3}
    (offset, value), = published(spark, feed)
    assert offset == 1 and value["raw_data"] == items[0] and value["aqi"] == 40
    bad = {(r.body_id, r.pos, r.error) for r in spark.read.parquet(feed.rejects_path).collect()}
    assert bad == {(0, 1, "type:AQI"), (1, -1, "malformed_body"), (4, -1, "malformed_body")}


def test_open_meteo_bodies_clock_change_short_arrays_and_current(spark, tmp_path):
    feed = BodyFeed("weather", "wx", str(tmp_path / "t"), str(tmp_path / "r"))
    body = {"hourly": {"time": ["2025-03-09T01:00", "2025-03-09T03:00"], "temperature_2m": [1.5], "is_day": [0, 1]}, "hourly_units": {"temperature_2m": "C"},
            "current": {"time": "2025-07-09T14:15", "temperature_2m": 28.0}, "current_units": {"temperature_2m": "C"}}
    feed.publish(spark, bodies(spark, ("weather", json.dumps(body)), ("weather", '{"hourly": {"time": "noon"}}'), ("weather", '{"current": {"time": "2025-07-09T14:15"}}')), 3)
    got = published(spark, feed)
    assert [(o & 1023, v["record_type"], v["open_meteo_start_time"], v["temperature"], v["is_day"]) for o, v in got] == [
        (0, "current", "2025-07-09T18:15:00Z", 28.0, None), (1, "forecast", "2025-03-09T06:00:00Z", 1.5, False),
        (2, "forecast", "2025-03-09T07:00:00Z", None, True), (0, "current", "2025-07-09T18:15:00Z", None, None)]
    assert [r.error for r in spark.read.parquet(feed.rejects_path).collect()] == ["missing:hourly.time"]


def test_nws_bodies(spark, tmp_path):
    feed = BodyFeed("nws", "wx", str(tmp_path / "t"), str(tmp_path / "r"))
    period = {"startTime": "2025-07-09T14:00:00-04:00", "endTime": "2025-07-09T15:00:00-04:00", "temperature": {"value": 28.5, "unitCode": "C"}}
    feed.publish(spark, bodies(spark, ("nws", json.dumps({"properties": {"periods": [period, period]}})), ("nws", '{"properties": {}}')), 0)
    got = published(spark, feed)
    assert [o for o, _ in got] == [1, 2] and got[0][1]["temperature"] == 28.5 and got[0][1]["office"] == "OKX"
    assert [r.error for r in spark.read.parquet(feed.rejects_path).collect()] == ["missing:properties.periods"]


def test_marts_are_switched_together_after_the_gate(spark, tmp_path):
    path = str(tmp_path / "m")
    assert read_mart(spark, path, "a") is None
    assert publish_marts(spark, path, {"a": spark.range(3), "b": spark.range(2)}) == {"a": 3, "b": 2}
    fails = spark.range(5).withColumn("id", F.when(F.col("id") < 9, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    for bad, why in ((spark.range(0), "empty marts: \\['b'\\]"), (fails, "lost")):
        with pytest.raises(Exception, match=why):
            publish_marts(spark, path, {"a": spark.range(9), "b": bad})
        assert [read_mart(spark, path, n).count() for n in "ab"] == [3, 2]
    publish_marts(spark, path, {"a": spark.range(4), "b": spark.range(1)})
    assert [read_mart(spark, path, n).count() for n in "ab"] == [4, 1]


def test_run_log_and_counts_survive_repeats(spark, tmp_path):
    log, counts = str(tmp_path / "log"), str(tmp_path / "c")
    assert logged(spark, log, "job", "1", lambda: 7) == 7
    with pytest.raises(ZeroDivisionError):
        logged(spark, log, "job", "2", lambda: 1 / 0)
    assert {(r.run_id, r.state, r.error_message) for r in spark.read.parquet(log).collect()} == {
        ("1", "success", None), ("2", "failed", "ZeroDivisionError: division by zero")}
    for b, n in ((0, 5), (1, 7), (1, 7)):
        keep_counts(spark, counts, {"batch_id": b, "read": n, "merged": n - 1})
    assert total_counts(spark, counts).first().asDict() == {"batches": 2, "read": 12, "merged": 10}
