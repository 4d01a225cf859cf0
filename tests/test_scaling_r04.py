"""What findings of round 4 asked for."""

import datetime as dt
import json

from pyspark.sql import functions as F

from envlake.operators import nested as N
from envlake.operators import validate as V
from envlake.session import apply_conf
from envlake.sources import airnow, open_meteo
from envlake.sources import openaq as O
from envlake.streaming.bodies import BODY, BodyFeed, body_events
from envlake.streaming.ingest import TOPIC_SCHEMA, process_batch
from envlake.streaming.pipelines import airnow_spec, open_meteo_spec
from envlake.streaming.store import read_table

from test_one_cast import TEXTS


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_message_is_parsed_once(spark):
    """Three things are taken out of the parsed text, which was parsed for each."""
    df = spark.createDataFrame([("{}",)], "value string")
    assert _plan(V.parsed(df, "value", "m")).count("parseJson") == 1
    assert _plan(V.judged(df, V.NWS_EVENT).where("error is null")).count("parseJson") == 1
    assert _plan(O.parse_envelopes(df)).count("parseJson") == 1


def test_plain_reading_has_no_lambda(spark):
    """Lambdas are interpreted an entry at a time; the values of a list are cast together."""
    m = V.parsed(spark.createDataFrame([("{}",)], "value string"), "value", "m").select(F.explode(F.array(N.plain_texts(O.ENVELOPE, "m"))).alias("x"))
    assert "lambdafunction" not in _plan(m.select(N.read_plain(O.ENVELOPE, "x").alias("p")))


def test_each_part_is_read_as_value_by_value(spark):
    """What is read by its texts and what is not make one struct, the same as all value by value; an odd part
    leaves the others to their texts."""
    odd = ["9007199254740993.0", "123456789012345678.0", '"9007199254740993"', "-5", '"-0"', "-0", "1e0", '"~none~"', "true", "null", '""', "[]", "{}"]
    texts = [*TEXTS, "7", "[]", "{", "null", "{}"]
    texts += ['{"location":{"id":%s,"country":{"id":%s},"owner":{},"provider":{},"coordinates":{}},"licenses":[{"openaq_license_id":1,"share_alike_required":%s,'
              '"license_date_from":%s},{"openaq_license_id":%s}],"sensors":[{"id":1,"parameter":%s},{"id":"2","parameter":{"name":%s,"id":%s}}],'
              '"latest":{"results":[{"locationsId":1,"sensorsId":%s,"datetime":{"utc":"2024-01-01"},"value":%s},{"locationsId":1,"sensorsId":2,'
              '"datetime":{"utc":"2024-01-02T00:00:00Z"},"value":"\\n[1"}]},"meta":{"version":%s}}' % (x, x, x, x if x[0] not in "19" else '"2024-02-30"', *[x] * 7) for x in odd]
    texts += [t.replace('"utc":"2024-01-01"', f'"utc":{x}') for t in texts[-len(odd):] for x in ('"2024"', "2024", '"2024-01-01,2024-01-02"', '"2024-13-01"')]
    df = V.parsed(spark.createDataFrame(list(enumerate(texts)), "i int, value string"), "value", "m")
    text = lambda c: F.to_json(F.struct(c.alias("e")), {"ignoreNullFields": "false"})
    a = {r.i: r.a for r in N.read_each(df, O.ENVELOPE, "m", "got").select("i", text(F.col("got")).alias("a")).collect()}
    b = {r.i: r.b for r in df.select("i", text(N.read_nested(O.ENVELOPE, "m")).alias("b")).collect()}
    assert a == b and len(a) == len(texts)


def test_methods_that_are_too_long_to_compile_are_not_made(spark):
    """HotSpot interprets a method of over 8,000 bytes; Spark's own limit is 65,535."""
    assert int(apply_conf(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


_AT = dt.datetime(2025, 5, 1, 12)


def _bodies(spark, service, *texts):
    return spark.createDataFrame([(i, service, 40.0, 1.5, "UTC", "o", "g", 1, 2, _AT, t) for i, t in enumerate(texts)], BODY)


AIRNOW = json.dumps([{"DateIssue": "2025-05-01", "DateForecast": "2025-05-02", "ReportingArea": "a", "AQI": 5, "Category": {"Number": 1, "Name": "Good"}}, {"AQI": "high"}, 7])
HOURS = json.dumps({"hourly": {"time": ["2025-05-01T00:00", "2025-05-01T01:00", "2025-05-01T02:00"], "pm2_5": [1.0, None, 3.0], "ozone": [4.0], "pm10": [1, 2, 3, 4]},
                    "current": {"time": "2025-05-01T02:15", "pm10": 9.0}})


def test_messages_and_bodies_are_not_kept_in_memory(spark, tmp_path, monkeypatch):
    """A batch of bodies, and of their messages, was persisted, which fills the executors' memory at size."""
    def kept(*_a, **_k):
        raise AssertionError("persisted")
    monkeypatch.setattr(type(spark.range(1)), "persist", kept)
    for service, text, spec, n, bad in (("airnow", AIRNOW, airnow_spec, 1, 3), ("air_quality", HOURS, lambda t, q: open_meteo_spec("air_quality", t, q), 4, 1)):
        root = str(tmp_path / service)
        feed = BodyFeed(service, "t", f"{root}/topic", f"{root}/rejects")
        assert feed.publish(spark, _bodies(spark, service, text, "{"), 0) == {"batch_id": 0, "published": n, "rejected": bad}
        msgs = spark.read.schema(TOPIC_SCHEMA).json(f"{root}/topic/batch_id=0")
        got = process_batch(spark, msgs, 0, spec(f"{root}/table", f"{root}/dlq"))
        assert got == {"batch_id": 0, "read": n, "malformed": 0, "dead_lettered": 0, "merged": n}
        assert read_table(spark, f"{root}/table").count() == n


def test_an_airnow_body_and_its_items_are_read_once(spark):
    """the body was parsed for the filter and for each use, an item for each of its fields."""
    events, bad = airnow.items_to_events(_bodies(spark, "airnow", AIRNOW), "body", keep_cols=("body_id",))
    assert _plan(events).count("parseJson") == 1 and _plan(events).count("from_json") == 1
    assert _plan(bad).count("from_json") == 1
    assert [r.error for r in bad.orderBy("item_pos").collect()] == ["type:AQI", "malformed_item"] and events.count() == 1


def test_hours_do_not_carry_the_arrays(spark):
    """every hour of a body was a row with all arrays of the body, and a body was read for each array."""
    events, _ = body_events(_bodies(spark, "air_quality", HOURS), "air_quality")
    assert _plan(events).count("from_json") <= 2  # the hours, and the current conditions
    todo, held = [events._jdf.queryExecution().optimizedPlan()], 0
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Generate" and "posexplode" in node.toString().splitlines()[0]:
            held += 1
            types = [node.output().apply(i).dataType().typeName() for i in range(node.output().size())]
            assert "array" not in types
    assert held == 1
    rows = events.where("record_type = 'forecast'").orderBy("pos").select("pm2_5", "ozone", "pm10").collect()
    assert [tuple(r) for r in rows] == [(1.0, 4.0, 1.0), (None, None, 2.0), (3.0, None, 3.0)]
    none = spark.createDataFrame([(1,)], "i int").select(F.from_json(F.lit('{"hourly":{"pm10":[1]}}'), "hourly struct<time: array<string>, pm10: array<double>>, hourly_units struct<pm10: string>").alias("raw"),
                                                         F.lit(1.0).alias("latitude"), F.lit(1.0).alias("longitude"), F.lit("UTC").alias("timezone"), F.lit(_AT).alias("ingest_dt"))
    assert open_meteo.hourly_events(none, "air_quality").count() == 0
