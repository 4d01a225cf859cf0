import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envlake.operators.validate import parse_message
from envlake.sources import airnow, nws, open_meteo, openaq
from envlake.sources.publish import to_messages, write_messages

FETCHED = dt.datetime(2025, 7, 9, 18, 30, 45, 250_000)
NWS_SCHEMA = T.StructType([T.StructField("raw", T.StringType()), T.StructField("meta", nws.META), T.StructField("ingest_dt", T.TimestampType())])


def quantity(value, low=None, high=None, unit="wmoUnit:percent"):
    return {"value": value, "minValue": low, "maxValue": high, "unitCode": unit}


def nws_frame(spark, periods, meta=("ZZT", 3, 88, "ZZT")):
    raw = json.dumps({"properties": {"periods": periods}}) if periods is not None else json.dumps({"properties": {}})
    return spark.createDataFrame([(raw, meta, FETCHED)], NWS_SCHEMA)


def test_nws_quantities_become_four_columns(spark):
    hour = {"startTime": "2025-07-09T14:00:00+05:30", "endTime": "2025-07-09T15:00:00+05:30", "isDaytime": True,
            "relativeHumidity": quantity(71.5, 70, 73), "dewpoint": quantity(0, unit="wmoUnit:degC"), "windGust": None,
            "probabilityOfPrecipitation": {"value": 5, "unitCode": "wmoUnit:percent"}, "unknownField": {"x": 1}}
    later = {**hour, "startTime": "2025-07-09T15:00:00+05:30", "endTime": "2025-07-09T16:00:00+05:30", "relativeHumidity": quantity(None)}
    first, second = nws.periods_to_events(nws_frame(spark, [hour, later])).orderBy("start_time").collect()
    assert (first.relative_humidity, first.relative_humidity_min, first.relative_humidity_max, first.relative_humidity_unit) == (71.5, 70.0, 73.0, "wmoUnit:percent")
    assert (first.dewpoint, first.dewpoint_unit, first.dewpoint_max) == (0.0, "wmoUnit:degC", None)
    assert (first.wind_gust, first.wind_gust_unit, first.temperature) == (None, None, None)
    assert second.relative_humidity is None and second.relative_humidity_unit == "wmoUnit:percent"
    assert first.event_id == "ZZT:3,88:2025-07-09T14:00:00+05:30-2025-07-09T15:00:00+05:30"
    assert first.ingested_at == "2025-07-09T18:30:45Z"


def test_nws_without_periods_or_grid(spark):
    assert nws.periods_to_events(nws_frame(spark, None)).count() == 0
    assert nws.periods_to_events(nws_frame(spark, [])).count() == 0
    r = nws.periods_to_events(nws_frame(spark, [{"startTime": "2025-07-09T00:00:00Z"}], meta=(None, None, 4, None))).first()
    assert r.event_id.startswith("unknown:unknown,4:") and r.end_time is None


def test_nws_record_flags_bad_values(spark):
    ev = nws.periods_to_events(nws_frame(spark, [{"startTime": "2025-07-09T14:00:00+05:30", "endTime": "2025-07-09T15:00:00Z", "windSpeed": quantity(12)},
                                                 {"startTime": "noon", "endTime": "2025-07-09T15:00:00Z"}, {"endTime": "2025-07-09T15:00:00Z"}]))
    got = {r.error: r for r in nws.event_to_record(ev).collect()}
    assert got[None].start_time == dt.datetime(2025, 7, 9, 8, 30) and got[None].wind_speed == 12.0
    assert set(got) == {None, "type:start_time", "missing:start_time"}
    text = ev.withColumn("wind_speed", F.lit("brisk"))
    assert {r.error for r in nws.event_to_record(text.where("start_time like '2025%'")).collect()} == {"type:wind_speed"}


AIR_HOURS = {"time": ["2025-03-30T01:00", "2025-03-30T03:00", "2025-03-30T04:00"], "pm10": [12.25, None, 14.0], "ozone": [60.0, 61.0]}
AIR_SCHEMA = T.StructType([
    T.StructField("hourly", T.StructType([T.StructField("time", T.ArrayType(T.StringType())), T.StructField("pm10", T.ArrayType(T.DoubleType())),
                                          T.StructField("ozone", T.ArrayType(T.DoubleType()))])),
    T.StructField("hourly_units", T.StructType([T.StructField("pm10", T.StringType())])),
    T.StructField("current", T.StructType([T.StructField("time", T.StringType()), T.StructField("ozone", T.DoubleType())])),
    T.StructField("current_units", T.StructType([T.StructField("ozone", T.StringType())]))])


def air_frame(spark, payload):
    return (spark.createDataFrame([(json.dumps(payload), 52.5, 13.375, "Europe/Berlin", FETCHED)],
                                  "raw string, latitude double, longitude double, timezone string, ingest_dt timestamp")
            .withColumn("raw", F.from_json("raw", AIR_SCHEMA)))


def test_open_meteo_hours_are_local_and_arrays_may_be_short(spark):
    """The clock goes forward between the first two hours; ozone has no third value."""
    ev = open_meteo.payload_events(air_frame(spark, {"hourly": AIR_HOURS, "hourly_units": {"pm10": "ug"}}), "air_quality").orderBy("open_meteo_start_time").collect()
    assert [e.open_meteo_start_time for e in ev] == ["2025-03-30T00:00:00Z", "2025-03-30T01:00:00Z", "2025-03-30T02:00:00Z"]
    assert [e.open_meteo_end_time for e in ev][0] == "2025-03-30T01:00:00Z"
    assert [(e.pm10, e.ozone, e.us_aqi) for e in ev] == [(12.25, 60.0, None), (None, 61.0, None), (14.0, None, None)]
    assert {(e.pm10_unit, e.ozone_unit, e.record_type, e.record_frequency_min) for e in ev} == {("ug", None, "forecast", 60)}
    assert ev[0].event_id == "open-meteo:air_quality:forecast:52.5000:13.3750:2025-03-30T00:00:00Z"


def test_open_meteo_current_lasts_a_quarter_hour(spark):
    now = {"time": "2025-07-09T20:15", "ozone": 88.5}
    both = open_meteo.payload_events(air_frame(spark, {"hourly": AIR_HOURS, "hourly_units": {}, "current": now, "current_units": {"ozone": "ug"}}), "air_quality")
    cur = both.where("record_type = 'current'").collect()
    assert [(c.open_meteo_start_time, c.open_meteo_end_time, c.ozone, c.ozone_unit, c.pm10) for c in cur] == [
        ("2025-07-09T18:15:00Z", "2025-07-09T18:30:00Z", 88.5, "ug", None)]
    assert both.count() == 4
    assert open_meteo.payload_events(air_frame(spark, {"hourly": {"time": []}, "hourly_units": {}}), "air_quality").count() == 0


def test_open_meteo_routes_and_records(spark):
    ev = open_meteo.payload_events(air_frame(spark, {"hourly": AIR_HOURS, "hourly_units": {}}), "air_quality")
    blank = ev.limit(1).withColumns({"data_kind": F.lit(""), "record_type": F.lit("air_quality")})
    tide = ev.limit(1).withColumn("data_kind", F.lit("tide"))
    none = ev.limit(1).withColumns({"data_kind": F.lit(None).cast("string"), "record_type": F.lit(None).cast("string")})
    w, a, bad = open_meteo.route_by_kind(ev.unionByName(blank).unionByName(tide).unionByName(none))
    assert (w.count(), a.count(), bad.count()) == (0, 4, 2)
    rec = open_meteo.event_to_record(a, "air_quality")
    assert rec.where("error is not null").count() == 0
    assert rec.agg(F.min("open_meteo_start_time")).first()[0] == dt.datetime(2025, 3, 30, 0, 0)
    lost = open_meteo.event_to_record(a.withColumn("latitude", F.lit(None).cast("double")), "air_quality")
    assert {r.error for r in lost.collect()} == {"missing:coordinates"}


def test_airnow_items_and_bodies(spark):
    good = {"ReportingArea": "North Shore", "DateIssue": "2025-07-09", "DateForecast": "2025-07-10 ", "AQI": "101", "ActionDay": "TRUE",
            "Category": {"Number": 3, "Name": "Unhealthy for Sensitive Groups"}, "Latitude": -33.8}
    items = [good, "foo", 5, None, [good], {**good, "AQI": 1.5}, {**good, "Category": {"Number": "three"}},
             {"DateIssue": "2025-07-09", "ActionDay": "maybe"}, {"ReportingArea": "B", "ActionDay": False}]
    bodies = [json.dumps(items), "[]", "not json", '{"ReportingArea": "x"}', json.dumps([good])[:-4], json.dumps([good]) + " tail", None]
    df = spark.createDataFrame(list(enumerate(bodies)), "n int, items string")
    events, rejected = airnow.items_to_events(df, keep_cols=("n",))
    ev = {r.item_pos: r for r in events.collect()}
    assert sorted(ev) == [0, 7, 8]
    assert ev[0].event_id.startswith("airnow:NorthShore:2025-07-09:2025-07-10") and (ev[0].aqi, ev[0].category_number, ev[0].action_day) == (101, 3, True)
    assert (ev[7].reporting_area, ev[7].action_day, ev[7].aqi) == ("unknown", False, None) and ev[8].action_day is False
    assert json.loads(ev[0].raw_data) == good
    bad = sorted((r.n, r.item_pos, r.error) for r in rejected.collect())
    assert bad == [(0, 1, "malformed_item"), (0, 2, "malformed_item"), (0, 3, "malformed_item"), (0, 4, "malformed_item"), (0, 5, "type:AQI"),
                   (0, 6, "type:Category.Number"), *[(n, -1, "malformed_body") for n in (2, 3, 4, 5, 6)]]


def test_parse_message_wants_one_whole_value(spark):
    texts = ['{"a":1}', " [1, 2] ", "3", '"s"', '{"a":1} x', '{"a":', "", "1, 2", None]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, value string").select("i", parse_message(F.col("value")).isNotNull().alias("ok")).collect()
    assert [r.ok for r in sorted(got)] == [True] * 4 + [False] * 5


def test_sensor_map_keeps_last_values_and_first_place(spark):
    s = spark.createDataFrame([("A", "7", 0, "no2"), ("A", "", 1, "x"), ("A", "9", 2, "so2"), ("A", None, 3, "x"), ("A", "7", 4, "no"), ("B", "7", 0, "co")],
                              "place string, id string, pos int, param string")
    got = {(r.place, r.id): (r.param, r.first_pos) for r in openaq.sensor_map(s, "place", "id", "pos", ["param"]).collect()}
    assert got == {("A", "7"): ("no", 0), ("A", "9"): ("so2", 2), ("B", "7"): ("co", 0)}


def envelope(**over):
    base = {"location": {"id": "41", "name": "Pier", "country": {"id": 9, "code": "NZ"}, "coordinates": {"latitude": -41.3, "longitude": 174.8}},
            "licenses": [{"openaq_license_id": "12", "name": "open", "commercial_use_allowed": True, "license_attribution_name": "Council", "license_date_from": "2020-02-03"}],
            "sensors": [{"id": "501", "parameter": {"id": 2, "name": "pm25", "displayName": "PM2.5", "units": "ug"}}, {"id": 502}],
            "latest": {"results": [{"locationsId": 41, "sensorsId": 501, "datetime": {"utc": "2025-07-09T18:00:00Z"}, "value": -1.0}]},
            "meta": {"source": "openaq", "version": "v3"}}
    return json.dumps({**base, **over})


def test_envelopes_are_taken_or_refused_whole(spark):
    result = {"locationsId": 41, "sensorsId": 501, "datetime": {"utc": "2025-07-09T18:00:00Z"}, "value": 2.0}
    cases = [(envelope(), None), (envelope(licenses=None, sensors=None, latest=None), None), (envelope(licenses="", sensors=0, latest=False, meta=None), None),
             (envelope(location={"id": "4x"}), "invalid:location.id"), (envelope(location={}), "invalid:location.id"), (envelope(location="Pier"), "invalid:location"),
             (envelope(location={"id": 4, "country": "NZ"}), "invalid:location.country"), (envelope(location={"id": 4, "coordinates": {"latitude": "north"}}), "invalid:location.coordinates.latitude"),
             (envelope(location={"id": 4, "firstSeenAt": "once"}), "invalid:location.firstSeenAt"), (envelope(location={"id": 4, "name": ["Pier"]}), "invalid:location.name"),
             ("{", "malformed_json"), (envelope() + " x", "malformed_json"), (envelope()[:-9], "malformed_json"), ("[1]", "not_an_object"), ("7", "not_an_object"),
             (envelope(licenses=[{"openaq_license_id": None}]), "invalid:licenses[0].openaq_license_id"), (envelope(licenses={"a": 1}), "invalid:licenses"),
             (envelope(licenses=[{"openaq_license_id": 1, "commercial_use_allowed": "yes"}]), "invalid:licenses[0].commercial_use_allowed"),
             (envelope(sensors=[{"id": "501"}, {"id": "a"}]), "invalid:sensors[1].id"), (envelope(sensors="bad"), "invalid:sensors"),
             (envelope(sensors=[5]), "invalid:sensors[0]"), (envelope(sensors=[{"id": 1, "parameter": "pm"}]), "invalid:sensors[0].parameter"),
             (envelope(latest={"results": [result, {**result, "sensorsId": 0}]}), "missing:latest.results[1].sensorsId"),
             (envelope(latest={"results": [{**result, "locationsId": None}]}), "missing:latest.results[0].locationsId"),
             (envelope(latest={"results": "none"}), "invalid:latest.results"), (envelope(latest="now"), "invalid:latest"),
             (envelope(latest={"results": [{**result, "datetime": {}}]}), "missing:latest.results[0].datetime.utc"),
             (envelope(latest={"results": [{**result, "datetime": {"utc": "noon"}}]}), "invalid:latest.results[0].datetime.utc"),
             (envelope(meta=None), "missing:meta"), (envelope(meta="v3"), "invalid:meta"), (envelope(meta={}), None)]
    got = openaq.parse_envelopes(spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "n int, value string"))
    assert {r.n: r.error for r in got.collect()} == {i: e for i, (_, e) in enumerate(cases)}
    ok = got.where("n < 2")
    loc = {r.n: r for r in openaq.location_rows(ok, ["n"]).collect()}
    assert (loc[0].openaq_locations_id, loc[0].country_code, loc[0].owner_id, loc[0].latitude) == (41, "NZ", None, -41.3)
    lic = openaq.license_rows(ok, ["n"]).collect()
    assert [(r.n, r.openaq_license_id, r.license_date_from_dtz, r.attribution_required) for r in lic] == [(0, 12, dt.datetime(2020, 2, 3), None)]
    assert [(r.pos, r.openaq_sensors_id, r.parameter_name) for r in openaq.sensor_rows(ok, ["n"]).collect()] == [(0, 501, "pm25"), (1, 502, None)]
    m = openaq.measurement_rows(ok, ["n"]).collect()
    assert [(r.event_id, r.is_valid, r.quality_status) for r in m] == [("41:501:openaq.locations.latest:2025-07-09T18:00:00Z", False, "negative_value")]


def test_values_of_envelopes_by_json_type(spark):
    readings = [12.5, "12.5", " 7 ", True, False, "n/a", None, [1], {"a": 1}, -3, "-3", 0, "", 10 ** 15]
    want = [(12.5, None), (12.5, None), (7.0, None), (1.0, None), (0.0, None), (None, "non_numeric_value"), (None, "missing_value"), (None, "non_numeric_value"),
            (None, "non_numeric_value"), (-3.0, "negative_value"), (-3.0, "negative_value"), (0.0, None), (None, "non_numeric_value"), (1e15, None)]
    result = {"locationsId": 41, "sensorsId": 501, "datetime": {"utc": "2025-07-09T18:00:00Z"}}
    loc = {"id": 41.9, "name": 5, "country": {"id": "7"}, "owner": {"id": 2.6}, "coordinates": {"latitude": "-41.5"}, "firstSeenAt": 86400}
    value = envelope(location=loc, latest={"results": [{**result, "value": v} for v in readings]}, licenses=[{"openaq_license_id": True, "share_alike_required": 1}])
    env = openaq.parse_envelopes(spark.createDataFrame([(0, value)], "n int, value string"))
    assert env.first().error is None
    assert [(r.value, r.quality_status) for r in openaq.measurement_rows(env, ["n"]).orderBy("pos").collect()] == want
    r = openaq.location_rows(env, ["n"]).first()
    assert (r.openaq_locations_id, r.name, r.country_id, r.owner_id, r.latitude, r.first_seen_at_dtz) == (41, "5", 7, 3, -41.5, dt.datetime(1970, 1, 2))
    assert [(x.openaq_license_id, x.share_alike_required) for x in openaq.license_rows(env, ["n"]).collect()] == [(1, True)]


def test_licenses_are_enriched(spark):
    lic = spark.createDataFrame([("12", "Council"), ("13", None), ("", "x"), ("0", "x"), (None, "x")], "openaq_license_id string, license_attribution_name string")
    meta = spark.createDataFrame([("12", "open", True, None)], "openaq_license_id string, name string, commercial_use_allowed boolean, attribution_required boolean")
    got = {r.openaq_license_id: r for r in openaq.enrich_licenses(lic, meta, attribution=("license_attribution_name",)).collect()}
    assert set(got) == {"12", "13"}
    assert (got["12"].name, got["12"].commercial_use_allowed, got["12"].attribution_required, got["12"].share_alike_required) == ("open", True, False, False)
    assert (got["13"].license_attribution_name, got["13"].name, got["13"].commercial_use_allowed) == ("", None, False)


def test_a_long_list_goes_on_in_further_envelopes(spark):
    places = openaq.location_minimal(spark.createDataFrame([(1, "Pier"), (2, "Quay"), (3, "Mole")], "k long, n string"), id=F.col("k"), name=F.col("n"))
    lic = spark.createDataFrame([(1, 0, "5"), (2, 0, "6")], "k long, pos int, openaq_license_id string")
    sen = spark.createDataFrame([(k, i, str(i)) for k, n in ((1, 4), (2, 23)) for i in reversed(range(n))], "k long, pos int, id string")
    res = spark.createDataFrame([(2, i, i) for i in range(11)], "k long, pos int, sensorsId long")
    build = lambda m: openaq.build_envelopes(places.select("k", "location"), "k", lic, sen, res, "s", "v", max_items=m).collect()
    whole = {r.k: r for r in build(100)}
    assert len(whole) == 3 and [x.id for x in whole[2].sensors] == [str(i) for i in range(23)] and whole[3].licenses == whole[3].sensors == []
    parts = sorted(build(10), key=lambda r: (r.k, r.part))
    assert [(r.k, r.part, len(r.licenses), len(r.sensors), len(r.latest.results)) for r in parts] == [
        (1, 0, 1, 4, 0), (2, 0, 1, 10, 10), (2, 1, 0, 10, 1), (2, 2, 0, 3, 0), (3, 0, 0, 0, 0)]
    assert [x for r in parts if r.k == 2 for x in r.sensors] == whole[2].sensors and {r.location.name for r in parts if r.k == 2} == {"Quay"}


def test_nearest_location_zero_distance_is_real(spark):
    c = spark.createDataFrame([("p", 70, 0.0), ("p", 80, 0.1), ("p", 60, None), ("q", 30, None), ("r", 9, 4.0), ("r", 8, 4.0)], "req string, id int, distance double")
    assert {r.req: r.id for r in openaq.nearest_location(c, "req").collect()} == {"p": 70, "q": 30, "r": 8}


def test_publish_keeps_null_fields_and_counts(spark, tmp_path):
    msgs = to_messages(spark.createDataFrame([(None, "buoy"), (6, None)], "id int, name string"), "id", ["id", "name"], "t")
    assert {(r.key, r.value) for r in msgs.collect()} == {("unknown", '{"id":null,"name":"buoy"}'), ("6", '{"id":6,"name":null}')}
    assert write_messages(msgs, str(tmp_path / "out")) == 2 and spark.read.json(str(tmp_path / "out")).count() == 2


def test_fixed_suites_run_on_declared_schema(spark):
    from envlake import schemas
    from envlake.operators import quality as Q
    empty = spark.createDataFrame([], schemas.TABLES["stg_weather_hourly_forecast"])
    res = Q.run_suite(empty, "nws", Q.NWS_SUITE)
    assert res.count() == len(Q.NWS_SUITE)
    assert Q.suite_verdict(res).first().success is True
