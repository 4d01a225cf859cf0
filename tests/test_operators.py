import datetime as dt
import random

from conftest import SF_SMALL

from pyspark.sql import Window
from pyspark.sql import functions as F

from envlake.operators.dedupe import first_per_key, last_wins
from envlake.operators.geo import nearest_geo
from envlake.operators.latest import latest_per_group
from envlake.operators.nearest_time import nearest_in_time
from envlake.operators.scd2 import scd2_merge
from envlake.operators.upsert import ORDER_COL, upsert_by_key
from envlake.operators.validate import EventSpec, validate
from envlake.operators import quality as Q

T0 = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_per_group_keeps_ties_and_matches_window(spark):
    data = [(1, "a", T0), (1, "a", T0), (1, "a", T0 - dt.timedelta(hours=1)), (2, "a", T0 - dt.timedelta(days=3)),
            (2, "b", T0 - dt.timedelta(hours=5))]
    df = spark.createDataFrame(data, "loc int, sen string, ts timestamp")
    cut = F.lit(T0 - dt.timedelta(days=1)).cast("timestamp")
    got = latest_per_group(df, ["loc", "sen"], "ts", min_ts=cut)
    w = Window.partitionBy("loc", "sen")
    ref = (df.withColumn("mx", F.max("ts").over(w)).where((F.col("ts") == F.col("mx")) & (F.col("ts") >= cut))
           .drop("mx"))
    assert rows(got) == rows(ref)
    assert len(rows(got)) == 3


def test_first_per_key_matches_row_number(spark):
    random.seed(1)
    data = [(random.randint(0, 5), random.choice([None, 1, 2, 3]), i) for i in range(200)]
    df = spark.createDataFrame(data, "k int, o int, id int")
    for keep, spec, order in (("first", "asc_nulls_last", [F.col("o").asc_nulls_last(), F.col("id").asc()]),
                              ("last", "asc_nulls_last", [F.col("o").desc_nulls_first(), F.col("id").desc()]),
                              ("first", "desc_nulls_first", [F.col("o").desc_nulls_first(), F.col("id").desc()])):
        got = first_per_key(df, ["k"], [("o", spec), ("id", spec)], keep=keep)
        ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order))) \
            .where("rn = 1").drop("rn")
        assert rows(got) == rows(ref), (keep, spec)


def test_upsert_batch_split_and_replay_invariance(spark):
    random.seed(2)
    data = [(random.randint(0, 9), i, random.choice([None, 1.0, 2.0, 3.0]), T0 + dt.timedelta(minutes=i))
            for i in range(120)]
    df = spark.createDataFrame(data, "k int, seq int, v double, ts timestamp")
    pol = {"v": "coalesce", "first_seq": "keep", "touched": "touch"}
    prep = df.withColumn("first_seq", F.col("seq"))

    def run(splits):
        base = None
        for lo, hi in splits:
            b = prep.where((F.col("seq") >= lo) & (F.col("seq") < hi))
            base = upsert_by_key(base, b, ["k"], ["seq"], pol, clock_col="ts", columns=["v", "first_seq", "touched"])
            base = base.checkpoint(eager=True)
        return base
    one = run([(0, 120)])
    four = run([(0, 7), (7, 50), (50, 51), (51, 120)])
    assert rows(one) == rows(four)
    replay = upsert_by_key(four, prep.where("seq >= 51"), ["k"], ["seq"], pol, clock_col="ts",
                           columns=["v", "first_seq", "touched"])
    assert rows(replay) == rows(four)
    # coalesce keeps the last non-null value; keep keeps the first seq
    exp = {}
    for k, seq, v, ts in sorted(data, key=lambda r: r[1]):
        e = exp.setdefault(k, {"v": None, "first": seq, "n": 0, "last_ts": None})
        if v is not None:
            e["v"] = v
        e["n"] += 1
        e["last_ts"] = ts
    got = {r.k: r for r in one.drop(ORDER_COL).collect()}
    for k, e in exp.items():
        assert got[k].v == e["v"] and got[k].first_seq == e["first"]
        assert got[k].touched == (e["last_ts"] if e["n"] > 1 else None)


def _scd2_reference(data):
    """Sequential version counting in plain Python (the brute-force model)."""
    out = {}
    for k, a, b, seq, clock in sorted(data, key=lambda r: r[3]):
        vers = out.setdefault(k, [])
        if vers and (vers[-1]["a"], vers[-1]["b"]) == (a, b):
            vers[-1]["touch"] = clock
            continue
        if vers:
            vers[-1]["end"] = clock
        vers.append({"a": a, "b": b, "start": clock, "end": None, "touch": clock})
    return sorted(((k, v["a"], v["b"], v["start"], v["end"], v["end"] is None, v["touch"])
                   for k, vs in out.items() for v in vs), key=repr)


def test_scd2_matches_sequential_model_for_any_split(spark):
    random.seed(3)
    data = [(random.randint(0, 5), random.choice(["x", "y", None]), random.choice([1, 2]), i,
             T0 + dt.timedelta(hours=i // 2)) for i in range(120)]
    df = spark.createDataFrame(data, "k int, a string, b int, seq int, clock timestamp")
    ref = _scd2_reference(data)
    for splits in ([(0, 120)], [(0, 10), (10, 11), (11, 80), (80, 120)]):
        dim = None
        for lo, hi in splits:
            b = df.where((F.col("seq") >= lo) & (F.col("seq") < hi))
            dim = scd2_merge(dim, b, ["k"], ["a", "b"], ["seq"], "clock", "sk", "t",
                             touch_cols=["touched"], bucket=F.floor(F.col("seq") / 7)).checkpoint(eager=True)
        got = sorted(((r.k, r.a, r.b, r.effective_start_at_dtz, r.effective_end_at_dtz, r.is_current, r.touched)
                      for r in dim.collect()), key=repr)
        assert got == ref
        cur = dim.where("is_current").groupBy("k").count().where("count > 1").count()
        assert cur == 0
        assert dim.select("sk").distinct().count() == dim.count()


def test_scd2_ignores_replayed_and_late_rows(spark):
    cols = "k int, a string, seq int, clock timestamp"
    feed = [(1, "x", 1, T0), (1, "y", 2, T0 + dt.timedelta(days=1)), (2, "x", 3, T0), (None, "x", 4, T0)]
    first, late = spark.createDataFrame(feed, cols), spark.createDataFrame([(1, "z", 0, T0 - dt.timedelta(days=3))], cols)
    dim = None
    for b in (first, first, late, first):
        dim = scd2_merge(dim, b, ["k"], ["a"], ["seq"], "clock", "sk", "t", touch_cols=["touched"]).checkpoint(eager=True)
    got = sorted((r.k, r.a, r.effective_start_at_dtz, r.effective_end_at_dtz, r.is_current) for r in dim.collect())
    assert got == [(1, "x", T0, T0 + dt.timedelta(days=1), False), (1, "y", T0 + dt.timedelta(days=1), None, True),
                   (2, "x", T0, None, True)]
    assert dim.where("effective_end_at_dtz < effective_start_at_dtz").count() == 0


def test_scd2_plan_exchanges_the_batch_once(spark):
    from envlake.operators.scd2 import scd2_step
    cur = spark.read.schema("k bigint, a string, sk bigint, effective_start_at_dtz timestamp, effective_end_at_dtz timestamp, "
                            "is_current boolean, _order struct<seq:bigint>").parquet(f"{SF_SMALL}/orders.parquet")
    upd = spark.read.parquet(f"{SF_SMALL}/orders.parquet").selectExpr("o_custkey k", "o_orderstatus a", "o_orderkey seq", "o_orderdate clock")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        step = scd2_step(None, upd, ["k"], ["a"], ["seq"], "clock", "sk", "t")
        plan = step._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 4, plan   # batch, summary by key, and back (reused scans aside)
        assert "CartesianProduct" not in scd2_step(cur, upd, ["k"], ["a"], ["seq"], "clock", "sk", "t")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nearest_in_time_matches_brute_force(spark):
    random.seed(4)
    left = [(i, random.randint(0, 3), T0 + dt.timedelta(seconds=random.randint(0, 10 * 86400))) for i in range(150)]
    right = [(1000 + i, random.randint(0, 4), T0 + dt.timedelta(seconds=random.randint(0, 10 * 86400)), float(i))
             for i in range(40)]
    L = spark.createDataFrame(left, "id int, k int, ts timestamp")
    R = spark.createDataFrame(right, "rid int, k int, ts timestamp, v double")
    got = nearest_in_time(L, R, ["k"], "ts", "ts", ["rid", "v"], right_tiebreak="rid", bucket_seconds=3600)
    g = {r.id: r.r_rid for r in got.collect()}
    for i, k, ts in left:
        cands = [(abs((ts - rts).total_seconds()), 0 if rts <= ts else 1, rts, rid) for rid, rk, rts, _ in right
                 if rk == k]
        exp = min(cands)[3] if cands else None
        assert g[i] == exp, i


def test_nearest_geo_matches_brute_force(spark):
    random.seed(5)
    P = [(i, 40 + random.random() * 0.3, -90 + random.random() * 0.3) for i in range(300)]
    Q_ = [(j, 40 + random.random() * 0.3, -90 + random.random() * 0.3) for j in range(200)]
    probes = spark.createDataFrame(P, "pid int, latitude double, longitude double")
    points = spark.createDataFrame(Q_, "qid int, latitude double, longitude double")
    got = {r.pid: r.match_id for r in nearest_geo(probes, points, "pid", "qid").collect()}
    import math

    def km(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        x = math.cos(a) * math.cos(c) * math.cos(d - b) + math.sin(a) * math.sin(c)
        return 6371.0 * math.acos(max(-1.0, min(1.0, x)))
    for pid, la, lo in P:
        c = [(km(la, lo, qa, qo), qid) for qid, qa, qo in Q_ if abs(qa - la) <= 0.05 and abs(qo - lo) <= 0.05]
        best = min(c) if c else None
        exp = best[1] if best and best[0] <= 2.0 else None
        assert got[pid] == exp


def test_validate_split_errors(spark):
    spec = EventSpec("t", {"event_id": "string", "source": "string", "n": "int", "kind": "string", "raw": "object", "b": "boolean"},
                     required=("event_id", "source"), literals={"kind": "weather"})
    cases = [('{"event_id": "a", "source": "s", "n": 1, "kind": "weather", "extra": 5}', None),
             ('{"event_id": "b", "n": "2", "kind": "weather"}', "missing:source"),
             ('{"event_id": "c", "source": "s", "n": 1.5}', "type:n"), ("nope", "malformed_json"),
             ('{"event_id": "d", "source": "s", "kind": "air"}', "literal:kind"), ('{"event_id": "e", "source": "s", "n": "3"}', None),
             ('{"event_id": 12, "source": "s"}', "type:event_id"), ('{"event_id": true, "source": "s"}', "type:event_id"),
             ('{"event_id": ["x"], "source": "s"}', "type:event_id"), ('{"event_id": "f", "source": null}', "missing:source"),
             ('{"event_id": "g", "source": "s"} trailing', "malformed_json"), ('{"event_id": "h", "sour', "malformed_json"),
             ('{"event_id": "i", "source": "s"}], [2', "malformed_json"), ("5", "not_an_object"), ('["x"]', "not_an_object"), (None, "malformed_json"),
             ('{"event_id": "j", "source": "s", "raw": "text"}', "type:raw"), ('{"event_id": "k", "source": "s", "raw": {"z": [1]}}', None),
             ('{"event_id": "l", "source": "s", "b": 2}', "type:b"), ('{"event_id": "m", "source": "s", "b": "Yes"}', None),
             ('{"event_id": "n", "source": "s", "n": 1e3}', None), ('{"event_id": "o", "source": "s", "n": true}', "type:n")]
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(cases)], "offset long, value string")
    got = validate(df, spec, keep_cols=("offset",))
    valid = {r.offset: r for r in got.valid.collect()}
    errors = {r.offset: r.error for part in (got.rejected, got.malformed) for r in part.collect()}
    assert errors == {i: e for i, (_, e) in enumerate(cases) if e}
    assert sorted(valid) == [i for i, (_, e) in enumerate(cases) if not e]
    assert (valid[0].n, valid[5].n, valid[20].n, valid[17].raw, valid[19].b) == (1, 3, 1000, '{"z":[1]}', True)
    assert {r.error for r in got.malformed.collect()} == {"malformed_json"} and "extra" not in got.valid.columns


def test_quality_suite_mostly_and_accepted_range(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (200.0,), (None,)], "x double")
    res = {r.check + r.column_name: r for r in Q.run_suite(df, "t", [
        Q.Check("between", "x", 0, 100, mostly=0.6), Q.Check("not_null", "x")]).collect()}
    assert res["betweenx"].unexpected == 1 and res["betweenx"].nonnull == 3 and res["betweenx"].success
    assert res["not_nullx"].unexpected == 1 and not res["not_nullx"].success
    assert Q.accepted_range(df, "x", 2, 100).count() == 2          # one below, one above, NULL never
    assert Q.accepted_range(df, "x", 2, 100, combine="and").count() == 0
    assert Q.accepted_range(df, "x", max_value=100).count() == 1
