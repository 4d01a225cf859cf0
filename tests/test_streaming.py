from pyspark.sql import functions as F

from envlake.streaming.dlq import dead_letter_records
from envlake.streaming.replay import replay_events_as_stream

from conftest import SF_SMALL


def test_stream_replay_equals_last_wins(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    got = replay_events_as_stream(spark, ev, files=4, files_per_batch=1)
    exp = (ev.groupBy("user_id", "event_type")
           .agg(F.max_by(F.struct("event_id", "ts", "value"), F.struct("ts", "event_id")).alias("r"))
           .select("user_id", "event_type", "r.*"))
    cols = ["user_id", "event_type", "event_id", "ts", "value"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, exp.select(*cols).collect()))


def test_dead_letter_record_shape(spark):
    rej = spark.createDataFrame([("k1", "t", 0, 5, "boom", '{"bad": "json"}')],
                                "key string, topic string, partition int, offset long, error string, raw_value string")
    r = dead_letter_records(rej).first()
    assert (r.key, r.original_topic, r.partition, r.offset, r.error, r.raw_value) == (
        "k1", "t", 0, 5, "boom", '{"bad": "json"}')
    assert r.ts_utc.endswith("Z")


def test_bootstrap_refresh_gate_and_run_log(spark, tmp_path):
    import datetime as dt
    import pytest
    from envlake import schemas
    from envlake.plans import maintenance as MT
    root = str(tmp_path)
    MT.bootstrap_tables(spark, root, {"stg_open_meteo_air": schemas.TABLES["stg_open_meteo_air"]})
    assert spark.read.parquet(f"{root}/stg_open_meteo_air").count() == 0
    paths = MT.refresh_marts({"m1": spark.range(3), "m2": spark.range(0)}, root)
    with pytest.raises(RuntimeError):
        MT.verify_marts(spark, paths)
    assert MT.log_run(spark, f"{root}/runs", "job", "r1", "success", dt.datetime(2024, 1, 1))
    assert spark.read.parquet(f"{root}/runs").count() == 1


COLS = ["ts", "user_id", "event_type", "value"]


def test_merge_into_is_idempotent_by_any_partitioning(spark, tmp_path):
    from envlake.streaming.ingest import merge_into
    from envlake.streaming.store import day_part, read_table
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for name, kw in (("hash", {"buckets": 4}), ("day", {"part": day_part("ts")})):
        path = str(tmp_path / name)
        b1 = ev.where("ts < '2024-01-15'")
        for _ in range(2):   # second run = replay of the same batch
            merge_into(spark, path, b1, ["event_id"], ["ts"], columns=COLS, **kw)
        merge_into(spark, path, ev.where("ts >= '2024-01-15'"), ["event_id"], ["ts"], columns=COLS, **kw)
        got = read_table(spark, path)
        assert got.count() == ev.count() and got.select("event_id").distinct().count() == ev.count()


def test_interrupted_write_never_shrinks_the_table(spark, tmp_path):
    import pytest
    from envlake.streaming.ingest import merge_into
    from envlake.streaming.store import read_table
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    path = str(tmp_path / "t")
    merge_into(spark, path, ev, ["event_id"], ["ts"], buckets=4, columns=COLS)
    # Fails in the tasks, after the write has begun.
    broken = ev.withColumn("ts", F.col("ts") + F.expr("make_dt_interval(1)")).withColumn(
        "value", F.when(F.col("event_id") % 7 == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("value")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        merge_into(spark, path, broken, ["event_id"], ["ts"], buckets=4, columns=COLS)
    assert read_table(spark, path).count() == ev.count()
    merge_into(spark, path, ev.limit(10), ["event_id"], ["ts"], buckets=4, columns=COLS)
    assert read_table(spark, path).count() == ev.count()


def test_unreadable_is_not_absent(spark, tmp_path):
    import pytest
    from envlake.streaming.store import read_table
    assert read_table(spark, str(tmp_path / "none")) is None
    (tmp_path / "t" / "log" / "epoch=0").mkdir(parents=True)
    (tmp_path / "t" / "log" / "epoch=0" / "part-0.json").write_text('{"version": 1, "part": 0, "folder": "%s/gone"}\n' % tmp_path)
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "t")).count()


def test_log_epochs_keep_the_whole_table(spark, tmp_path, monkeypatch):
    from envlake.streaming import store
    monkeypatch.setattr(store, "EPOCH", 3)
    path = str(tmp_path / "t")
    for i in range(8):   # each write replaces one of four partitions
        store.write_parts(spark, path, spark.range(5).selectExpr(f"{i % 4} k", f"{i} v", "id"), F.col("k"))
        newest = {k: max(v for v in range(i + 1) if v % 4 == k) for k in range(min(i + 1, 4))}
        got = {r.k: r.v for r in store.read_table(spark, path).select("k", "v").distinct().collect()}
        assert got == newest
        assert sorted(store.read_table(spark, path, only=[0]).select("v").distinct().collect()) == [(newest[0],)]
