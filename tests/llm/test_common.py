"""Components, row keys and staging."""

import random

import pytest
from common_rows import frame
from pyspark.sql import functions as F

from envlake.llm.common import connected_components, row_key, small_batches, smallest_digests, staged, whole_rows


def components(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for a, b in edges if a != b for x in (a, b)}


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(300)],                                   # a long chain
    [(random.Random(1).sample(range(300), 1)[0], i) for i in range(300)],  # a star
    [(random.Random(i).randrange(400), random.Random(-i).randrange(400)) for i in range(1, 250)],
    [(5, 5), (-7, 9), (9, -7), (9, 2), (2**62, -2**62)], [(3, 3)], []], ids=["chain", "star", "random", "odd", "loop", "none"])
def test_components_match_union_find(spark, edges):
    df = spark.createDataFrame(edges, "src long, dst long")
    assert {r.node: r.root for r in connected_components(df).collect()} == components(edges)


def test_row_keys_tell_nulls_and_columns_apart(spark):
    rows = [("a", None, "b"), (None, "a", "b"), ("a", "b", None), (None, None, None), ("", None, None), ("a", None, "b")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    keys = [tuple(r) for r in df.select(*row_key(df)).collect()]
    assert len(set(keys)) == 5 and keys[0] == keys[-1]
    back = whole_rows(frame(spark)).select("__doc.*")
    assert back.columns == frame(spark).columns and back.count() == frame(spark).count()


def test_staging_uses_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    df = staged(spark.range(5).selectExpr("id", "cast(null as string) s"), "x")
    assert df.count() == 5 and all(folder.removeprefix("file://") in f for f in df.inputFiles())
    assert staged(spark.range(0), "empty").count() == 0


def test_batches_only_get_smaller(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "7")
        small_batches(spark, 50)
        assert spark.conf.get(key) == "7"
        spark.conf.set(key, "0")
        small_batches(spark, 50)
        assert spark.conf.get(key) == "50"
    finally:
        spark.conf.set(key, before)


def test_sample_is_the_smallest_digests(spark):
    df = spark.range(5000).selectExpr("id as __id")
    want = [r[0] for r in df.orderBy(F.xxhash64("__id")).limit(40).collect()]
    for d in (df, df.repartition(7), df.union(df)):
        assert [r[0] for r in smallest_digests(d, 40).collect()] == want
    few = spark.createDataFrame([(i % 3,) for i in range(900)], "__id long")
    assert sorted(r[0] for r in smallest_digests(few, 10).collect()) == [0, 1, 2]
    assert smallest_digests(df.where("false"), 3).count() == 0
