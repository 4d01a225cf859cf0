"""Nearest-in-time matching (F9) - an as-of join in both directions.

Spark has no as-of join, so it is composed from windows over a union of both
sides. To stay exact *and* skew-safe, the windows are partitioned by
(keys, time bucket) rather than by keys alone: a hot key is spread over its
buckets. Matches that lie in another bucket are found through a per-bucket
summary (one row per key and bucket), whose own window is tiny. No candidate
cap and no cross product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envlake.functions.timefn import seconds_between


def _grain(ts: str, seconds: int):
    return F.floor(F.unix_seconds(F.col(ts)) / F.lit(seconds))


def _slots(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, rows: int, grain: int) -> DataFrame:
    """``keys, __g, __b``: the bucket of every grain of time in which a key has rows; buckets
    rise with time. One row a key and grain is counted, with partial aggregation."""
    both = left.select(*keys, _grain(left_ts, grain).alias("__g")).unionByName(right.select(*keys, _grain(right_ts, grain).alias("__g")))
    counted = both.groupBy(*keys, "__g").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(*keys).orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("__b", F.floor(F.coalesce(F.sum("__c").over(before), F.lit(0)) / F.lit(rows))).drop("__c")


def _with_slot(d: DataFrame, slots: DataFrame, keys: list[str], grain: int) -> DataFrame:
    s = slots.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__g").alias("__kg"), "__b")
    on = _grain("__ts", grain).eqNullSafe(s["__kg"])
    for i, k in enumerate(keys):
        on = on & d[k].eqNullSafe(s[f"__k{i}"])
    return d.join(s, on, "left").drop("__kg", *[f"__k{i}" for i in range(len(keys))])


def nearest_in_time(left: DataFrame, right: DataFrame, keys: Sequence[str],
                    left_ts: str, right_ts: str, right_cols: Sequence[str],
                    right_tiebreak: str | None = None, bucket_seconds: int = 86400,
                    prefix: str = "r_", bucket_rows: int | None = None, grain_seconds: int = 60) -> DataFrame:
    """Every ``left`` row with the ``right`` row (same ``keys``) closest in time.

    On equal distance the earlier right row wins; equal right timestamps are
    ordered by ``right_tiebreak``. Adds ``{prefix}<col>`` for each right column,
    ``{prefix}ts`` and ``diff_seconds`` (absolute); left rows whose key has no
    right row get NULLs.

    Buckets are ``bucket_seconds`` long, or, with ``bucket_rows``, follow the data: rows of
    both sides are counted by key and ``grain_seconds``, and a bucket is a stretch of time
    of about that many rows, so that a key with all its rows in one hour is spread as well.
    The result is the same.
    """
    keys = list(keys)
    tb = right_tiebreak or right_ts
    bsec = F.lit(bucket_seconds)
    rcols = [c for c in right_cols]

    bucket = lambda d: d.withColumn("__b", F.floor(F.unix_seconds("__ts") / bsec))
    if bucket_rows:
        slots = _slots(left, right, keys, left_ts, right_ts, bucket_rows, grain_seconds)
        # Keys compare null-safely; the grain alone keeps the join from being a product.
        bucket = lambda d: _with_slot(d, slots, keys, grain_seconds)
    lv = F.struct(*[F.col(c) for c in left.columns])
    lb = bucket(left.select(*keys, F.col(left_ts).alias("__ts"), lv.alias("__lv")))
    rv = F.struct(F.col(right_ts).alias("ts"), F.col(tb).alias("tb"),
                  *[F.col(c).alias(c) for c in rcols])
    rb = bucket(right.select(*keys, F.col(right_ts).alias("__ts"), rv.alias("__rv")))

    # 1) in-bucket previous / next right row for each left row (one union, two
    #    running windows; running frames stream and spill, no O(n^2) frames).
    lt, rt = lb.schema["__lv"].dataType, rb.schema["__rv"].dataType
    u = (lb.select(*keys, "__b", "__ts", "__lv", F.lit(None).cast(rt).alias("__rv"))
         .unionByName(rb.select(*keys, "__b", "__ts", F.lit(None).cast(lt).alias("__lv"), "__rv")))
    side = F.when(F.col("__lv").isNull(), F.lit(0)).otherwise(F.lit(1))
    part = Window.partitionBy(*keys, "__b")
    wp = part.orderBy(F.col("__ts").asc(), side.asc(), F.col("__rv.tb").asc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wn = part.orderBy(F.col("__ts").desc(), side.asc(), F.col("__rv.tb").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inb = (u.withColumn("__p", F.last("__rv", ignorenulls=True).over(wp))
            .withColumn("__n", F.last("__rv", ignorenulls=True).over(wn))
            .where(F.col("__lv").isNotNull())
            .select(*keys, "__b", "__ts", "__lv", "__p", "__n"))

    # 2) per (key, bucket): last / first right row, carried to later / earlier
    #    buckets. One row per key and bucket, so even a hot key is small here.
    okey = F.struct("__ts", F.col("__rv.tb"))
    summ = (rb.groupBy(*keys, "__b")
              .agg(F.max_by("__rv", okey).alias("__last"), F.min_by("__rv", okey).alias("__first")))
    lkeys = lb.select(*keys, "__b").distinct()
    allb = summ.join(lkeys, on=keys + ["__b"], how="full")
    wb = Window.partitionBy(*keys)
    carry = (allb
             .withColumn("__pb", F.last("__last", ignorenulls=True)
                         .over(wb.orderBy(F.col("__b").asc()).rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("__nb", F.last("__first", ignorenulls=True)
                         .over(wb.orderBy(F.col("__b").desc()).rowsBetween(Window.unboundedPreceding, -1)))
             .select(*keys, "__b", "__pb", "__nb"))

    m = inb.join(carry, on=keys + ["__b"], how="left")
    prev = F.coalesce(F.col("__p"), F.col("__pb"))
    nxt = F.coalesce(F.col("__n"), F.col("__nb"))
    m = m.select("__ts", "__lv", prev.alias("__prev"), nxt.alias("__next"))
    dp = F.abs(seconds_between(F.col("__ts"), F.col("__prev.ts")))
    dn = F.abs(seconds_between(F.col("__ts"), F.col("__next.ts")))
    best = (F.when(F.col("__prev").isNull(), F.col("__next"))
            .when(F.col("__next").isNull(), F.col("__prev"))
            .when(dn < dp, F.col("__next")).otherwise(F.col("__prev")))
    m = m.withColumn("__best", best)
    sel = [F.col(f"__lv.{c}").alias(c) for c in left.columns]
    sel += [F.col(f"__best.{c}").alias(f"{prefix}{c}") for c in rcols]
    sel += [F.col("__best.ts").alias(f"{prefix}ts"),
            F.abs(seconds_between(F.col("__ts"), F.col("__best.ts"))).alias("diff_seconds")]
    return m.select(*sel)
