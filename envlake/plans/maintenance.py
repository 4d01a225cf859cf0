"""Table maintenance jobs: quality backfill (B10), bootstrap (B6), mart
refresh and gate (B7, B8), run log (B9)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def backfill_quality(df: DataFrame) -> DataFrame:
    """Add ``value_normalized / is_valid / quality_status`` when absent and
    recompute them from ``value`` where any of the three is NULL (a valid value's
    status is NULL, so valid rows are recomputed each time, to the same result)."""
    for c, t in (("value_normalized", "double"), ("is_valid", "boolean"), ("quality_status", "string")):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    v = F.col("value")
    redo = F.col("value_normalized").isNull() | F.col("is_valid").isNull() | F.col("quality_status").isNull()
    new_norm = F.when(v.isNull() | (v < 0), F.lit(None).cast("double")).otherwise(v)
    new_valid = F.when(v.isNull() | (v < 0), F.lit(False)).otherwise(F.lit(True))
    new_status = (F.when(v.isNull(), F.lit("missing_value")).when(v < 0, F.lit("negative_value"))
                  .otherwise(F.lit(None).cast("string")))
    return df.select(*[c for c in df.columns if c not in ("value_normalized", "is_valid", "quality_status")],
                     F.when(redo, new_norm).otherwise(F.col("value_normalized")).alias("value_normalized"),
                     F.when(redo, new_valid).otherwise(F.col("is_valid")).alias("is_valid"),
                     F.when(redo, new_status).otherwise(F.col("quality_status")).alias("quality_status"))


def bootstrap_tables(spark: SparkSession, root: str, schemas: dict,
                     partition_by: dict[str, list[str]] | None = None) -> None:
    """Create an empty Parquet table per declared schema (StructType or DDL)
    when absent."""
    from envlake.sources.paths import table_exists
    for name, schema in schemas.items():
        path = f"{root}/{name}"
        if table_exists(spark, path):
            continue
        w = spark.createDataFrame([], schema).write.mode("ignore")
        if partition_by and name in partition_by:
            w = w.partitionBy(*partition_by[name])
        w.parquet(path)


def refresh_marts(marts: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Full refresh of each mart in the given (dependency) order, each into a folder of its
    own; returns the paths. What was written before stays as it is."""
    out = {}
    for name, df in marts.items():
        out[name] = f"{root}/{name}/{uuid.uuid4().hex}"
        df.write.parquet(out[name])
    return out


def publish_marts(spark: SparkSession, path: str, marts: dict[str, DataFrame]) -> dict[str, int]:
    """Refresh all ``marts`` in the store at ``path``: written beside the live version, in the
    given order, checked to have rows, then switched together by one commit. A refresh that fails or
    leaves a mart empty raises, and readers go on with the live version. Returns the
    rows of each mart."""
    from envlake.streaming.store import Write, commit
    counted: dict[str, int] = {}

    def gate(rows: dict[str, int]) -> None:
        if empty := [n for n, k in rows.items() if not k]:
            raise RuntimeError(f"empty marts: {empty}")
        counted.update(rows)
    commit(spark, path, {n: Write(df, F.lit(0), base=True) for n, df in marts.items()}, gate=gate)
    return counted


def read_mart(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """The live version of a mart, or None before the first refresh."""
    from envlake.streaming.store import read_table
    return read_table(spark, path, table=name)


def logged(spark: SparkSession, log_path: str, job_id: str, run_id: str, job):
    """Run ``job()`` and append its outcome to the run log; a failure is logged and raised."""
    start = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    try:
        out = job()
    except Exception as e:
        log_run(spark, log_path, job_id, run_id, "failed", start, error=f"{type(e).__name__}: {str(e)[:500]}")
        raise
    log_run(spark, log_path, job_id, run_id, "success", start)
    return out


def verify_marts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Gate: one row per mart with ``has_rows``; raises when any mart is empty."""
    rows = [(n, not spark.read.parquet(p).isEmpty()) for n, p in paths.items()]
    res = spark.createDataFrame(rows, "mart string, has_rows boolean")
    empty = [n for n, ok in rows if not ok]
    if empty:
        raise RuntimeError(f"empty marts: {empty}")
    return res


RUN_LOG_SCHEMA = T.StructType([
    T.StructField("dag_id", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("execution_date", T.TimestampType()), T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()), T.StructField("state", T.StringType()),
    T.StructField("error_message", T.StringType()), T.StructField("created_at", T.TimestampType())])


def log_run(spark: SparkSession, path: str, job_id: str, run_id: str, state: str, start: dt.datetime,
            end: dt.datetime | None = None, error: str | None = None, execution_date: dt.datetime | None = None):
    """Append one run-log row; best effort (a failing log never fails the job)."""
    try:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = [(job_id, run_id, execution_date or start, start, end or now, state, error, now)]
        spark.createDataFrame(row, RUN_LOG_SCHEMA).write.mode("append").parquet(path)
        return True
    except Exception:  # noqa: BLE001 - logging must not break the job
        return False
