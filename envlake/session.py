"""Session helpers: the settings every envlake job assumes, and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. UTC makes date_trunc / day boundaries stable,
# AQE lets joins switch to broadcast only when the *measured* side is small and
# splits skewed shuffle partitions at run time.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Naive Parquet timestamps are read as UTC instants (TIMESTAMP), not
    # TIMESTAMP_NTZ, so time functions apply and filters still reach the scan.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    # HotSpot compiles no method of over 8,000 bytes. A stage that would become one is run
    # operator by operator, in methods that are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings envlake needs to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "envlake", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's session and call
    :func:`apply_conf` instead."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the configured checkpoint folder. Only a local master (tests,
    a single machine) may fall back to a scratch folder when none is set; on a
    cluster a folder of one node would lose data, so that raises."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor shares")
        d = tempfile.mkdtemp(prefix="envlake-ckpt-", dir=os.environ.get("ENVLAKE_SCRATCH"))
        spark.conf.set("spark.checkpoint.dir", d)
    # Setting the folder makes Spark create a sub-folder, so only do it once.
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back: lineage
    is cut at the price of one computation (an RDD checkpoint costs two)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(jobs: Sequence[Callable], at_once: int = 4) -> list:
    """The results of independent ``jobs``, which submit their Spark jobs from threads of
    their own, so that small ones do not wait for each other. The first error is raised
    when all have ended."""
    with ThreadPoolExecutor(max(1, min(at_once, len(jobs)))) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]
