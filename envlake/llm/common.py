"""Helpers the corpus operators share: reading tables, cutting lineage in the
shared folder, row keys, small Arrow batches and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.session import ensure_checkpoint_dir

#: The columns of the ``documents`` table, which every filtering stage returns.
DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Rows of one Arrow batch handed to Python. Texts reach hundreds of kB, so the
#: default of 10,000 rows could hold gigabytes.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch, keeping a lower setting of the user's."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage is cut and
    a lost executor costs no recomputation. Column names must be distinct."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(df: DataFrame) -> list[Column]:
    """Two 64-bit digests of the whole row (null-safe), 128 bits together."""
    cols = [F.col(f"`{c}`") for c in sorted(df.columns)]
    # Nulls leave a running hash unchanged, so the pattern of nulls is hashed too.
    nulls = F.concat_ws("", *[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(F.lit(s), nulls, *cols).alias(f"__row{s}") for s in (1, 2)]


def smallest_digests(ids: DataFrame, n: int, id_col: str = "__id") -> DataFrame:
    """The ``n`` distinct ids with the smallest digests: a sample that does not depend
    on partitions. Where there are many ids, only digests below a bound that about
    ``2 n`` reach are sorted, so no task gathers ``n`` rows of every partition."""
    digest = F.xxhash64(id_col)
    total = ids.count()
    if total > 4 * n:
        near = ids.where(digest < F.lit(-(1 << 63) + (1 << 64) * 2 * n // total)).distinct()
        if near.limit(n).count() == n:  # fewer only where ids repeat a lot
            return near.orderBy(digest, id_col).limit(n)
    return ids.distinct().orderBy(digest, id_col).limit(n)


def whole_rows(df: DataFrame) -> DataFrame:
    """``__doc`` (the row as a struct) and its key ``__row1, __row2``: no column of
    ``df`` can clash with a name used on the way; ``__doc.*`` gives it back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__doc"), *row_key(df))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph given as long columns ``src, dst``.

    Returns ``node, root`` (the smallest node of the component) for every node
    that has an edge. Each round takes the smallest label among a node's
    neighbours and then jumps to that label's own label, so chains shrink
    geometrically; rounds are written to the shared folder. Nothing is gathered
    on the driver but one count a round.
    """
    both = staged(edges.select("src", "dst").where("src <> dst")
                  .union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")).where("src <> dst"))
                  .distinct(), "edges")
    labels = staged(both.groupBy(F.col("src").alias("node"))
                    .agg(F.least(F.min("dst"), F.first("src")).alias("root")), "labels")
    for _ in range(max_rounds):
        near = (both.join(labels.select(F.col("node").alias("dst"), "root"), "dst")
                .groupBy(F.col("src").alias("node")).agg(F.min("root").alias("near")))
        step = (labels.join(near, "node")
                .select("node", F.least("root", "near").alias("root"), F.col("root").alias("old")))
        jump = (step.join(labels.select(F.col("node").alias("root"), F.col("root").alias("far")), "root")
                .select("node", F.least("root", "far").alias("root"), "old"))
        done = staged(jump, "labels")
        labels = done.select("node", "root")
        if done.where("root <> old").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
