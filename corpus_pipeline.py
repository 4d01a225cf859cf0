"""The corpus pipeline: documents that a line-wise quality model rejects go, one
document of each near-duplicate group stays, documents that hold benchmark items
go, the sources are interleaved to target weights, and the token ids are written
in that order to bit-packed files.

Stages see and return the columns of ``documents``; further columns are dropped."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.llm import bitpack, crf_quality, decontam, mixing, queries, simhash
from envlake.llm.common import DOC_COLUMNS, scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more; labels are learned from four folds of five."""
    model = crf_quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), queries.fold(5) != 0)
    return crf_quality.keep_good(docs.select(*DOC_COLUMNS), model, 0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each SimHash group: 3-word shingles, 3 bits."""
    return simhash.drop_near_duplicates(docs.select(*DOC_COLUMNS), shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within a tenth of its characters in edits."""
    return decontam.drop_contaminated(docs.select(*DOC_COLUMNS), table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that keeps each source at its weight. The files
    written from it follow each other in that order."""
    return mixing.mixed(docs.select(*DOC_COLUMNS))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids in bit-packed files, in the order in which the documents were stored: that
    of the file's number (names have five digits only) and of the row in it, which is the mixture's. Documents that do
    not come from files are taken in id order."""
    order = []
    try:
        docs = docs.select(*DOC_COLUMNS, F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__at"))
        order = [F.regexp_extract("__file", r"part-(\d+)", 1).try_cast("bigint"), F.col("__file"), F.col("__at")]
    except AnalysisException:
        docs = docs.select(*DOC_COLUMNS)
    return bitpack.token_index(docs, queries.tokenizer(), end_id=0, order=order)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixture", mixture), ("token_ids", token_ids)]

#: Neither the trained model nor fingerprints and schedules can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's rows are written as Parquet
    in the shared folder and read again as the next one's."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
