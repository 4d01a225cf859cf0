"""Whether a Parquet table is there, in any file system Spark reads."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def table_exists(spark: SparkSession, path: str) -> bool:
    """False only when the path is absent; a path that cannot be read raises."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True
