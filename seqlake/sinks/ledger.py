"""Ledger of processed ids (SNK9, JON6, STR2).

A parquet table of ``(scope..., id, recorded_at)``.  Ids are appended
only after the work they stand for has succeeded; readers anti-join
against it, so a retry after a failure repeats the work and a rerun after
success does nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_ledger(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The ledger, or an empty frame of ``columns`` when none exists yet."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    return spark.read.parquet(path).select(*columns)


def record(ids: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Append ids (after success).  Duplicates are harmless: readers only
    test membership."""
    ids.select(*columns).withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(path)


def unseen(rows: DataFrame, ledger: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.join(ledger.select(*columns), list(columns), "left_anti")
