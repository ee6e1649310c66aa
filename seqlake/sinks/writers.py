"""Table and file sinks (SNK3-SNK8, SNK10, SNK13, SNK14).

Exports are folders of CSV part files written by many tasks; one named,
ordered file comes from :mod:`seqlake.sinks.onefile`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """``DROP TABLE; CREATE TABLE AS`` -> overwrite a parquet folder."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Catalog table (needs a metastore / warehouse on the cluster)."""
    df.write.mode(mode).saveAsTable(name)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """CSV with a header; every value quoted only where needed."""
    (df.write.mode(mode).option("header", True).option("sep", sep).option("quote", '"')
     .option("escape", '"').option("emptyValue", "").csv(path))


def append_if_any(df: DataFrame, path: str, fmt: str = "csv") -> bool:
    """Append ``df`` only when it has at least one row (the catalog file
    of an ingest exists only if something moved).  Returns whether it wrote."""
    if df.isEmpty():
        return False
    if fmt == "csv":
        write_csv(df, path, mode="append")
    else:
        write_table(df, path, fmt=fmt, mode="append")
    return True
