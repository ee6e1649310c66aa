"""JOB5 ``export_new_reads``: read files of the last N days, renamed for
upload, minus what the destination already holds (FLT17, FN16, FN19, JON7, Q13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import read_export_name, relative_to, uri_text
from ..functions.predicates import looks_like_read
from ..functions.timefmt import whole_seconds
from ..operators.joins import missing_from
from ..operators.latest import latest_by

DAY = 24 * 60 * 60


def new_reads(fastq: DataFrame, now: int, lookback_days: int = 30) -> DataFrame:
    """Catalog read rows newer than ``now - lookback`` (strictly; no upper
    bound), as ``(dest_name, source, ts)``.  Rows whose time is not an
    integer are skipped (count them with :func:`skipped_rows`)."""
    ts = whole_seconds("timestamp")
    limit = now - lookback_days * DAY
    return (fastq.where(looks_like_read("file") & (ts > F.lit(limit)))
            .select(read_export_name("id", "file").alias("dest_name"), F.col("current").alias("source"),
                    ts.alias("ts")))


def skipped_rows(fastq: DataFrame) -> DataFrame:
    """Read files the export cannot date (non-integer time)."""
    return fastq.where(looks_like_read("file") & whole_seconds("timestamp").isNull())


def one_per_destination(reads: DataFrame) -> DataFrame:
    """Several rows can map to one upload name; keep the newest, then the
    smallest source URI (the lab's last copy wins by file order)."""
    return latest_by(reads, ["dest_name"], ["ts"], ["source"])


def pending_uploads(reads: DataFrame, destination: DataFrame, key: str = "key") -> DataFrame:
    """Drop names the destination already has (full listing, every page)."""
    return missing_from(one_per_destination(reads), destination, ["dest_name"], [key])


def export_new_reads(spark, fastq_csv: str, dest_root: str, now: int, lookback_days: int = 30, copier=None,
                     status_path: str | None = None) -> dict:
    """JOB5 against files: read ``meta.fastq.csv``, pick new reads, skip
    names already at ``dest_root``, copy the rest as ``<dest_root>/<name>``.

    The status of every copy is written, to ``status_path`` or below the shared
    folder, and counted by the copy itself; none of it comes to the driver."""
    from ..session import send_package, shared_dir
    from ..sinks.committed import counted
    from ..sinks.copy import copy_files, local_copy
    from ..sources import files as src

    send_package(spark)
    fastq = src.read_catalog(spark, fastq_csv, with_id_alt=True)
    reads = new_reads(fastq, now, lookback_days)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(dest_root)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        # Object keys relative to the destination root (uploads go to its top level).
        root = uri_text(F.lit(dest_root.rstrip("/") + "/"))
        listing = src.list_files(spark, dest_root).select(relative_to("path", root).alias("key"))
    else:
        listing = spark.createDataFrame([], "key string")
    todo = pending_uploads(reads, listing).withColumn(
        "dest", F.concat(F.lit(dest_root.rstrip("/") + "/"), F.col("dest_name")))
    status, seen = counted(copy_files(todo.select(F.col("source").alias("origin"), "dest"), copier or local_copy))
    status.write.mode("overwrite").parquet(status_path or shared_dir(spark, "export-status"))
    return {"copied": int(seen.get["files"] or 0), "skipped_rows": skipped_rows(fastq).count()}
