"""JOB4 ``build_analysis_table``: latest passing result per sample with
its read pair and newest assembly, split into complete and missing rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import present, qc_not_failed
from ..functions.timefmt import seconds_value
from ..operators.latest import latest_by
from ..operators.pairs import newest_assembly, read_pairs

# Output columns of the analysis table, in order.
RESULT_FIELDS = ["qc", "qc_reason", "read_depth", "assembly_len", "n_contigs", "per_gc", "species",
                 "species_conf", "mlst_1", "mlst_2", "mlst_1_scheme", "mlst_2_scheme", "beta_amr",
                 "other_amr", "plasmids", "vir_genes"]
ANALYSIS_COLUMNS = ["id", "workflow", "timestamp"] + RESULT_FIELDS + ["fastq_1", "fastq_2", "assembly"]


def latest_result(results: DataFrame, key: str = "id", ts: str = "timestamp",
                  tiebreak: Sequence[str | Column] = ("row_id",)) -> DataFrame:
    """Newest result row per sample (numeric time, then ``tiebreak``)."""
    return latest_by(results.withColumn("_t", seconds_value(ts)), [key], ["_t"], list(tiebreak)).drop("_t")


def latest_passing(results: DataFrame, key: str = "id", ts: str = "timestamp",
                   tiebreak: Sequence[str | Column] = ("row_id",)) -> DataFrame:
    """QC runs after "latest": a newer FAIL hides an older PASS.  Rows
    without a species are dropped (they cannot be reported)."""
    return latest_result(results, key, ts, tiebreak).where(qc_not_failed("qc") & present("species"))


def complete() -> Column:
    """Assembly and both reads present."""
    return present("assembly") & present("fastq_1") & present("fastq_2")


def analysis_table(results: DataFrame, reads: DataFrame, assemblies: DataFrame, key: str = "id",
                   ts: str = "timestamp", tiebreak: Sequence[str | Column] = ("row_id",),
                   normalize_files: bool = False) -> DataFrame:
    """Latest passing results left-joined with read pairs and assemblies
    (``reads`` / ``assemblies`` are catalog rows with ``id_alt``).

    The file side's ``id_alt`` only drops the re-sequence suffix, while
    result ids are also reduced to the accession; ``normalize_files``
    applies the full id normalisation to the file side as well.
    """
    if normalize_files:
        from ..functions.ids import normalize_sample_id
        reads = reads.withColumn("id_alt", normalize_sample_id("id"))
        assemblies = assemblies.withColumn("id_alt", normalize_sample_id("id"))
    base = latest_passing(results, key, ts, tiebreak)
    pairs = read_pairs(reads).withColumnRenamed("id_alt", key)
    asm = newest_assembly(assemblies).withColumnRenamed("id_alt", key)
    return base.join(pairs, key, "left").join(asm, key, "left")


def split_complete(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ok, missing): rows with assembly and both reads, and the rest."""
    ok = complete()
    return table.where(ok), table.where(~ok)


def export_analysis(spark: SparkSession, table: DataFrame, out_dir: str) -> dict[str, str]:
    """Write ``gba.csv`` (spaces -> ``_`` in every value) and
    ``gba.miss.csv``, one named file each; both are replaced on every build and ordered by id."""
    from ..session import shared_dir
    from ..sinks.onefile import write_ordered_file

    path = f"{shared_dir(spark, 'analysis')}/table"          # built once, split after
    table.write.parquet(path)
    ok, miss = split_complete(spark.read.schema(table.schema).parquet(path))
    ok = ok.select(*[F.replace(F.col(c).cast("string"), F.lit(" "), F.lit("_")).alias(c) for c in ok.columns])
    out = out_dir.rstrip("/")
    paths = {"gba": f"{out}/gba.csv", "gba.miss": f"{out}/gba.miss.csv"}
    write_ordered_file(ok, paths["gba"], ["id"])
    write_ordered_file(miss, paths["gba.miss"], ["id"])
    return paths


# ---------------------------------------------------------------- runner
def build_analysis_table_from_files(spark: SparkSession, data_dir: str) -> dict[str, str]:
    """JOB4 on the catalog exports of JOB3 in ``data_dir``.

    Result tables listed in ``meta.gba.csv`` that exist are read with
    their own headers, fields resolved, ids normalised; then the newest
    passing row per sample is joined with read pairs and assemblies and
    ``gba.csv`` / ``gba.miss.csv`` are written.
    """
    from ..functions.paths import uri_text
    from ..operators.headers import resolve_results
    from ..session import send_package
    from ..sources import files as src
    from ..sources.listing import list_folders

    send_package(spark)
    d = data_dir.rstrip("/")
    gba = src.read_catalog(spark, f"{d}/meta.gba.csv", with_id_alt=True).distinct()
    gba = gba.where(F.col("id") == "null").withColumn("current", uri_text("current"))
    # a table may be gone, with its folder or alone
    there = list_folders(gba.select(F.regexp_replace("current", "/[^/]+$", "").alias("path")), recursive=False)
    gba = gba.join(there.select(F.col("path").alias("current")), "current", "left_semi")
    paths = [r[0] for r in gba.select("current").distinct().collect()]      # one summary a run, read split by split
    rows = src.read_tables_with_header(spark, paths).withColumn("current", uri_text("file_path"))
    rows = rows.join(gba.select("current", "workflow", "timestamp"), "current")
    results = resolve_results(rows, keep=["workflow", "timestamp", "current", "block", "line_no"])
    fastq = src.read_catalog(spark, f"{d}/meta.fastq.csv", with_id_alt=True)
    fasta = src.read_catalog(spark, f"{d}/meta.fasta.csv", with_id_alt=True)
    table = analysis_table(results, fastq, fasta, tiebreak=("current", "block", "line_no"))
    table = table.select(*ANALYSIS_COLUMNS)
    return export_analysis(spark, table, d)
