"""JOB3 ``build_catalog``: cleaned catalog and its four exports.

The lab runs seven statements in order against a query service: drop and
create ``meta_alt``, then export ``meta``, ``meta_alt`` and three subsets.
Here ``meta_alt`` is one DataFrame, written once and re-read by the
subsets, so the distinct runs a single time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.ids import strip_suffix
from ..functions.predicates import is_assembly, is_read_file, is_result_table
from ..functions.text import normalize_workflow

CATALOG_COLUMNS = ["id", "workflow", "run", "file", "timestamp", "origin", "current"]
CLEAN_COLUMNS = CATALOG_COLUMNS + ["id_alt"]


def clean_rows(meta: DataFrame) -> DataFrame:
    """Catalog rows with workflow family names and ``id_alt`` (duplicates
    kept: consumers that only take minima or arg-maxima need no distinct)."""
    return meta.select(
        "id", normalize_workflow("workflow").alias("workflow"), "run", "file", "timestamp", "origin", "current",
        strip_suffix("id").alias("id_alt"),
    )


def clean_catalog(meta: DataFrame) -> DataFrame:
    """``meta_alt``: distinct rows, workflow family names, ``id_alt``."""
    return clean_rows(meta).distinct()


def result_tables(meta_alt: DataFrame) -> DataFrame:
    """``meta.gba``: run-level summary tables of the analysis workflows."""
    return meta_alt.where(is_result_table())


def read_files(meta_alt: DataFrame) -> DataFrame:
    """``meta.fastq``: read files (``.fastq.gz`` with R1 or R2)."""
    return meta_alt.where(is_read_file())


def assembly_files(meta_alt: DataFrame) -> DataFrame:
    """``meta.fasta``: assemblies (``.fasta``, ``.fa``, ``.fa.gz``, ``.fna``)."""
    return meta_alt.where(is_assembly())


def build_catalog(spark: SparkSession, meta: DataFrame, out_dir: str, table_format: str = "parquet") -> dict[str, str]:
    """Write ``meta_alt`` and the CSV exports below ``out_dir``.

    Returns the written paths by name.  Every write replaces the previous
    build (the lab drops the table and clears its temporary prefix).
    """
    from ..sinks.writers import write_csv, write_table

    out = out_dir.rstrip("/")
    paths = {"meta_alt": f"{out}/meta_alt"}
    write_table(clean_catalog(meta), paths["meta_alt"], fmt=table_format)
    meta_alt = spark.read.format(table_format).load(paths["meta_alt"])
    exports = {
        "meta.raw": meta.select(*CATALOG_COLUMNS),
        "meta.clean": meta_alt,
        "meta.gba": result_tables(meta_alt),
        "meta.fastq": read_files(meta_alt),
        "meta.fasta": assembly_files(meta_alt),
    }
    for name, df in exports.items():
        paths[name] = f"{out}/{name}.csv"
        write_csv(df, paths[name])
    return paths


# ------------------------------------------------- ordered SQL statements
def run_sql_steps(spark: SparkSession, steps: list[str], views: dict[str, DataFrame] | None = None) -> list[DataFrame]:
    """Run SQL statements in order (SNK16), after registering ``views``.

    Whitespace is collapsed first (statements are logged on one line);
    a failing statement raises at once instead of being ignored.  The
    results of ``SELECT`` steps are returned lazily, one per statement.
    """
    import re
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return [spark.sql(re.sub(r"\s+", " ", q).strip()) for q in steps]
