"""File sources (SRC1-SRC6, SRC8, SRC9, SRC12, SRC14-SRC18); folders named by
rows are in :mod:`seqlake.sources.listing`.

Everything tabular is read as text with an explicit or header-given
schema (never inferred: ``0001`` must stay ``0001``) and cast late.
Storage state (does a file exist, when was it modified) is read once as a
listing DataFrame and used in joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.paths import uri_text

CATALOG_COLUMNS = ["id", "workflow", "run", "file", "timestamp", "origin", "current"]


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def local_table(spark: SparkSession, rows: list[tuple], columns: list[str], types: list[str] | None = None) -> DataFrame:
    """A small literal table as a local relation, so the planner knows its
    size (an RDD-backed frame has none and is never broadcast)."""
    import pandas as pd
    types = types or ["string"] * len(columns)
    pdf = pd.DataFrame(rows, columns=columns)
    for c, t in zip(columns, types):
        if t == "string":
            pdf[c] = pdf[c].astype("object").where(pdf[c].notna(), None)
    return spark.createDataFrame(pdf, ", ".join(f"`{c}` {t}" for c, t in zip(columns, types)))


def string_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def read_csv(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", header: bool = True,
             columns: Sequence[str] | None = None, recursive: bool = False) -> DataFrame:
    """CSV/TSV with every column as text (SRC1, SRC2, SRC5, SRC6).

    With ``columns`` the schema is positional (a header row, if any, is
    skipped); without, names come from the header.  Quotes are ``"`` and
    doubled quotes escape.  Empty cells are NULL, the text ``null`` stays
    text.  ``recursive`` reads every file below the given folders (each
    export is itself a folder of part files).
    """
    r = (spark.read.option("header", header).option("sep", sep).option("quote", '"').option("escape", '"')
         .option("inferSchema", False).option("mode", "PERMISSIVE"))
    if recursive:
        r = r.option("recursiveFileLookup", True)
    if columns is not None:
        r = r.schema(string_schema(columns))
    return r.csv(_paths(paths))


def read_catalog(spark: SparkSession, paths: str | Sequence[str], with_id_alt: bool = False) -> DataFrame:
    """Catalog files ``id,workflow,run,file,timestamp,origin,current``
    (``meta_alt`` exports carry ``id_alt`` too); a folder is read with
    everything below it (one sub-folder per ingest run)."""
    cols = CATALOG_COLUMNS + (["id_alt"] if with_id_alt else [])
    return read_csv(spark, paths, columns=cols, recursive=True)


def read_named(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str], sep: str = ",") -> DataFrame:
    """``(file_path, *names)`` of delimited files, each column found by its
    name in the file's own header; one that a file lacks is NULL there.
    Outer quotes of a cell are taken off."""
    return named_cells(read_tables_with_header(spark, paths, sep), names, keep=["file_path"])


def named_cells(rows: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Columns ``names`` of rows ``(header, cells)``, found by name in each
    row's own header; absent or empty ones are NULL."""
    from ..operators.headers import cell
    bare = F.transform("header", lambda h: F.regexp_replace(F.trim(h), '^"|"$', ""))
    value = lambda n: F.nullif(F.regexp_replace(cell(bare, F.col("cells"), n), '^"|"$', ""), F.lit(""))
    return rows.select(*keep, *[value(n).alias(n) for n in names])


def read_manifests(spark: SparkSession, run_paths: DataFrame | Sequence[str], name: str = "manifest.csv") -> DataFrame:
    """One read over the manifest of every run folder (SRC4), each by its
    own header; the run folder is taken from each row's source file.

    Folders given as rows ``(run_path)`` are read inside the tasks that they
    are dealt to; a list of folders is read by Spark's text source."""
    if isinstance(run_paths, DataFrame):
        from .listing import read_lines
        files = run_paths.select(F.concat(F.regexp_replace("run_path", "/+$", ""), F.lit(f"/{name}")).alias("path"))
        lines = read_lines(files).withColumn("line", F.regexp_replace("line", "^\ufeff", "")).where(F.length("line") > 0)
        first = lines.groupBy("file_path").agg(F.min_by(F.split("line", ",", -1), "line_no").alias("header"), F.min("line_no").alias("_first"))
        rows = lines.join(first, "file_path").where(F.col("line_no") > F.col("_first")).select("file_path", "header", F.split("line", ",", -1).alias("cells"))
        rows = named_cells(rows, ["sample", "fastq_1", "fastq_2"], keep=["file_path"])
        return rows.select(F.regexp_replace("file_path", "/[^/]+$", "").alias("run_path"), "sample", "fastq_1", "fastq_2")
    rows = read_named(spark, [f"{p.rstrip('/')}/{name}" for p in run_paths], ["sample", "fastq_1", "fastq_2"])
    return rows.select(F.regexp_replace("file_path", "/[^/]+$", "").alias("run_path"), "sample", "fastq_1", "fastq_2")


# ------------------------------------------------------------ listings
def list_files(spark: SparkSession, root: str | Sequence[str], recursive: bool = True, glob: str | None = None) -> DataFrame:
    """Every file below ``root``: ``(path, modified_ms, length)`` (SRC8, SRC9).

    Uses the ``binaryFile`` source with only metadata columns selected,
    so file contents are never read; Spark lists large trees in parallel.
    Partition-style folder names (``id=...``) are not turned into columns.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(_paths(root))
    return df.select(
        uri_text("path").alias("path"),
        F.unix_millis(F.col("modificationTime")).alias("modified_ms"),
        F.col("length"),
    )


# ------------------------------------------------ header-per-file tables
def read_tables_with_header(spark: SparkSession, paths: str | Sequence[str], sep: str = "\t") -> DataFrame:
    """Many delimited files, each with its own header (SRC3).

    Returns ``(file_path, block, line_no, header, cells)``: one row per data
    line, next to the header array of the file it came from.  Lines are
    read split by split, whatever the size of a file; the header is the
    first line of the split that starts at byte 0, and headers (one row
    per file) are joined back by path.  ``(block, line_no)`` orders the lines of
    a file.  Cells are split on the separator (quoted separators are not
    supported).
    """
    files = _paths(paths)
    if not files:
        return spark.createDataFrame([], "file_path string, block long, line_no long, header array<string>, cells array<string>")
    lines = spark.read.text(files).select(
        uri_text("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        F.regexp_replace("value", "\r", "").alias("line"))
    firsts = (lines.where(F.col("block") == 0).groupBy("file_path")
              .agg(F.min_by("line", "line_no").alias("_h"), F.min("line_no").alias("_hno")))
    body = lines.join(firsts, "file_path").where((F.col("line_no") != F.col("_hno")) & (F.length("line") > 0))
    return body.select("file_path", "block", "line_no", F.split("_h", _re_quote(sep), -1).alias("header"),
                       F.split("line", _re_quote(sep), -1).alias("cells"))


def newest_file_per_key(listing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest listed file per key (SRC18), by modification time then path."""
    from ..operators.latest import latest_by
    return latest_by(listing, list(keys), ["modified_ms"], ["path"])


# ----------------------------------------------------- delimiter sniff
# Delimiters tried, in order of preference.
DELIMITERS = [",", "\t", ";", "|", " "]


def sniff_delimiters(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(file_path, sep)``: the first candidate that occurs the same,
    non-zero number of times on every line of the file outside quotes
    (SRC17).  Files where no candidate qualifies get NULL."""
    lines = spark.read.text(_paths(paths)).select(
        uri_text("_metadata.file_path").alias("file_path"), F.regexp_replace("value", r'"[^"]*"|\r', "").alias("line")).where(F.length("line") > 0)
    counts = [(F.size(F.split("line", _re_quote(d), -1)) - 1).alias(f"n{i}") for i, d in enumerate(DELIMITERS)]
    most = lines.select("file_path", *counts).groupBy("file_path").agg(
        *[f(f"n{i}").alias(f"{n}{i}") for i in range(len(DELIMITERS)) for n, f in (("min", F.min), ("max", F.max))])
    same = lambda i: (F.col(f"min{i}") == F.col(f"max{i}")) & (F.col(f"min{i}") > 0)
    return most.select("file_path", F.coalesce(*[F.when(same(i), F.lit(d)) for i, d in enumerate(DELIMITERS)]).alias("sep"))


def _re_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)


# ------------------------------------------------------ retention rules
RULE_COLUMNS = ["workflow", "kind", "pattern"]


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule table ``workflow,kind,pattern`` (CSV with header) (SRC14)."""
    return read_csv(spark, path).select(*RULE_COLUMNS)


def read_rules_config(spark: SparkSession, path: str) -> DataFrame:
    """Rule table from a scheme file of blocks

        name {
            run_files    = [ '/a', '/b' ]
            sample_files = [ '/<sample>/x' ]
        }

    The file is read whole and taken apart with regular expressions.
    """
    text = spark.read.text(path, wholetext=True)
    blocks = text.select(F.explode(F.regexp_extract_all("value", F.lit(r"(\w+)\s*\{[^{}]*\}"), 0)).alias("b"))
    out = None
    for kind in ("run_files", "sample_files"):
        lst = F.regexp_extract("b", kind + r"\s*=\s*\[([^\]]*)\]", 1)
        part = blocks.select(
            F.regexp_extract("b", r"^(\w+)", 1).alias("workflow"), F.lit(kind).alias("kind"),
            F.explode(F.regexp_extract_all(lst, F.lit(r"'([^']*)'"), 1)).alias("pattern"))
        out = part if out is None else out.unionByName(part)
    return out


def write_rules_config(rules: DataFrame) -> str:
    """Scheme-file text for a (small) rule table, e.g. inferred rules.

    The rule table of one workflow is bounded by the files of one run,
    so it is rendered on the driver.
    """
    rows = rules.orderBy("workflow", "kind", "pattern").collect()
    by_wf: dict[str, dict[str, list[str]]] = {}
    for r in rows:
        by_wf.setdefault(r["workflow"], {"run_files": [], "sample_files": []})[r["kind"]].append(r["pattern"])
    out = []
    for wf, kinds in by_wf.items():
        out.append(f"{wf} {{")
        for k in ("run_files", "sample_files"):
            items = ",\n        ".join(f"'{p}'" for p in kinds[k])
            out.append(f"    {k} = [\n        {items}]")
        out.append("}")
    return "\n".join(out) + "\n"


# ------------------------------------------------------------ JSON docs
def read_json_docs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One JSON document per file as text ``(file_path, json)`` (SRC10-12);
    parse with ``from_json`` and the operator's schema."""
    return spark.read.text(_paths(paths), wholetext=True).select(
        uri_text("_metadata.file_path").alias("file_path"), F.col("value").alias("json"))


# ------------------------------------------------- lake partition paths
LAKE_KEYS = ["id", "workflow", "run", "file", "timestamp"]


def lake_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Catalog rows rebuilt from the lake's own layout (SRC15): every
    object under ``<root>/data`` yields ``id, workflow, run, file,
    timestamp`` from its ``key=value`` folders and ``current`` = its path.

    Values stay text (``id=0001`` stays ``0001``, ``id=null`` stays
    ``null``); the listing runs in parallel and reads no file content.
    """
    files = list_files(spark, f"{root.rstrip('/')}/data")
    cols = [F.regexp_extract("path", f"/{k}=([^/]*)/", 1).alias(k) for k in LAKE_KEYS]
    return files.select(*cols, F.lit(None).cast("string").alias("origin"), F.col("path").alias("current"))
