"""Read samplesheet checks (FLT20, FLT21, FN17, FN18, FN22, AGG10, WIN1).

The lab's checker stops at the first bad line.  Here every line is
checked in one pass and the result is an error table (one row per bad
line, naming the first rule it breaks, in the checker's rule order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import FASTQ_EXTENSIONS, ends_with_any, last_two_suffixes
from .ranking import group_row_number

REQUIRED_COLUMNS = ("sample", "fastq_1", "fastq_2")

# Checker messages.
MSG_SAMPLE = "Sample input is required."
MSG_FIRST = "At least the first FASTQ file is required."
MSG_EXT = "The FASTQ file has an unrecognized extension: "
MSG_FORMATS = "\nIt should be one of: " + ", ".join(FASTQ_EXTENSIONS)
MSG_PAIR = "FASTQ pairs must have the same file extensions."


def _txt(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def missing_columns(columns, required=REQUIRED_COLUMNS) -> list[str]:
    return [c for c in required if c not in columns]


def first_error(sample: str = "sample", first: str = "fastq_1", second: str = "fastq_2") -> Column:
    s, f1, f2 = _txt(sample), _txt(first), _txt(second)
    return (F.when(F.length(s) <= 0, F.lit(MSG_SAMPLE))
            .when(F.length(f1) <= 0, F.lit(MSG_FIRST))
            .when(~ends_with_any(f1, FASTQ_EXTENSIONS), F.concat(F.lit(MSG_EXT), f1, F.lit(MSG_FORMATS)))
            .when((F.length(f2) > 0) & ~ends_with_any(f2, FASTQ_EXTENSIONS), F.concat(F.lit(MSG_EXT), f2, F.lit(MSG_FORMATS)))
            .when((F.length(f2) > 0) & (last_two_suffixes(f1) != last_two_suffixes(f2)), F.lit(MSG_PAIR)))


def single_end(first: str = "fastq_1", second: str = "fastq_2") -> Column:
    return ~((F.length(_txt(first)) > 0) & (F.length(_txt(second)) > 0))


def sheet_errors(sheet: DataFrame, line: str = "line") -> DataFrame:
    """``(line, error)`` for every line that breaks a rule."""
    return sheet.select(F.col(line), first_error().alias("error")).where(F.col("error").isNotNull())


def clean_lines(sheet: DataFrame) -> DataFrame:
    """Lines that break no rule: only these are transformed."""
    return sheet.where(first_error().isNull())


def sheet_duplicates(sheet: DataFrame) -> DataFrame:
    """(sample, fastq_1) pairs listed more than once (after sanitising)."""
    s = sheet.withColumn("sample", F.replace(F.col("sample"), F.lit(" "), F.lit("_")))
    return (s.groupBy("sample", "fastq_1").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def sheet_valid(sheet: DataFrame, line: str = "line", tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Transformed sheet: sample sanitised and suffixed ``_T{n}`` (n-th
    occurrence in line order), ``single_end`` inserted as column two, other
    columns kept in order.  ``tiebreak`` orders lines that share a number
    (never the case in a file; derived sheets may repeat numbers)."""
    s = sheet.withColumn("sample", F.replace(F.col("sample"), F.lit(" "), F.lit("_")))
    s = group_row_number(s, ["sample"], line, out="_n", tiebreak=tiebreak)
    s = s.withColumn("sample", F.concat(F.col("sample"), F.lit("_T"), F.col("_n").cast("string")))
    s = s.withColumn("single_end", single_end())
    rest = [c for c in sheet.columns if c != "sample"]
    return s.select("sample", "single_end", *rest)


# ---------------------------------------------------------------- runner
class SamplesheetError(ValueError):
    pass


def validate_samplesheet(spark, path: str, out_path: str | None = None) -> DataFrame:
    """JOB7 on one samplesheet file (any of ``, \t ; |``).

    Raises :class:`SamplesheetError` listing every bad line (line numbers
    count the header as line 1) or the missing columns; otherwise returns
    the transformed sheet and writes it as one CSV file when ``out_path`` is given.
    """
    from ..sinks.onefile import write_ordered_file
    from ..sources.files import read_csv, sniff_delimiters

    seps = [r["sep"] for r in sniff_delimiters(spark, path).select("sep").distinct().collect()]   # at most one per delimiter
    if len(seps) > 1:
        raise SamplesheetError(f"the files of {path} have different delimiters")
    sep = seps[0] if seps else None
    if sep is None:
        raise SamplesheetError(f"could not detect the delimiter of {path}")
    from .ranking import line_numbers
    lines = line_numbers(spark.read.text(path))          # 1 = the header line
    sheet = read_csv(spark, path, sep=sep)
    header = sheet.columns
    missing = missing_columns(header)
    if missing:
        raise SamplesheetError("The sample sheet must contain these column headers: " + ", ".join(REQUIRED_COLUMNS))
    parsed = lines.where(F.col("line") > 1).select(
        "line", F.from_csv("value", ", ".join(f"`{c}` string" for c in header), {"sep": sep}).alias("r"))
    parsed = parsed.where(F.length(F.col("r").cast("string")) > 0).select("line", "r.*")
    errors = sheet_errors(parsed).orderBy("line").collect()   # every bad line of one file people wrote
    if errors:
        raise SamplesheetError("\n".join(f"{e['error']} On line {e['line']}." for e in errors))
    if sheet_duplicates(parsed).limit(1).count():
        raise SamplesheetError("The pair of sample name and FASTQ must be unique.")
    valid = sheet_valid(parsed)
    if out_path:
        write_ordered_file(valid, out_path, ["line"], [c for c in valid.columns if c != "line"])
    return valid.orderBy("line").drop("line")
