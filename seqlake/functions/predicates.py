"""Row predicates (FLT*).  Each returns a boolean Column so Catalyst can
push it into scans and combine it with others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import entity_name

# Run-level result tables that feed the analysis table,
# as (workflow, file) pairs.
RESULT_TABLES = [
    ("phoenix", "Phoenix_Summary.tsv"),
    ("phoenix", "terra_table.tsv"),
    ("theiaprok", "terra_table.tsv"),
    ("recapp", "terra_table.tsv"),
]
# Name patterns (SQL LIKE) of read files and assemblies.
READ_LIKE = "%.fastq.gz%"
READ_MATES = ("%R1%", "%R2%")
ASSEMBLY_LIKE = ("%.fasta%", "%.fa", "%.fa.gz", "%.fna%")
# Full-match patterns for original reads and first mates
# (the dots are not escaped, as in the lab's rules).
READ_FILE_RE = r".*_R[12].*.fastq.gz"
FIRST_MATE_RE = r".*_R1.*.fastq.gz"
# Fixed value: the summary whose upload starts a production ingest.
TRIGGER_FILE = "Phoenix_Summary.tsv"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_match(c: Column | str, regex: str) -> Column:
    """Whole-value regex match (Groovy ``==~``)."""
    return _c(c).rlike(f"^(?:{regex})$")


def is_result_table(workflow: Column | str = "workflow", file: Column | str = "file",
                    sample: Column | str = "id") -> Column:
    """Run-level (``id = 'null'``) summary tables of the known workflows."""
    wf, fl = _c(workflow), _c(file)
    any_pair = F.lit(False)
    for w, f in RESULT_TABLES:
        any_pair = any_pair | ((wf == w) & (fl == f))
    return (_c(sample) == "null") & any_pair


def is_read_file(file: Column | str = "file") -> Column:
    fl = _c(file)
    return fl.like(READ_LIKE) & (fl.like(READ_MATES[0]) | fl.like(READ_MATES[1]))


def is_assembly(file: Column | str = "file") -> Column:
    fl = _c(file)
    out = F.lit(False)
    for p in ASSEMBLY_LIKE:
        out = out | fl.like(p)
    return out


def is_original_read(file: Column | str = "file") -> Column:
    return full_match(file, READ_FILE_RE)


def is_first_mate(file: Column | str = "file") -> Column:
    return full_match(file, FIRST_MATE_RE)


def is_sample_assembly(file: Column | str = "file", sample: Column | str = "id") -> Column:
    """``<id>.scaffolds.fa.gz`` or ``<id>_contigs.fasta``."""
    fl, s = _c(file), _c(sample)
    return (fl == F.concat(s, F.lit(".scaffolds.fa.gz"))) | (fl == F.concat(s, F.lit("_contigs.fasta")))


def qc_not_failed(qc: Column | str = "qc") -> Column:
    """Drops only the exact text ``FAIL``; NULL and other values pass."""
    return ~F.equal_null(_c(qc), F.lit("FAIL"))


def present(c: Column | str) -> Column:
    """Groovy truth of a text value: not NULL and not empty."""
    c = _c(c)
    return c.isNotNull() & (c != "")


def absent(c: Column | str) -> Column:
    return ~present(c)


def has_uri(c: Column | str, marker: str = "gs://") -> Column:
    return F.contains(_c(c), F.lit(marker))


def looks_like_read(file: Column | str) -> Column:
    """Read-export test: ``_R1`` in the name or ``R2`` in the name (sic)."""
    fl = _c(file)
    return F.contains(fl, F.lit("_R1")) | F.contains(fl, F.lit("R2"))


def newer_than(seconds: Column, limit: int) -> Column:
    """Strictly after ``limit``; no upper bound."""
    return seconds > F.lit(limit)


def within(seconds: Column, start, end) -> Column:
    return (seconds >= F.lit(start)) & (seconds <= F.lit(end))


def is_trigger_upload(key: Column | str, name: str = TRIGGER_FILE) -> Column:
    return F.regexp_extract(_c(key), r"([^/]*)$", 1) == name


def summary_retained(status: Column | str = "status", statuses: Column | str = "workflowStatuses",
                     entity: Column | str = "submissionEntity") -> Column:
    """Keep rule of the monitor summary (TSV form): run done, some workflow
    succeeded, and the entity is not a set."""
    ent = entity_name(entity)
    return ((_c(status) == "Done") & F.contains(_c(statuses), F.lit("Succeeded"))
            & ~F.contains(ent, F.lit("_set")))


def not_set_table(name: Column | str) -> Column:
    return ~F.contains(_c(name), F.lit("_set"))


def all_columns_present(columns: Sequence[str], required: Sequence[str]) -> bool:
    """Driver-side header test (the header is metadata, not data)."""
    return set(required).issubset(set(columns))
