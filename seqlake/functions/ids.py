"""Sample-id cleaning (FN2-FN4, FN6).

All functions build JVM-side column expressions; nothing runs in Python
per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the lab's conventions for results to match.
# Suffix that marks a re-sequenced sample; everything from it on is dropped.
RESEQ_SUFFIX = "-WA.*"
# State accession ids, then the older lab id form; tried in this order.
ACCESSION_PATTERN = r"WA\d{7}"
LEGACY_ID_PATTERN = r"\d{4}JQ-\d{5}"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_suffix(c: Column | str, pattern: str = RESEQ_SUFFIX) -> Column:
    """``REGEXP_REPLACE(id, '-WA.*', '')`` (every match, as Spark/Trino do)."""
    return F.regexp_replace(_c(c), pattern, "")


def extract_or_keep(c: Column | str, pattern: str) -> Column:
    """First match of ``pattern`` anywhere in the value, else the value itself."""
    c = _c(c)
    return F.coalesce(F.regexp_substr(c, F.lit(pattern)), c)


def normalize_sample_id(c: Column | str) -> Column:
    """Id used to join results with files: drop the re-sequence suffix, then
    keep the accession, then the legacy id, when present."""
    out = strip_suffix(c)
    out = extract_or_keep(out, ACCESSION_PATTERN)
    return extract_or_keep(out, LEGACY_ID_PATTERN)


def extract_last_match(c: Column | str, patterns: Sequence[str], missing: str = "None") -> Column:
    """Match every pattern in turn; the *last* pattern that matches wins.

    A value that matches none becomes the text ``missing`` (the id
    extractor prints Python's ``None``).
    """
    c = _c(c)
    tried = [F.regexp_substr(c, F.lit(p)) for p in reversed(list(patterns))]
    return F.coalesce(*tried, F.lit(missing))


def sanitize(c: Column | str) -> Column:
    """``,`` -> ``;`` and space -> ``_`` (safe inside unquoted CSV)."""
    return F.translate(_c(c), ", ", ";_")
