"""Text columns: workflow names, entity names, file suffixes
(FN1, FN5, FN12, FN17, FN18, FN24)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Workflow families, matched in this order, first wins.
# (LIKE pattern, case used for the test, normalised name)
WORKFLOW_FAMILIES = [
    ("%phoenix%", "lower", "phoenix"),
    ("%theiaprok%", "lower", "theiaprok"),
    ("%RECAPP%", "upper", "recapp"),
    ("%BASESPACE%", "upper", "basespace_fetch"),
]

# Accepted read-file extensions.
FASTQ_EXTENSIONS = (".fq.gz", ".fastq.gz")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_workflow(c: Column | str) -> Column:
    """Map free-text workflow names onto their family, else keep them."""
    c = _c(c)
    out = None
    for pattern, case, name in WORKFLOW_FAMILIES:
        probe = F.lower(c) if case == "lower" else F.upper(c)
        cond = probe.like(pattern)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(c)


def collapse_ws(c: Column | str) -> Column:
    """``" ".join(s.split())``."""
    return F.regexp_replace(F.trim(_c(c)), r"\s+", " ")


def entity_name(c: Column | str) -> Column:
    """``entity:name`` -> ``entity`` (text before the first colon)."""
    return F.split_part(_c(c), F.lit(":"), F.lit(1))


def strip_set(c: Column | str) -> Column:
    """Set submissions run on ``<type>_set``; their entity type is ``<type>``."""
    return F.regexp_replace(_c(c), "_set$", "")


def last_two_suffixes(c: Column | str) -> Column:
    """``"".join(pathlib.Path(x).suffixes[-2:])`` as text.

    Only the last path segment counts, leading dots are not suffix
    separators, and a name ending in ``.`` has no suffixes.  Every suffix
    starts with its only dot, so equal texts mean equal suffix lists.
    Built from regular expressions only (no array lambdas), so it stays
    in generated code.
    """
    # The name is the last component once trailing "/" and "/." are dropped.
    name = F.regexp_extract(F.regexp_replace(_c(c), r"(/\.?)+$", ""), r"([^/]*)$", 1)
    stem_free = F.regexp_extract(F.regexp_replace(name, r"^\.+", ""), r"^[^.]*(.*)$", 1)
    last_two = F.regexp_extract(stem_free, r"((?:\.[^.]*){0,2})$", 1)
    return F.when(name.endswith("."), F.lit("")).otherwise(last_two)


def ends_with_any(c: Column | str, endings: Sequence[str]) -> Column:
    c = _c(c)
    out = F.lit(False)
    for e in endings:
        out = out | c.endswith(e)
    return out
