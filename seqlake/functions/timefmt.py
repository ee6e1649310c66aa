"""Time columns (FN13-FN16, Q1, Q11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Object times are kept as seconds with millisecond precision.
SECONDS_TYPE = "decimal(18,3)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: Column | str) -> Column:
    """Whole epoch seconds of a timestamp (time-zone independent)."""
    return F.unix_timestamp(_c(ts)).cast("bigint")


def ms_to_seconds(ms: Column | str) -> Column:
    """``lastModified() / 1000`` kept exact, e.g. 1700000000.5."""
    return (_c(ms).cast("decimal(20,0)") / F.lit(1000)).cast(SECONDS_TYPE)


def round_seconds(sec: Column | str) -> Column:
    """``(ms / 1000).round()``: half up, to whole seconds."""
    return F.round(_c(sec).cast(SECONDS_TYPE), 0).cast("bigint")


def epoch_micros(ts: Column | str) -> Column:
    """Epoch microseconds of a timestamp, local (NTZ) or instant (LTZ),
    without going through the session time zone: whole seconds from
    ``unix_timestamp`` plus the fraction of the seconds field."""
    c = _c(ts)
    frac = (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("bigint") % F.lit(1_000_000)
    return F.unix_timestamp(c).cast("bigint") * F.lit(1_000_000) + frac


def timestamp_seconds(ts: Column | str) -> Column:
    """Timestamp column -> decimal seconds, keeping milliseconds."""
    return (epoch_micros(ts).cast("decimal(24,0)") / F.lit(1_000_000)).cast(SECONDS_TYPE)


def seconds_text(sec: Column | str) -> Column:
    """Decimal seconds as the shortest text: 1700000000, 1700000000.5."""
    s = _c(sec).cast(SECONDS_TYPE).cast("string")
    return F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def seconds_value(text: Column | str) -> Column:
    """Catalog timestamp text -> number for ordering (NULL if not numeric).

    The catalog compares times as text; 9- and 10-digit epochs then sort
    wrongly, so ordering uses the numeric value.
    """
    return _c(text).try_cast(SECONDS_TYPE)


def whole_seconds(text: Column | str) -> Column:
    """Text -> integer seconds, NULL for anything ``int()`` would reject."""
    c = _c(text)
    return F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(c).try_cast("bigint"))


def parse_iso(text: Column | str) -> Column:
    """ISO-8601 text such as ``2024-01-01T00:00:07.179575Z`` -> timestamp."""
    return F.try_to_timestamp(_c(text), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"))
