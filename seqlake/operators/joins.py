"""Existence and difference as joins (JON5-JON8, SET3, SET4).

The lab probes storage once per candidate file (``exists()``).  Here the
storage side is a listing DataFrame and the probe is one hash or
sort-merge semi/anti join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

def _on(left_cols: Sequence[str], right_cols: Sequence[str], left: DataFrame, right: DataFrame):
    if list(left_cols) == list(right_cols):
        return list(left_cols)
    cond = None
    for a, b in zip(left_cols, right_cols):
        c = left[a] == right[b]
        cond = c if cond is None else cond & c
    return cond


def present_in(df: DataFrame, other: DataFrame, cols: Sequence[str], other_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other`` (left semi join)."""
    other_cols = list(other_cols or cols)
    right = other.select(*other_cols)
    return df.join(right, _on(cols, other_cols, df, right), "left_semi")


def missing_from(df: DataFrame, other: DataFrame, cols: Sequence[str], other_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other`` (left anti
    join).  An empty ``other`` keeps everything."""
    other_cols = list(other_cols or cols)
    right = other.select(*other_cols)
    return df.join(right, _on(cols, other_cols, df, right), "left_anti")
