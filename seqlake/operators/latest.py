"""Newest row per key and related ranking rules (AGG2-AGG4, WIN2, JON13, LIM1).

"Latest" is an aggregate, not a window: ``min_by`` over an ordering
struct is computed partially on the map side, so a key that holds a third
of all rows is collapsed to one row per task before the shuffle.  A
``row_number()`` window would instead send every row of the hot key to
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order_struct(newest_first: Sequence[Column | str], then_ascending: Sequence[Column | str]) -> Column:
    """Struct whose minimum is the wanted row.

    ``newest_first`` columns must be numeric; NULLs rank last (a missing
    time never beats a present one), then larger values first.
    ``then_ascending`` breaks ties, smallest first.
    """
    parts = []
    for i, c in enumerate(newest_first):
        c = F.col(c) if isinstance(c, str) else c
        parts.append(c.isNull().alias(f"n{i}"))
        parts.append((-c).alias(f"v{i}"))
    for j, c in enumerate(then_ascending):
        c = F.col(c) if isinstance(c, str) else c
        parts.append(c.alias(f"t{j}"))
    return F.struct(*parts)


def latest_by(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column | str],
              then_ascending: Sequence[Column | str] = ()) -> DataFrame:
    """One row per ``keys``: the row with the largest ``newest_first``
    values, ties broken by the smallest ``then_ascending`` values.

    Pass a tie-break that is unique within a key so the result is
    deterministic (the lab keeps "whichever came first").
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*payload), _order_struct(newest_first, then_ascending))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col("_best")[c].alias(c) for c in payload])


def rows_matching_latest(df: DataFrame, keys: Sequence[str], match: Sequence[str],
                         newest_first: Sequence[Column | str], then_ascending: Sequence[Column | str] = ()) -> DataFrame:
    """All rows equal to the newest row of their key on ``match`` columns.

    Submissions keep every run that ties the newest one on
    (method, entity, date).  The arg-max is an aggregate (one row per key);
    the semi join then runs on the full ``keys + match`` tuple, which
    splits a hot key over its distinct dates.
    """
    keys, match = list(keys), list(match)
    best = latest_by(df.select(*keys, *match, *[c for c in _names(newest_first, then_ascending)
                                                   if c not in keys + match]),
                     keys, newest_first, then_ascending).select(*[F.col(c).alias(f"_b_{c}") for c in keys + match])
    on = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in keys + match]     # a NULL method ties with a NULL method
    return df.join(best, on=on, how="left_semi")


def _names(*groups) -> list[str]:
    out = []
    for g in groups:
        for c in g:
            if isinstance(c, str) and c not in out:
                out.append(c)
    return out


def first_rows_marked(df: DataFrame, key: str, first: int, order: Sequence[str], out: str = "start",
                      by: Sequence[str] = ()) -> DataFrame:
    """Every row once, with ``out`` telling whether it is among the ``first``
    rows in ``order`` (then ``key``), of the table or of each ``by`` group.

    The last of the first rows is found by a top-k (taken per partition, then
    merged) and every row is compared with it, so rows that repeat or lack a
    key stay as many as they are; those equal to the last one share its mark.
    """
    place = F.struct(*dict.fromkeys([*order, key]))
    if not by:
        last = df.orderBy(place).limit(first).agg(F.max(place).alias("_last"))
        return df.withColumn(out, F.coalesce(place <= last.scalar(), F.lit(False)))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(place))
    last = df.withColumn("_rank", rank).where(F.col("_rank") <= first).groupBy(*by).agg(F.max(place).alias("_last"))
    last = last.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_last")
    on = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    return df.join(last, on, "left").select(*df.columns, F.coalesce(place <= F.col("_last"), F.lit(False)).alias(out))
