"""Row numbers that stay distributed (WIN1, WIN3, WIN5).

Two shapes occur:

* a running count inside a group, in line order (``<sample>_T{n}``);
* a dense global index in some order (batches of N files).

Neither uses a window over a whole group or over the whole table, which
would put a hot group, or everything, into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# Rows per sub-group when numbering inside a group; bounds the largest
# window partition no matter how skewed the group key is.
DEFAULT_SPAN = 1 << 16


def group_row_number(df: DataFrame, keys: Sequence[str], order_col: str, out: str = "n",
                     span: int = DEFAULT_SPAN, tiebreak: Sequence[str] = ()) -> DataFrame:
    """1-based position of each row within its ``keys`` group, in
    ``order_col`` order (an integer), then ``tiebreak`` columns when the
    order value repeats.

    The group is cut into ranges of ``span`` consecutive order values.
    Range sizes are counted with a partial aggregate, prefix-summed per
    group over that small table, and added to a row number taken inside
    each range.  The largest sort is therefore ``span`` rows, not a
    third of the table.
    """
    keys = list(keys)
    tagged = df.withColumn("_rng", F.floor(F.col(order_col) / F.lit(span)))
    sizes = tagged.groupBy(*keys, "_rng").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*keys).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_rng", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(*keys, "_rng").orderBy(order_col, *tiebreak)
    numbered = tagged.withColumn("_pos", F.row_number().over(inner))
    return (numbered.join(offsets, on=keys + ["_rng"], how="inner")
            .withColumn(out, (F.col("_off") + F.col("_pos")).cast("bigint"))
            .drop("_rng", "_pos", "_off"))


def global_index(df: DataFrame, order: Sequence[str], out: str = "idx") -> DataFrame:
    """Dense 0-based index of every row in ``order`` (unique keys).

    Range-partition and sort, then cut lineage with ``checkpoint()`` so
    partition contents and order are fixed (range bounds come from a
    sample and would not repeat on recomputation).  The in-partition
    position comes from ``monotonically_increasing_id`` (partition id in
    the high bits, position in the low 33 bits); per-partition counts are a
    table of one row per partition, whose prefix sums are joined back.
    """
    from ..session import checkpoint_root
    order = list(order)
    checkpoint_root(df.sparkSession)          # the cluster's folder; a private one only if unset
    fixed = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint(eager=True)
    mid = F.monotonically_increasing_id()
    tagged = fixed.withColumn("_part", F.shiftright(mid, 33)).withColumn("_pos", mid.bitwiseAND((1 << 33) - 1))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"))
    # One row per partition: small by construction.
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    # Exactly one row per partition of a range shuffle (at most
    # spark.sql.shuffle.partitions rows): a known bound.
    offsets = F.broadcast(offsets)
    return (tagged.join(offsets, "_part")
            .withColumn(out, (F.col("_off") + F.col("_pos")).cast("bigint"))
            .drop("_part", "_pos", "_off"))


def batch_number(df: DataFrame, order: Sequence[str], size: int, out: str = "batch") -> DataFrame:
    """Batches of ``size`` consecutive rows in ``order`` (``collate(size)``)."""
    idx = global_index(df, order, out="_idx")
    return idx.withColumn(out, F.floor(F.col("_idx") / F.lit(size)).cast("bigint")).drop("_idx")


def line_numbers(df: DataFrame, out: str = "line", start: int = 1) -> DataFrame:
    """Dense numbers in the input's own order (lines of one text file).

    A text scan yields its splits in file order and lines in order within
    a split, and repeats that exactly on recomputation, so no sort and no
    checkpoint is needed: position inside the partition plus the count of
    all earlier partitions (a one-row-per-partition table).
    """
    mid = F.monotonically_increasing_id()
    tagged = df.withColumn("_part", F.shiftright(mid, 33)).withColumn("_pos", mid.bitwiseAND((1 << 33) - 1))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(counts.select("_part", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off")))
    return (tagged.join(offsets, "_part")
            .withColumn(out, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("bigint"))
            .drop("_part", "_pos", "_off"))
