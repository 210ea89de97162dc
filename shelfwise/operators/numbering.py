"""Row numbers and running totals over an order, without sending an ordered group to one task.

Rows are laid out once by key ranges, sorted inside each, and stored: Spark cuts
the ranges from the rows' own keys, so a large group spreads over several. What
is stored no longer depends on the cut. The sizes of the earlier ranges of the
same group are added to the place of a row in its range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.operators.spread import lookup_join
from shelfwise.session import cut_lineage

# A group of at most so many rows is summed where its key is; more of them take the ranges.
ROWS_OF_A_TASK = 100_000
# Spark's increasing ids: the task above, the place in its rows in the low bits.
PLACE_BITS = 33


def _ranged(df: DataFrame, group: list[str], order: list[str], ranges: int | None) -> DataFrame:
    """``df`` stored in key order with ``_range`` and the place ``_at`` in it; the ranges follow one another by key.

    The rows are stored before they are laid out, because Spark reads them twice: for the cuts and for the rows.
    """
    names, rows = [*group, *order], cut_lineage(df)
    laid = rows.repartitionByRange(*([ranges] if ranges else []), *names).sortWithinPartitions(*names)
    placed = laid.withColumn("_id", F.monotonically_increasing_id())
    return cut_lineage(placed.withColumns({
        "_range": F.shiftright("_id", PLACE_BITS).cast("int"), "_at": F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))}).drop("_id"))


def _with_offsets(rows: DataFrame, ranged: DataFrame, group: list[str], size: Column) -> DataFrame:
    """Add to ``rows`` of ``ranged`` the sum ``_before`` of ``size`` over earlier ranges of the group, and the least place ``_first`` in its own.

    The window sees at most one row per range and group.
    """
    sizes = ranged.groupBy(*group, "_range").agg(size.alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(sizes.select(
        *group, "_range", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    return lookup_join(rows, offsets, [*group, "_range"], ["_at"], "inner")


def number_rows(df: DataFrame, group: list[str], order: list[str], out: str,
                start: int = 1, ranges: int | None = None,
                sample_from: DataFrame | None = None) -> DataFrame:
    """Add ``out``: ``start``, ``start + 1``, … by ``order`` within ``group``; the result is stored.

    ``group + order`` must be non-null and identify a row. ``sample_from`` is not
    needed any more: the cuts come from the rows.
    """
    ranged = _ranged(df, group, order, ranges)
    joined = _with_offsets(ranged, ranged, group, F.count(F.lit(1)))
    number = F.col("_before") + F.col("_at") - F.col("_first") + start
    return joined.withColumn(out, number.cast("bigint")).select(*[c for c in df.columns if c != out], out)


def running_total(df: DataFrame, group: list[str], order: list[str], value: str, out: str,
                  ranges: int | None = None, sample_from: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` up to and including each row.

    ``df`` is read more than once. Groups of few rows are summed by key, one
    shuffle for all; the rows of larger ones go by ranges.
    """
    if not group:
        return _total_by_ranges(df, group, order, value, out, ranges)
    large = cut_lineage(df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > ROWS_OF_A_TASK).select(*group))
    by_key = lambda rows: rows.withColumn(out, F.sum(value).over(_so_far(group, order)))
    if large.isEmpty():
        return by_key(df)
    small, rest = lookup_join(df, large, group, order, "left_anti"), lookup_join(df, large, group, order, "left_semi")
    return by_key(small).unionByName(_total_by_ranges(rest, group, order, value, out, ranges))


def _so_far(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _total_by_ranges(df: DataFrame, group: list[str], order: list[str], value: str, out: str, ranges: int | None) -> DataFrame:
    ranged = _ranged(df, group, order, ranges)
    summed = ranged.withColumn("_sum", F.sum(value).over(_so_far([*group, "_range"], order)))
    joined = _with_offsets(summed, ranged, group, F.sum(value))
    return joined.withColumn(out, F.col("_before") + F.col("_sum")).select(*df.columns, out)
