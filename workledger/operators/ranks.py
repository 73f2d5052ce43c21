"""Numbers and ranks over a whole table, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from workledger.session import materialize


def row_numbers(df: DataFrame, order: Sequence[Column], alias: str, ranges: int | None = None) -> DataFrame:
    """Add ``alias``: the number of the row, from 1, in the given order.

    The rows are cut into ranges of the order. A range numbers its own rows and
    adds the rows of the ranges before it; those counts are one row per range.
    Rows that are equal in the whole order share a range, in no certain order.
    ``ranges`` is the number of ranges; if not given, the session's number of shuffle partitions.
    """
    cut = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    # Ranges are drawn from a sample, so they are written before they are read twice.
    cut = materialize(cut.withColumn("_range", F.spark_partition_id()), "ranges")
    counts = cut.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    # One row per range: never more than the number of ranges.
    numbered = cut.withColumn("_own", own).join(F.broadcast(offsets), "_range")
    return numbered.withColumn(alias, F.col("_own") + F.col("_before")).drop("_own", "_before", "_range")


# Distinct values, a rank each, that may be broadcast: some tens of bytes each.
MAX_BROADCAST_VALUES = 1_000_000
# Distinct values that one task may number.
MAX_IN_ONE_TASK = 100_000


def dense_ranks(
    df: DataFrame, column: str, alias: str, ranges: int | None = None, max_broadcast: int = MAX_BROADCAST_VALUES
) -> DataFrame:
    """Add ``alias``: the dense rank of the row by falling ``column``.

    The distinct values are counted. Few are numbered by one task; many, or any if
    ``ranges`` is given, by ranges. The ranks are joined back, broadcast if they are few enough.
    """
    values, order = df.select(column).distinct(), [F.desc(column)]
    number = values.limit(max(max_broadcast, MAX_IN_ONE_TASK) + 1).count()
    if ranges is None and number <= MAX_IN_ONE_TASK:
        ranks = values.withColumn(alias, F.row_number().over(Window.orderBy(*order)))
    else:
        ranks = row_numbers(values, order, alias, ranges)
    return df.join(F.broadcast(ranks) if number <= max_broadcast else ranks, column)
