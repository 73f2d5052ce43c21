"""The value of the preceding row within a key, also for very large keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from workledger.session import materialize

# A key with more rows than this is cut into chunks of about this many rows, or a task's share if that is more.
CHUNK_ROWS = 5_000_000


def heavy_keys(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The keys above ``rows`` rows with their sizes ``n``."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > rows)


def with_previous(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    column: str,
    alias: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``alias``: ``column`` of the preceding row of the same ``key``.

    A window puts all rows of a key into one task. That is right for ordinary
    keys; those too large for it take :func:`_previous_by_chunks`.
    """
    heavy = materialize(heavy_keys(df, key, chunk_rows), "heavy")
    cut = heavy.agg(F.sum("n")).first()[0]
    lagged = F.lag(column).over(Window.partitionBy(key).orderBy(*order))
    if not cut:
        return df.withColumn(alias, lagged)
    large = df.join(heavy, key, "left_semi")
    small = df.join(heavy, key, "left_anti").withColumn(alias, lagged)
    return small.unionByName(_previous_by_chunks(large, key, order, column, alias, chunks_of(df.sparkSession, cut, chunk_rows)))


def chunks_of(spark: SparkSession, rows: int, chunk_rows: int) -> int:
    """In how many ranges ``rows`` rows are cut.

    A range is a task, so chunks smaller than a task's usual share are put together:
    there are more ranges than shuffle partitions only where a range would exceed ``CHUNK_ROWS``.
    """
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + rows // CHUNK_ROWS)
    return min(1 + rows // chunk_rows, tasks)


def _previous_by_chunks(
    df: DataFrame, key: str, order: Sequence[str], column: str, alias: str, chunks: int
) -> DataFrame:
    """Cut the rows, sorted by key and order, into ranges of similar size.

    Within a range the window sees only that range. The first row of a key in a
    range takes the last value the key has in an earlier range. Those last
    values are one row per key and range that holds it, so no more than the
    number of ranges plus that of keys. The ranges come
    from sampling and must not change between the two readings, hence the
    written table.
    """
    ranges = df.repartitionByRange(chunks, key, *order).withColumn("_chunk", F.spark_partition_id())
    ranges = materialize(ranges, "ranges")
    inside = Window.partitionBy(key, "_chunk").orderBy(*order)
    last = ranges.groupBy(key, "_chunk").agg(F.max_by(F.struct(column), F.struct(*order)).alias("_last"))
    carried = last.select(
        key,
        "_chunk",
        F.lag(F.col(f"_last.{column}")).over(Window.partitionBy(key).orderBy("_chunk")).alias("_carried"),
    )
    return (
        ranges.withColumn("_at", F.row_number().over(inside))
        .withColumn("_within", F.lag(column).over(inside))
        .join(carried, [key, "_chunk"])
        .withColumn(alias, F.when(F.col("_at") == 1, F.col("_carried")).otherwise(F.col("_within")))
        .drop("_at", "_within", "_carried", "_chunk")
    )
