"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_by(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Spark turns the filter on the row number into a group limit that runs before
    the shuffle, so each task sends at most one row per key: a key that holds a
    large share of all rows costs no more than any other.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def latest_events(accepted: DataFrame) -> DataFrame:
    """The current version of every event; of equal ones the first in file order."""
    return latest_by(
        accepted,
        ["event_id"],
        [
            F.desc("updated_at_utc"),
            F.desc("payload_hash"),
            F.asc("source_file"),
            F.asc("source_row_number"),
        ],
    )


def latest_event_per_work_order(events: DataFrame) -> DataFrame:
    return latest_by(
        events,
        ["work_order_id"],
        [F.desc("event_timestamp_utc"), F.desc("updated_at_utc"), F.desc("event_id")],
    )
