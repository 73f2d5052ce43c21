"""The work-order summary and the analyses built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from workledger import schemas
from workledger.operators.previous import CHUNK_ROWS, with_previous
from workledger.operators.ranks import MAX_BROADCAST_VALUES, dense_ranks
from workledger.session import materialize

EVENT_ORDER = ("event_timestamp_utc", "updated_at_utc", "event_id")


def work_order_summary(events: DataFrame) -> DataFrame:
    """One row per work order.

    All aggregates share one shuffle and combine before it, so a work order with
    very many events sends one row per task. The last known attributes come from
    a single ``max_by`` over the full event order, which settles equal times.
    """
    kind, time = F.col("event_type"), F.col("event_timestamp_utc")
    newest = F.struct("client_id", "store_id", "technician_id", "priority", "event_type")
    labor = F.when(kind == "WORK_COMPLETED", F.coalesce("labor_minutes", F.lit(0))).otherwise(0)
    per_order = events.groupBy("work_order_id").agg(
        F.max_by(newest, F.struct(*EVENT_ORDER)).alias("newest"),
        F.min(F.when(kind == "OPENED", time)).alias("opened_timestamp"),
        F.max(F.when(kind == "CLOSED", time)).alias("closed_timestamp"),
        F.sum(labor).alias("total_labor_minutes"),
        F.count("*").alias("event_count"),
        F.count_if(kind == "REOPENED").alias("reopen_count"),
        F.max("updated_at_utc").alias("last_updated_timestamp"),
    )
    last_kind = F.col("newest.event_type")
    status = last_kind
    for event_type, label in schemas.STATUS_OF_LAST_EVENT.items():
        status = F.when(last_kind == event_type, label).otherwise(status)
    opened, closed = F.col("opened_timestamp"), F.col("closed_timestamp")
    seconds = F.unix_seconds(closed) - F.unix_seconds(opened)
    return per_order.select(
        "work_order_id",
        "newest.client_id",
        "newest.store_id",
        "newest.technician_id",
        "newest.priority",
        "opened_timestamp",
        "closed_timestamp",
        status.alias("current_status"),
        "total_labor_minutes",
        "event_count",
        "reopen_count",
        F.when(closed >= opened, seconds / F.lit(3600.0)).alias("resolution_hours"),
        "last_updated_timestamp",
    )


def work_order_status_counts(summary: DataFrame) -> DataFrame:
    return summary.groupBy("current_status").agg(F.count("*").alias("work_orders"))


def technician_close_rank(summary: DataFrame, ranges: int | None = None, max_broadcast: int = MAX_BROADCAST_VALUES) -> DataFrame:
    """Technicians ranked by the number of work orders they closed.

    The distinct counts are ranked, in ranges, and joined to the technicians.
    """
    counts = (
        summary.filter((F.col("current_status") == "CLOSED") & F.col("technician_id").isNotNull())
        .groupBy("technician_id")
        .agg(F.count("*").alias("closed_work_order_count"))
    )
    counts = materialize(counts, "closed")
    ranked = dense_ranks(counts, "closed_work_order_count", "close_rank", ranges, max_broadcast)
    return ranked.select("technician_id", "closed_work_order_count", F.col("close_rank").cast("long").alias("close_rank"))


def reopen_rate(summary: DataFrame) -> DataFrame:
    """Share of closed work orders that were reopened; NULL if none is closed."""
    closed = F.col("current_status") == "CLOSED"
    reopened = F.count_if(closed & (F.col("reopen_count") > 0))
    return summary.agg(
        (F.lit(100.0) * reopened / F.nullif(F.count_if(closed), F.lit(0))).alias(
            "reopened_closed_wo_percent"
        )
    )


def weekly_completed(summary: DataFrame) -> DataFrame:
    """Closed work orders and their mean resolution time per week of closing."""
    week = F.date_trunc("WEEK", "closed_timestamp").alias("week_start")
    return (
        summary.filter(F.col("current_status") == "CLOSED")
        .groupBy(week)
        .agg(
            F.count("*").alias("completed_work_orders"),
            F.avg("resolution_hours").alias("average_resolution_hours"),
        )
    )


def event_transitions(events: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Every event with the type of the event before it on the same work order."""
    narrow = events.select("work_order_id", "event_type", *EVENT_ORDER)
    previous = with_previous(
        narrow, "work_order_id", EVENT_ORDER, "event_type", "previous_event_type", chunk_rows
    )
    return previous.select(
        "work_order_id", "event_id", "previous_event_type", "event_type", "event_timestamp_utc"
    )


def abnormal_sequences(
    events: DataFrame,
    transitions: tuple[tuple[str, str], ...] = schemas.ABNORMAL_TRANSITIONS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Events that follow a type they should not follow."""
    wanted = F.lit(False)
    for previous, following in transitions:
        wanted = wanted | (
            (F.col("previous_event_type") == previous) & (F.col("event_type") == following)
        )
    return (
        event_transitions(events, chunk_rows)
        .filter(wanted)
        .select("work_order_id", "previous_event_type", "event_type", "event_timestamp_utc")
    )
