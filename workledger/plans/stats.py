"""Counts of a run and its audit row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from workledger.operators.latest import latest_events

REFERENCE_FILES = 2


def one_row(*parts: DataFrame) -> DataFrame:
    """Bring one-row tables with different columns together in one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*(F.max(name).alias(name) for name in stacked.columns))


def ingest_stats(
    classified: DataFrame,
    stores: DataFrame,
    technicians: DataFrame,
    reference_rejects: DataFrame,
    checksum: DataFrame | None = None,
    files: DataFrame | None = None,
    current: DataFrame | None = None,
) -> DataFrame:
    """One row with the statistics of a batch.

    ``files`` names the event files, also those without lines; ``current`` holds
    the current versions where they have been written already.

    ``rejected_records`` counts lines and reference rows, ``records_read`` lines
    only. A version is superseded if it is accepted but not the current one.
    """
    accepted = F.col("reject_reason").isNull()
    named = classified if files is None else files
    lines = classified.agg(
        F.count("*").alias("records_read"),
        F.count_if(accepted).alias("accepted_event_versions"),
        F.count_if(~accepted).alias("rejected_lines"),
    )
    if current is None:
        # Only the columns that decide which version is current go into the shuffle.
        versions = classified.filter(accepted).select(
            "event_id", "work_order_id", "updated_at_utc", "payload_hash", "source_file", "source_row_number"
        )
        current = latest_events(versions)
    current = current.agg(
        F.count("*").alias("unique_valid_events"),
        F.count_distinct("work_order_id").alias("unique_work_orders"),
    )
    parts = [
        named.agg(F.count_distinct("source_file").alias("event_files")),
        lines,
        current,
        stores.agg(F.count("*").alias("stores")),
        technicians.agg(F.count("*").alias("technicians")),
        reference_rejects.agg(F.count("*").alias("rejected_reference_rows")),
    ]
    if checksum is not None:
        parts.append(checksum)
    row = one_row(*parts)
    return row.select(
        (F.col("event_files") + REFERENCE_FILES).alias("files_read"),
        "records_read",
        "accepted_event_versions",
        "unique_valid_events",
        (F.col("accepted_event_versions") - F.col("unique_valid_events")).alias(
            "duplicate_or_superseded_records"
        ),
        (F.col("rejected_lines") + F.col("rejected_reference_rows")).alias("rejected_records"),
        "unique_work_orders",
        "stores",
        "technicians",
        *(["source_checksum"] if checksum is not None else []),
    )


def ingestion_run_row(stats: DataFrame, run_id: str, completed_at: Column) -> DataFrame:
    """The audit row of a run, from its statistics (with checksum)."""
    return stats.select(
        F.lit(run_id).alias("run_id"),
        "source_checksum",
        F.col("files_read").alias("file_count"),
        (F.col("accepted_event_versions") + F.col("rejected_records")).alias("record_count"),
        F.col("unique_valid_events").alias("unique_event_count"),
        F.col("rejected_records").alias("rejected_count"),
        completed_at.alias("completed_at"),
    )


def already_loaded(batches: DataFrame, runs: DataFrame) -> DataFrame:
    """Those of ``batches`` whose checksum a run has recorded, with its ``run_id``."""
    return batches.join(runs.select("source_checksum", "run_id"), "source_checksum")


# Registers of a sketch, as a power of two: a standard error of about 0.8 %, 8 KB a sketch.
SKETCH_REGISTERS = 14


def distinct_sketches(rows: DataFrame, by: str, *columns: str, registers: int = SKETCH_REGISTERS) -> DataFrame:
    """Per value of ``by`` a mergeable sketch of the distinct values of each column.

    The opt-in beside exact counts: sketches of runs are kept and put together
    later, where exact counts would need all rows again.
    """
    return rows.groupBy(by).agg(*(F.hll_sketch_agg(column, registers).alias(column) for column in columns))


def sketched_counts(sketches: DataFrame, *columns: str) -> DataFrame:
    """One row: the estimated number of distinct values over all sketches of each column."""
    return sketches.agg(*(F.hll_sketch_estimate(F.hll_union_agg(column)).alias(column) for column in columns))
