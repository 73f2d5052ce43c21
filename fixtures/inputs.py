"""The derived inputs as Spark DataFrames and as files."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from fixtures import sql
from workledger.schemas import STORES, TECHNICIANS
from workledger.session import configure, fresh_folder
from workledger.sources.references import Reference, split_reference

FILES = tuple(f"work_order_events_0{i}.jsonl" for i in (1, 2, 3))
NO_LINES = "work_order_events_04.jsonl"  # an event file without a line
LINES_OF_A_TASK = 50_000  # a few seconds of work
_landed: dict[tuple[str, str, tuple[str, ...]], str] = {}


def derive(spark: SparkSession, sf_dir: str, text: str, **others: str) -> DataFrame:
    """Run one of the SQL texts on the tables of a folder; ``others`` stand for tables of their name."""
    names = {name: f"parquet.`{sf_dir}/{name}.parquet`" for name in ("events", "customer", "supplier")}
    return configure(spark).sql(sql.on(text, **names | others))


def _instants(df: DataFrame) -> DataFrame:
    zoneless = [name for name, kind in df.dtypes if kind == "timestamp_ntz"]
    return df.withColumns({name: df[name].cast("timestamp") for name in zoneless})


def work_order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _instants(derive(spark, sf_dir, sql.WORK_ORDER_EVENTS))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of event files, spread evenly.

    The narrow rows that lines are made of are moved, not the lines. The number of
    tasks grows with the rows: left to the engine it is one more than there are cores,
    so that one task runs when all others are done.
    """
    events = f"parquet.`{sf_dir}/events.parquet`"
    rows = spark.table(events).count()
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(rows / LINES_OF_A_TASK))
    spread = f"(select /*+ repartition({tasks}, event_id) */ * from {events})"
    return derive(spark, sf_dir, sql.EVENT_LINES, events=spread).drop("f")


def stores(spark: SparkSession, sf_dir: str) -> Reference:
    return split_reference(derive(spark, sf_dir, sql.STORE_ROWS), STORES)


def technicians(spark: SparkSession, sf_dir: str) -> Reference:
    return split_reference(derive(spark, sf_dir, sql.TECHNICIAN_ROWS), TECHNICIANS)


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _instants(derive(spark, sf_dir, sql.MERGE_TARGET))


def merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _instants(derive(spark, sf_dir, sql.MERGE_SOURCE))


def write_event_files(spark: SparkSession, sf_dir: str, folder: str, files: tuple[str, ...]) -> None:
    """Write event files; each is a folder of part files in line order."""
    lines = event_lines(spark, sf_dir)
    for name in files:
        part = lines.filter(lines.source_file == name)
        ordered = part.repartitionByRange("source_row_number").sortWithinPartitions("source_row_number")
        ordered.select("raw").write.text(f"{folder}/{name}")


def write_reference_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    for name, text in (("stores.csv", sql.STORE_ROWS), ("technicians.csv", sql.TECHNICIAN_ROWS)):
        rows = derive(spark, sf_dir, text)
        ordered = rows.repartitionByRange("source_row_number").sortWithinPartitions("source_row_number")
        keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        ordered.drop("source_file", "source_row_number").write.options(
            header=True, escape='"', **keep_blanks
        ).csv(f"{folder}/{name}")


def landed(spark: SparkSession, sf_dir: str, files: tuple[str, ...] = (*FILES, NO_LINES)) -> str:
    """A folder with event and reference files, written once per session."""
    wanted = (spark.sparkContext.applicationId, sf_dir, files)
    if wanted not in _landed:
        folder = fresh_folder(configure(spark), "landed")
        write_event_files(spark, sf_dir, folder, files)
        write_reference_files(spark, sf_dir, folder)
        _landed[wanted] = folder
    return _landed[wanted]
