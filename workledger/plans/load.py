"""Loading a batch of event files into the warehouse."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from workledger.operators.classify import accepted_events, classify, rejected_lines
from workledger.operators.latest import latest_events
from workledger.operators.merge import changed_rows, compared_events
from workledger.plans.checks import constraint_violations
from workledger.plans.kept import refresh
from workledger.plans.stats import already_loaded, ingest_stats, ingestion_run_row, one_row
from workledger.plans.warehouse import EVENTS, KEYS, REJECTS, REPLAYED, RUNS, State, Warehouse
from workledger.schemas import STORE_FILE, TECHNICIAN_FILE
from workledger.session import configure, materialize
from workledger.sources.checksum import batch_checksum, line_digest
from workledger.sources.lines import event_files, number_rows, scan_lines
from workledger.sources.references import Reference, read_stores, read_technicians


@dataclass(frozen=True)
class Batch:
    """A classified batch: every line once, numbered, with reason and digest."""

    lines: DataFrame
    stores: Reference
    technicians: Reference
    files: DataFrame | None = None

    @property
    def reference_rejects(self) -> DataFrame:
        return self.stores.rejects.unionByName(self.technicians.rejects)

    @property
    def rejects(self) -> DataFrame:
        return rejected_lines(self.lines).unionByName(self.reference_rejects)

    @property
    def versions(self) -> DataFrame:
        return accepted_events(self.lines).drop("digest")

    @property
    def checksum(self) -> DataFrame:
        def digested(reference: Reference) -> DataFrame:
            rows = reference.scanned
            names = [name for name in rows.columns if name not in ("source_file", "source_row_number")]
            text = F.to_json(F.struct(*names))
            return rows.withColumn("digest", line_digest(text))

        parts = [self.lines, digested(self.stores), digested(self.technicians)]
        if self.files is not None:
            # A file counts by its name too, so one without lines leaves a mark.
            name_only = {"source_row_number": F.lit(0).cast("long"), "digest": line_digest(F.lit(""))}
            parts.append(self.files.withColumns(name_only))
        return batch_checksum(*parts)

    def stats(self, checksum: DataFrame, current: DataFrame | None = None) -> DataFrame:
        stores, technicians = self.stores.clean, self.technicians.clean
        return ingest_stats(self.lines, stores, technicians, self.reference_rejects, checksum, self.files, current)


def classify_batch(
    scanned: DataFrame,
    stores: Reference,
    technicians: Reference,
    profile: str,
    known_stores: DataFrame,
    known_technicians: DataFrame,
    files: DataFrame | None = None,
    earlier_lines: DataFrame | None = None,
) -> Batch:
    """Classify scanned lines and write the result once for all later steps."""
    lines = scanned.withColumn("digest", line_digest(F.col("raw")))
    classified = classify(lines, known_stores, known_technicians, profile)
    numbered = number_rows(materialize(classified, "classified"), earlier_lines=earlier_lines)
    return Batch(numbered, stores, technicians, files)


def dry_run(spark: SparkSession, source_dir: str, profile: str = "strict") -> DataFrame:
    """The statistics of a batch; no warehouse is read or written."""
    configure(spark)
    stores, technicians = read_stores(spark, source_dir), read_technicians(spark, source_dir)
    lines, files = scan_lines(spark, source_dir), event_files(spark, source_dir)
    batch = classify_batch(lines, stores, technicians, profile, stores.clean, technicians.clean, files)
    return batch.stats(batch.checksum)


def load_batch(
    spark: SparkSession,
    source_dir: str,
    warehouse: str,
    profile: str = "strict",
    run_id: str | None = None,
    now: datetime | None = None,
    is_retry: bool = False,
) -> str:
    """Load all event files of a folder; returns the id of the run that loaded them.

    A batch whose content was loaded before only refreshes the reference tables.
    Other content under the id of a recorded run is an error, or adds nothing if
    it ``is_retry``.
    """
    configure(spark)
    lines, files = scan_lines(spark, source_dir), event_files(spark, source_dir)
    return load_lines(spark, lines, source_dir, warehouse, profile, run_id, now, files, is_retry)


def load_lines(
    spark: SparkSession,
    scanned: DataFrame,
    reference_dir: str,
    warehouse: str,
    profile: str = "strict",
    run_id: str | None = None,
    now: datetime | None = None,
    files: DataFrame | None = None,
    is_retry: bool = False,
    earlier_lines: DataFrame | None = None,
) -> str:
    """Load scanned lines, with the reference files of ``reference_dir``.

    ``earlier_lines`` counts, per ``source_file``, the lines that came in earlier loads.
    """
    run_id = run_id or str(uuid.uuid4())
    tables = Warehouse(spark, warehouse)
    state = tables.state()
    recorded = not tables.table(RUNS, state).filter(F.col("run_id") == run_id).isEmpty()
    if recorded and is_retry:
        return run_id
    tables.mark(run_id, "STARTED")
    try:
        return _load(tables, state, scanned, files, reference_dir, profile, run_id, now, recorded, earlier_lines)
    except Exception:
        tables.mark(run_id, "FAILED")
        raise


def _load(
    tables: Warehouse,
    state: State,
    scanned: DataFrame,
    files: DataFrame | None,
    reference_dir: str,
    profile: str,
    run_id: str,
    now: datetime | None,
    recorded: bool,
    earlier_lines: DataFrame | None,
) -> str:
    spark = tables.spark
    seen_at = F.lit(now or datetime.now(timezone.utc)).cast("timestamp")
    load, before, written = tables.new_load(state), state, {}
    stores, technicians = read_stores(spark, reference_dir), read_technicians(spark, reference_dir)
    for name, reference in (("stores", stores), ("technicians", technicians)):
        changes = changed_rows(tables.table(name, state), reference.clean, KEYS[name])
        _, written[name] = tables.put(name, changes, state, load)
        state = state.put(name, load, written[name])
    # The staged profile checks ids against all references loaded so far.
    known = [stores.clean, technicians.clean]
    if profile == "staged":
        known = [tables.table("stores", state), tables.table("technicians", state)]
    batch = classify_batch(scanned, stores, technicians, profile, *known, files, earlier_lines)

    checksum = materialize(batch.checksum, "checksum")
    earlier = already_loaded(checksum, tables.table(RUNS, state)).first()
    if earlier is not None:
        if any(written.values()):
            tables.publish(before, load, written)
        return earlier.run_id
    if recorded:
        raise ValueError(f"run {run_id} is recorded with other content")

    events, changes, stored_in = _store_events(tables, state, load, batch.versions, seen_at)
    written |= stored_in
    stats = materialize(batch.stats(checksum, events), "stats")
    rejects = tables.append(REJECTS, reject_rows(batch.rejects, run_id, seen_at), load)
    written[REJECTS] = []
    run = ingestion_run_row(stats, run_id, F.current_timestamp() if now is None else seen_at)

    # Other stored events have other keys, and run ids and checksums were looked up.
    checked = constraint_violations(**{EVENTS: changes, REJECTS: rejects, RUNS: run})
    broken = checked.filter("violations > 0").collect()
    if broken:
        raise ValueError("; ".join(f"{r.table_name}.{r.column_name} {r.constraint_kind}: {r.violations}" for r in broken))
    tables.publish(before, load, written, run)
    return run_id


def _store_events(
    tables: Warehouse, state: State, load: str, versions: DataFrame, seen_at: Column
) -> tuple[DataFrame, DataFrame, dict[str, list[int]]]:
    """Merge the current ones of written ``versions`` into the stored events; returns them, those that changed something, and the buckets written.

    Every event has a current version, so the buckets to compare with are those of all
    versions. The comparison follows the choice of versions on the same key: the wide rows
    are shuffled once for both, and written once before they go to their buckets, or, by a
    first load, to the buckets themselves.
    """
    buckets = tables.listed(versions.select(tables.bucket(EVENTS, state))) if state.of(EVENTS) else []
    stored = tables.partitions(EVENTS, state, buckets)
    current = latest_events(versions).withColumn("raw_payload", F.parse_json("raw")).drop("raw")
    compared = compared_events(stored, current, seen_at)
    if state.of(EVENTS):
        events, _ = tables.touched(EVENTS, compared, state)
        changes, written = tables.put(EVENTS, events.filter("changes"), state, load)
    else:
        # Nothing is stored, so every event is new and goes to its bucket at once.
        events, written = tables.place(EVENTS, compared, state, load)
        changes = events
    return events, changes, {EVENTS: written} | refresh(tables, state, load, changes, stored)


def reject_rows(rejects: DataFrame, run_id: str, seen_at) -> DataFrame:
    """Rows of the reject table; the id is the same whenever the run is repeated."""
    return rejects.select(
        F.xxhash64(F.lit(run_id), "source_file", "source_row_number").alias("rejection_id"),
        F.lit(run_id).alias("run_id"),
        "source_file",
        "source_row_number",
        "reason",
        "raw_payload",
        seen_at.alias("rejected_at"),
    )


def replay_rejects(
    rejects: DataFrame, stores: DataFrame, technicians: DataFrame, profile: str = "strict"
) -> DataFrame:
    """Judge stored rejects again, for instance after references were corrected.

    Lines that now pass have no ``reject_reason``.
    """
    lines = rejects.select("source_file", "source_row_number", F.col("raw_payload").alias("raw"))
    return classify(lines, stores, technicians, profile)


def open_rejects(tables: Warehouse, state: State | None = None) -> DataFrame:
    """Rejects that no replay has loaded."""
    state = state or tables.state()
    return tables.table(REJECTS, state).join(tables.table(REPLAYED, state), ["run_id", "source_file", "source_row_number"], "left_anti")


def load_replay(
    spark: SparkSession,
    warehouse: str,
    stores: DataFrame | None = None,
    technicians: DataFrame | None = None,
    profile: str = "strict",
    run_id: str | None = None,
    now: datetime | None = None,
) -> str | None:
    """Judge the open rejects of event lines again and load those that pass now; returns the run's id, None if none passes.

    Ids are checked against the warehouse's references unless others are given.
    What passes is merged like a batch, and noted, so no later replay takes it
    again. What is still rejected stays as it is, under its first run.
    """
    configure(spark)
    tables = Warehouse(spark, warehouse)
    state, run_id = tables.state(), run_id or str(uuid.uuid4())
    seen_at = F.lit(now or datetime.now(timezone.utc)).cast("timestamp")
    if not tables.table(RUNS, state).filter(F.col("run_id") == run_id).isEmpty():
        raise ValueError(f"run {run_id} is recorded")
    tables.mark(run_id, "STARTED")
    try:
        known = [tables.table("stores", state) if stores is None else stores]
        known.append(tables.table("technicians", state) if technicians is None else technicians)
        of_events = open_rejects(tables, state).filter(~F.col("source_file").isin(STORE_FILE, TECHNICIAN_FILE))
        lines = of_events.select("run_id", "source_file", "source_row_number", F.col("raw_payload").alias("raw"))
        passed = materialize(classify(lines, *known, profile).filter("reject_reason is null").drop("reject_reason"), "passed")
        if passed.isEmpty():
            return None
        load = tables.new_load(state)
        events, changes, written = _store_events(tables, state, load, passed.drop("run_id"), seen_at)
        noted = passed.select("run_id", "source_file", "source_row_number", F.lit(run_id).alias("replay_run_id"), seen_at.alias("replayed_at"))
        tables.append(REPLAYED, noted, load)
        digested = passed.select(F.concat_ws("/", F.lit("replay"), "run_id", "source_file").alias("source_file"), "source_row_number", line_digest(F.col("raw")).alias("digest"))
        counted = passed.agg(F.count_distinct("source_file").alias("file_count"), F.count("*").alias("record_count"))
        unique = events.agg(F.count("*").alias("unique_event_count"))
        completed = F.current_timestamp() if now is None else seen_at
        run = one_row(batch_checksum(digested), counted, unique).select(
            F.lit(run_id).alias("run_id"), "source_checksum", "file_count", "record_count", "unique_event_count",
            F.lit(0).cast("long").alias("rejected_count"), completed.alias("completed_at"),
        )
        broken = constraint_violations(**{EVENTS: changes, RUNS: run}).filter("violations > 0").collect()
        if broken:
            raise ValueError("; ".join(f"{r.table_name}.{r.column_name} {r.constraint_kind}: {r.violations}" for r in broken))
        tables.publish(state, load, {**written, REPLAYED: []}, run)
        return run_id
    except Exception:
        tables.mark(run_id, "FAILED")
        raise
