
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixtures import inputs  # noqa: E402
from fixtures.oracles import ORACLES  # noqa: E402
from workledger.functions import payload as js  # noqa: E402
from workledger.operators.classify import (  # noqa: E402
    accepted_events,
    classify,
    normalize,
    rejected_lines,
)
from workledger.operators.existence import flag_known, unknown_references  # noqa: E402
from workledger.operators.latest import latest_event_per_work_order, latest_events  # noqa: E402
from workledger.operators.merge import merge_latest, upsert  # noqa: E402
from workledger.plans import marts  # noqa: E402
from workledger.plans.checks import constraint_violations  # noqa: E402
from workledger.plans.kept import keep_analyses  # noqa: E402
from workledger.plans.load import (  # noqa: E402
    dry_run,
    load_batch,
    load_replay,
    reject_rows,
    replay_rejects,
)
from workledger.plans.stats import (  # noqa: E402
    already_loaded,
    distinct_sketches,
    ingest_stats,
    ingestion_run_row,
    one_row,
    sketched_counts,
)
from workledger.plans.views import create_views, register_views  # noqa: E402
from workledger.plans.warehouse import Warehouse  # noqa: E402
from workledger.schemas import EVENT_COLUMNS  # noqa: E402
from workledger.session import configure, fresh_folder, materialize  # noqa: E402
from workledger.sources.checksum import batch_checksum, line_digest  # noqa: E402
from workledger.sources.lines import number_rows, scan_lines  # noqa: E402
from workledger.sources.references import read_stores  # noqa: E402
from workledger.streaming.ingest import ingest_stream  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

try:
    import corpus_pipeline
    from workledger.llm import queries as llm
except ImportError:  # the text operators are not there
    TEXT_QUERIES: dict[str, Query] = {}
    TEXT_ORACLES: dict[str, str] = {}
else:
    TEXT_QUERIES = llm.QUERIES | {"pipeline": corpus_pipeline.run}
    TEXT_ORACLES = llm.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

SMOKE_DIR = "/root/testdata/sf0.001"
FIRST_LOAD = datetime(2024, 6, 1, tzinfo=timezone.utc)
SECOND_LOAD = datetime(2024, 6, 2, tzinfo=timezone.utc)


def _plain(df: DataFrame) -> DataFrame:
    """Instants without zone, as the oracle has them."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _seen_at():
    return F.lit(FIRST_LOAD).cast("timestamp")


# --- analyses ---------------------------------------------------------------


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.work_order_summary(inputs.work_order_events(spark, sf_dir))


def _over_summary(mart: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: mart(_summary(spark, sf_dir))


def _over_events(mart: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: mart(inputs.work_order_events(spark, sf_dir))


def _weekly_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = marts.weekly_completed(_summary(spark, sf_dir))
    return weeks.withColumn("average_resolution_hours", F.round("average_resolution_hours", 6))


# --- lines ------------------------------------------------------------------


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_lines(spark, inputs.landed(spark, sf_dir))
    return number_rows(materialize(scanned, "lines")).select("source_file", "source_row_number", "raw")


def _normalized_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [name for name in EVENT_COLUMNS if name != "payload_hash"]
    return normalize(inputs.event_lines(spark, sf_dir)).select("source_file", "source_row_number", *columns)


def _payload_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = normalize(inputs.event_lines(spark, sf_dir))
    hashed = F.when(F.col("_valid"), js.payload_hash(F.col("_doc"), F.col("raw")))
    return parsed.select("source_file", "source_row_number", hashed.alias("payload_hash"))


def _classified(spark: SparkSession, sf_dir: str, profile: str = "strict") -> DataFrame:
    lines = inputs.event_lines(spark, sf_dir)
    stores, technicians = inputs.stores(spark, sf_dir), inputs.technicians(spark, sf_dir)
    return classify(lines, stores.clean, technicians.clean, profile)


def _event_rows(events: DataFrame, payload: str = "raw") -> DataFrame:
    return events.select(*EVENT_COLUMNS, "source_file", "source_row_number", F.col(payload).alias("raw_payload"))


def _accepted(profile: str) -> Query:
    return lambda spark, sf_dir: _event_rows(accepted_events(_classified(spark, sf_dir, profile)))


def _reference_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.stores(spark, sf_dir).rejects.unionByName(inputs.technicians(spark, sf_dir).rejects)


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = rejected_lines(_classified(spark, sf_dir))
    return lines.unionByName(_reference_rejects(spark, sf_dir))


def _rejected_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_lines(_classified(spark, sf_dir, "staged"))


def _reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_lines(_classified(spark, sf_dir)).groupBy("reason").agg(F.count("*").alias("lines"))


def _latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_rows(latest_events(accepted_events(_classified(spark, sf_dir))))


def _stats(spark: SparkSession, sf_dir: str, checksum: DataFrame | None = None) -> DataFrame:
    return ingest_stats(
        materialize(_classified(spark, sf_dir), "classified"),
        inputs.stores(spark, sf_dir).clean,
        inputs.technicians(spark, sf_dir).clean,
        _reference_rejects(spark, sf_dir),
        checksum,
    )


def _distinct_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct counts, and whether those of the files' sketches together are within two per cent."""
    names = ("work_order_id", "event_id")
    accepted = materialize(accepted_events(_classified(spark, sf_dir)).select("source_file", *names), "accepted")
    sketches = materialize(distinct_sketches(accepted, "source_file", *names), "sketches")
    estimated = sketched_counts(sketches, *names).select(*[F.col(name).alias(f"{name}_estimate") for name in names])
    exact = accepted.agg(*[F.count_distinct(name).alias(name) for name in names])
    within = [(F.abs(F.col(f"{n}_estimate") - F.col(n)) <= 0.02 * F.col(n)).alias(f"{n}_within") for n in names]
    return one_row(exact, estimated).select(*names, *within)


def _checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.event_lines(spark, sf_dir).withColumn("digest", line_digest(F.col("raw")))
    return batch_checksum(lines)


def _run_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = _stats(spark, sf_dir, _checksum(spark, sf_dir))
    return ingestion_run_row(stats, "run-1", _seen_at()).drop("source_checksum")


# --- references -------------------------------------------------------------


def _reference_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_stores(spark, inputs.landed(spark, sf_dir)).scanned


def _reference_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.work_order_events(spark, sf_dir)
    events = flag_known(events, inputs.stores(spark, sf_dir).clean, "store_id", "store_known")
    technicians = inputs.technicians(spark, sf_dir).clean
    events = flag_known(events, technicians, "technician_id", "technician_known")
    return events.select("event_id", "store_id", "technician_id", "store_known", "technician_known")


def _unknown_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.work_order_events(spark, sf_dir).select("event_id", "store_id")
    return unknown_references(events, inputs.stores(spark, sf_dir).clean, "store_id")


def _unknown_references_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.work_order_events(spark, sf_dir).select("event_id", "store_id")
    return unknown_references(events, inputs.stores(spark, sf_dir).clean, "store_id", max_broadcast=0)


def _transitions_by_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.event_transitions(inputs.work_order_events(spark, sf_dir), chunk_rows=3)


def _views_weekly_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(inputs.work_order_events(spark, sf_dir))
    weeks = spark.sql("SELECT * FROM analysis_weekly_completed")
    return weeks.withColumn("average_resolution_hours", F.round("average_resolution_hours", 6))


# --- merges -----------------------------------------------------------------


def _merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_events(inputs.merge_source(spark, sf_dir)).drop("first_seen_at", "last_seen_at")


def _merge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = inputs.merge_target(spark, sf_dir)
    return merge_latest(target, _merge_source(spark, sf_dir), _seen_at())


def _merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = F.lit(SECOND_LOAD).cast("timestamp")
    return merge_latest(_merge_events(spark, sf_dir), _merge_source(spark, sf_dir), later)


def _merge_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = inputs.stores(spark, sf_dir).clean
    changed = target.filter(F.col("store_number").cast("int") % 3 == 0)
    changed = changed.withColumns({"region": F.upper("region"), "active_flag": F.lit("FALSE")})
    return upsert(target, changed, "store_id")


def _already_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").cast("string").alias("key"))
    runs = orders.distinct().select(F.md5("key").alias("source_checksum"), F.concat(F.lit("run-"), "key").alias("run_id"))
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    batches = customers.select(
        F.md5(F.col("c_custkey").cast("string")).alias("source_checksum"), F.col("c_name").alias("batch")
    )
    return already_loaded(batches, runs)


def _constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Accepted versions, not yet reduced to one per event: the key must fail.
    versions = accepted_events(materialize(_classified(spark, sf_dir), "classified"))
    return constraint_violations(work_order_events=versions)


# --- loads ------------------------------------------------------------------


def _loaded(spark: SparkSession, sf_dir: str) -> Warehouse:
    root = fresh_folder(configure(spark), "warehouse")
    load_batch(spark, inputs.landed(spark, sf_dir), root, run_id="run-1", now=FIRST_LOAD)
    return Warehouse(spark, root)


def _load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _loaded(spark, sf_dir).table("work_order_events")
    return events.withColumn("raw_payload", F.to_json("raw_payload"))


def _load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(configure(spark), "warehouse")
    first, rest = inputs.FILES[:1], inputs.FILES[1:]
    load_batch(spark, inputs.landed(spark, sf_dir, first), root, run_id="run-1", now=FIRST_LOAD)
    load_batch(spark, inputs.landed(spark, sf_dir, rest), root, run_id="run-2", now=SECOND_LOAD)
    return _numbered_loads(Warehouse(spark, root).table("work_order_events"))


def _numbered_loads(events: DataFrame) -> DataFrame:
    load_number = {name: 1 + F.datediff(name, F.lit(FIRST_LOAD.date())) for name in ("first_seen_at", "last_seen_at")}
    return events.withColumns(load_number).select(
        "event_id", "work_order_id", "event_type", "updated_at_utc", "payload_hash", "labor_minutes",
        "source_file", "source_row_number", "first_seen_at", "last_seen_at",
    )


def _load_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(configure(spark), "warehouse")
    load_batch(spark, inputs.landed(spark, sf_dir), root, run_id="run-1", now=FIRST_LOAD)
    # The same run once more, over another content: it is recorded and adds nothing.
    other = inputs.landed(spark, sf_dir, inputs.FILES[:1])
    load_batch(spark, other, root, run_id="run-1", now=SECOND_LOAD, is_retry=True)
    return Warehouse(spark, root).table("rejected_records").drop("rejection_id")


def _streamed(spark: SparkSession, sf_dir: str) -> Warehouse:
    folder, root = fresh_folder(configure(spark), "landing"), fresh_folder(spark, "warehouse")
    checkpoint = fresh_folder(spark, "stream")
    inputs.write_reference_files(spark, sf_dir, folder)
    for files in (inputs.FILES[:1], inputs.FILES[1:]):
        inputs.write_event_files(spark, sf_dir, folder, files)
        ingest_stream(spark, folder, root, checkpoint).awaitTermination()
    return Warehouse(spark, root)


def _stream_ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = _streamed(spark, sf_dir).table("rejected_records")
    return rejects.select("source_file", "source_row_number", "reason", "raw_payload")


def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir).table("work_order_events").select(
        "event_id", "work_order_id", "event_type", "updated_at_utc", "payload_hash", "labor_minutes",
        "source_file", "source_row_number",
    )


def _views_follow_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(configure(spark), "warehouse")
    create_views(Warehouse(spark, root))
    for n, files in enumerate((inputs.FILES[:1], inputs.FILES[1:])):
        load_batch(spark, inputs.landed(spark, sf_dir, files), root, run_id=f"run-{n}", now=(FIRST_LOAD, SECOND_LOAD)[n])
    # Made before the loads; read now, as temporary views belong to the session.
    return materialize(spark.sql("SELECT * FROM work_order_summary"), "summary")


def _summary_after_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(configure(spark), "warehouse")
    keep_analyses(Warehouse(spark, root))
    for n, files in enumerate((inputs.FILES[:1], inputs.FILES[1:])):
        load_batch(spark, inputs.landed(spark, sf_dir, files), root, run_id=f"run-{n}", now=(FIRST_LOAD, SECOND_LOAD)[n])
    return Warehouse(spark, root).table("kept_work_order_summary")


def _replay_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(configure(spark), "warehouse")
    load_batch(spark, inputs.landed(spark, sf_dir), root, run_id="run-1", now=FIRST_LOAD)
    named = F.try_variant_get(F.try_parse_json("raw"), "$.location.store_id", "string")
    stores = inputs.event_lines(spark, sf_dir).select(named.alias("store_id")).distinct()
    for run in ("replay-1", "replay-2"):
        load_replay(spark, root, stores, run_id=run, now=SECOND_LOAD)
    return _numbered_loads(Warehouse(spark, root).table("work_order_events"))


def _dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dry_run(spark, inputs.landed(spark, sf_dir)).drop("source_checksum")


def _replay_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The missing stores were added since: every store an event names is known.
    rejects = reject_rows(rejected_lines(_classified(spark, sf_dir)), "run-1", _seen_at())
    named = F.try_variant_get(F.try_parse_json("raw"), "$.location.store_id", "string")
    stores = inputs.event_lines(spark, sf_dir).select(named.alias("store_id")).distinct()
    judged = replay_rejects(rejects, stores, inputs.technicians(spark, sf_dir).clean)
    return judged.select("source_file", "source_row_number", "reject_reason")


_QUERIES: dict[str, Query] = {
    "work_order_summary": _summary,
    "work_order_status_counts": _over_summary(marts.work_order_status_counts),
    "technician_close_rank": _over_summary(marts.technician_close_rank),
    "technician_close_rank_ranges": _over_summary(lambda summary: marts.technician_close_rank(summary, ranges=64, max_broadcast=0)),
    "reopen_rate": _over_summary(marts.reopen_rate),
    "weekly_completed": _weekly_completed,
    "event_transitions": _over_events(marts.event_transitions),
    "abnormal_sequences": _over_events(marts.abnormal_sequences),
    "latest_event_per_work_order": _over_events(latest_event_per_work_order),
    "raw_lines": _raw_lines,
    "normalized_events": _normalized_events,
    "payload_hash": _payload_hash,
    "accepted_events": _accepted("strict"),
    "accepted_events_staged": _accepted("staged"),
    "rejected_records": _rejected,
    "rejected_records_staged": _rejected_staged,
    "reject_reason_counts": _reason_counts,
    "latest_events": _latest_events,
    "ingest_stats": _stats,
    "ingestion_run_row": _run_row,
    "distinct_estimate": _distinct_estimate,
    "batch_checksum": _checksum,
    "reference_scan": _reference_scan,
    "reference_clean": lambda spark, sf_dir: inputs.stores(spark, sf_dir).clean,
    "reference_clean_technicians": lambda spark, sf_dir: inputs.technicians(spark, sf_dir).clean,
    "reference_rejects": _reference_rejects,
    "reference_left_join": _reference_left_join,
    "unknown_references": _unknown_references,
    "unknown_references_large": _unknown_references_joined,
    "event_transitions_chunked": _transitions_by_chunks,
    "views_weekly_completed": _views_weekly_completed,
    "merge_events": _merge_events,
    "merge_replay": _merge_replay,
    "merge_stores": _merge_stores,
    "batch_already_loaded": _already_loaded,
    "constraint_violations": _constraint_violations,
    "load_events": _load_events,
    "load_rejects": lambda spark, sf_dir: _loaded(spark, sf_dir).table("rejected_records").drop("rejection_id"),
    "load_run": lambda spark, sf_dir: _loaded(spark, sf_dir).table("ingestion_runs").drop("source_checksum"),
    "load_twice": _load_twice,
    "dry_run": _dry_run,
    "replay_rejects": _replay_rejects,
    "summary_after_loads": _summary_after_loads,
    "replay_twice": _replay_twice,
    "views_follow_loads": _views_follow_loads,
    "load_retry": _load_retry,
    "stream_ingest": _stream_ingest,
    "stream_ingest_rejects": _stream_ingest_rejects,
}


def _registered(query: Query) -> Query:
    return lambda spark, sf_dir: _plain(query(configure(spark), sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Weekly completed work orders over the smallest tables."""
    return queries()["weekly_completed"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    return {name: _registered(query) for name, query in (_QUERIES | TEXT_QUERIES).items()}


def oracle_sql() -> dict[str, str]:
    same = {"technician_close_rank_ranges": "technician_close_rank", "unknown_references_large": "unknown_references", "event_transitions_chunked": "event_transitions", "views_weekly_completed": "weekly_completed", "load_retry": "load_rejects", "summary_after_loads": "views_follow_loads"}
    return ORACLES | {name: ORACLES[other] for name, other in same.items()} | TEXT_ORACLES
