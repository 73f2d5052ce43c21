"""Batch and stream loads into a warehouse of small files."""

import json
import os
from datetime import datetime, timezone
from itertools import product

import pytest
from pyspark.sql import functions as F

from workledger import schemas
from workledger.operators.merge import changed_events
from workledger.plans.checks import constraint_violations
from workledger.plans import load as load_module, marts, warehouse as warehouse_module
from workledger.plans.kept import keep_analyses
from workledger.plans.load import dry_run, load_batch, load_replay, open_rejects, replay_rejects
from workledger.plans.views import create_views
from workledger.plans.warehouse import EVENTS, KEPT, REJECTS, Warehouse, bucket_of
from workledger.session import materialize
from workledger.streaming.ingest import ingest_stream

DAY = [datetime(2026, 2, day, tzinfo=timezone.utc) for day in range(1, 6)]


def line(event_id, updated, kind="OPENED", **more):
    record = {
        "event_id": event_id, "work_order_id": "W1", "client_id": "C1", "event_type": kind,
        "event_timestamp": "2026-01-01T00:00:00Z", "updated_at": f"2026-01-{updated:02}T00:00:00Z", **more,
    }
    return json.dumps(record)


def batch(folder, *lines, name="work_order_events_01.jsonl", store="S1"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    (folder / "stores.csv").write_text(
        f"store_id,client_id,store_number,region,active_flag\n{store},C1,1,North,TRUE\n,C1,2,North,TRUE\n"
    )
    (folder / "technicians.csv").write_text("technician_id,technician_name,home_region,active_flag\nT1,Ann,North,FALSE\n")
    return str(folder)


def events(warehouse):
    rows = warehouse.table(EVENTS).collect()
    return {
        r.event_id: (r.event_type, r.first_seen_at.day, r.last_seen_at.day, json.loads(r.raw_payload.toJson())["event_type"])
        for r in rows
    }


def buckets(spark, *ids, count=64):
    rows = spark.createDataFrame([(i,) for i in ids], "id string").select(bucket_of(F.col("id"), count).alias("b")).collect()
    return {r.b for r in rows}


def test_first_load_writes_events_to_their_buckets_alone(spark, tmp_path, monkeypatch):
    """Nothing is stored, so nothing is compared: no table of wide rows lies between the choice of versions and the buckets."""
    labels = []
    for module in (warehouse_module, load_module):
        monkeypatch.setattr(module, "materialize", lambda df, label: (labels.append(label), materialize(df, label))[1])
    root, ids = str(tmp_path / "warehouse"), [f"E{n}" for n in range(40)]
    warehouse = Warehouse(spark, root)
    load_batch(spark, batch(tmp_path / "one", *[line(i, 1) for i in ids], *[line(i, 2, "CLOSED") for i in ids[:3]]), root, run_id="r1", now=DAY[0])
    assert EVENTS not in labels
    assert set(warehouse.state().of(EVENTS)) == buckets(spark, *ids)
    assert events(warehouse) == {i: (("CLOSED" if i in ids[:3] else "OPENED",) + (1, 1) + ("CLOSED" if i in ids[:3] else "OPENED",)) for i in ids}
    assert warehouse.table("ingestion_runs").first().unique_event_count == 40
    load_batch(spark, batch(tmp_path / "two", line("E1", 3, "REOPENED"), line("E2", 1)), root, run_id="r2", now=DAY[1])
    assert EVENTS in labels
    found = events(warehouse)
    assert (found["E1"], found["E2"], len(found)) == (("REOPENED", 1, 2, "REOPENED"), ("CLOSED", 1, 1, "CLOSED"), 40)


def test_first_load_without_events(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    load_batch(spark, batch(tmp_path / "one", "not-json", ""), root, run_id="r1", now=DAY[0])
    assert events(Warehouse(spark, root)) == {}
    load_batch(spark, batch(tmp_path / "two", line("E1", 1)), root, run_id="r2", now=DAY[1])
    assert events(Warehouse(spark, root)) == {"E1": ("OPENED", 2, 2, "OPENED")}


def test_load_replay_and_correct(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    warehouse = Warehouse(spark, root)
    at_s2 = {"location": {"store_id": "S2"}}
    first = batch(tmp_path / "one", line("E1", 1), line("E2", 1), line("E3", 5), "", line("E4", 1, **at_s2), line("E1", 2, "CLOSED"))
    assert load_batch(spark, first, root, run_id="r1", now=DAY[0]) == "r1"
    assert events(warehouse) == {
        "E1": ("CLOSED", 1, 1, "CLOSED"), "E2": ("OPENED", 1, 1, "OPENED"), "E3": ("OPENED", 1, 1, "OPENED"),
    }
    rejects = warehouse.table("rejected_records")
    assert {(r.run_id, r.source_file, r.source_row_number, r.reason) for r in rejects.collect()} == {
        ("r1", "work_order_events_01.jsonl", 4, "blank JSONL line"),
        ("r1", "work_order_events_01.jsonl", 5, "unknown store_id: S2"),
        ("r1", "stores.csv", 3, "missing store_id"),
    }
    assert rejects.select("rejection_id").distinct().count() == 3
    run = warehouse.table("ingestion_runs").first()
    assert (run.file_count, run.record_count, run.unique_event_count, run.rejected_count) == (3, 7, 3, 3)

    # The same content again, from another folder: nothing but references.
    again = batch(tmp_path / "copy", *(tmp_path / "one" / "work_order_events_01.jsonl").read_text().splitlines())
    before = warehouse.state().of(EVENTS)
    assert load_batch(spark, again, root, run_id="r2", now=DAY[1]) == "r1"
    with pytest.raises(ValueError, match="r1 is recorded with other content"):
        load_batch(spark, batch(tmp_path / "other", line("E9", 1)), root, run_id="r1", now=DAY[1])
    assert warehouse.state().of(EVENTS) == before
    assert warehouse.table("ingestion_runs").count() == 1

    # Corrections: newer, equal time with another payload, older, new event.
    second = batch(tmp_path / "two", line("E1", 3, "REOPENED"), line("E2", 1, "ASSIGNED"), line("E3", 4, "CLOSED"),
                   line("E5", 1), store="S2")
    assert load_batch(spark, second, root, run_id="r3", now=DAY[2]) == "r3"
    assert events(warehouse) == {
        "E1": ("REOPENED", 1, 3, "REOPENED"), "E2": ("ASSIGNED", 1, 3, "ASSIGNED"),
        "E3": ("OPENED", 1, 1, "OPENED"), "E5": ("OPENED", 3, 3, "OPENED"),
    }
    assert {row.store_id for row in warehouse.table("stores").collect()} == {"S1", "S2"}

    # A small batch leaves the buckets of other events alone.
    before = warehouse.state().of(EVENTS)
    third = batch(tmp_path / "three", line("E6", 1), line("E1", 4, "CLOSED"))
    load_batch(spark, third, root, run_id="r4", now=DAY[3])
    after = warehouse.state().of(EVENTS)
    assert {b for b in after if before.get(b) != after[b]} == buckets(spark, "E6", "E1")
    assert events(warehouse)["E1"] == ("CLOSED", 1, 4, "CLOSED")
    assert {tuple(row) for row in warehouse.run_status().collect()} == {
        ("r1", "SUCCEEDED"), ("r2", "STARTED"), ("r3", "SUCCEEDED"), ("r4", "SUCCEEDED"),
    }

    # The store that was missing is known by now.
    judged = replay_rejects(
        rejects.filter("source_file like '%jsonl'"), warehouse.table("stores"), warehouse.table("technicians")
    )
    assert {(r.event_id, r.reject_reason) for r in judged.collect()} == {("E4", None), (None, "blank JSONL line")}

    tables = ("work_order_events", "rejected_records", "ingestion_runs")
    checks = constraint_violations(**{name: warehouse.table(name) for name in tables})
    assert checks.filter("violations <> 0").count() == 0 and checks.count() == 22


def test_order_of_batches_decides_equal_times(spark, tmp_path):
    a, b = line("E1", 1, "OPENED"), line("E1", 1, "CLOSED")
    one, two = batch(tmp_path / "a", a), batch(tmp_path / "b", b)
    kinds = set()
    for name, order in (("ab", (one, two)), ("ba", (two, one))):
        root = str(tmp_path / name)
        for source in order:
            load_batch(spark, source, root, now=DAY[0])
        kinds.add((name, Warehouse(spark, root).table(EVENTS).first().event_type))
    assert kinds == {("ab", "CLOSED"), ("ba", "OPENED")}


def test_failed_load_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "warehouse")
    load_batch(spark, batch(tmp_path / "one", line("E1", 1)), root, run_id="r1", now=DAY[0])
    warehouse = Warehouse(spark, root)
    before, state = events(warehouse), warehouse.state()

    def fail(*_):
        raise RuntimeError("lost")

    second = batch(tmp_path / "two", line("E1", 2, "CLOSED"), "bad", store="S9")
    with monkeypatch.context() as patched:
        patched.setattr(Warehouse, "publish", fail)
        with pytest.raises(RuntimeError, match="lost"):
            load_batch(spark, second, root, run_id="r2", now=DAY[1])
    assert events(warehouse) == before and warehouse.state() == state
    assert ("r2", "FAILED") in {tuple(row) for row in warehouse.run_status().collect()}
    assert {row.store_id for row in warehouse.table("stores").collect()} == {"S1"}
    load_batch(spark, second, root, run_id="r2", now=DAY[1])
    assert events(warehouse) == {"E1": ("CLOSED", 1, 2, "CLOSED")}
    assert warehouse.table("rejected_records").filter("run_id = 'r2'").count() == 2


def test_crash_while_publishing_blocks_nothing(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    load_batch(spark, batch(tmp_path / "one", line("E1", 1)), root, run_id="r1", now=DAY[0])
    (tmp_path / "warehouse" / "commits" / ".part-unfinished.parquet").write_text("{")
    (tmp_path / "warehouse" / "commits" / "_temporary" / "0").mkdir(parents=True)
    load_batch(spark, batch(tmp_path / "two", line("E2", 1)), root, run_id="r2", now=DAY[1])
    assert set(events(Warehouse(spark, root))) == {"E1", "E2"}


def test_second_writer_is_refused(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    seen_by_both = warehouse.state()
    warehouse.publish(seen_by_both, "first", {"stores": [3]})
    first = warehouse.state()
    with pytest.raises(RuntimeError, match="another load published"):
        warehouse.publish(seen_by_both, "lost", {"stores": [3]})
    assert warehouse.state() == first and first.of("stores") == {3: "first"}


def test_violated_constraint_fails_the_load(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "warehouse")
    monkeypatch.setitem(schemas.NOT_NULL, EVENTS, ("event_id", "technician_id"))
    with pytest.raises(ValueError, match="work_order_events.technician_id not null: 1"):
        load_batch(spark, batch(tmp_path / "one", line("E1", 1)), root, now=DAY[0])
    assert Warehouse(spark, root).state().of(EVENTS) == {}


def test_histories_of_four_loads(spark):
    """Every history of four loads over two times and two payloads, against a loop."""
    columns = "event_id string, updated_at_utc timestamp, payload_hash string, first_seen_at timestamp, last_seen_at timestamp"
    stored, expected = spark.createDataFrame([], columns), {}
    histories = list(product([None, (1, "a"), (1, "b"), (2, "a"), (2, "b")], repeat=4))
    for load in range(4):
        given = []
        for n, history in enumerate(histories):
            if version := history[load]:
                given.append((f"E{n}", DAY[version[0]], version[1]))
                kept = expected.get(n)
                if kept is None or version[0] > kept[0] or version[0] == kept[0] and version[1] != kept[1]:
                    expected[n] = (*version, kept[2] if kept else load, load)
        batch = spark.createDataFrame(given, "event_id string, updated_at_utc timestamp, payload_hash string")
        changes = changed_events(stored, batch, F.lit(DAY[load]).cast("timestamp"))
        rows = stored.join(changes, "event_id", "left_anti").unionByName(changes).collect()
        stored = spark.createDataFrame(rows, columns)
    found = [(r.event_id, r.updated_at_utc.day - 1, r.payload_hash, r.first_seen_at.day - 1, r.last_seen_at.day - 1) for r in rows]
    assert sorted(found) == sorted((f"E{n}", *kept) for n, kept in expected.items())


def spoil(root, name, keep):
    """Make every file of the buckets not in ``keep`` unreadable; returns the files."""
    spoiled = [f for f in (root / name).glob("bucket=*/load=*/*.parquet") if int(f.parts[-3].partition("=")[2]) not in keep]
    for file in spoiled:
        file.write_text("spoiled")
    return spoiled


def test_load_reads_and_writes_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    ids = [f"E{n}" for n in range(300)]
    load_batch(spark, batch(tmp_path / "one", *[line(i, 1) for i in ids]), root, run_id="r1", now=DAY[0])
    warehouse = Warehouse(spark, root)
    before = warehouse.state()
    assert set(before.of(EVENTS)) == buckets(spark, *ids) and len(before.of(EVENTS)) > 60
    two = buckets(spark, "E1", "E2")
    assert len(two) == 2
    spoiled = spoil(tmp_path / "warehouse", EVENTS, two)
    content = batch(tmp_path / "two", line("E1", 2, "CLOSED"), line("E2", 1, "CLOSED"), line("E3", 1))
    three = two | buckets(spark, "E3")
    with pytest.raises(Exception):  # E3 is compared with what its bucket holds
        load_batch(spark, content, root, run_id="r2", now=DAY[1])
    load_batch(spark, batch(tmp_path / "three", line("E1", 2, "CLOSED"), line("E2", 1, "CLOSED")), root, run_id="r3", now=DAY[1])
    after = warehouse.state()
    assert {b for b in after.of(EVENTS) if after.of(EVENTS)[b] != before.of(EVENTS)[b]} == two and three > two
    # The references are as before, so nothing of them is written.
    assert after.of("stores") == before.of("stores") and after.of("technicians") == before.of("technicians")
    assert [(r.event_id, r.event_type, r.first_seen_at.day, r.last_seen_at.day) for r in warehouse.lookup(EVENTS, ["E1"]).collect()] == [("E1", "CLOSED", 1, 2)]
    assert warehouse.lookup(EVENTS, []).count() == 0
    assert all(file.read_text() == "spoiled" for file in spoiled)
    # An older version changes nothing: its bucket is read and not written.
    load_batch(spark, batch(tmp_path / "four", line("E1", 1, "ASSIGNED")), root, run_id="r4", now=DAY[2])
    assert warehouse.state().of(EVENTS) == after.of(EVENTS)


def test_partitions_stay_few(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    for n in range(3):
        load_batch(spark, batch(tmp_path / f"b{n}", line(f"E{n}", 1), line("E0", n + 1)), root, run_id=f"r{n}", now=DAY[n])
    warehouse = Warehouse(spark, root)
    rows = lambda: {name: sorted(map(str, warehouse.table(name).collect())) for name in (EVENTS, REJECTS, "stores", "ingestion_runs")}
    before = rows()
    warehouse.compact()
    assert len(warehouse.state().appended[REJECTS]) == 1
    assert set(warehouse.state().of(EVENTS)) == buckets(spark, *[f"E{n}" for n in range(3)])
    # E0 was rewritten twice, the rejects of three loads were written together.
    assert rows() == before and len(warehouse.vacuum()) == 2 + 3
    assert rows() == before and warehouse.unlisted() == []
    assert warehouse.table("ingestion_runs").count() == 3
    assert {name: row[1:3] for name, row in events(warehouse).items()} == {
        "E0": (1, 3), **{f"E{n}": (n + 1, n + 1) for n in range(1, 3)}
    }


def test_retry_of_a_recorded_run_adds_nothing(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    load_batch(spark, batch(tmp_path / "one", line("E1", 1), "bad"), root, run_id="r1", now=DAY[0])
    before = Warehouse(spark, root).state()
    again = batch(tmp_path / "one", line("E1", 1), "bad", store="S7")
    assert load_batch(spark, again, root, run_id="r1", now=DAY[1], is_retry=True) == "r1"
    assert Warehouse(spark, root).state() == before


def test_empty_event_file_counts(spark, tmp_path):
    source = batch(tmp_path / "one", line("E1", 1))
    before = dry_run(spark, source).first()
    (tmp_path / "one" / "work_order_events_02.jsonl").write_text("")
    after = dry_run(spark, source).first()
    assert (before.files_read, after.files_read) == (3, 4)
    assert before.source_checksum != after.source_checksum


def test_staged_profile_knows_earlier_references(spark, tmp_path):
    at_s1 = {"location": {"store_id": "S1"}, "labor": {"minutes": 1.5}}
    for profile, accepted in (("staged", 1), ("strict", 0)):
        root = str(tmp_path / profile)
        load_batch(spark, batch(tmp_path / "one", line("E0", 1)), root, profile, now=DAY[0])
        load_batch(spark, batch(tmp_path / "two", line("E1", 1, **at_s1), store="S2"), root, profile, now=DAY[1])
        assert Warehouse(spark, root).table(EVENTS).filter("event_id = 'E1'").count() == accepted


def test_dry_run(spark, tmp_path):
    source = batch(tmp_path / "one", line("E1", 1), line("E1", 2), line("E2", 1), "bad")
    stats = dry_run(spark, source).first().asDict()
    assert len(stats.pop("source_checksum")) == 64
    assert stats == {
        "files_read": 3, "records_read": 4, "accepted_event_versions": 3, "unique_valid_events": 2,
        "duplicate_or_superseded_records": 1, "rejected_records": 2, "unique_work_orders": 1, "stores": 1,
        "technicians": 1,
    }


def test_batch_without_valid_events(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    load_batch(spark, batch(tmp_path / "one", "bad"), root, now=DAY[0])
    assert Warehouse(spark, root).table(EVENTS).count() == 0
    assert Warehouse(spark, root).table("rejected_records").count() == 2


def test_stream_loads_each_file_once(spark, tmp_path):
    root, checkpoint = str(tmp_path / "warehouse"), str(tmp_path / "checkpoint")
    source = batch(tmp_path / "landing", line("E1", 2), line("E2", 1))
    ingest_stream(spark, source, root, checkpoint).awaitTermination()
    # An old event corrected late, and one that is older than what is stored.
    batch(tmp_path / "landing", line("E2", 3, "CLOSED"), line("E1", 1, "CLOSED"), name="work_order_events_02.jsonl")
    ingest_stream(spark, source, root, checkpoint).awaitTermination()
    ingest_stream(spark, source, root, checkpoint).awaitTermination()
    warehouse = Warehouse(spark, root)
    assert {(r.event_id, r.event_type) for r in warehouse.table(EVENTS).collect()} == {("E1", "OPENED"), ("E2", "CLOSED")}
    runs = [r.run_id for r in warehouse.table("ingestion_runs").collect()]
    assert sorted(run.rpartition("-")[2] for run in runs) == ["0", "1"]

    # A new checkpoint replays all files as one batch; no event is added twice, no run id repeats.
    ingest_stream(spark, source, root, str(tmp_path / "again")).awaitTermination()
    runs = [r.run_id for r in warehouse.table("ingestion_runs").collect()]
    assert len(runs) == len(set(runs)) == 3
    assert {(r.event_id, r.event_type) for r in warehouse.table(EVENTS).collect()} == {("E1", "OPENED"), ("E2", "CLOSED")}


def test_stream_by_single_files(spark, tmp_path):
    source = batch(tmp_path / "landing", line("E1", 2), "bad")
    batch(tmp_path / "landing", "bad", line("E2", 1), name="work_order_events_02.jsonl")
    root = str(tmp_path / "warehouse")
    ingest_stream(spark, source, root, str(tmp_path / "checkpoint"), max_files=1).awaitTermination()
    warehouse = Warehouse(spark, root)
    assert warehouse.table("ingestion_runs").count() == 2
    rejects = warehouse.table("rejected_records").filter("source_file like '%jsonl'")
    assert {(r.source_file[-8:], r.source_row_number) for r in rejects.collect()} == {("01.jsonl", 2), ("02.jsonl", 1)}


def test_parts_of_a_file_are_numbered_on(spark, tmp_path):
    """Parts in one micro-batch each, and parts that land later, have the numbers of one batch."""
    source = batch(tmp_path / "landing", line("E1", 2))
    folder = tmp_path / "landing" / "work_order_events_03.jsonl"
    folder.mkdir()
    parts = [folder / f"part-0000{n}.txt" for n in range(3)]
    for n, part in enumerate(parts):
        part.write_text("bad\n" * (n + 2))
        os.utime(part, (1_700_000_000 + n, 1_700_000_000 + n))  # files are taken by age
    root, checkpoint = str(tmp_path / "warehouse"), str(tmp_path / "checkpoint")
    ingest_stream(spark, source, root, checkpoint, max_files=1).awaitTermination()
    (folder / "part-00009-late.txt").write_text("bad\n\n")
    ingest_stream(spark, source, root, checkpoint).awaitTermination()
    warehouse = Warehouse(spark, root)
    rejects = warehouse.table(REJECTS).filter("source_file = 'work_order_events_03.jsonl'")
    total = sum(n + 2 for n in range(len(parts)))
    assert sorted(r.source_row_number for r in rejects.collect()) == list(range(1, total + 3))
    assert [r.source_row_number for r in rejects.filter("reason like 'blank%'").collect()] == [total + 2]
    assert warehouse.table("ingestion_runs").count() == len(parts) + 2


def test_views_follow_loads(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    warehouse = Warehouse(spark, root)
    names = create_views(warehouse)
    count = lambda name: spark.table(name).count()
    assert {name: count(name) for name in names if name != "analysis_reopen_rate"} == {name: 0 for name in names if name != "analysis_reopen_rate"}
    sources = [
        batch(tmp_path / "one", line("E1", 1), line("E2", 2, "CLOSED", work_order_id="W2"), "bad"),
        batch(tmp_path / "two", line("E1", 3, "CLOSED"), line("E3", 3, work_order_id="W2"), line("E4", 1, "REOPENED"), "worse"),
    ]
    for n, source in enumerate(sources):
        load_batch(spark, source, root, run_id=f"r{n}", now=DAY[n])
        events = warehouse.table(EVENTS)
        summary = marts.work_order_summary(events)
        expected = {
            "work_order_summary": summary,
            "analysis_technician_close_rank": marts.technician_close_rank(summary),
            "analysis_reopen_rate": marts.reopen_rate(summary),
            "analysis_weekly_completed": marts.weekly_completed(summary),
            "analysis_abnormal_sequences": marts.abnormal_sequences(events),
            **{name: warehouse.table(name) for name in (REJECTS, "ingestion_runs", "stores", "technicians", "replayed_rejects")},
            **{name: warehouse.table(name) for name in KEPT},
            EVENTS: events,
        }
        assert set(expected) == set(names)
        for name, frame in expected.items():
            assert sorted(map(str, spark.table(name).collect())) == sorted(map(str, frame.collect())), name
            assert spark.table(name).columns == frame.columns
    assert count(EVENTS) == 4 and count("analysis_abnormal_sequences") == 1
    warehouse.compact()
    warehouse.vacuum()
    assert count(REJECTS) == 4 and count(EVENTS) == 4


def test_replay_loads_once(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    warehouse = Warehouse(spark, root)
    at = lambda store: {"location": {"store_id": store}}
    load_batch(spark, batch(tmp_path / "one", line("E1", 1, **at("S2")), line("E2", 1), line("E3", 1, **at("S9")), "bad"), root, run_id="r1", now=DAY[0])
    assert load_replay(spark, root, run_id="p0", now=DAY[1]) is None
    load_batch(spark, batch(tmp_path / "two", line("E1", 2, "CLOSED", **at("S2")), line("E1", 1, "ASSIGNED", **at("S8")), store="S2"), root, run_id="r2", now=DAY[1])
    before = {tuple(r) for r in warehouse.table(REJECTS).collect()}
    assert load_replay(spark, root, run_id="p1", now=DAY[2]) == "p1"
    # E1 as first rejected is older than what was loaded since: it is noted and changes nothing.
    assert events(warehouse)["E1"] == ("CLOSED", 2, 2, "CLOSED")
    stores = spark.createDataFrame([("S9",)], "store_id string")
    assert load_replay(spark, root, stores, run_id="p2", now=DAY[3]) == "p2"
    assert load_replay(spark, root, stores, run_id="p3", now=DAY[4]) is None
    assert events(warehouse)["E3"] == ("OPENED", 4, 4, "OPENED") and len(events(warehouse)) == 3
    # Rejects stay as they were, under their first run.
    assert {tuple(r) for r in warehouse.table(REJECTS).collect()} == before
    assert sorted((r.run_id, r.source_file[-8:], r.source_row_number) for r in open_rejects(warehouse).collect()) == [
        ("r1", "01.jsonl", 4), ("r1", "ores.csv", 3), ("r2", "01.jsonl", 2), ("r2", "ores.csv", 3),
    ]
    assert {tuple(r) for r in warehouse.run_status().collect()} >= {("p1", "SUCCEEDED"), ("p2", "SUCCEEDED"), ("p3", "STARTED")}
    with pytest.raises(ValueError, match="p2 is recorded"):
        load_replay(spark, root, run_id="p2")


def test_kept_tables_follow_micro_batches(spark, tmp_path):
    root, checkpoint = str(tmp_path / "warehouse"), str(tmp_path / "checkpoint")
    warehouse = Warehouse(spark, root)
    load_batch(spark, batch(tmp_path / "old", *[line(f"O{n}", 1, work_order_id=f"X{n}") for n in range(150)]), root, now=DAY[0])
    keep_analyses(warehouse)
    untouched = warehouse.state().of("kept_work_order_summary")
    batches = [
        [line("E1", 1), line("E2", 2, "CLOSED"), line("E3", 3, "OPENED"), line("E4", 1, "CLOSED", work_order_id="W2")],
        # A correction of the type, one that moves an event to another work order, an older one.
        [line("E2", 3, "WORK_COMPLETED", labor={"minutes": 5}), line("E3", 4, "OPENED", work_order_id="W2"), line("E1", 1, "CLOSED"), "bad"],
        # W2 loses all its events; a new one.
        [line("E3", 5, "REOPENED"), line("E4", 2, "CLOSED", work_order_id="W3"), line("E5", 2, "CLOSED", work_order_id="W4")],
    ]
    touched = [{"W1", "W2"}, {"W1", "W2"}, {"W1", "W2", "W3", "W4"}]
    before = untouched
    spoiled = spoil(tmp_path / "warehouse", "work_order_history", buckets(spark, "W1", "W2", "W3", "W4"))
    assert len(spoiled) > 40
    for n, lines in enumerate(batches):
        source = batch(tmp_path / "landing", *lines, name=f"work_order_events_0{n}.jsonl")
        ingest_stream(spark, source, root, checkpoint).awaitTermination()
        events = warehouse.table(EVENTS)
        summary, kept = marts.work_order_summary(events), warehouse.table("kept_work_order_summary")
        assert kept.schema == summary.schema or kept.columns == summary.columns
        assert sorted(map(str, kept.collect())) == sorted(map(str, summary.collect()))
        found = warehouse.table("kept_abnormal_sequences").collect()
        assert sorted(map(str, found)) == sorted(map(str, marts.abnormal_sequences(events).collect()))
        after = warehouse.state().of("kept_work_order_summary")
        assert {b for b in after if after[b] != before.get(b)} == buckets(spark, *touched[n])
        before = after
    assert {r.work_order_id for r in kept.collect()} == {f"X{n}" for n in range(150)} | {"W1", "W3", "W4"}
