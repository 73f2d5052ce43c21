"""Operators on skewed and edge inputs, against plain Python."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import workledger.operators.ranks  # noqa: F401
from workledger import operators
from workledger.operators.existence import flag_known, unknown_references
from workledger.operators.merge import merge_latest, upsert
from workledger.operators.previous import CHUNK_ROWS, chunks_of, heavy_keys, with_previous
from workledger.operators.ranks import row_numbers
from workledger.plans import marts
from workledger.plans.stats import distinct_sketches, sketched_counts
from workledger.schemas import ABNORMAL_TRANSITIONS, EVENT_TYPES

START = datetime(2026, 1, 1)
EVENTS = (
    "event_id string, work_order_id string, client_id string, event_type string, event_timestamp_utc timestamp,"
    "updated_at_utc timestamp, priority string, technician_id string, store_id string, labor_minutes bigint"
)


def skewed_events(spark, rows=4000):
    """A third of all rows on one work order, many of them at the same time."""
    rng = random.Random(7)
    data = []
    for n in range(rows):
        order = "HOT" if n % 3 == 0 else f"W{rng.randrange(400)}"
        at = START + timedelta(hours=rng.randrange(50) if n % 2 else 3)
        data.append(
            (f"E{n:05}", order, f"C{rng.randrange(3)}", rng.choice(EVENT_TYPES), at,
             at + timedelta(minutes=rng.randrange(3)), None, rng.choice([None, "T1", "T2", "T3"]),
             None, rng.choice([None, 5, 7]))
        )
    return data, spark.createDataFrame(data, EVENTS)


def python_transitions(data):
    previous, found = {}, {}
    for row in sorted(data, key=lambda r: (r[1], r[4], r[5], r[0])):
        found[row[0]] = previous.get(row[1])
        previous[row[1]] = row[3]
    return found


@pytest.mark.parametrize("chunk_rows", [100, 1000, 5_000_000])
def test_previous_value_of_large_keys(spark, chunk_rows):
    data, df = skewed_events(spark)
    rows = marts.event_transitions(df, chunk_rows).collect()
    assert len(rows) == len(data)
    assert {row.event_id: row.previous_event_type for row in rows} == python_transitions(data)
    assert [row.work_order_id for row in heavy_keys(df, "work_order_id", 1000).collect()] == ["HOT"]


def test_small_chunks_do_not_make_a_task_each(spark):
    data, df = skewed_events(spark)
    rows = marts.event_transitions(df, 3)
    assert {row.event_id: row.previous_event_type for row in rows.collect()} == python_transitions(data)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [chunks_of(spark, n, 3) for n in (2, 10, 4000, 6_000_000)] == [1, min(4, tasks), tasks, tasks]
    # Ranges stay below the rows that one task takes, however many rows there are.
    assert chunks_of(spark, 1000 * CHUNK_ROWS, CHUNK_ROWS) == 1001
    assert chunks_of(spark, 1000 * CHUNK_ROWS, 3) == 1001


def test_previous_value_may_be_null(spark):
    data = [("k", n, None if n % 3 else n) for n in range(300)]
    df = spark.createDataFrame(data, "k string, n int, v int")
    rows = with_previous(df, "k", ["n"], "v", "p", chunk_rows=40).collect()
    assert {row.n: row.p for row in rows} == {n: (data[n - 1][2] if n else None) for n in range(300)}


def test_abnormal_sequences(spark):
    data, df = skewed_events(spark)
    before = python_transitions(data)
    expected = sorted((r[1], before[r[0]], r[3], r[4]) for r in data if (before[r[0]], r[3]) in ABNORMAL_TRANSITIONS)
    assert sorted(tuple(row) for row in marts.abnormal_sequences(df).collect()) == expected


@pytest.mark.parametrize("max_broadcast", [1_000_000, 0])
def test_known_flag_by_broadcast_and_by_join(spark, max_broadcast):
    rows = [(n, "HOT" if n % 3 == 0 else (None if n % 3 == 1 else f"S{n}")) for n in range(900)]
    df = spark.createDataFrame(rows, "source_row_number bigint, store_id string")
    ids = spark.createDataFrame([("HOT",), ("HOT",), (None,), *((f"S{n}",) for n in range(450))], "store_id string")
    found = flag_known(df, ids, "store_id", "known", max_broadcast).collect()
    assert len(found) == len(rows)
    known = {"HOT", *(f"S{n}" for n in range(450))}
    assert all(row.known == (row.store_id in known) for row in found)
    only_id = df.select("store_id")
    assert unknown_references(only_id, ids, "store_id", max_broadcast).count() == sum(s is not None and s not in known for _, s in rows)


MERGE = "event_id string, updated_at_utc timestamp, payload_hash string, first_seen_at timestamp, last_seen_at timestamp"


def merged(spark, target, source):
    at = {1: START, 2: START + timedelta(days=1), 3: START + timedelta(days=2)}
    first, now = START - timedelta(days=9), START + timedelta(days=9)
    t = spark.createDataFrame([(e, at[u], h, first, first) for e, u, h in target], MERGE)
    s = spark.createDataFrame([(e, at[u], h) for e, u, h in source], "event_id string, updated_at_utc timestamp, payload_hash string")
    rows = merge_latest(t, s, F.lit(now)).collect()
    times = {value: key for key, value in at.items()}
    return {
        r.event_id: (times[r.updated_at_utc], r.payload_hash, r.first_seen_at == first, r.last_seen_at == now) for r in rows
    }


def test_rows_are_narrow_where_ids_are_looked_up(spark, monkeypatch):
    from workledger.operators import classify as judging

    moved = []

    def looked_up(df, ids, column, flag):
        moved.append(set(df.columns))
        return flag_known(df, ids, column, flag, 0)

    monkeypatch.setattr(judging, "flag_known", looked_up)
    lines = spark.createDataFrame([('{"event_type":"OPENED"}',), ("bad",)], "raw string")
    ids = spark.createDataFrame([("S1", "T1")], "store_id string, technician_id string")
    judged = {row.raw: row.reject_reason for row in judging.classify(lines, ids, ids).collect()}
    assert judged == {'{"event_type":"OPENED"}': "event_id is required", "bad": "invalid JSON"}
    assert len(moved) == 2 and not any(name in columns for columns in moved for name in ("_doc", "_valid", "_priority_given"))


def test_merge_truth_table(spark):
    target = [("newer", 1, "b"), ("other hash", 2, "b"), ("same", 2, "b"), ("older", 2, "b"), ("target only", 1, "b")]
    source = [("newer", 2, "a"), ("other hash", 2, "a"), ("same", 2, "b"), ("older", 1, "z"), ("new", 1, "a")]
    assert merged(spark, target, source) == {
        "newer": (2, "a", True, True),
        "other hash": (2, "a", True, True),
        "same": (2, "b", True, False),
        "older": (2, "b", True, False),
        "target only": (1, "b", True, False),
        "new": (1, "a", False, True),
    }


def test_merge_into_empty_and_of_nothing(spark):
    assert merged(spark, [], [("e", 1, "a")]) == {"e": (1, "a", False, True)}
    assert merged(spark, [("e", 1, "a")], []) == {"e": (1, "a", True, False)}


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([(3, "b"), (4, "c")], "v int, k string")
    assert {tuple(row) for row in upsert(target, source, "k").collect()} == {("a", 1), ("b", 3), ("c", 4)}


def order(spark, *events):
    rows = [
        (f"E{n}", "W", "C", kind, START + timedelta(hours=hour), START, None, technician, None, labor)
        for n, (kind, hour, technician, labor) in enumerate(events)
    ]
    return spark.createDataFrame(rows, EVENTS)


def test_summary_takes_the_last_event_with_its_nulls(spark):
    row = marts.work_order_summary(
        order(spark, ("OPENED", 0, "T1", None), ("WORK_COMPLETED", 1, "T1", 5), ("WORK_COMPLETED", 2, "T1", None),
              ("CLOSED", 3, "T1", 9), ("REOPENED", 4, "T2", None), ("ASSIGNED", 4, None, None))
    ).first()
    assert (row.current_status, row.technician_id) == ("ASSIGNED", None)
    assert (row.total_labor_minutes, row.event_count, row.reopen_count, row.resolution_hours) == (5, 6, 1, 3.0)


def test_no_resolution_when_closed_before_opened(spark):
    row = marts.work_order_summary(order(spark, ("CLOSED", 0, "T", None), ("OPENED", 1, "T", None))).first()
    assert (row.current_status, row.resolution_hours) == ("OPEN", None)


def test_analyses_of_nothing(spark):
    summary = marts.work_order_summary(spark.createDataFrame([], EVENTS))
    assert [tuple(row) for row in marts.reopen_rate(summary).collect()] == [(None,)]
    assert marts.weekly_completed(summary).count() == 0
    assert marts.technician_close_rank(summary).count() == 0


@pytest.mark.parametrize("ranges, max_broadcast", [(None, 10), (None, 0), (1, 10), (4, 0), (64, 10)])
def test_ranks_by_ranges(spark, monkeypatch, ranges, max_broadcast):
    closed = [f"T{n % 40}" for n in range(900) if n % 40 < n % 61] + [None] * 50
    rows = [(t, "CLOSED") for t in closed] + [("T1", "OPEN")] * 99
    found = marts.technician_close_rank(spark.createDataFrame(rows, "technician_id string, current_status string"), ranges, max_broadcast)
    counts = Counter(t for t in closed if t)
    order = sorted(set(counts.values()), reverse=True)
    assert {tuple(r) for r in found.collect()} == {(t, n, order.index(n) + 1) for t, n in counts.items()}
    monkeypatch.setattr(operators.ranks, "MAX_IN_ONE_TASK", 3)
    by_ranges = marts.technician_close_rank(spark.createDataFrame(rows, "technician_id string, current_status string"), ranges, max_broadcast)
    assert sorted(by_ranges.collect()) == sorted(found.collect())
    numbered = row_numbers(spark.createDataFrame([(n,) for n in (5, 3, None, 9, 7)], "n int"), [F.col("n").isNull(), F.col("n")], "place", ranges)
    assert {(r.n, r.place) for r in numbered.collect()} == {(3, 1), (5, 2), (7, 3), (9, 4), (None, 5)}


def test_united_sketches_are_the_sketch_of_all(spark):
    rows = spark.range(60_000).selectExpr("id % 7 as run", "cast(id % 20000 as string) as a", "concat('x', id % 3) as b")
    apart = sketched_counts(distinct_sketches(rows, "run", "a", "b"), "a", "b").first()
    together = sketched_counts(distinct_sketches(rows.withColumn("run", F.lit(0)), "run", "a", "b"), "a", "b").first()
    assert apart == together and abs(apart.a - 20_000) <= 400 and apart.b == 3
