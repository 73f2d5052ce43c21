"""Every reject rule of both profiles, JSON edge cases, timestamps and labor values."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from workledger.functions import payload
from workledger.functions.text import WHITE_SPACE, any_padded, iso_timestamp, stripped
from workledger.operators.classify import accepted_events, classify
from workledger.operators.latest import latest_events

BASE = {
    "event_id": "E1", "work_order_id": "W7", "client_id": "C3", "event_type": "Assigned", "priority": "p3",
    "event_timestamp": "2025-11-30T22:15:00-02:30", "updated_at": "2025-12-01T09:30:00+01:00",
    "technician": {"id": "T1"}, "location": {"region": "Harbour", "store_id": "S1"}, "labor": {"minutes": 35},
}
DROP = object()


def event(**changes):
    record = {**BASE, **changes}
    return json.dumps({k: v for k, v in record.items() if v is not DROP}, ensure_ascii=False)


def judge(spark, raws, profile="strict"):
    lines = spark.createDataFrame(
        [("f.jsonl", i, raw) for i, raw in enumerate(raws)], "source_file string, source_row_number bigint, raw string"
    )
    stores = spark.createDataFrame([("S1",), ("S1",), (None,)], "store_id string")
    technicians = spark.createDataFrame([("T1",)], "technician_id string")
    rows = classify(lines, stores, technicians, profile).collect()
    return sorted(rows, key=lambda row: row.source_row_number)


STRICT = [
    ("", "blank JSONL line"),
    (" \t  \x1c", "blank JSONL line"),
    ("not-json", "invalid JSON"),
    ('{"a":1} x', "invalid JSON"),
    ('{"a":1}] g', "invalid JSON"),
    ('{"a":1},{"b":2}', "invalid JSON"),
    ('{"a":1}{"b":2}', "invalid JSON"),
    (event() + "," + event(), "invalid JSON"),
    (event() + ',"x"] y', "invalid JSON"),
    (event()[:-1], "invalid JSON"),
    ("123", "JSON document must be an object"),
    ("null", "JSON document must be an object"),
    ("[1]", "JSON document must be an object"),
    ("[" + event() + "]", "JSON document must be an object"),
    ('"s"', "JSON document must be an object"),
    (event(event_type=DROP), "event_type is required"),
    (event(event_type=" "), "event_type is required"),
    (event(event_type=5), "event_type is required"),
    (event(event_type=" exploded "), "unsupported event_type: EXPLODED"),
    (event(priority="P9"), "priority must be P1, P2, P3 or P4 when present"),
    (event(priority=" P1"), "priority must be P1, P2, P3 or P4 when present"),
    (event(priority=1), "priority must be P1, P2, P3 or P4 when present"),
    (event(priority="p3"), None),
    (event(priority=None), None),
    (event(technician="T1"), "technician and location must be objects when present"),
    (event(location=[1]), "technician and location must be objects when present"),
    (event(technician=1.5), "technician and location must be objects when present"),
    *((event(technician=empty, location=empty), None) for empty in (None, False, 0, 0.0, "", [], {})),
    (event(labor=[]), "labor must be an object or null"),
    (event(labor=0), "labor must be an object or null"),
    (event(labor=None), None),
    (event(labor={}), None),
    (event(technician={"id": ""}), "id is required"),
    (event(technician={"id": 7}), "id is required"),
    (event(technician={"id": None}), None),
    (event(location={"store_id": " "}), "store_id is required"),
    (event(location={"store_id": "S1", "region": {}}), "region is required"),
    *(
        (event(labor={"minutes": bad}), "labor.minutes must be a non-negative integer when present")
        for bad in (10.0, 1.5, True, "10", -5, [], {}, 12345678901234567890)
    ),
    (event(labor={"minutes": 3000000000}), None),
    (event(labor={"minutes": 10**10}), "labor.minutes must have at most 10 digits"),
    (event(labor={"minutes": None}), None),
    (event().replace("35}", "35e0}"), "labor.minutes must be a non-negative integer when present"),
    (event(source=" "), "source is required"),
    (event(source=3), "source is required"),
    (event(source=" app "), None),
    (event(event_id=DROP), "event_id is required"),
    (event(event_id=3), "event_id is required"),
    (event(work_order_id="\t"), "work_order_id is required"),
    (event(client_id=None), "client_id is required"),
    (event(event_timestamp=DROP), "event_timestamp is required"),
    (event(event_timestamp=20260101), "event_timestamp is required"),
    (event(event_timestamp="garbage"), "event_timestamp is not a valid ISO timestamp"),
    (event(updated_at=" "), "updated_at is required"),
    (event(updated_at="2026-02-30"), "updated_at is not a valid ISO timestamp"),
    (event(location={"store_id": " S9 "}), "unknown store_id: S9"),
    (event(technician={"id": "T9"}), "unknown technician_id: T9"),
    # The order of the rules decides which failure is told.
    (event(event_type="x", priority="P9", event_id=DROP), "unsupported event_type: X"),
    (event(labor={"minutes": -1}, event_id=DROP), "labor.minutes must be a non-negative integer when present"),
    (event(location={"store_id": "S9"}, technician={"id": "T9"}), "unknown store_id: S9"),
    ("  " + event() + "\t", None),
    ('{"event_id":"E0",' + event()[1:], None),
]

STAGED = [
    ("", "Invalid JSON"),
    ("not-json", "Invalid JSON"),
    ('{"a":1} x', "Invalid JSON"),
    ("[1]", "Missing event_id"),
    ("null", "Missing event_id"),
    (event(event_id=DROP), "Missing event_id"),
    (event(event_id=""), None),
    (event(event_id=5), None),
    (event(work_order_id=None), "Missing work_order_id"),
    (event(client_id=DROP), "Missing client_id"),
    (event(event_timestamp="x"), "Invalid event_timestamp"),
    (event(updated_at=DROP), "Invalid updated_at"),
    (event(event_type=DROP), "Invalid event_type"),
    (event(event_type=" opened"), "Invalid event_type"),
    (event(priority="P9"), "Invalid priority"),
    (event(labor={"minutes": -5}), "Labor minutes must be non-negative"),
    (event(labor={"minutes": "x"}), "Invalid labor minutes"),
    (event(labor={"minutes": 1.5}), None),
    (event(labor={"minutes": "10"}), None),
    (event(labor=7), None),
    (event(location={"store_id": "S9"}, technician={"id": "T9"}), "Unknown store_id"),
    (event(technician={"id": "T9"}), "Unknown technician_id"),
]


@pytest.mark.parametrize("profile, cases", [("strict", STRICT), ("staged", STAGED)])
def test_reasons(spark, profile, cases):
    rows = judge(spark, [raw for raw, _ in cases], profile)
    wrong = [
        (raw, expected, row.reject_reason)
        for (raw, expected), row in zip(cases, rows)
        if row.reject_reason != expected
    ]
    assert not wrong
    for row in rows:
        assert (row.payload_hash is None) == (row.reject_reason is not None)


def test_fields_are_trimmed_cased_and_read_from_objects(spark):
    row = judge(spark, [event(event_id=" E1 ", source=" app ", priority="p2")])[0]
    assert (row.event_type, row.technician_id, row.store_id, row.region) == ("ASSIGNED", "T1", "S1", "Harbour")
    assert row.event_timestamp_utc == datetime(2025, 12, 1, 0, 45)
    assert row.updated_at_utc == datetime(2025, 12, 1, 8, 30)
    assert (row.event_id, row.source_system, row.priority, row.labor_minutes) == ("E1", "app", "P2", 35)


def test_padding_of_any_text_is_noticed(spark):
    texts = ["", "a", "!", "a!", "North West", "é", "日本", "a!b c", "x" * 50, None]
    texts += [text for c in WHITE_SPACE for text in (c, c + "a", "a" + c, "a" + c + "b", "!" + c, c + "!", "é" + c)]
    rows = [(a, b, c) for a in texts[:12] for b in texts for c in ("z", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    columns = [F.col(name) for name in df.columns]
    changed = [~stripped(column).eqNullSafe(column) for column in columns]
    found = df.select(any_padded(columns).alias("padded"), (changed[0] | changed[1] | changed[2]).alias("changed"), "a", "b")
    assert found.filter("changed and not padded").isEmpty()
    # Plain texts, white space inside them too, are not taken to the slow way.
    plain = found.filter(F.coalesce("a", F.lit("a")).isin("a", "North West") & F.coalesce("b", F.lit("a")).isin("a", "North West", "a!", "!", "x" * 50))
    assert not plain.isEmpty() and plain.filter("padded").isEmpty()
    # A line with one padded text among plain ones is read like one without padding.
    padded = {**BASE, "location": {"region": "North West", "store_id": "\u3000S1\x1f"}}
    row, other = judge(spark, [json.dumps(padded), json.dumps({**padded, "location": {"region": "North West", "store_id": "S1"}})])
    assert row.reject_reason is None and (row.store_id, row.region) == ("S1", "North West") == (other.store_id, other.region)


def test_objects_with_and_without_the_member_read(spark):
    objects = [{}, {"id": None}, {"other": 1}, {"id": "T1", "more": {"id": 2}}]
    others = [0, 0.0, "", [], False, None]
    faulty = [1, "x", [0], True, ["id"]]
    lines = [event(technician=value, location=DROP, labor=DROP) for value in (*objects, *others, *faulty)]
    message = "technician and location must be objects when present"
    reasons = [row.reject_reason for row in judge(spark, lines)]
    assert reasons == [None] * len(objects + others) + [message] * len(faulty)
    labors = [event(labor=value) for value in ({}, {"minutes": None}, {"hours": 1}, None, 0, "", [], 5)]
    reasons = [row.reject_reason for row in judge(spark, labors)]
    assert reasons == [None] * 4 + ["labor must be an object or null"] * 4


def test_staged_rounds_labor(spark):
    raws = [event(labor={"minutes": value}) for value in (1.5, "10", 2.4)]
    assert [row.labor_minutes for row in judge(spark, raws, "staged")] == [2, 10, 2]


def test_hash_tells_whole_floats_from_integers(spark):
    hashes = [r.payload_hash for r in judge(spark, [event(cost=json.loads(x)) for x in ("10", "10.0", "1.5")])]
    assert len(set(hashes)) == 3
    spelled = [event(cost=1.5), event(cost=1.5).replace("1.5", "1.50")]
    assert len({r.payload_hash for r in judge(spark, spelled)}) == 1


def test_hash_follows_values(spark):
    """Payloads hash alike exactly if Python reads the same values and kinds of numbers."""
    whole = "9" * 45
    values = [
        "1e1", "10.0", "10", "1000E-2", "10.00", "-0", "0", "-0.0", "0.0", "1.5", "15e-1", "[1.0,1]", "[1,1.0]", "[1, 1.0]", '"1e1"', '"10.0"',
        whole, whole[:-1] + "8", "1e400", "[1.5,\"a\\\"1.0,\"]", "[1.5,\"a\\u00221.0,\"]", "[1.5,\"a\\\\\"]", "[1.5,\"a\\u005c\"]",
        '{"b":1.0,"a":2}', '{"a":2,"b":1.0}', '{"a":2,"b":1}', '{"a":1.0,"a":2.0}', '{"a":2.0}', '[{"s":1.0},"n10"]', "123456789.123456789", "\"x 1.5 \\n\"",
        '"x 1.5 \\u000a"', '"x \\u0031.5 \\n"', "[true,false,null,1.0]", "[true,false,null,1]", "[1.0," + ",".join(['"\\\\\\""'] * 3000) + "]",
    ]
    lines = [event().replace('"event_id"', '"cost": %s, "event_id"' % v, 1) for v in values]
    hashes = [r.payload_hash for r in judge(spark, lines)]
    read = [repr(json.loads(line)["cost"]) if not v.startswith("{") else json.dumps(json.loads(line)["cost"], sort_keys=True) for v, line in zip(values, lines, strict=True)]
    read = [{"inf": "Infinity"}.get(r, r) for r in read]
    assert None not in hashes
    pairs = {(h, r) for h, r in zip(hashes, read, strict=True)}
    assert len(pairs) == len(set(hashes)) == len(set(read))


def test_floats_are_spelled_without_tokens(spark, monkeypatch):
    """Numbers that a variant prints as doubles give the text that taking the line apart gives, without doing so."""
    numbers = ["1.5", "-0.0", "10.0", "1e1", "1000E-2", "1E+5", "-1.25e3", "1e-99", "0.30000000000000004", "1e22", "[1.0,10,-0]", '{"b":2.50,"a":"1.5\\\\\\" 2.0"}']
    lines = spark.createDataFrame([('{"n": %s, "k\\\\": "x 1.0"}' % n,) for n in numbers], "raw string")
    by_value = {r.raw: r.text for r in lines.select("raw", payload._by_value(F.col("raw")).alias("text")).collect()}
    monkeypatch.setattr(payload, "_by_value", lambda raw: F.lit("taken apart"))
    spelled = lines.select("raw", payload.canonical_text(payload.document(F.col("raw")), F.col("raw")).alias("text"))
    assert {r.raw: r.text for r in spelled.collect()} == by_value
    extreme = spark.createDataFrame([('{"n":1e400}',), ("[%s]" % ("9" * 39),)], "raw string")
    assert {r.text for r in extreme.select(payload.canonical_text(payload.document(F.col("raw")), F.col("raw")).alias("text")).collect()} == {"taken apart"}


def test_hash_ignores_formatting_and_keeps_last_repeated_key(spark):
    record = json.loads(event())
    spaced = json.dumps(record, indent=None, separators=(" , ", " : "))
    repeated = '{"event_id":"E0",' + event()[1:]
    canonical = json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    expected = hashlib.sha256(canonical.encode()).hexdigest()
    rows = judge(spark, [event(), spaced, repeated])
    assert [row.payload_hash for row in rows] == [expected] * 3
    assert [row.event_id for row in rows] == ["E1"] * 3


def test_one_version_stays_per_event_and_broken_lines_go(spark):
    first = event(event_type="OPENED", updated_at="2026-01-01T00:00:00Z")
    later = event(event_type="CLOSED", updated_at="2026-01-02T00:00:00Z")
    lines = [first, later, "not-json", later, first]
    df = spark.createDataFrame(
        [("f", i, raw) for i, raw in enumerate(lines)], "source_file string, source_row_number bigint, raw string"
    )
    known = spark.createDataFrame([("S1", "T1")], "store_id string, technician_id string")
    accepted = accepted_events(classify(df, known, known))
    current = latest_events(accepted).collect()
    assert accepted.count() == 4
    # Of two equal versions the first one in the file is current.
    assert [(row.event_type, row.source_row_number) for row in current] == [("CLOSED", 1)]


def test_equal_times_keep_larger_hash(spark):
    raws = [event(event_type=kind) for kind in ("OPENED", "CLOSED", "REOPENED")]
    rows = judge(spark, raws)
    df = spark.createDataFrame([(r.event_id, r.updated_at_utc, r.payload_hash, "f", r.source_row_number) for r in rows],
                               "event_id string, updated_at_utc timestamp, payload_hash string, source_file string, source_row_number bigint")
    assert latest_events(df).first().payload_hash == max(row.payload_hash for row in rows)


# Texts that Python's datetime.fromisoformat accepts must give the same instant.
TIMES = [
    "2026-01-01T00:00:00Z", "2026-01-01T05:00:00+05:00", "2026-01-01 05:00:00", "2026-01-01T05:00:00.5",
    "2026-01-01T05:00:00.123456-03:30", "2026-01-01T05:00:00,25", "2026-01-01T05:00:00.123456789",
    "2026-01-01T05:00Z", "2026-01-01T05Z", "2026-01-01T05:00+0530", "2026-01-01T05+05", "2026-01-01",
    "20260101", "20260101T050607", "20260101T0506Z", "2026-01-01x05:00", "2026-01-01T05:00:00+05:30:15",
    "2026-13-01", "2026-02-30", "2026-01-01T25:00:00", "2026-01-01T00:60:00", "2026", "T12:00:00", "2026-1-1",
    "12026-01-01", "0000-01-01", "garbage", "", "2026-01-01T", "2026-01-01T05:00:00z", "2026-0101", "2026-01-01T0500:00",
    # Weeks, and offsets of up to a day.
    "2026-W01-1", "2026W011", "2026-W01", "2026W01", "2026-W53-7", "2025-W53-1", "2020W537", "0001-W01-1", "9999-W52-7",
    "2026-W01-1T05:00", "2026W011T0500+19", "2026-W01T05", "2026-W01-05", "2026W01112:30", "2026W0112", "2026W011T",
    "2026-W01-0", "2026-W01-8", "2026-W00-1", "2026-W54-1", "0000-W01-1", "2026-W1-1", "2026-W01-1x05:30Z",
    "2026-W01 05:00:00.5-23:59", "2026-W01-", "2020-W53-7T23:59:59,9", "2026-01-01T05:00:00+19:00", "2026-01-01T05:00:00-18:30",
    "2026-01-01T05:00:00+23:59:59.999999", "2026-01-01T05:00:00+24:00", "2026-01-01T05:00:00+05:99", "2026-01-01T05:00:00+23:60",
    "2026-01-01T05:00:00+05:3015", "2026-01-01T05:00:00-00:00", "2026-01-01T24:00:00",
]


def test_timestamps_match_python(spark):
    def python(text):
        try:
            parsed = datetime.fromisoformat(text.replace("Z", "+00:00"))
        except ValueError:
            return None
        return parsed.replace(tzinfo=None) - (parsed.utcoffset() or parsed - parsed)

    df = spark.createDataFrame([(text,) for text in TIMES], "t string")
    rows = df.select("t", iso_timestamp(F.col("t")).cast("timestamp_ntz").alias("at")).collect()
    assert {row.t: row.at for row in rows} == {text: python(text) for text in TIMES}
