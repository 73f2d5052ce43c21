"""Table schemas and the fixed vocabularies of the event model."""

from pyspark.sql import types as T

# They define which records are valid.
EVENT_TYPES = ("OPENED", "ASSIGNED", "WORK_STARTED", "WORK_COMPLETED", "REOPENED", "CLOSED")
PRIORITIES = ("P1", "P2", "P3", "P4")
ACTIVE_FLAGS = ("TRUE", "FALSE")

# Fixed values: (previous, next) event types that should not follow one another.
ABNORMAL_TRANSITIONS = (
    ("WORK_COMPLETED", "WORK_STARTED"),
    ("CLOSED", "WORK_STARTED"),
    ("CLOSED", "OPENED"),
    ("CLOSED", "ASSIGNED"),
    ("OPENED", "REOPENED"),
    ("WORK_STARTED", "REOPENED"),
)

# Status shown for the last event type; others show the type itself.
STATUS_OF_LAST_EVENT = {
    "OPENED": "OPEN",
    "WORK_STARTED": "IN_PROGRESS",
    "WORK_COMPLETED": "COMPLETED",
}

EVENT_FILE_PATTERN = "work_order_events_*.jsonl"
STORE_FILE = "stores.csv"
TECHNICIAN_FILE = "technicians.csv"


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


STORES = T.StructType(_strings("store_id", "client_id", "store_number", "region", "active_flag"))

TECHNICIANS = T.StructType(_strings("technician_id", "technician_name", "home_region", "active_flag"))

WORK_ORDER_EVENTS = T.StructType(
    _strings("event_id", "work_order_id", "client_id", "event_type")
    + [
        T.StructField("event_timestamp_utc", T.TimestampType()),
        T.StructField("updated_at_utc", T.TimestampType()),
    ]
    + _strings("priority", "technician_id", "store_id", "region")
    + [T.StructField("labor_minutes", T.LongType())]
    + _strings("source_system", "source_file")
    + [T.StructField("source_row_number", T.LongType())]
    + _strings("payload_hash")
    + [
        T.StructField("raw_payload", T.VariantType()),
        T.StructField("first_seen_at", T.TimestampType()),
        T.StructField("last_seen_at", T.TimestampType()),
    ]
)

REJECTED_RECORDS = T.StructType(
    [T.StructField("rejection_id", T.LongType())]
    + _strings("run_id", "source_file")
    + [T.StructField("source_row_number", T.LongType())]
    + _strings("reason", "raw_payload")
    + [T.StructField("rejected_at", T.TimestampType())]
)

INGESTION_RUNS = T.StructType(
    _strings("run_id", "source_checksum")
    + [
        T.StructField("file_count", T.LongType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("unique_event_count", T.LongType()),
        T.StructField("rejected_count", T.LongType()),
        T.StructField("completed_at", T.TimestampType()),
    ]
)

_TIMES = [T.StructField("event_timestamp_utc", T.TimestampType()), T.StructField("updated_at_utc", T.TimestampType())]

# What the analyses read of an event, for keeping them up to date by work order.
WORK_ORDER_HISTORY = T.StructType(
    _strings("work_order_id", "event_id", "event_type")
    + _TIMES
    + _strings("client_id", "store_id", "technician_id", "priority")
    + [T.StructField("labor_minutes", T.LongType())]
)

WORK_ORDER_SUMMARY = T.StructType(
    _strings("work_order_id", "client_id", "store_id", "technician_id", "priority")
    + [T.StructField("opened_timestamp", T.TimestampType()), T.StructField("closed_timestamp", T.TimestampType())]
    + _strings("current_status")
    + [T.StructField(name, T.LongType()) for name in ("total_labor_minutes", "event_count", "reopen_count")]
    + [T.StructField("resolution_hours", T.DoubleType()), T.StructField("last_updated_timestamp", T.TimestampType())]
)

ABNORMAL_SEQUENCES = T.StructType(_strings("work_order_id", "previous_event_type", "event_type") + _TIMES[:1])

# Rejects that were loaded later on, and the run that did.
REPLAYED_REJECTS = T.StructType(
    _strings("run_id", "source_file")
    + [T.StructField("source_row_number", T.LongType())]
    + _strings("replay_run_id")
    + [T.StructField("replayed_at", T.TimestampType())]
)

# The columns a classified line carries besides its position, text and reason.
EVENT_COLUMNS = (
    "event_id",
    "work_order_id",
    "client_id",
    "event_type",
    "event_timestamp_utc",
    "updated_at_utc",
    "priority",
    "technician_id",
    "store_id",
    "region",
    "labor_minutes",
    "source_system",
    "payload_hash",
)

NOT_NULL = {
    "work_order_events": (
        "event_id",
        "work_order_id",
        "client_id",
        "event_type",
        "event_timestamp_utc",
        "updated_at_utc",
        "source_file",
        "source_row_number",
        "payload_hash",
    ),
    "rejected_records": ("run_id", "source_file", "source_row_number", "reason"),
    "ingestion_runs": (
        "run_id",
        "source_checksum",
        "file_count",
        "record_count",
        "unique_event_count",
        "rejected_count",
    ),
}

UNIQUE = {
    "work_order_events": ("event_id",),
    "ingestion_runs": ("run_id", "source_checksum"),
}
