"""From raw lines to typed events with at most one reject reason each.

Two rule lists exist. ``strict`` checks JSON types, trims text and reports the
first failing rule in a fixed order; ``staged`` casts leniently, tests for NULL
only and uses its own order and wording. Both are lists of column expressions
whose first non-NULL entry is the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from workledger import schemas
from workledger.functions import payload as js
from workledger.functions.text import any_padded, is_blank, iso_timestamp, stripped
from workledger.operators.existence import flag_known

PROFILES = ("strict", "staged")

# The widest number the labor column holds.
MAX_LABOR_MINUTES = 9_999_999_999

_FIELDS = (
    *("event_id", "work_order_id", "client_id", "event_type", "event_timestamp", "updated_at"),
    *("priority", "technician", "location", "labor", "source"),
)
_TEXTS = """event_id string, work_order_id string, client_id string, event_type string,
    event_timestamp string, updated_at string, priority string, source string,
    technician struct<id: string>, location struct<store_id: string, region: string>,
    labor struct<minutes: string>"""

# Columns whose ids are looked up, in the order of their rules.
_REFERENCES = ("store_id", "technician_id")
_REQUIRED_TEXT = ("event_id", "work_order_id", "client_id")
# Column -> its name in messages, the last part of its path.
_OPTIONAL_TEXT = {"technician_id": "id", "store_id": "store_id", "region": "region", "source_system": "source"}
_TIMES = {"event_timestamp_utc": "event_timestamp", "updated_at_utc": "updated_at"}
# Values that are read without the white space around them.
_STRIPPED = (*_REQUIRED_TEXT, *_OPTIONAL_TEXT, *_TIMES.values(), "event_type")
# Columns whose place in the document is not a top-level field of their name.
_NESTED = {
    "technician_id": ("technician", "id"),
    "store_id": ("location", "store_id"),
    "region": ("location", "region"),
    "labor_minutes": ("labor", "minutes"),
}


def _parts() -> dict[str, Column]:
    """``_json_<name>`` (a variant) and ``_text_<name>`` for every value the rules read."""
    values, texts = F.col("_fields"), F.col("_texts")
    parts = {f"_json_{name}": values[name] for name in _FIELDS}
    parts |= {f"_text_{name}": texts[name] for name in _FIELDS if name not in ("technician", "location", "labor")}
    for name, (outer, inner) in _NESTED.items():
        parts[f"_json_{name}"] = js.member(values[outer], inner)
        parts[f"_text_{name}"] = texts[outer][inner]
    return parts | {"_json_source_system": values["source"], "_text_source_system": texts["source"]}


def _json(name: str) -> Column:
    return F.col(f"_json_{name}")


def _text(name: str) -> Column:
    return F.col(f"_text_{name}")


def _string(name: str) -> Column:
    text = _text(name)
    return js.if_string(_json(name), F.when(F.col("_padded"), stripped(text)).otherwise(text))


def _reject(condition: Column, reason: Column | str) -> Column:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.when(F.coalesce(condition, F.lit(False)), reason)


def _missing(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) == ""


def _not_in(name: str, values: tuple[str, ...]) -> Column:
    return ~F.coalesce(F.col(name).isin(*values), F.lit(False))


# --- strict -----------------------------------------------------------------


def _strict_columns() -> dict[str, Column]:
    return {
        **{name: _string(name) for name in (*_REQUIRED_TEXT, *_OPTIONAL_TEXT)},
        **{f"_{name}_given": js.is_given(_json(name)) for name in _OPTIONAL_TEXT},
        **{f"_{name}_text": _string(field) for name, field in _TIMES.items()},
        "event_type": F.upper(_string("event_type")),
        "_priority_given": js.is_given(_json("priority")),
        "priority": js.if_string(_json("priority"), F.upper(_text("priority"))),
        "_technician_ok": js.is_object_or_empty(_json("technician"), _json("technician_id")),
        "_location_ok": js.is_object_or_empty(_json("location"), _json("store_id")),
        "_labor_ok": js.is_object(_json("labor"), _json("labor_minutes")) | ~js.is_given(_json("labor")),
        "_labor_minutes_given": js.is_given(_json("labor_minutes")),
        "labor_minutes": F.when(
            js.json_type(_json("labor_minutes")) == "BIGINT", _text("labor_minutes").try_cast("bigint")
        ),
    }


def _strict_reasons() -> list[Column]:
    labor = F.col("labor_minutes")

    def optional(name: str) -> Column:
        return _reject(F.col(f"_{name}_given") & _missing(name), f"{_OPTIONAL_TEXT[name]} is required")

    def timestamp(name: str) -> list[Column]:
        field = _TIMES[name]
        return [
            _reject(_missing(f"_{name}_text"), f"{field} is required"),
            _reject(F.col(name).isNull(), f"{field} is not a valid ISO timestamp"),
        ]

    return [
        # No blank line is valid JSON, so only invalid lines are searched.
        _reject(~F.col("_valid") & is_blank(F.col("raw")), "blank JSONL line"),
        _reject(~F.col("_valid"), "invalid JSON"),
        _reject(~js.is_object_text(F.col("raw")), "JSON document must be an object"),
        _reject(_missing("event_type"), "event_type is required"),
        _reject(
            _not_in("event_type", schemas.EVENT_TYPES),
            F.concat(F.lit("unsupported event_type: "), F.col("event_type")),
        ),
        _reject(
            F.col("_priority_given") & _not_in("priority", schemas.PRIORITIES),
            "priority must be P1, P2, P3 or P4 when present",
        ),
        _reject(
            ~F.col("_technician_ok") | ~F.col("_location_ok"),
            "technician and location must be objects when present",
        ),
        _reject(~F.col("_labor_ok"), "labor must be an object or null"),
        optional("technician_id"),
        optional("store_id"),
        optional("region"),
        _reject(
            F.col("_labor_minutes_given") & (labor.isNull() | (labor < 0)),
            "labor.minutes must be a non-negative integer when present",
        ),
        _reject(labor > MAX_LABOR_MINUTES, "labor.minutes must have at most 10 digits"),
        optional("source_system"),
        *(_reject(_missing(name), f"{name} is required") for name in _REQUIRED_TEXT),
        *timestamp("event_timestamp_utc"),
        *timestamp("updated_at_utc"),
    ]


def _unknown(name: str, label: Column | str) -> Column:
    return _reject(F.col(name).isNotNull() & ~F.col(f"_{name}_known"), label)


def _strict_unknown() -> list[Column]:
    return [_unknown(name, F.concat(F.lit(f"unknown {name}: "), F.col(name))) for name in _REFERENCES]


# --- staged -----------------------------------------------------------------


def _staged_columns() -> dict[str, Column]:
    labor = _text("labor_minutes")
    return {
        **{name: _text(name) for name in (*_REQUIRED_TEXT, *_OPTIONAL_TEXT)},
        **{f"_{name}_text": _text(field) for name, field in _TIMES.items()},
        "event_type": F.upper(_text("event_type")),
        "priority": F.upper(_text("priority")),
        "_labor_minutes_given": labor.isNotNull(),
        # A number in any notation, rounded half away from zero.
        "labor_minutes": F.round(labor.try_cast("decimal(38,9)")).try_cast("bigint"),
    }


def _staged_reasons() -> list[Column]:
    labor = F.col("labor_minutes")
    return [
        _reject(~F.col("_valid"), "Invalid JSON"),
        *(_reject(F.col(name).isNull(), f"Missing {name}") for name in _REQUIRED_TEXT),
        _reject(F.col("event_timestamp_utc").isNull(), "Invalid event_timestamp"),
        _reject(F.col("updated_at_utc").isNull(), "Invalid updated_at"),
        _reject(_not_in("event_type", schemas.EVENT_TYPES), "Invalid event_type"),
        _reject(
            F.col("priority").isNotNull() & _not_in("priority", schemas.PRIORITIES), "Invalid priority"
        ),
        _reject(
            F.col("_labor_minutes_given") & (labor.isNull() | (labor > MAX_LABOR_MINUTES)),
            "Invalid labor minutes",
        ),
        _reject(labor < 0, "Labor minutes must be non-negative"),
    ]


def _staged_unknown() -> list[Column]:
    return [_unknown(name, f"Unknown {name}") for name in _REFERENCES]


# --- jobs -------------------------------------------------------------------


def normalize(lines: DataFrame, profile: str = "strict") -> DataFrame:
    """Parse ``raw`` and add the event columns plus the helpers the rules read."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}, expected one of {PROFILES}")
    raw, doc = F.col("raw"), F.col("_doc")
    texts = F.when(js.is_object_text(raw), js.texts(raw, _TEXTS))
    parsed = lines.withColumns({"_doc": js.document(raw), "_texts": texts}).withColumns(
        {"_valid": js.is_single_json(doc, raw), "_fields": js.fields(doc, _FIELDS)}
    )
    kept, parts = [*lines.columns, "_doc", "_valid"], _parts()
    padded = any_padded([parts[f"_text_{name}"] for name in _STRIPPED])
    values = parsed.select(*kept, *(part.alias(name) for name, part in parts.items()), padded.alias("_padded"))
    columns = _strict_columns() if profile == "strict" else _staged_columns()
    events = values.select(*kept, *(column.alias(name) for name, column in columns.items()))
    return events.withColumns({name: iso_timestamp(F.col(f"_{name}_text")) for name in _TIMES})


def classify(
    lines: DataFrame, stores: DataFrame, technicians: DataFrame, profile: str = "strict"
) -> DataFrame:
    """Every line once, with its event columns and ``reject_reason``.

    ``lines`` has the column ``raw`` and any position columns, which are kept.
    Event columns are NULL on rejected lines; accepted lines have no reason. The
    ids are looked up last, in both rule lists: a long list of ids moves rows, and
    by then these hold neither the parsed document nor what the other rules read.
    """
    events = normalize(lines, profile)
    reasons = _strict_reasons() if profile == "strict" else _staged_reasons()
    judged = events.withColumn("_reason", F.coalesce(*reasons))
    sound = F.col("_reason").isNull()
    values = {name: F.col(name) for name in schemas.EVENT_COLUMNS if name != "payload_hash"}
    values["payload_hash"] = js.payload_hash(F.col("_doc"), F.col("raw"))
    judged = judged.select(
        *lines.columns, "_reason", *(F.when(sound, column).alias(name) for name, column in values.items())
    )
    judged = flag_known(judged, stores, "store_id", "_store_id_known")
    judged = flag_known(judged, technicians, "technician_id", "_technician_id_known")
    unknown = _strict_unknown() if profile == "strict" else _staged_unknown()
    accepted = F.col("reject_reason").isNull()
    return judged.withColumn("reject_reason", F.coalesce("_reason", *unknown)).select(
        *lines.columns,
        *(F.when(accepted, F.col(name)).alias(name) for name in schemas.EVENT_COLUMNS),
        "reject_reason",
    )


def accepted_events(classified: DataFrame) -> DataFrame:
    return classified.filter("reject_reason is null").drop("reject_reason")


def rejected_lines(classified: DataFrame) -> DataFrame:
    return classified.filter("reject_reason is not null").select(
        "source_file",
        "source_row_number",
        F.col("reject_reason").alias("reason"),
        F.col("raw").alias("raw_payload"),
    )
