"""Named views, for users who query with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from workledger import schemas
from workledger.plans import marts
from workledger.plans.warehouse import APPENDED, EVENTS, KEYS, TABLES, Warehouse


def register_views(events: DataFrame) -> list[str]:
    """Register the events, their summary and the four analyses as views; returns their names."""
    summary = marts.work_order_summary(events)
    views = {
        "work_order_events": events,
        "work_order_summary": summary,
        "analysis_technician_close_rank": marts.technician_close_rank(summary),
        "analysis_reopen_rate": marts.reopen_rate(summary),
        "analysis_weekly_completed": marts.weekly_completed(summary),
        "analysis_abnormal_sequences": marts.abnormal_sequences(events),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)


def _visible(warehouse: Warehouse, name: str) -> str:
    """The rows of a table that the audit rows make visible when the text is run."""
    columns = ", ".join(f"t.{column}" for column in TABLES[name].fieldNames())
    rows, commits = f"parquet.`{warehouse.root}/{name}`", f"parquet.`{warehouse.root}/commits`"
    if name in KEYS:
        newest = f"""SELECT bucket, max_by(load, sequence) AS load
            FROM (SELECT load, sequence, explode(written['{name}']) AS bucket FROM {commits}) GROUP BY bucket"""
        return f"SELECT {columns} FROM {rows} t JOIN ({newest}) v ON t.bucket = v.bucket AND t.load = v.load"
    if name in APPENDED:
        loads = f"""SELECT load FROM {commits} WHERE map_contains_key(written, '{name}')
            EXCEPT SELECT explode(replaced) FROM {commits}"""
        return f"SELECT {columns} FROM {rows} t LEFT SEMI JOIN ({loads}) v ON t.load = v.load"
    return f"SELECT {columns} FROM {commits} t WHERE kind = 'RUN'"


def _status(last_type: str) -> str:
    cases = " ".join(f"WHEN '{kind}' THEN '{label}'" for kind, label in schemas.STATUS_OF_LAST_EVENT.items())
    return f"CASE {last_type} {cases} ELSE {last_type} END"


def _analyses() -> dict[str, str]:
    """The summary and the analyses over the view of the events."""
    order = "(" + ", ".join(marts.EVENT_ORDER) + ")"
    pairs = ", ".join(f"('{a}', '{b}')" for a, b in schemas.ABNORMAL_TRANSITIONS)
    return {
        "work_order_summary": f"""
SELECT work_order_id, newest.client_id, newest.store_id, newest.technician_id, newest.priority, opened_timestamp, closed_timestamp,
  {_status("newest.event_type")} AS current_status, total_labor_minutes, event_count, reopen_count,
  CASE WHEN closed_timestamp >= opened_timestamp
    THEN (unix_seconds(closed_timestamp) - unix_seconds(opened_timestamp)) / 3600.0D END AS resolution_hours,
  last_updated_timestamp
FROM (
  SELECT work_order_id, max_by(struct(client_id, store_id, technician_id, priority, event_type), {order}) AS newest,
    min(event_timestamp_utc) FILTER (WHERE event_type = 'OPENED') AS opened_timestamp,
    max(event_timestamp_utc) FILTER (WHERE event_type = 'CLOSED') AS closed_timestamp,
    sum(CASE WHEN event_type = 'WORK_COMPLETED' THEN coalesce(labor_minutes, 0) ELSE 0 END) AS total_labor_minutes,
    count(*) AS event_count, count_if(event_type = 'REOPENED') AS reopen_count, max(updated_at_utc) AS last_updated_timestamp
  FROM {EVENTS} GROUP BY work_order_id)""",
        "analysis_technician_close_rank": """
WITH counts AS (
  SELECT technician_id, count(*) AS closed_work_order_count FROM work_order_summary
  WHERE current_status = 'CLOSED' AND technician_id IS NOT NULL GROUP BY technician_id),
ranks AS (
  SELECT closed_work_order_count, CAST(dense_rank() OVER (ORDER BY closed_work_order_count DESC) AS BIGINT) AS close_rank
  FROM (SELECT DISTINCT closed_work_order_count FROM counts))
SELECT technician_id, closed_work_order_count, close_rank FROM counts JOIN ranks USING (closed_work_order_count)""",
        "analysis_reopen_rate": """
SELECT 100.0D * count_if(current_status = 'CLOSED' AND reopen_count > 0) / nullif(count_if(current_status = 'CLOSED'), 0)
  AS reopened_closed_wo_percent FROM work_order_summary""",
        "analysis_weekly_completed": """
SELECT date_trunc('WEEK', closed_timestamp) AS week_start, count(*) AS completed_work_orders,
  avg(resolution_hours) AS average_resolution_hours
FROM work_order_summary WHERE current_status = 'CLOSED' GROUP BY 1""",
        "analysis_abnormal_sequences": f"""
SELECT work_order_id, previous_event_type, event_type, event_timestamp_utc
FROM (SELECT *, lag(event_type) OVER (PARTITION BY work_order_id ORDER BY {", ".join(marts.EVENT_ORDER)}) AS previous_event_type
  FROM {EVENTS})
WHERE (previous_event_type, event_type) IN ({pairs})""",
    }


def create_views(warehouse: Warehouse, temporary: bool = True) -> list[str]:
    """Views of all tables of a warehouse, of the summary and the analyses; returns their names.

    A view is SQL text that is resolved whenever it is read, so it always shows
    the newest load, also those after the view was made. Views that are not
    temporary go to the current database of the session's catalog.
    """
    warehouse.create()
    texts = {name: _visible(warehouse, name) for name in TABLES} | _analyses()
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    for name, text in texts.items():
        warehouse.spark.sql(f"CREATE OR REPLACE {kind} {name} AS {text}")
    return list(texts)
