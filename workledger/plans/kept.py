"""The summary and the abnormal sequences as tables that every load keeps up to date.

Beside the events, which lie by event id, a narrow history of each work order is
kept, by work order. A load takes the versions that it replaces out of the
histories, puts its own in, and works out anew the work orders it touched; of the
three tables only their buckets are read and written. A correction that moves an
event to another work order touches both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from workledger.plans import marts
from workledger.plans.warehouse import EVENTS, HISTORY, SEQUENCES, SUMMARY, TABLES, State, Warehouse
from workledger.session import materialize

_NARROW = TABLES[HISTORY].fieldNames()


def _write(tables: Warehouse, state: State, load: str, histories: DataFrame, keys: DataFrame | None) -> dict[str, list[int]]:
    histories, _ = tables.touched(HISTORY, histories, state)
    found = {HISTORY: histories, SUMMARY: marts.work_order_summary(histories), SEQUENCES: marts.abnormal_sequences(histories)}
    return {name: tables.put(name, rows, state, load, keys)[1] for name, rows in found.items()}


def keep_analyses(tables: Warehouse) -> None:
    """Work out the kept tables from all events; from now on every load keeps them."""
    state = tables.state()
    if not state.kept:
        load = tables.new_load(state)
        written = _write(tables, state, load, tables.table(EVENTS, state).select(*_NARROW), None)
        tables.publish(state, load, written)


def refresh(tables: Warehouse, state: State, load: str, changes: DataFrame, stored: DataFrame) -> dict[str, list[int]]:
    """Bring the kept tables up to ``changes``, events that replace those of ``stored`` or are new; returns the buckets written."""
    if not state.kept:
        return {}
    replaced = stored.join(changes.select("event_id"), "event_id", "left_semi").select("work_order_id")
    keys = materialize(changes.select("work_order_id").union(replaced).distinct(), "work_orders")
    _, buckets = tables.touched(HISTORY, keys, state)
    before = tables.partitions(HISTORY, state, buckets).select(*_NARROW).join(keys, "work_order_id", "left_semi")
    unchanged = before.join(changes.select("event_id"), "event_id", "left_anti")
    return _write(tables, state, load, unchanged.select(*_NARROW).unionByName(changes.select(*_NARROW)), keys)
