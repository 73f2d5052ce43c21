"""Every registered query against its DuckDB oracle, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry
from compare import differences, oracle_connection
from fixtures import inputs, sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, oracle, name):
    found = entry.queries()[name](spark, SF_DIR).toPandas()
    if name not in entry.oracle_sql():
        assert len(found) > 0
        return
    assert differences(found, oracle.execute(entry.oracle_sql()[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["week_start", "completed_work_orders", "average_resolution_hours"]


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_lines_are_dealt_out_evenly_before_they_are_made(spark, monkeypatch):
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    monkeypatch.setattr(inputs, "LINES_OF_A_TASK", 20)
    lines = inputs.event_lines(spark, SF_DIR)
    tasks = math.ceil(rows / 20)
    assert tasks > spark.sparkContext.defaultParallelism
    assert lines.rdd.getNumPartitions() == tasks
    assert "RepartitionByExpression [event_id" in lines._jdf.queryExecution().optimizedPlan().toString()
    plain = inputs.derive(spark, SF_DIR, sql.EVENT_LINES).drop("f")
    assert lines.exceptAll(plain).isEmpty() and plain.exceptAll(lines).isEmpty()
