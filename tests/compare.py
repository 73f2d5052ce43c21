"""Compare a Spark result with DuckDB's answer to the oracle, row by row."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def _canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            frame[name] = column.astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(column):
            frame[name] = column.round(9).astype(str)
        elif pd.api.types.is_numeric_dtype(column):
            frame[name] = column.astype("float64").astype(str)
        else:
            frame[name] = column.map(
                lambda v: "nan" if pd.isna(v) else str(v)
            )
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def differences(spark_frame: pd.DataFrame, oracle_frame: pd.DataFrame) -> str:
    """Empty if both hold the same columns and rows, else what differs."""
    if sorted(spark_frame.columns) != sorted(oracle_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(oracle_frame.columns)}"
    if len(spark_frame) != len(oracle_frame):
        return f"{len(spark_frame)} and {len(oracle_frame)} rows"
    left, right = _canonical(spark_frame), _canonical(oracle_frame)
    wrong = [name for name in left.columns if not (left[name] == right[name]).all()]
    if not wrong:
        return ""
    at = (left[wrong[0]] != right[wrong[0]]).idxmax()
    return f"columns {wrong}, e.g. {left.loc[at, wrong].to_dict()} and {right.loc[at, wrong].to_dict()}"
