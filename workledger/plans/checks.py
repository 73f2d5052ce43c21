"""Counts of rows that break a declared key or NOT NULL column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from workledger import schemas


def constraint_violations(**tables: DataFrame) -> DataFrame:
    """One row per constraint of the given tables; all counts should be 0."""
    found = []
    for name, df in tables.items():
        columns = schemas.NOT_NULL[name]
        nulls = df.agg(*(F.count_if(F.col(column).isNull()).alias(column) for column in columns))
        found.append(_named(nulls.unpivot([], list(columns), "column_name", "violations"), name, "not null"))
        for column in schemas.UNIQUE.get(name, ()):
            repeated = df.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")
            count = repeated.agg(F.count("*").alias("violations")).withColumn("column_name", F.lit(column))
            found.append(_named(count, name, "unique"))
    return reduce(DataFrame.unionByName, found)


def _named(counts: DataFrame, table: str, kind: str) -> DataFrame:
    return counts.select(
        F.lit(table).alias("table_name"), "column_name", F.lit(kind).alias("constraint_kind"), "violations"
    )
