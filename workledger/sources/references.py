"""Store and technician reference files."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from workledger import schemas
from workledger.functions.text import is_blank, stripped
from workledger.operators.latest import latest_by
from workledger.session import materialize
from workledger.sources.records import scan_records


@dataclass(frozen=True)
class Reference:
    """One reference file: rows as read, rows that count, rows that do not."""

    scanned: DataFrame
    clean: DataFrame
    rejects: DataFrame


def scan_reference(spark: SparkSession, source_dir: str, file_name: str, key: str) -> DataFrame:
    """CSV rows as strings with their row number; the header is row 1."""
    # Fields without anything between the commas are NULL, like those a row is too short for.
    options = {"quote": '"', "escape": '"', "nullValue": "\0"}
    path = f"{source_dir.rstrip('/')}/{file_name}"
    # Of the first file, the header alone is read here.
    names = spark.read.options(header=True, multiLine=True, **options).csv(path).columns
    if key not in names:
        raise ValueError(f"{file_name} is missing required column {key}")
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    parsed = F.from_csv("record", F.lit(schema), {**options, "multiLine": "true", "maxCharsPerColumn": "-1"})
    records = scan_records(spark, path, file_name).withColumn("_row", parsed)
    return materialize(records.select("_row.*", "source_file", "source_row_number"), "reference")


def split_reference(rows: DataFrame, schema: T.StructType) -> Reference:
    """Validate reference rows and keep the last row of every key.

    The key is the first column of ``schema``. A column the file lacks is empty.
    """
    key = schema.fieldNames()[0]
    missing = [name for name in schema.fieldNames() if name not in rows.columns]
    rows = rows.withColumns({name: F.lit(None).cast("string") for name in missing})

    def filled(name: str):
        return F.coalesce(F.col(name), F.lit(""))

    reason = F.when(is_blank(filled(key)), F.lit(f"missing {key}")).when(
        ~F.upper(filled("active_flag")).isin(*schemas.ACTIVE_FLAGS),
        F.lit("active_flag must be TRUE or FALSE"),
    )
    judged = rows.withColumn("reason", reason)
    rejects = judged.filter("reason is not null").select(
        "source_file",
        "source_row_number",
        "reason",
        F.to_json(F.struct(*schema.fieldNames())).alias("raw_payload"),
    )
    trimmed = judged.filter("reason is null").select(
        "source_row_number", *(stripped(filled(name)).alias(name) for name in schema.fieldNames())
    )
    clean = latest_by(trimmed, [key], [F.desc("source_row_number")]).select(*schema.fieldNames())
    return Reference(rows, clean, rejects)


def _read(spark: SparkSession, source_dir: str, file_name: str, schema: T.StructType) -> Reference:
    key = schema.fieldNames()[0]
    reference = split_reference(scan_reference(spark, source_dir, file_name, key), schema)
    # Read several times by a load: counted, joined, merged.
    return replace(reference, clean=materialize(reference.clean, "reference"))


def read_stores(spark: SparkSession, source_dir: str) -> Reference:
    return _read(spark, source_dir, schemas.STORE_FILE, schemas.STORES)


def read_technicians(spark: SparkSession, source_dir: str) -> Reference:
    return _read(spark, source_dir, schemas.TECHNICIAN_FILE, schemas.TECHNICIANS)
