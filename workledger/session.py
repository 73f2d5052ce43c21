"""Session settings the jobs rely on, and staging of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime settings that results depend on.

    Instants are truncated to weeks and printed in UTC. A JSON object with a
    repeated key keeps the last value instead of failing to parse, and a field
    of an unexpected type does not hide the other fields.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.json.enablePartialResults", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster."""
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="workledger-")
    return _local_folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Used where rows are read several times (the parse would repeat) or where a
    value such as a partition number must not change between two readings. The
    written table also cuts the lineage, so a lost executor costs a re-read of
    its files and not a re-computation.
    """
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
