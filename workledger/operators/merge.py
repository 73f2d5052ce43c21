"""Upserts as joins; no table format with MERGE is needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compared_events(stored: DataFrame, batch: DataFrame, seen_at: Column) -> DataFrame:
    """The events of a batch as they are to be stored, and whether each ``changes`` what is stored.

    A row replaces the stored one of its event if it is newer, or equally old with
    another payload; an event that is not stored is new. Of the stored rows four
    narrow columns are read.
    """
    old = stored.select(
        "event_id",
        F.col("updated_at_utc").alias("_updated"),
        F.col("payload_hash").alias("_hash"),
        F.col("first_seen_at").alias("_first_seen"),
    )
    joined = batch.join(old, "event_id", "left")
    corrected = (F.col("updated_at_utc") == F.col("_updated")) & (F.col("payload_hash") != F.col("_hash"))
    changes = F.coalesce(F.col("_updated").isNull() | (F.col("updated_at_utc") > F.col("_updated")) | corrected, F.lit(False))
    seen = {"first_seen_at": F.coalesce("_first_seen", seen_at), "last_seen_at": seen_at}
    return joined.withColumns({**seen, "changes": changes}).drop("_updated", "_hash", "_first_seen")


def changed_events(stored: DataFrame, batch: DataFrame, seen_at: Column) -> DataFrame:
    """Those events of a batch that change what is stored."""
    return compared_events(stored, batch, seen_at).filter("changes").drop("changes")


def changed_rows(stored: DataFrame, given: DataFrame, key: str) -> DataFrame:
    """Those given rows that are not stored as they are."""
    names = [name for name in given.columns if name != key]
    old = stored.select(key, *[F.col(name).alias(f"_{name}") for name in names], F.lit(True).alias("_stored"))
    joined = given.join(old, key, "left")
    same = F.col("_stored").isNotNull()
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return joined.filter(~same).select(*given.columns)


def without(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return target.join(keys.select(key), key, "left_anti")


def merge_latest(target: DataFrame, source: DataFrame, seen_at: Column) -> DataFrame:
    """``target`` after merging ``source``, by one full join: each event's row is taken from one side."""
    stored = target.select(F.col("event_id").alias("_key"), F.struct("*").alias("_stored"))
    given = source.select(F.col("event_id").alias("_key"), F.struct("*").alias("_given"))
    old, new = F.col("_stored"), F.col("_given")
    newer = new["updated_at_utc"] > old["updated_at_utc"]
    corrected = (new["updated_at_utc"] == old["updated_at_utc"]) & (new["payload_hash"] != old["payload_hash"])
    take = F.col("_given").isNotNull() & (F.col("_stored").isNull() | F.coalesce(newer | corrected, F.lit(False)))
    merged = {
        name: F.when(F.col("_take"), new[name]).otherwise(old[name])
        for name in target.columns
        if name not in ("first_seen_at", "last_seen_at")
    }
    merged["first_seen_at"] = F.coalesce(old["first_seen_at"], seen_at)
    merged["last_seen_at"] = F.when(F.col("_take"), seen_at).otherwise(old["last_seen_at"])
    joined = stored.join(given, "_key", "full").withColumn("_take", take)
    return joined.select(*[merged[name].alias(name) for name in target.columns])


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Source rows replace target rows of the same key; other target rows stay."""
    return without(target, source, key).unionByName(source.select(*target.columns))
