"""Does a value occur in a reference table?"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from workledger.session import materialize

# Reference ids that may be broadcast; a short string each, so well below 100 MB.
MAX_BROADCAST_IDS = 1_000_000

_NOT_HASHED = ("map", "variant", "array", "struct")


def flag_known(
    df: DataFrame,
    ids: DataFrame,
    column: str,
    flag: str,
    max_broadcast: int = MAX_BROADCAST_IDS,
) -> DataFrame:
    """Add a boolean ``flag``: the value of ``column`` is one of ``ids[column]``.

    Repeated reference ids do not multiply rows. A counted, small id list is
    broadcast, so the rows stay where they are. A longer list is joined on the id
    and its hash; both sides have an exchange of their own, so the engine splits
    exactly the ids that it finds to be heavy. Rows without an id match nothing
    and are spread by a hash of their other columns.
    """
    # Written once: the ids are counted and joined, and may be dear to work out.
    known = materialize(ids.select(F.col(column).alias("_id")).distinct(), "ids").filter("_id is not null")
    known = known.withColumn("_known", F.lit(True))
    if known.count() <= max_broadcast:
        joined = df.join(F.broadcast(known), F.col(column) == F.col("_id"), "left")
    else:
        others = [F.col(f"`{name}`") for name, kind in df.dtypes if not kind.startswith(_NOT_HASHED)]
        spread = F.when(F.col(column).isNull(), F.xxhash64(F.lit(0), *others)).otherwise(F.xxhash64(column))
        joined = df.withColumn("_spread", spread).join(
            known.withColumn("_hash", F.xxhash64("_id")),
            (F.col(column) == F.col("_id")) & (F.col("_spread") == F.col("_hash")),
            "left",
        )
    return joined.withColumn(flag, F.coalesce("_known", F.lit(False))).drop("_id", "_known", "_spread", "_hash")


def unknown_references(
    events: DataFrame, ids: DataFrame, column: str, max_broadcast: int = MAX_BROADCAST_IDS
) -> DataFrame:
    """Events naming a ``column`` value that the reference table lacks."""
    named = events.filter(F.col(column).isNotNull())
    return flag_known(named, ids, column, "_is_known", max_broadcast).filter("not _is_known").drop("_is_known")
