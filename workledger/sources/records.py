"""Records of CSV files that are read in splits, also where quoted fields hold line breaks.

Whether a line begins inside a quoted field depends on all lines before it. Each
line maps the state before it (0 outside, 1 inside quotes) to the state behind
it: it keeps it, turns it round, or ends in one state whatever came before. The maps
of a block's lines are combined along the block, those of the blocks along the
file, so that no file needs one task; only the lines of records that hold line
breaks are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from workledger.session import materialize
from workledger.sources.lines import with_place, with_running_id

_BLOCK = ["source_file", "file_part", "block_start"]
# A complete quoted field; the rest of a field that is open when the line begins; a field that stays open.
_QUOTED = r'(?:^|(?<=,))"[^"]*+(?:""[^"]*+)*+"(?=,|\r?$)'
_REST = r'^[^"]*+(?:""[^"]*+)*+"(?!")'
_OPEN = r'(?:^|,)"'


def _behind(text: Column) -> Column:
    """Whether a field is open at the end of a line that begins outside quotes."""
    return F.regexp_replace(text, _QUOTED, "").rlike(_OPEN).cast("int")


def _combined(rows: DataFrame, order: Window, if_open: Column, if_closed: Column) -> DataFrame:
    """Along ``order``, the map from the state before all rows to that behind each row, as ``known, bit``.

    If ``known`` the state is ``bit``, else that before all rows, turned round if ``bit`` is 1.
    """
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = F.when((if_closed == 1) & (if_open == 0), 1).otherwise(0)
    turned = rows.withColumn("_turned", F.sum(turns).over(until))
    fixed = F.when(if_open == if_closed, F.struct(if_open.alias("state"), F.col("_turned").alias("turned")))
    last = turned.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(until))
    since = F.col("_turned") - F.coalesce("_fixed.turned", F.lit(0))
    bit = (F.coalesce("_fixed.state", F.lit(0)) + since) % 2
    return last.withColumns({"known": F.col("_fixed").isNotNull(), "bit": bit.cast("int")}).drop("_turned", "_fixed")


def _after(known: Column, bit: Column, before: Column) -> Column:
    return F.when(known, bit).otherwise((before + bit) % 2)


def _states(lines: DataFrame, along: Window) -> tuple[DataFrame, Column, Column]:
    """The lines, and as columns the states before and behind each."""
    mapped = _combined(lines, along, F.col("open"), F.col("closed")).drop("open", "closed")
    mapped = mapped.withColumns(
        {"known_before": F.coalesce(F.lag("known").over(along), F.lit(False)), "bit_before": F.coalesce(F.lag("bit").over(along), F.lit(0))}
    )
    # A row per block: the state before it, from the maps of the blocks before it.
    blocks = mapped.groupBy(*_BLOCK).agg(F.max_by(F.struct("known", "bit"), "running_id").alias("map"))
    of_part = Window.partitionBy("source_file", "file_part").orderBy("block_start")
    is_open = _after(F.col("map.known"), F.col("map.bit"), F.lit(1))
    is_closed = _after(F.col("map.known"), F.col("map.bit"), F.lit(0))
    along_part = _combined(blocks.select(*_BLOCK, is_open.alias("o"), is_closed.alias("c")), of_part, F.col("o"), F.col("c"))
    behind = _after(F.col("known"), F.col("bit"), F.lit(0))
    entered = along_part.select(*_BLOCK, F.coalesce(F.lag(behind).over(of_part), F.lit(0)).alias("entered"))
    before = _after(F.col("known_before"), F.col("bit_before"), F.col("entered"))
    return mapped.join(entered, _BLOCK), before, _after(F.col("known"), F.col("bit"), F.col("entered"))


def scan_records(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``source_file, source_row_number, record``: the text of every record; empty lines are none.

    The first record of every file is its header and not returned. Records are numbered
    from 2 over the part files of a folder. Lines end with a line feed, after which a
    carriage return in front of it is no part of a record.
    """
    text = spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "raw")
    raw = F.col("raw")
    rest = F.regexp_replace(raw, _REST, "")
    inside = F.when(~raw.rlike(_REST), 1).otherwise(F.regexp_replace(rest, _QUOTED, "").rlike(r',"').cast("int"))
    lines = with_running_id(with_place(text, name)).withColumns(
        {"closed": F.when(F.contains(raw, F.lit('"')), _behind(raw)).otherwise(0), "open": F.when(F.contains(raw, F.lit('"')), inside).otherwise(1)}
    )
    # Places in a scan may differ between two readings.
    lines = materialize(lines, "lines")
    along = Window.partitionBy(*_BLOCK).orderBy("running_id")
    if lines.filter("closed = 1").isEmpty():
        # No line leaves a field open, so none begins inside one.
        placed, before, after = lines, F.lit(0), F.lit(0)
    else:
        placed, before, after = _states(lines, along)
    begins = (before == 0) & ~((after == 0) & F.col("raw").isin("", "\r"))
    single = (before == 0) & (after == 0)
    stated = placed.select(*_BLOCK, "running_id", "raw", begins.cast("int").alias("begins"), single.alias("single"))
    stated = stated.filter("begins = 1 or not single").withColumn("upto", F.sum("begins").over(along))
    stated = materialize(stated, "stated")

    # Numbers: the records that begin in the blocks before, and one header for each part file.
    counts = stated.groupBy(*_BLOCK).agg(F.sum("begins").alias("n"))
    parts = Window.partitionBy("source_file").orderBy(F.length("file_part"), "file_part", "block_start")
    earlier = parts.rowsBetween(Window.unboundedPreceding, -1)
    first = F.min(F.when(F.col("n") > 0, F.col("block_start"))).over(Window.partitionBy("source_file", "file_part"))
    heads = counts.withColumn("heads", (first == F.col("block_start")).cast("int"))
    offsets = heads.select(
        *_BLOCK,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"),
        F.sum("heads").over(parts).alias("headers"),
        (F.coalesce(first == F.col("block_start"), F.lit(False))).alias("with_header"),
    )
    numbered = stated.join(offsets, _BLOCK).withColumn("number", F.col("earlier") + F.col("upto"))
    whole = numbered.filter("single").select("source_file", "number", "headers", "raw", (F.col("with_header") & (F.col("upto") == 1)).alias("header"))
    spread = numbered.filter("not single")
    # Lines of one record are brought together; a record of many lines is one value anyhow.
    joined = spread.groupBy("source_file", "number").agg(
        F.max("headers").alias("headers"),
        F.array_sort(F.collect_list(F.struct(F.length("file_part").alias("l"), "file_part", "block_start", "running_id", "raw"))).alias("lines"),
        F.min_by(F.col("with_header") & (F.col("upto") == 1), F.struct(F.col("block_start"), F.col("running_id"))).alias("header"),
    )
    joined = joined.withColumn("raw", F.array_join(F.transform("lines", lambda x: x["raw"]), "\n")).drop("lines")
    records = whole.unionByName(joined).filter("not header")
    return records.select(
        "source_file",
        (F.col("number") - F.col("headers") + 1).alias("source_row_number"),
        F.regexp_replace("raw", r"\r$", "").alias("record"),
    )
