"""Lines of event files with their file name and their number in that file.

A large file is read by many tasks, so a line's number is not known while it is
read. The scan records where the line was met (file part, block, running id);
once those rows are written, the line counts of the blocks before it give the
number. Neither step sorts the lines or needs one task per file.
"""

from __future__ import annotations

from fnmatch import fnmatchcase

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from workledger.schemas import EVENT_FILE_PATTERN
from workledger.session import materialize

POSITION = ("file_part", "block_start", "running_id")

# Rows of the per-block table that may be broadcast: one row per input split of
# about 128 MB and about 100 bytes wide, so at most 100 MB.
MAX_BROADCAST_BLOCKS = 1_000_000


def source_file_name(pattern: str = EVENT_FILE_PATTERN) -> Column:
    """The name of the event file a row came from.

    An event file may also be a folder of part files, as Spark writes text;
    then it is the folder that carries the name.
    """
    name = pattern.replace(".", r"\.").replace("*", "[^/]*")
    folder = F.regexp_extract(F.col("_metadata.file_path"), f"/({name})/[^/]+$", 1)
    return F.coalesce(F.nullif(folder, F.lit("")), F.col("_metadata.file_name"))


def with_place(scan: DataFrame, pattern: str) -> DataFrame:
    """Add the file name and the block each row of a file scan was met in."""
    return scan.select(
        "*",
        source_file_name(pattern).alias("source_file"),
        F.col("_metadata.file_name").alias("file_part"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def with_running_id(rows: DataFrame) -> DataFrame:
    """Add an id that grows along each block.

    Must be applied to the scan itself, before anything that moves rows.
    """
    return rows.withColumn("running_id", F.monotonically_increasing_id())


def scan_lines(spark: SparkSession, source_dir: str, pattern: str = EVENT_FILE_PATTERN) -> DataFrame:
    """Raw lines of all matching files; no matching file is an error."""
    try:
        scan = spark.read.text(f"{source_dir.rstrip('/')}/{pattern}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no {pattern} files found in {source_dir}") from missing
    return with_running_id(with_place(scan.withColumnRenamed("value", "raw"), pattern))


def event_files(spark: SparkSession, source_dir: str, pattern: str = EVENT_FILE_PATTERN) -> DataFrame:
    """The names of all matching files, also of those without lines.

    Scans leave empty files out, so the names come from the listing that every
    scan keeps in the driver: as many as the batch has files.
    """
    places = [path.split("/") for path in spark.read.text(f"{source_dir.rstrip('/')}/{pattern}").inputFiles()]
    names = {place[-2] if fnmatchcase(place[-2], pattern) else place[-1] for place in places}
    return spark.createDataFrame([(name,) for name in sorted(names)], "source_file string")


def number_rows(
    rows: DataFrame, first: int = 1, max_broadcast: int = MAX_BROADCAST_BLOCKS, earlier_lines: DataFrame | None = None
) -> DataFrame:
    """Replace the scan position by ``source_row_number``.

    ``rows`` must be a written table: the position columns of a scan may differ
    between two readings, those of a table do not. ``earlier_lines`` has, per
    ``source_file``, the ``lines`` that were numbered before these.
    """
    block = ["source_file", "file_part", "block_start"]
    blocks = rows.groupBy(*block).agg(F.count("*").alias("n"), F.min("running_id").alias("first_id"))
    # Part files are numbered with at least five digits, so longer names come later.
    earlier = (
        Window.partitionBy("source_file")
        .orderBy(F.length("file_part"), "file_part", "block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = blocks.select(
        *block,
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) + first - F.col("first_id")).alias("shift"),
    )
    if earlier_lines is not None:
        offsets = offsets.join(earlier_lines, "source_file", "left")
        offsets = offsets.withColumn("shift", F.col("shift") + F.coalesce("lines", F.lit(0))).drop("lines")
    # Written once: every reader of the numbered rows joins it.
    offsets = materialize(offsets, "blocks")
    if offsets.count() <= max_broadcast:
        offsets = F.broadcast(offsets)
    return (
        rows.join(offsets, block)
        .withColumn("source_row_number", F.col("running_id") + F.col("shift"))
        .drop("shift", *POSITION)
    )
