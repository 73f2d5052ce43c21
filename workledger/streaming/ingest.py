"""Load event files as they land, with the batch load as the sink.

Corrections may arrive at any age, so no watermark drops them: each micro-batch
is merged into the event table by key. The run id is that of the query, which its
checkpoint keeps, and of the micro-batch: a repeated micro-batch has the run id of
the first attempt and adds nothing if that was recorded, also when the reference
files have changed since.

The lines of every event file are counted per micro-batch, beside the checkpoint. So
the parts of a file may come in several micro-batches: their numbers go on
where those of the parts before them ended, as in one batch. Parts must land in
their order; one that lands after a later part is numbered behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from workledger.plans.load import load_lines
from workledger.schemas import EVENT_FILE_PATTERN
from workledger.session import configure
from workledger.sources.lines import with_place, with_running_id


def ingest_stream(
    spark: SparkSession,
    source_dir: str,
    warehouse: str,
    checkpoint: str,
    name: str = "stream",
    profile: str = "strict",
    max_files: int | None = None,
) -> StreamingQuery:
    """Load all files not loaded before and stop; call again for later files, or parts of files.

    A micro-batch takes ``max_files`` files, or parts of files, at most.
    """
    configure(spark)
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    scan = reader.load(f"{source_dir.rstrip('/')}/{EVENT_FILE_PATTERN}")
    lines = with_place(scan.withColumnRenamed("value", "raw"), EVENT_FILE_PATTERN)

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first().id
        run_id = f"{name}-{query}-{batch_id}"
        counts = f"{checkpoint.rstrip('/')}/line_counts"
        # Repeated with the micro-batch, to the same content.
        batch.groupBy("source_file").agg(F.count("*").alias("lines")).write.mode("overwrite").parquet(f"{counts}/batch={batch_id}")
        earlier = spark.read.schema("source_file string, lines long, batch long").parquet(counts).filter(F.col("batch") < batch_id)
        earlier = earlier.groupBy("source_file").agg(F.sum("lines").alias("lines"))
        scanned = with_running_id(batch)
        load_lines(spark, scanned, source_dir, warehouse, profile, run_id, is_retry=True, earlier_lines=earlier)

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
