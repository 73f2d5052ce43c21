"""One identifier for the content of a whole batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

WORDS = 4


def line_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def batch_checksum(*parts: DataFrame) -> DataFrame:
    """A single row ``source_checksum`` over ``(source_file, source_row_number, digest)`` rows.

    Every line contributes a SHA-256 value over its file name, its number and
    its text. The values are combined with XOR, which needs no order: each task
    reduces its rows to a few words, so neither a file nor the file list ever
    sits in one task. Numbers make all contributions distinct, so none cancel.
    """
    lines = reduce(
        DataFrame.unionByName,
        (part.select("source_file", "source_row_number", "digest") for part in parts),
    )
    mark = F.sha2(F.concat_ws("\0", "source_file", "source_row_number", "digest"), 256)
    words = lines.select(mark.alias("mark")).select(
        *(
            F.conv(F.substring("mark", 1 + 16 * i, 16), 16, -10).cast("bigint").alias(f"w{i}")
            for i in range(WORDS)
        )
    )
    combined = words.agg(F.count("*").alias("n"), *(F.bit_xor(f"w{i}").alias(f"w{i}") for i in range(WORDS)))
    return combined.select(
        F.sha2(F.concat_ws(":", "n", *(f"w{i}" for i in range(WORDS))), 256).alias("source_checksum")
    )
