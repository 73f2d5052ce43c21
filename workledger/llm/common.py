"""What the text operators share: appended columns, folds, bounded samples."""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

HELD_OUT = 1
BATCH_BYTES = 4 << 20
SAMPLE_CHARS = 50_000
# What the driver receives of all labels together, however many there are (but one text of each).
SAMPLE_TOTAL = 400_000_000


class Lookup:
    """Places of many keys at once in an array of distinct 64-bit keys; -1 for keys that are not there."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys).astype(np.uint64)
        self.shift = np.uint64(64 - max(10, len(keys).bit_length() + 2))
        size = 1 << (64 - int(self.shift))
        self.slots = np.full(size, -1, np.int64)
        self.keys = np.zeros(size, np.uint64)
        open_, slot, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(open_):
            self.probes += 1
            free = np.flatnonzero(self.slots[slot] < 0)
            self.slots[slot[free]] = open_[free]  # of several, the last one stays
            left = self.slots[slot] != open_
            self.keys[slot[~left]] = keys[open_[~left]]
            open_, slot = open_[left], (slot[left] + 1) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64, copy=False)
        slot = self._slot(keys)
        out = self.slots[slot]
        other = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        slot = slot[other]
        while len(other):
            slot = (slot + 1) % len(self.slots)
            out[other] = self.slots[slot]
            on = (out[other] >= 0) & (self.keys[slot] != keys[other])
            other, slot = other[on], slot[on]
        return out


def held_out(id_column: str = "doc_id") -> Column:
    """True for the third of the ids that no model learns from."""
    remainder = F.crc32(F.col(id_column).cast("string")) % 3
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` less the columns that an operator's output would clash with."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{name}`") for name in df.columns if name.lower() not in taken])


def portable(function: Callable, shared: Broadcast | None = None) -> Callable:
    """``function`` for mapInArrow, also where workers were not told of this package's folder.

    With ``shared`` the function gets the broadcast value too.

    On a cluster the package is installed or sent with ``--py-files``; a worker
    on the driver's machine finds it where the driver has it.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    package, sent = __name__.partition(".")[0], cloudpickle.dumps(function)

    def run(batches):
        import importlib.util
        import pickle
        import sys

        if importlib.util.find_spec(package) is None:
            sys.path.append(root)
        yield from pickle.loads(sent)(batches, *([] if shared is None else [shared.value]))

    return run


def append_columns(
    df: DataFrame,
    inputs: list[str],
    outputs: T.StructType,
    prepare: Callable[..., Callable[..., list]],
    shared: Broadcast | None = None,
) -> DataFrame:
    """Add the columns ``outputs``, computed from ``inputs`` batch by batch.

    Batches are cut at BATCH_BYTES, so long texts do not add up in a worker (a
    text longer than that is a batch of its own). ``prepare`` runs once per task, on the value
    of ``shared`` if there is one, and returns a function from Arrow arrays to
    as many lists or Arrow arrays. Input columns named like an output are replaced.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    passed = without(df, outputs.fieldNames()).columns
    schema = T.StructType([*df.select(*[F.col(f"`{c}`") for c in passed]).schema.fields, *outputs.fields])
    # Inputs travel under names of their own, also when an output replaces them.
    sent = df.select(
        *[F.col(f"`{c}`") for c in passed], *[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(inputs) if c not in passed]
    )
    place = {c: c if c in passed else f"__in{i}" for i, c in enumerate(inputs)}

    def run(batches, *values):
        compute = prepare(*values)
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = [to_arrow_schema(T.StructType([field])).field(0).type for field in outputs.fields]
        for batch in batches:
            made = compute(*[batch.column(batch.schema.get_field_index(place[c])) for c in inputs])
            made = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in zip(made, kinds, strict=True)]
            kept = [batch.column(i) for i in range(len(passed))]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=[*passed, *outputs.fieldNames()])
        pa.default_memory_pool().release_unused()  # the worker lives on

    return sent.mapInArrow(portable(run, shared), schema)


def _id_type(*tables: DataFrame) -> str:
    """Ids are integers, or text if those of any table are not."""
    return "long" if all(isinstance(t.schema["doc_id"].dataType, T.IntegralType) for t in tables) else "string"


def least_hashed(examples: DataFrame, rows_per_label: int) -> list[tuple[int | str, object]]:
    """Of the distinct (doc_id, label) rows, those with the ``rows_per_label`` smallest hashes of their id in each label.

    All labels are taken in one job, however many there are. What the driver
    sorts was cut before by the hash below which a little more than
    ``rows_per_label`` rows of the label are expected. Of very many labels fewer rows each are taken:
    ``SAMPLE_TOTAL`` bounds the texts of them all. Rows with a null are left out; ids are integers or text.
    """
    examples = examples.select(F.col("doc_id").cast(_id_type(examples)).alias("doc_id"), "label").dropna().distinct()
    order = F.xxhash64("doc_id")
    # Eight standard deviations above what is needed.
    share = (rows_per_label + 8 * rows_per_label**0.5 + 32) / F.col("count")
    below = F.when(share < 1, share * 2.0**64 - 2.0**63).otherwise(2.0**63).alias("below")
    bounds = examples.groupBy("label").count().select("label", below)
    near = examples.join(F.broadcast(bounds), "label").filter(order <= F.col("below"))
    by_label: dict[object, list[tuple[int, int | str]]] = {}
    for row in near.select("label", order.alias("order"), "doc_id").collect():
        by_label.setdefault(row.label, []).append((row.order, row.doc_id))
    rows = min(rows_per_label, max(1, SAMPLE_TOTAL // (SAMPLE_CHARS * max(1, len(by_label)))))
    return [(i, label) for label, found in by_label.items() for _, i in sorted(found)[:rows]]


def texts_of(texts: DataFrame, chosen: list[tuple[int | str, object]], label_type: str) -> list[tuple[str, object]]:
    """One (text, label) row for each chosen id and label, by id; ``texts`` may have a label column of its own.

    Of several texts under one id the smallest is taken, before the driver receives any.
    """
    if not chosen:
        return []
    id_type = "long" if isinstance(chosen[0][0], int) else "string"
    ids = texts.sparkSession.createDataFrame(sorted(chosen), f"doc_id {id_type}, label {label_type}")
    own = texts.withColumn("doc_id", F.col("doc_id").cast(id_type))
    joined = own.join(F.broadcast(ids), [c for c in ids.columns if c in texts.columns])
    rows = joined.groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    return [(row.text, row.label) for row in sorted(rows, key=lambda r: (r.doc_id, r.label))]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows_per_label: int, max_chars: int = SAMPLE_CHARS
) -> list[tuple[str, int]]:
    """At most ``rows_per_label`` texts of each label value outside the held-out fold.

    The ids with the smallest hashes are taken, each once however often it is
    repeated, so the sample is the same whatever the partitioning. Texts over
    ``max_chars`` are left out of the sample, which bounds what the driver
    receives. Rows without text, id or label are no examples, nor are labels of documents without such a
    text; they take no example's place.
    """
    own_id = F.col("doc_id").cast(_id_type(docs, labels)).alias("doc_id")
    texts = docs.select(own_id, "text").filter(F.length("text") <= max_chars)
    usable = labels.filter(~held_out()).select(own_id, F.col(label).cast("int").alias("label"))
    usable = usable.join(texts.select("doc_id"), "doc_id", "left_semi")
    return texts_of(texts, least_hashed(usable, rows_per_label), "int")
