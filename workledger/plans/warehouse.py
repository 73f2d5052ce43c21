"""Plain Parquet tables that change together.

Tables that are upserted (events, stores, technicians) are partitioned by a bucket
of the key's hash and by load. A load writes the buckets that it changes, whole,
as new partitions; all other buckets are neither read nor written. So a table is
read without settling anything, and a read for known keys touches their buckets only.
Rejects, and what became of them, are appended, partitioned by load.

The audit row is written last and names the buckets of the load: from then on
readers see them. What a failed load left is in no audit row; its load id never
comes again. ``compact`` and ``vacuum`` are jobs to run now and then.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from workledger import schemas
from workledger.session import materialize

EVENTS = "work_order_events"
REJECTS = "rejected_records"
REPLAYED = "replayed_rejects"
RUNS = "ingestion_runs"
HISTORY = "work_order_history"
SUMMARY = "kept_work_order_summary"
SEQUENCES = "kept_abnormal_sequences"
TABLES = {
    EVENTS: schemas.WORK_ORDER_EVENTS,
    REJECTS: schemas.REJECTED_RECORDS,
    REPLAYED: schemas.REPLAYED_REJECTS,
    RUNS: schemas.INGESTION_RUNS,
    "stores": schemas.STORES,
    "technicians": schemas.TECHNICIANS,
    HISTORY: schemas.WORK_ORDER_HISTORY,
    SUMMARY: schemas.WORK_ORDER_SUMMARY,
    SEQUENCES: schemas.ABNORMAL_SEQUENCES,
}
# Kept up to date by every load, if asked for once.
KEPT = (HISTORY, SUMMARY, SEQUENCES)
APPENDED = (REJECTS, REPLAYED)
# The column whose hash gives the bucket; other tables are appended to.
KEYS = {EVENTS: "event_id", "stores": "store_id", "technicians": "technician_id"} | dict.fromkeys(KEPT, "work_order_id")

# Buckets of a new warehouse. A bucket is what a correction rewrites, so large
# warehouses take more: at most as many as partitions one wants to list.
BUCKETS = 64

_MARKS = "run_id string, status string, marked_at timestamp"
# The audit row, and what the load wrote: per table its buckets. ``replaced`` holds loads that a compaction stands for.
_COMMITS = T.StructType(
    [
        *schemas.INGESTION_RUNS.fields,
        T.StructField("kind", T.StringType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("load", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("written", T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))),
        T.StructField("replaced", T.ArrayType(T.StringType())),
    ]
)


# A partition without rows that gives a new table its columns.
_EMPTY = {name: "bucket=-1/load=none" if name in KEYS else "load=none" for name in TABLES if name != RUNS}


@dataclass(frozen=True)
class State:
    """What readers see: of keyed tables the load of every bucket, of appended ones all loads."""

    sequence: int = 0
    buckets: int = BUCKETS
    live: dict[str, dict[int, str]] = field(default_factory=dict)
    appended: dict[str, tuple[str, ...]] = field(default_factory=dict)
    kept: bool = False

    def of(self, table: str) -> dict[int, str]:
        return self.live.get(table, {})

    def put(self, table: str, load: str, buckets: list[int]) -> State:
        return replace(self, live={**self.live, table: {**self.of(table), **dict.fromkeys(buckets, load)}})


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def buckets_of(table: str, buckets: int) -> int:
    """Stores and technicians are a small part of the events, and so are their buckets."""
    return -(-buckets // 16) if table in ("stores", "technicians") else buckets


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        """``buckets`` counts for a new warehouse; later loads keep what the first one had."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    # --- what is visible ---

    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(_COMMITS).parquet(f"{self.root}/commits")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMITS)

    def state(self) -> State:
        """The loads that are visible now: a row per bucket and one per load come to the driver."""
        commits = self.commits()
        last = commits.agg(F.max("sequence").alias("sequence"), F.max("buckets").alias("buckets"), F.bool_or(F.map_contains_key("written", HISTORY)).alias("kept")).first()
        if last.sequence is None:
            return State(buckets=self.buckets)
        written = commits.select("sequence", "load", F.explode("written").alias("table", "of"))
        newest = written.select("*", F.explode("of").alias("bucket")).groupBy("table", "bucket").agg(F.max_by("load", "sequence").alias("load"))
        live: dict[str, dict[int, str]] = {}
        for row in newest.collect():
            live.setdefault(row.table, {})[row.bucket] = row.load
        gone = commits.select(F.explode("replaced").alias("load"))
        loads = written.filter(F.col("table").isin(*APPENDED)).join(gone, "load", "left_anti").sort("sequence").collect()
        appended = {name: tuple(row.load for row in loads if row.table == name) for name in APPENDED}
        return State(last.sequence, last.buckets, live, appended, last.kept)

    def publish(self, state: State, load: str, written: dict[str, list[int]], run: DataFrame | None = None, replaced: list[str] | None = None) -> None:
        """Make the load visible, by one row. Fails if another load published since ``state`` was read."""
        if self.state().sequence != state.sequence:
            raise RuntimeError("another load published meanwhile")
        kind = "RUN" if run is not None else "REFRESH" if replaced is None else "COMPACT"
        audit = run.select(*schemas.INGESTION_RUNS.fieldNames()).first() if run is not None else (None,) * len(schemas.INGESTION_RUNS)
        row = (*audit, kind, state.sequence + 1, load, state.buckets, written, replaced or [])
        self.spark.createDataFrame([row], _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def create(self) -> None:
        """Give tables without rows their columns, for readers of the folders themselves (views)."""
        files = self._files()
        for name, place in _EMPTY.items():
            if not files.exists(self._path(f"{name}/{place}")):
                self.spark.createDataFrame([], TABLES[name]).coalesce(1).write.parquet(f"{self.root}/{name}/{place}")
        if not files.exists(self._path("commits")):
            self.spark.createDataFrame([], _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    # --- tables ---

    def table(self, name: str, state: State | None = None) -> DataFrame:
        if name == RUNS:
            return self.commits().filter("kind = 'RUN'").select(*TABLES[name].fieldNames())
        return self.partitions(name, state or self.state()).select(*TABLES[name].fieldNames())

    def partitions(self, name: str, state: State, buckets: list[int] | None = None) -> DataFrame:
        """Visible rows with their partition columns; of keyed tables those of ``buckets``, if given."""
        if name in KEYS:
            live = state.of(name)
            wanted = sorted(live if buckets is None else live.keys() & set(buckets))
            return self._read(name, [f"bucket={bucket}/load={live[bucket]}" for bucket in wanted])
        return self._read(name, [f"load={load}" for load in state.appended.get(name, ())])

    def _read(self, name: str, places: list[str]) -> DataFrame:
        schema = T.StructType([*TABLES[name].fields, *([T.StructField("bucket", T.IntegerType())] if name in KEYS else []), T.StructField("load", T.StringType())])
        # Known to be empty when a query is planned, so that nothing is shuffled to be joined with it.
        nothing = self.spark.createDataFrame([], schema).limit(0)
        if not places:
            return nothing
        base = f"{self.root}/{name}"
        if name in KEPT:  # the last row of a bucket may have gone
            files = self._files()
            places = [place for place in places if files.exists(self._path(f"{name}/{place}"))]
            if not places:
                return nothing
        return self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{place}" for place in places])

    def lookup(self, name: str, keys: list, state: State | None = None) -> DataFrame:
        """The rows of a few keys, read from their buckets alone."""
        state, key = state or self.state(), F.col(KEYS[name])
        rows = self.partitions(name, state)
        count = buckets_of(name, state.buckets)
        in_bucket = F.col("bucket").isin(*[bucket_of(F.lit(k), count) for k in keys]) if keys else F.lit(False)
        return rows.filter(in_bucket & key.isin(*keys)).select(*TABLES[name].fieldNames())

    def new_load(self, state: State) -> str:
        return f"{state.sequence + 1:09}-{uuid.uuid4().hex[:12]}"

    def touched(self, name: str, rows: DataFrame, state: State) -> tuple[DataFrame, list[int]]:
        """The rows, written with their ``bucket``, and the buckets they are in."""
        placed = materialize(rows.withColumn("bucket", self.bucket(name, state)), name)
        return placed, self.listed(placed.select("bucket"))

    def bucket(self, name: str, state: State) -> Column:
        return bucket_of(F.col(KEYS[name]), buckets_of(name, state.buckets)).alias("bucket")

    def listed(self, buckets: DataFrame) -> list[int]:
        return sorted(row.bucket for row in buckets.distinct().collect())

    def put(self, name: str, changes: DataFrame, state: State, load: str, keys: DataFrame | None = None) -> tuple[DataFrame, list[int]]:
        """Write the buckets that ``changes`` touch anew: the stored rows, less those of the same keys, and the changes.

        If ``keys`` are given, these are the keys whose stored rows go. Returns the
        changes as written and the buckets. Nothing is written where nothing changes.
        ``changes`` that hold their ``bucket`` are written already, by :meth:`touched`.
        """
        key, names = KEYS[name], [*TABLES[name].fieldNames(), "bucket"]
        if "bucket" in changes.columns:
            placed = changes.select(*names)
            buckets = self.listed(placed.select("bucket")) if keys is None else []
        else:
            placed, buckets = self.touched(name, changes.select(*TABLES[name].fieldNames()), state)
        gone = placed.select("bucket", key)
        if keys is not None:
            gone, buckets = self.touched(name, keys.select(key), state)
        if buckets:
            stored = self.partitions(name, state, buckets).select(*names)
            kept = stored.join(gone, ["bucket", key], "left_anti")
            self._write_buckets(name, kept.unionByName(placed.select(*names)), load)
        return placed, buckets

    def place(self, name: str, rows: DataFrame, state: State, load: str) -> tuple[DataFrame, list[int]]:
        """Write rows to a table in which nothing is stored, at once; returns them as written, and their buckets."""
        self._write_buckets(name, rows.select(*TABLES[name].fieldNames()).withColumn("bucket", self.bucket(name, state)), load)
        written = self._files().globStatus(self._path(f"{name}/bucket=*/load={load}")) or []
        buckets = sorted(int(status.getPath().getParent().getName().removeprefix("bucket=")) for status in written)
        return self._read(name, [f"bucket={bucket}/load={load}" for bucket in buckets]), buckets

    def _write_buckets(self, name: str, rows: DataFrame, load: str) -> None:
        # Rows of a bucket come together, and a large bucket is split again by size.
        placed = rows.hint("rebalance", F.col("bucket")).withColumn("load", F.lit(load))
        placed.write.mode("append").partitionBy("bucket", "load").parquet(f"{self.root}/{name}")

    def append(self, name: str, rows: DataFrame, load: str) -> DataFrame:
        # Also without rows there is a file then, which readers expect of a listed load.
        rows.select(*TABLES[name].fieldNames()).write.parquet(f"{self.root}/{name}/load={load}")
        return self._read(name, [f"load={load}"]).select(*TABLES[name].fieldNames())

    # --- upkeep ---

    def compact(self) -> None:
        """Write the rejects of all loads together, and what became of them, so that their folders stay few."""
        state = self.state()
        together = sorted({load for loads in state.appended.values() for load in loads})
        if len(together) > 1:
            load = self.new_load(state)
            for name in APPENDED:
                self.append(name, self.table(name, state), load)
            self.publish(state, load, {name: [] for name in APPENDED}, replaced=together)

    def unlisted(self) -> list[str]:
        """Partitions that readers do not see: replaced ones and those of failed loads."""
        state, files = self.state(), self._files()
        seen = {f"{name}/bucket={b}/load={load}" for name, live in state.live.items() for b, load in live.items()}
        seen |= {f"{name}/load={load}" for name, loads in state.appended.items() for load in loads}
        seen |= {f"{name}/{place}" for name, place in _EMPTY.items()}
        found = []
        for name in TABLES:
            pattern = f"{name}/bucket=*/load=*" if name in KEYS else f"{name}/load=*"
            for status in files.globStatus(self._path(pattern)) or []:
                place = status.getPath().toString()
                found.append(place[place.rindex(f"/{name}/") + 1 :])
        return sorted(set(found) - seen)

    def vacuum(self) -> list[str]:
        """Delete the unlisted partitions, at a time without loads and without readers of older states; returns them."""
        unlisted, files = self.unlisted(), self._files()
        for place in unlisted:
            files.delete(self._path(place), True)
        return unlisted

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("commits").getFileSystem(self.spark._jsc.hadoopConfiguration())

    # --- runs ---

    def mark(self, run_id: str, status: str) -> None:
        """Note that a run was started or failed, outside of what it publishes."""
        row = self.spark.range(1).select(
            F.lit(run_id).alias("run_id"), F.lit(status).alias("status"), F.current_timestamp().alias("marked_at")
        )
        row.write.mode("append").parquet(f"{self.root}/run_marks")

    def run_status(self) -> DataFrame:
        """``run_id, status``: SUCCEEDED if the run is recorded, else its last mark."""
        marks = self.spark.read.schema(_MARKS).parquet(f"{self.root}/run_marks")
        last = marks.groupBy("run_id").agg(F.max_by("status", "marked_at").alias("mark"))
        recorded = self.table(RUNS).select("run_id", F.lit("SUCCEEDED").alias("recorded"))
        status = F.coalesce("recorded", "mark").alias("status")
        return last.join(recorded, "run_id", "full").select("run_id", status)
