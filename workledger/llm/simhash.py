"""SimHash near-duplicates: an inverted index of positional bytes with count filtering.

Two 64-bit fingerprints that differ in at most 3 bits agree in at least 5 of
their 8 positional bytes. The index is keyed by what such a count guarantees: by
every choice of 5 positions with the 5 bytes there. Two fingerprints share a key
if their tally of shared positional bytes reaches 5, so pairs below the minimum
are never formed. The equal bytes of every pair that meets are counted, pairs below the
minimum go, and the rest is verified by the differing bits.

Equal fingerprints are one entry of the index. A posting list longer than
``BLOCK`` is dealt into blocks, and every two blocks meet in a task of their own.
What a task returns is not its pairs but at most one link per entry, enough to
join the same components. Components come from rounds of star contraction over
those links, each written to the shared folder.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other; documents without id take part, and a component without any id has a
null ``component_id``; repeated ids are kept as rows, each with its own
fingerprint; texts of any length are read whole, some words at a time; an empty table
gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from workledger.llm.common import append_columns, portable
from workledger.session import materialize

SHINGLE = 3
MAX_BITS = 3
BLOCK = 1024
SEED = 42
WORDS_AT_ONCE = 1 << 15


def _hash_sum(raw: bytes, length: int) -> tuple[np.ndarray, int]:
    """Per bit the number of shingles that set it, and the number of shingles."""
    words = raw.lower().split()
    counts, total = np.zeros(64, np.int64), 0
    if not words:
        return counts, 0
    length = min(length, len(words))
    for at in range(0, len(words) - length + 1, WORDS_AT_ONCE):
        some = words[at : at + WORDS_AT_ONCE + length - 1]
        text = b" ".join(some)
        stop = (np.cumsum([len(w) for w in some]) + np.arange(len(some))).tolist()
        start = [0, *[s + 1 for s in stop]]
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(text[a:b], SEED) for a, b in zip(start, stop[length - 1 :])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(hashes)
    return counts, total


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if over half of the shingles' hashes set it; as a signed 64-bit integer."""
    counts, total = _hash_sum(raw, shingle)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Add ``fingerprint`` as a signed integer."""

    def prepare():
        def compute(texts):
            return [[fingerprint((t.as_py() or "").encode("utf-8", "surrogatepass"), shingle) for t in texts]]

        return compute

    return append_columns(docs, [text], T.StructType([T.StructField("fingerprint", T.LongType())]), prepare)


def positions_needed(max_bits: int) -> int:
    """Positional bytes that two fingerprints share at least."""
    return 8 - max_bits


def index(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Postings (key, fp) of distinct fingerprints; the key holds a choice of positions and the bytes there."""
    kept = [
        sum(0xFF << 8 * p for p in places) for places in combinations(range(8), positions_needed(max_bits))
    ]
    signed = [m - (1 << 64) if m >> 63 else m for m in kept]
    masks = F.array(*[F.struct(F.lit(n).alias("choice"), F.lit(m).cast("long").alias("mask")) for n, m in enumerate(signed)])
    posted = prints.select("fp", F.explode(masks).alias("m"))
    return posted.select(F.col("m.choice").alias("choice"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("bytes"), "fp")


def _shared_bytes(differ: np.ndarray) -> np.ndarray:
    """The tally of a pair: positions whose bytes are equal, from the exclusive or of its fingerprints."""
    return (np.ascontiguousarray(differ).view(np.uint8).reshape(-1, 8) == 0).sum(1)


def _components(group: np.ndarray, fp: np.ndarray, max_bits: int) -> np.ndarray:
    """Per entry the smallest index that it is linked to within its group, by way of others too.

    ``group`` is sorted. Entry i is compared with entry i + d of its group, for all i at once.
    """
    n = len(fp)
    parent = np.arange(n)
    ends = np.searchsorted(group, group, side="right")

    def roots() -> None:
        nonlocal parent
        while not np.array_equal(up := parent[parent], parent):
            parent = up

    reach = ends - np.arange(n)
    for d in range(1, int(reach.max(initial=1))):
        i = np.flatnonzero(reach > d)
        differ = fp[i] ^ fp[i + d]
        enough = _shared_bytes(differ) >= positions_needed(max_bits)
        i, differ = i[enough], differ[enough]
        i = i[np.bitwise_count(differ) <= max_bits]
        while len(i := i[parent[i] != parent[i + d]]):
            a, b = parent[i], parent[i + d]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            roots()
    return parent


def _links_of_task(max_bits: int):
    """Reads postings sorted by group and returns (fp, other) for every entry linked to an earlier one."""

    def run(batches):
        held_group, held_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def linked(group, fp):
            parent = _components(group, fp, max_bits)
            at = np.flatnonzero(parent != np.arange(len(fp)))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[at].view(np.int64)), pa.array(fp[parent[at]].view(np.int64))], names=["u", "v"]
                )

        number = 0
        last = None
        for batch in batches:
            names = ["choice", "bytes", "block"]
            keys = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False).astype(np.int64) for k in names], 1)
            fp = batch.column(batch.schema.get_field_index("fp")).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            if not len(fp):
                continue
            new = np.ones(len(fp), np.int64)
            new[1:] = (keys[1:] != keys[:-1]).any(1)
            new[0] = last is None or bool((keys[0] != last).any())
            group = number + np.cumsum(new)
            number, last = int(group[-1]), keys[-1]
            group, fp = np.concatenate([held_group, group]), np.concatenate([held_fp, fp])
            whole = int(np.searchsorted(group, number))  # the last group may go on in the next batch
            yield from linked(group[:whole], fp[:whole])
            held_group, held_fp = group[whole:], fp[whole:]
        yield from linked(held_group, held_fp)

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (u, v) between distinct fingerprints whose components are those of all pairs within ``max_bits``."""
    postings = index(prints, max_bits)
    key = ["choice", "bytes"]
    sizes = postings.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    shared = postings.join(sizes, key)
    # A long list is dealt into blocks; entry of block b goes to every pair of blocks that has b.
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(other, F.col("own")) * F.col("blocks") + F.greatest(other, F.col("own")),
    )
    dealt = shared.withColumn("blocks", blocks).withColumn("own", own)
    dealt = dealt.select(*key, F.explode(F.when(F.col("blocks") > 1, pairs).otherwise(F.array(F.lit(0)))).alias("block"), "fp")
    grouped = [*key, "block"]
    dealt = dealt.repartition(*[F.col(c) for c in grouped]).sortWithinPartitions(*grouped)
    return dealt.mapInArrow(portable(_links_of_task(max_bits)), "u long, v long").distinct()


def _joined(many: DataFrame, least: DataFrame) -> DataFrame:
    """``many`` with its node's least neighbour; the hash in the key gives both sides an exchange that can be split."""
    key = F.xxhash64("u").alias("__hash")
    return many.select("*", key).join(least.select("*", key), ["__hash", "u"]).drop("__hash")


def _contract(edges: DataFrame) -> DataFrame:
    """One round: every node's neighbours, then its smaller neighbours, are linked to the smallest."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = _joined(both.filter("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    large = large.distinct()  # here u > v
    small = large.groupBy("u").agg(F.min("v").alias("m"))
    again = _joined(large, small).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return again.unionByName(small.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node that has a link to a smaller one; roots are the smallest nodes."""
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v"), "links")
    state = None
    while True:
        summary = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("s"))
        row = tuple(summary.first())
        if row == state or row[0] == 0:
            return edges.select("u", F.col("v").alias("root"))
        state = row
        edges = materialize(_contract(edges), "links")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: the id, ``fingerprint`` and ``component_id``, the smallest id of its component."""
    narrow = docs.select(F.col(f"`{id_column}`").alias(id_column), F.col(f"`{text}`").alias("__text"))
    prints = materialize(fingerprints(narrow, "__text", shingle).select(id_column, "fingerprint"), "fingerprints")
    distinct = materialize(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id_column).alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # A component may hold many fingerprints: its smallest id is found by a combined aggregation.
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = rooted.select(F.col("fp").alias("fingerprint"), "root").join(smallest, "root").drop("root")
    return prints.join(of_print, "fingerprint").select(id_column, "fingerprint", "component_id")
