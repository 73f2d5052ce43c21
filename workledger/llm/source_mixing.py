"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the number of copies the mix should hold of it. Of all
rates from 0 to ``MOST`` whose words add up to the target of each source, those
nearest to 1 in relative entropy are exponentially tilted: ``exp(tilt * size)``, cut
at ``MOST``, with one tilt a source. The tilts solve a convex dual problem, by Newton's
method on the logarithm of the words a source would have; each iteration is one
distributed aggregation. A step that leaves the interval known to hold the solution
is replaced by halving that interval.

Documents of one source and size have one rate, so the iterations read counts by
source and size (cells), which are combined before any shuffle. Rates are rounded
to copies cell by cell, from large documents to small ones, and what one cell takes too much
or too little is made up by the following ones, so that a source ends up within about one of
its smallest documents of its target. Which documents of a cell have the
additional copy is settled by a hash of their id, over slices of a cell of bounded size.

Defined cases: null and empty texts have size 0 and take 0 words; a null source is a
source of its own, the last one; equal rows are single documents, of which some may
be taken more often than others; documents without id are told apart by source and size only;
a table without words has all targets 0; an empty table gives an empty result. The result has the id and the columns named
below and no others, so no other column clashes.
"""

from __future__ import annotations

import math
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from workledger.llm.common import portable
from workledger.operators.ranks import row_numbers
from workledger.session import materialize

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3
#: Words of the tilted rates against the target, relative.
TOLERANCE = 1e-9
#: Cells of a source, its smallest sizes, that make up for what rounding left.
LAST = 16
#: Documents of a cell that are ordered in one task.
SLICE = 50_000



def size_of(text: Column) -> Column:
    """Number of words of a text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources`` (``place`` from 0, ``source_size``) with ``target``.

    All words are shared by weight, a target stops at ``most`` times its source's
    words, and the excess is shared anew. That raises one common factor until the
    targets ``min(most * words, factor * weight)`` add up; each round cuts at least one
    more source, or is the last.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = sources.withColumn("weight", weight)
    limit = most * F.col("source_size")
    factor, cut = 0.0, -1
    while True:
        stops = limit <= factor * F.col("weight")
        row = weighed.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(stops, limit)), F.lit(0)).alias("stopped"),
            F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0.0)).alias("open"),
            F.count_if(stops).alias("cut"),
        ).first()
        if row.cut == cut or not row.open:
            break
        cut, factor = row.cut, max(factor, (row.all - row.stopped) / row.open)
    return weighed.withColumn("target", F.least(limit.cast("double"), factor * F.col("weight"))).drop("weight")


def _rate(most: int) -> Column:
    exponent = F.col("tilt") * F.col("size") / F.col("scale")
    return F.when(exponent >= math.log(most), F.lit(float(most))).otherwise(F.exp(exponent))


def solve(cells: DataFrame, sources: DataFrame, most: int = MOST, rounds: int = 200) -> DataFrame:
    """``sources`` with ``tilt`` and ``scale``: the rate of a document is ``exp(tilt * size / scale)``, at most ``most``.

    ``cells`` has ``place, size, n`` without sizes of 0. Sources without words are left out.
    """
    shape = cells.groupBy("place").agg(F.min("size").alias("least"), (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    limit = F.lit(math.log(most)) * F.col("scale") / F.col("least")  # from here on every rate is ``most``
    reached = F.col("target") >= most * F.col("source_size")
    grows = F.col("target") >= F.col("source_size")
    state = sources.join(shape, "place").select(
        "place",
        "target",
        "source_size",
        "scale",
        F.when(reached, limit).otherwise(0.0).alias("tilt"),
        F.when(grows, 0.0).alias("low"),
        F.when(grows, limit).otherwise(0.0).alias("high"),
        reached.alias("solved"),
    )
    state = materialize(state, "tilts")
    for _ in range(rounds):
        if state.filter(~F.col("solved")).isEmpty():
            return state
        rate = _rate(most)
        words = F.col("n") * F.col("size")
        slope = F.when(rate < most, words * F.col("size") / F.col("scale") * rate).otherwise(0.0)
        open_ = state.filter(~F.col("solved")).select("place", "tilt", "scale")
        sums = cells.join(open_, "place").groupBy("place").agg(F.sum(words * rate).alias("words"), F.sum(slope).alias("slope"))
        over = F.col("words") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - F.ln(F.col("words") / F.col("target")) * F.col("words") / F.col("slope")
        inside = (F.col("slope") > 0) & F.coalesce(step > F.col("below"), F.lit(True)) & (step < F.col("above"))
        following = F.when(inside, step).otherwise((F.coalesce("below", F.col("above") * 2 - 1) + F.col("above")) / 2)
        # Between neighbouring numbers there is nothing left to find.
        exact = (F.abs(F.col("words") - F.col("target")) <= TOLERANCE * F.col("target")) | (following == F.col("tilt"))
        moved = state.join(sums, "place", "left").withColumns({"below": low, "above": high})
        done = F.col("solved") | F.coalesce(exact, F.lit(True))
        state = moved.select(
            "place", "target", "source_size", "scale",
            F.when(done, F.col("tilt")).otherwise(following).alias("tilt"),
            F.when(done, F.col("low")).otherwise(F.col("below")).alias("low"),
            F.when(done, F.col("high")).otherwise(F.col("above")).alias("high"),
            done.alias("solved"),
        )
        state = materialize(state, "tilts")
    raise ValueError(f"the tilts did not settle in {rounds} rounds")


def _rounded(most: int):
    """Adds ``base`` copies of every document of a cell and ``more``, the documents with one more.

    Cells come sorted by source and falling size. ``owed`` is what the cells of a
    source so far took less than their rates ask for, in words. A rate is rounded
    down or up; only the source's last ``LAST`` cells may go beyond that, if otherwise something stayed owed.
    """

    def run(batches):
        source, owed, held, done = None, 0.0, deque(), []

        def close() -> None:
            nonlocal owed
            while held:
                place, size, n, total = held.popleft()
                change = min(most * n, max(0, total + math.floor(owed / size + 0.5))) - total
                owed -= change * size
                done.append((place, size, n, total + change))

        def flush():
            place, size, n, total = (np.array(x, np.int64) for x in zip(*done, strict=True))
            done.clear()
            base = total // n
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (place, size, n, base, total - base * n)], names=["place", "size", "n", "base", "more"]
            )

        for batch in batches:
            for place, size, n, rate in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if place != source:
                    close()
                    source, owed = place, 0.0
                base = min(most, math.floor(rate))
                owed += (rate - base) * n * size if base < most else 0.0
                more = min(n, max(0, math.floor(owed / size + 0.5))) if base < most else 0
                owed -= more * size
                held.append((place, size, n, base * n + more))
                if len(held) > LAST:
                    done.append(held.popleft())
            if done:
                yield from flush()
        close()
        if done:
            yield from flush()

    return run


def copies(cells: DataFrame, tilts: DataFrame, most: int = MOST) -> DataFrame:
    """``place, size, n, base, more`` of every cell. A task sees the cells of whole sources, one row for each size."""
    rated = cells.join(tilts.select("place", "tilt", "scale"), "place").select("place", "size", "n", _rate(most).alias("rate"))
    placed = rated.repartition("place").sortWithinPartitions("place", F.desc("size"))
    return placed.mapInArrow(portable(_rounded(most)), "place long, size long, n long, base long, more long")


def _shared(units: DataFrame, decided: DataFrame, slice_rows: int) -> DataFrame:
    """``units`` (``id, place, size, rows``) with ``base`` and ``extra``, how many of their rows have one more copy.

    A cell is cut by a hash of the id into slices of about ``slice_rows`` rows. The
    additional copies are dealt to the slices by their rows and in a slice to the
    smallest hashes.
    """
    spread = F.xxhash64("id", F.lit(1))
    slices = F.ceil(F.col("n") / slice_rows)
    cut = units.join(decided, ["place", "size"]).withColumn("slice", F.pmod(spread, slices))
    cut = materialize(cut, "slices")
    counted = cut.groupBy("place", "size", "slice").agg(F.sum("rows").alias("own"), F.first("n").alias("n"), F.first("more").alias("more"))
    until = F.sum("own").over(Window.partitionBy("place", "size").orderBy("slice"))
    counted = counted.withColumn("until", until.cast("decimal(20,0)"))
    dealt = counted.selectExpr("place", "size", "slice", "more * until div n - more * (until - own) div n AS dealt")
    own = Window.partitionBy("place", "size", "slice").orderBy(F.xxhash64("id"), "id")
    mixed = cut.filter((F.col("more") > 0) & (F.col("more") < F.col("n"))).join(dealt, ["place", "size", "slice"])
    left = F.col("dealt") - (F.sum("rows").over(own) - F.col("rows"))
    mixed = mixed.withColumn("extra", F.greatest(F.lit(0), F.least(left, F.col("rows"))).cast("long")).drop("dealt")
    plain = cut.filter((F.col("more") == 0) | (F.col("more") == F.col("n")))
    plain = plain.withColumn("extra", F.when(F.col("more") > 0, F.col("rows")).otherwise(0).cast("long"))
    return plain.unionByName(mixed)


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    slice_rows: int = SLICE,
) -> DataFrame:
    """One row per document: the id, ``size``, ``source_size``, ``target`` (both of its source), ``copies`` and ``taken``."""
    sized = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{source}`").alias("source"), size_of(F.col(f"`{text}`")).alias("size"))
    # Equal rows become one with their number, so that none of them is a hot key later.
    units = materialize(sized.groupBy("id", "source", "size").agg(F.count("*").alias("rows")), "units")
    by_source = materialize(units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size")), "sources")
    order = [F.col("source").isNull(), F.col("source")]
    numbered = row_numbers(by_source, order, "place").withColumn("place", F.col("place") - 1)
    sources = materialize(targets(materialize(numbered, "sources"), weights, most), "targets")
    placed = units.join(sources.select(F.col("source").alias("of"), "place"), F.col("source").eqNullSafe(F.col("of"))).drop("source", "of")
    placed = materialize(placed, "placed")
    cells = materialize(placed.filter("size > 0").groupBy("place", "size").agg(F.sum("rows").alias("n")), "cells")
    decided = materialize(copies(cells, solve(cells, sources, most), most), "copies")
    counted = _shared(placed.filter("size > 0"), decided, slice_rows).select("id", "place", "size", "rows", "base", "extra")
    nothing = placed.filter("size = 0").select("id", "place", "size", "rows", F.lit(0).cast("long").alias("base"), F.lit(0).cast("long").alias("extra"))
    # Repeated rows are written out again, long repetitions in parts that are dealt out.
    all_ = counted.unionByName(nothing)
    long = F.col("rows") > slice_rows
    begins = F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(slice_rows).cast("long"))).alias("begin")
    parts = all_.filter(long).select("*", begins).repartition("id", "place", "size", "begin")
    every = all_.filter(~long).withColumn("begin", F.lit(0).cast("long")).unionByName(parts)
    stop = F.least(F.col("rows"), F.col("begin") + slice_rows) - 1
    every = every.withColumn("number", F.explode(F.sequence(F.col("begin"), stop)))
    number = F.col("base") + F.when(F.col("number") < F.col("extra"), 1).otherwise(0)
    return every.join(sources.select("place", "source_size", "target"), "place").select(
        F.col("id").alias(id_column), "size", "source_size", "target", number.alias("copies"), (number * F.col("size")).alias("taken")
    )
