"""Embedding whitening by spectrum slicing.

Vectors become whole numbers of 1/256. Their covariance is taken over the
distinct vectors, each once, in two distributed passes: sums first, then products
of what is centred. Only the covariance, dimensions squared, comes to the driver.

There the leading eigenvalues are isolated by counting: an LDLᵀ factorisation of the
shifted covariance has as many positive pivots as eigenvalues lie above the
shift (Sylvester's law of inertia). An interval that holds the wanted eigenvalue
alone is halved a few times, then Rayleigh quotient iteration runs from its
middle and converges cubically. Two more counts, just above and just below what it found,
certify the number of the eigenvalue; if they do not, the interval is halved on.

Defined cases: vectors that are null, empty, or hold null or non-finite entries are left
out, and so are vectors of another length than most (of equally frequent lengths the larger counts);
repeated vectors are whitened like any other and count once in the fit; directions
without variance have no component, so fewer than asked for may be found and one
vector alone has none; of equal eigenvalues any orthonormal vectors serve;
an empty table gives an empty result. Entries beyond 64 bits are cut to the largest 64-bit
number; a deviation beyond 64 bits is null. Output columns replace input columns of the same names.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from workledger.llm.common import portable, without
from workledger.session import materialize

COMPONENTS = 4
SCALE = 256.0
#: The covariance and some copies of it are in the driver: 8 MB each at this bound.
MAX_DIMENSIONS = 1024
EPSILON = float(np.finfo(np.float64).eps)
#: Where a pivot of one is preferred to one of two, Bunch and Parlett's bound.
PIVOT = (1 + 17**0.5) / 8

OUTPUT = T.StructType([T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])


class Model(NamedTuple):
    """``components`` and ``roots`` hold the unit eigenvectors and the square roots of their eigenvalues."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    roots: np.ndarray
    explained: np.ndarray
    identity_error: float


# --- the spectrum of one matrix -------------------------------------------------


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix above ``shift``: positive pivots of LDLᵀ of the shifted matrix.

    A pivot of two, taken where the diagonal is small, has one eigenvalue of each sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        r = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        largest = float(off.max())
        if largest == 0:
            return positive + int((np.diag(a) > 0).sum())
        if diagonal[r] >= PIVOT * largest:
            pivots = [r]
            positive += int(a[r, r] > 0)
        else:
            pivots = list(divmod(int(off.argmax()), len(a)))
            positive += 1
        others = np.delete(np.arange(len(a)), pivots)
        side = a[np.ix_(others, pivots)]
        a = a[np.ix_(others, others)] - side @ np.linalg.solve(a[np.ix_(pivots, pivots)], side.T)
        a = (a + a.T) / 2
    return positive


def rayleigh(matrix: np.ndarray, shift: float, found: list[np.ndarray], seed: int) -> tuple[float, np.ndarray]:
    """An eigenpair near ``shift``, orthogonal to the vectors ``found``."""
    size = len(matrix)
    norm = float(np.abs(matrix).sum(1).max())

    def apart(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for f in found:
                x = x - (f @ x) * f
        return x / np.linalg.norm(x)

    def solve(shift: float, x: np.ndarray) -> np.ndarray:
        shifted = matrix - shift * np.eye(size)
        try:
            y = np.linalg.solve(shifted, x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(shifted + norm * EPSILON * np.eye(size), x)
        return apart(y) if np.isfinite(y).all() and np.any(y) else x

    x = apart(np.random.default_rng(seed).standard_normal(size))
    for _ in range(2):  # at the middle of the interval first, so that the iteration begins near
        x = solve(shift, x)
    value, error = float(x @ matrix @ x), np.inf
    for _ in range(30):
        y = solve(value, x)
        quotient = float(y @ matrix @ y)
        left = float(np.linalg.norm(matrix @ y - quotient * y))
        if left >= error:
            break
        x, value, error = y, quotient, left
    return value, x


def leading(matrix: np.ndarray, components: int) -> list[tuple[float, np.ndarray]]:
    """The largest positive eigenvalues with unit eigenvectors, by falling value, certified by counts."""
    size = len(matrix)
    bound = float(np.abs(matrix).sum(1).max(initial=0)) if size else 0.0
    least = 4 * size * EPSILON * bound  # below it an eigenvalue may be nothing but rounding
    known: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in known:
            known[shift] = count_above(matrix, shift)
        return known[shift]

    out: list[tuple[float, np.ndarray]] = []
    wanted = min(components, above(least)) if bound > 0 else 0
    for number in range(1, wanted + 1):
        low, high = least, bound * (1 + 4 * EPSILON)  # above(low) >= number > above(high)
        for known_shift, count in sorted(known.items()):
            if count >= number:
                low = max(low, known_shift)
            else:
                high = min(high, known_shift)
        while True:
            width = high - low
            alone = above(low) == number and above(high) == number - 1
            if alone and width < 0.25 * high or width <= least:
                vectors = [v for _, v in out]
                value, vector = rayleigh(matrix, (low + high) / 2, vectors, number)
                margin = least + 1e-12 * abs(value)
                certain = above(value - margin) >= number and above(value + margin) <= number - 1
                if certain or width <= least:
                    out.append((value, vector))
                    break
            middle = (low + high) / 2
            if above(middle) >= number:
                low = middle
            else:
                high = middle
    return sorted(out, key=lambda pair: -pair[0])


# --- distributed sums --------------------------------------------------------------


def _matrix(column) -> np.ndarray:
    """The lists of an Arrow column, all of one length, as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _summed(df: DataFrame, column: str, kind: str, part) -> dict[int, float]:
    """``part`` makes an array of sums of a batch; the arrays of all batches added up, cell by cell.

    A task adds its batches, so it sends one row for each cell.
    """

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                made = part(_matrix(batch.column(0)))
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["cell", "value"])

    cells = df.select(column).mapInArrow(portable(run), f"cell long, value {kind}")
    return {row.cell: row.value for row in cells.groupBy("cell").agg(F.sum("value").alias("value")).collect()}


def whole(vector: Column) -> Column:
    """Entries as whole numbers of 1/256, downwards; null where the vector is to be left out."""
    usable = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False)))
    numbers = F.transform(vector, lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("long"))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & usable, numbers)


def prepared(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """The rows that take part, with their whole numbers ``__x``, and the number of dimensions."""
    placed = rows.withColumn("__x", whole(F.col(f"`{vector}`"))).filter(F.col("__x").isNotNull())
    placed = materialize(placed, "vectors")
    lengths = placed.groupBy(F.size("__x").alias("size")).agg(F.count("*").alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("size")).first()
    if most is None:
        return placed, 0
    if most.size > MAX_DIMENSIONS:
        raise ValueError(f"{most.size} dimensions; the covariance is held by the driver up to {MAX_DIMENSIONS}")
    return placed.filter(F.size("__x") == most.size), most.size


def fit(placed: DataFrame, dimensions: int, components: int = COMPONENTS) -> Model:
    """The components of the distinct vectors ``__x``."""
    if not dimensions:
        return Model(0, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0)
    distinct = materialize(placed.select("__x").distinct(), "distinct")
    sums = _summed(distinct, "__x", "long", lambda x: np.concatenate([[len(x)], x.sum(0, dtype=np.int64)]))
    n, total = sums[0], np.array([sums[j + 1] for j in range(dimensions)], np.int64)
    mean = total / n
    upper = np.triu_indices(dimensions)

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return (centred.T @ centred)[upper]

    covariance = _symmetric(_summed(distinct, "__x", "double", products), dimensions) / n
    pairs = leading(covariance, components)
    vectors = np.array([v for _, v in pairs]).reshape(len(pairs), dimensions)
    values = np.array([e for e, _ in pairs])
    model = Model(n, total, vectors, np.sqrt(values), values / max(float(np.trace(covariance)), EPSILON), 0.0)
    return model._replace(identity_error=_identity_error(distinct, model))


def _symmetric(cells: dict[int, float], size: int) -> np.ndarray:
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = [cells[k] for k in range(len(cells))]
    return out + np.triu(out, 1).T


def projected(x: np.ndarray, model: Model) -> np.ndarray:
    return (x - model.sums / model.n) @ model.components.T / model.roots


def _identity_error(distinct: DataFrame, model: Model) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    size = len(model.roots)
    if not size:
        return 0.0
    sums = _summed(distinct, "__x", "double", lambda x: projected(x, model).sum(0))
    mean = np.array([sums[k] for k in range(size)]) / model.n
    upper = np.triu_indices(size)

    def products(x: np.ndarray) -> np.ndarray:
        centred = projected(x, model) - mean
        return (centred.T @ centred)[upper]

    covariance = _symmetric(_summed(distinct, "__x", "double", products), size) / model.n
    return float(np.abs(covariance - np.eye(size)).max())


# --- all rows ------------------------------------------------------------------------


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Per row the exact sum of (n x - S)^2; None beyond 64 bits."""
    if not len(x):
        return []
    most = n * float(np.abs(x.astype(np.float64)).max()) + float(np.abs(sums.astype(np.float64)).max())
    if most < 2.0**62 and most * most * x.shape[1] < 2.0**62:
        return ((n * x.astype(np.int64) - sums) ** 2).sum(1).tolist()
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums.tolist(), strict=True)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Model]:
    """The rows that take part, with ``deviation`` and ``whitened`` (one entry for each component), and the model."""
    placed, dimensions = prepared(rows, vector)
    model = fit(placed, dimensions, components)
    kept = [c for c in without(placed, OUTPUT.fieldNames()).columns if c != "__x"]
    schema = T.StructType([*placed.select(*[F.col(f"`{c}`") for c in kept]).schema.fields, *OUTPUT.fields])

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(len(kept)))
            made = projected(x, model) if len(x) else np.zeros((0, 0))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(model.roots)), pa.array(np.ascontiguousarray(made).ravel())
            )
            columns = [*batch.columns[: len(kept)], pa.array(deviations(x, model.n, model.sums), pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *OUTPUT.fieldNames()])

    sent = placed.select(*[F.col(f"`{c}`") for c in kept], "__x")
    return sent.mapInArrow(portable(run), schema), model
