"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi rotations.

Entries are scaled to whole numbers, so that sums and products of any partitioning are
exact and equal vectors are found by their bytes. Every distinct vector counts once in
the fit. Tasks sum vectors, then, centred by the nearest whole mean, their products; the
small rest of the centring is exact arithmetic too. What reaches the driver is a
dimension-by-dimension matrix of whole numbers, whatever the number of rows.

The scatter is factored as A A' with a lower trapezoid A by Cholesky steps that take the
largest remaining diagonal first. Rotations of column pairs of A make its columns
orthogonal: their squared norms are the eigenvalues, the columns over their norms the
components. The product matrix is not formed again, so small eigenvalues keep their digits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import shipped
from leafmill.session import stage

SCALE = 256
COMPONENTS = 4

# Scaled entries from this size on count as not finite; below it all sums are exact.
LARGEST = 1 << 46

# Vectors handled at a time.
ROWS = 2048


@dataclass(frozen=True)
class Whitening:
    """n distinct vectors, their per-dimension sums, all eigenvalues, and the leading components (rows)."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def explained(self) -> np.ndarray:
        """Share of each leading component in the trace."""
        return self.eigenvalues[: len(self.components)] / self.eigenvalues.sum()


def whole(column: pa.Array, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows that are vectors of finite entries, and their entries times scale, floored.

    The vectors come as a list of (rows of that length, length) arrays with the rows' places
    beside them: [(places, values), ...].
    """
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    missing = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(scale * values)
        bad = missing | ~np.isfinite(values) | ~(np.abs(scaled) < LARGEST)
    faults = np.concatenate([[0], np.cumsum(bad)])
    lengths = np.diff(offsets)
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0) & (faults[offsets[1:]] == faults[offsets[:-1]])
    out = []
    for length in np.unique(lengths[usable]).tolist():
        places = np.flatnonzero(usable & (lengths == length))
        out.append((places, scaled[offsets[places][:, None] + np.arange(length)].astype(np.int64)))
    return usable, out


def scaled_vectors(frame: DataFrame, vector: str, keep: list[str], scale: int = SCALE) -> DataFrame:
    """(k0, k1 ..., x, length): whole vectors as bytes of the narrowest integers, ``keep`` renamed in order.

    Rows whose vector is null, empty or not finite go.
    """
    types = [frame.schema[k].dataType.simpleString() for k in keep]
    names = [f"k{i}" for i in range(len(keep))]
    schema = "".join(f"{n} {t}, " for n, t in zip(names, types)) + "x binary, length int"

    def scale_rows(batches):
        for batch in batches:
            _, groups = whole(batch.column(len(names)), scale)
            for places, values in groups:
                # The width depends on the vector alone, so equal vectors have equal bytes.
                size = np.abs(values).max(axis=1)
                for kind, low, high in ((np.int16, -1, 1 << 15), (np.int32, 1 << 15, 1 << 31), (np.int64, 1 << 31, LARGEST)):
                    rows = np.flatnonzero((size > low if low < 0 else size >= low) & (size < high))
                    if len(rows):
                        packed = np.ascontiguousarray(values[rows].astype(kind))
                        blobs = [r.tobytes() for r in packed]
                        taken = pa.array(places[rows])
                        yield pa.RecordBatch.from_arrays(
                            [
                                *(batch.column(i).take(taken) for i in range(len(names))),
                                pa.array(blobs, pa.binary()),
                                pa.array(np.full(len(rows), values.shape[1], np.int32)),
                            ],
                            names=[*names, "x", "length"],
                        )

    picked = frame.select(*(F.col(f"`{k}`").alias(n) for k, n in zip(keep, names)), F.col(f"`{vector}`").alias("v"))
    return picked.mapInArrow(scale_rows, schema)


def matrices(column: pa.Array, dimension: int):
    """(places, int64 matrix) of packed vectors, up to ROWS at a time."""
    sizes = np.diff(column.offsets.to_numpy() if hasattr(column, "offsets") else np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1])
    for kind in (np.int16, np.int32, np.int64):
        at = np.flatnonzero(sizes == dimension * np.dtype(kind).itemsize)
        for begin in range(0, len(at), ROWS):
            places = at[begin : begin + ROWS]
            raw = b"".join(column[i].as_py() for i in places.tolist())
            yield places, np.frombuffer(raw, kind).reshape(len(places), dimension).astype(np.int64)


def exact_products(rows: np.ndarray) -> np.ndarray:
    """Sum of outer products of whole rows as Python integers."""
    most = int(np.abs(rows).max(initial=0))
    if most * most * max(1, len(rows)) < 1 << 53:
        real = rows.astype(np.float64)
        return (real.T @ real).astype(np.int64).astype(object)
    # 23 bits a limb: the products of 128 rows stay exact in doubles.
    low, high = (rows & (1 << 23) - 1).astype(np.float64), (rows >> 23).astype(np.float64)
    total = np.zeros((rows.shape[1],) * 2, object)
    for begin in range(0, len(rows), 64):
        a, b = low[begin : begin + 64], high[begin : begin + 64]
        cross = (a.T @ b).astype(np.int64).astype(object)
        total += (a.T @ a).astype(np.int64).astype(object) + (cross + cross.T << 23)
        total += (b.T @ b).astype(np.int64).astype(object) << 46
    return total


def summed(vectors: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """How many vectors of (x), and their sums by dimension, exactly."""

    def add(batches):
        count, total = 0, np.zeros(dimension, object)
        for batch in batches:
            for places, rows in matrices(batch.column(0), dimension):
                count += len(places)
                total += rows.sum(axis=0).astype(object) if np.abs(rows).max() < 1 << 50 else rows.astype(object).sum(axis=0)
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, dimension)), pa.array([str(v) for v in [count, *total]])], names=["i", "s"]
            )

    parts = vectors.select("x").mapInArrow(add, "i bigint, s string")
    found = {r["i"]: int(r["s"]) for r in parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(dimension)]


def scatter(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of (x), divisor n: each entry a correctly rounded double.

    Rows are centred by the nearest whole mean before they are multiplied; the rest of the
    centring, below one half a dimension, is added in whole numbers.
    """
    dimension = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    ship = shipped(vectors.sparkSession, np.array(centre, np.int64))
    upper = np.triu_indices(dimension)

    def multiply(batches):
        middle, total = ship(), np.zeros((dimension,) * 2, object)
        seen = False
        for batch in batches:
            for _, rows in matrices(batch.column(0), dimension):
                total += exact_products(rows - middle)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0] * dimension + upper[1]), pa.array([str(v) for v in total[upper]])], names=["i", "s"]
            )

    parts = vectors.select("x").mapInArrow(multiply, "i bigint, s string")
    found = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    rest = [s - n * c for s, c in zip(sums, centre)]
    out = np.zeros((dimension,) * 2)
    for row in found:
        i, j = divmod(row["i"], dimension)
        out[i, j] = out[j, i] = (n * int(row["s"]) - rest[i] * rest[j]) / (n * n)
    return out


def trapezoid(matrix: np.ndarray) -> np.ndarray:
    """A with A A' = matrix, by Cholesky steps on the largest remaining diagonal.

    Rows keep their order; a column per step. Ends where the rest is rounding alone, so a
    singular matrix gives fewer columns.
    """
    size = len(matrix)
    rest = matrix.astype(np.float64).copy()
    least = size * np.finfo(np.float64).eps * max(0.0, float(np.diag(rest).max(initial=0.0)))
    columns = []
    for _ in range(size):
        pivot = int(np.argmax(np.diag(rest)))
        if not rest[pivot, pivot] > least:
            break
        column = rest[:, pivot] / np.sqrt(rest[pivot, pivot])
        rest -= np.outer(column, column)
        rest[pivot, :] = rest[:, pivot] = 0.0
        columns.append(column)
    return np.array(columns).T if columns else np.zeros((size, 0))


def rotated(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and components (rows) of A A' by one-sided Jacobi rotations of A.

    A sweep meets every pair of columns once, disjoint pairs at a time. Ends when no pair
    is further from orthogonal than rounding.
    """
    work = factor.T.copy()
    count = len(work)
    seats = list(range(count)) + [None] * (count % 2)
    tolerance = np.finfo(np.float64).eps * np.sqrt(max(1, factor.shape[0]))
    for _ in range(sweeps if count > 1 else 0):
        turned = False
        for _ in range(len(seats) - 1):
            pairs = [(a, b) for a, b in zip(seats[: len(seats) // 2], reversed(seats[len(seats) // 2 :])) if a is not None and b is not None]
            i, j = np.array(pairs).T
            x, y = work[i], work[j]
            xx, yy, xy = (x * x).sum(1), (y * y).sum(1), (x * y).sum(1)
            act = np.abs(xy) > tolerance * np.sqrt(xx * yy)
            if act.any():
                turned = True
                i, j, x, y, xx, yy, xy = (v[act] for v in (i, j, x, y, xx, yy, xy))
                ratio = (yy - xx) / (2 * xy)
                tangent = np.where(ratio >= 0, 1.0, -1.0) / (np.abs(ratio) + np.hypot(1.0, ratio))
                cosine = 1 / np.hypot(1.0, tangent)
                sine = (cosine * tangent)[:, None]
                cosine = cosine[:, None]
                work[i], work[j] = cosine * x - sine * y, sine * x + cosine * y
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if not turned:
            break
    values = (work * work).sum(axis=1)
    order = np.argsort(-values, kind="stable")
    values, work = values[order], work[order]
    components = work / np.sqrt(values)[:, None] if count else work
    # The largest entry is positive, so the sign does not depend on the rotations.
    top = components[np.arange(count), np.abs(components).argmax(axis=1)] if count else np.zeros(0)
    return values, components * np.where(top < 0, -1.0, 1.0)[:, None]


def fitted(vectors: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct whole vectors (x) of one dimension; None without any."""
    n, sums = summed(vectors, dimension)
    if n == 0:
        return None
    values, axes = rotated(trapezoid(scatter(vectors, n, sums)))
    return Whitening(n, tuple(sums), values, axes[:components])


def projected(model: Whitening, rows: np.ndarray) -> np.ndarray:
    """(rows, components): centred rows on each component over the root of its eigenvalue."""
    centred = rows - model.mean
    scale = np.sqrt(model.eigenvalues[: len(model.components)])
    # Summed row by row: a row's figures do not depend on its neighbours.
    return np.stack([(centred * axis).sum(axis=1) / s for axis, s in zip(model.components, scale)], axis=1) if len(scale) else np.zeros((len(rows), 0))


def deviations(model: Whitening, rows: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - sum)**2, exactly; None beyond a bigint."""
    real = ((model.n * rows.astype(np.float64) - np.array(model.sums, np.float64)) ** 2).sum(axis=1)
    with np.errstate(over="ignore"):
        # Modulo 2**64: right wherever the result itself fits.
        n = np.uint64(model.n % (1 << 64))
        gap = rows.astype(np.uint64) * n - np.array([s % (1 << 64) for s in model.sums], np.uint64)
        total = (gap * gap).sum(axis=1, dtype=np.uint64)
    out = [int(v) for v in total]
    for k in np.flatnonzero(real > 2.0**62).tolist():
        exact = sum((model.n * int(x) - s) ** 2 for x, s in zip(rows[k], model.sums))
        out[k] = exact if exact < 1 << 63 else None
    return out


def whitened(frame: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error).

    A row per input row and component, up to ``components``. Rows go whose vector is null,
    empty, holds null or non-finite entries (or entries of 2**46 / scale and more), or is
    not of the commonest length of the distinct vectors (of equally common ones the
    longest). Equal vectors count once in the fit, and each row gets its results; ids may
    be null or repeat. Components without variance are left out, so one distinct vector
    alone, like an empty table, gives no rows. deviation is null beyond a bigint. Columns
    of ``frame`` other than the two named are not read. Stages two narrow tables.
    """
    spark = frame.sparkSession
    scaled = stage(scaled_vectors(frame, vector, [vec_id], scale), "whitening-vectors")
    distinct = stage(scaled.groupBy("x", "length").agg(F.lit(1).alias("one")).select("x", "length"), "whitening-distinct")
    common = distinct.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    id_type = frame.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if common is None:
        return spark.createDataFrame([], schema)
    dimension = common["length"]
    fit = distinct.where(F.col("length") == dimension)
    model = fitted(fit, dimension, components)
    if not len(model.components):
        return spark.createDataFrame([], schema)
    k = len(model.components)
    ship = shipped(spark, model)

    def apply(batches):
        fit_model = ship()
        shares = fit_model.explained
        for batch in batches:
            for places, rows in matrices(batch.column(1), dimension):
                ids = batch.column(0).take(pa.array(np.repeat(places, k)))
                values = projected(fit_model, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(places))),
                        pa.array(np.full(len(places) * k, fit_model.n)),
                        pa.array(np.repeat(np.array(deviations(fit_model, rows), object), k), pa.int64()),
                        pa.array(values.reshape(-1)),
                        pa.array(np.tile(shares, len(places))),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained"],
                )

    applied = schema.removesuffix(", identity_error double")
    rows = scaled.where(F.col("length") == dimension).select(F.col("k0").alias("vec_id"), "x").mapInArrow(apply, applied)
    return rows.withColumn("identity_error", F.lit(identity_error(fit, dimension, model)))


def identity_error(vectors: DataFrame, dimension: int, model: Whitening) -> float:
    """The largest absolute entry of the covariance of whitened vectors less the identity."""
    ship = shipped(vectors.sparkSession, model)
    k = len(model.components)

    def apply(batches):
        fit_model = ship()
        for batch in batches:
            for _, rows in matrices(batch.column(0), dimension):
                values = projected(fit_model, rows)
                yield pa.RecordBatch.from_arrays([pa.array(values[:, i]) for i in range(k)], names=[f"w{i}" for i in range(k)])

    found = vectors.select("x").mapInArrow(apply, ", ".join(f"w{i} double" for i in range(k)))
    # covar_pop centres before it multiplies.
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = found.agg(*(F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(row, pairs))
