"""Whitened vectors by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

1. Every entry c becomes the whole number floor(64 c) + 1000000; the rows are
   written once. Sums per dimension are exact.
2. X holds the centred rows. Xv and X'u alternate: a step takes u = Xv less its
   predecessor, then X'u gives the next v. A task returns sums over its own rows
   only; Spark adds them, and the driver holds vectors of one vector's width.
3. u lies in the columns of X, so it is kept as coefficients a with u = Xa and
   rebuilt from the rows in every pass: nothing distributed lives between two
   passes, and a lost executor costs one task. Both sides are orthogonalised
   against all their predecessors in every step.
4. The singular values of the small bidiagonal matrix over sqrt(n) are the
   deviations, its right vectors combine the v to the components.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespect.functions.staging import staged

SCALE, SHIFT = 64, 1_000_000
_LARGEST = 2.0**56  # 64 times this is the greatest entry that a long holds
_ROWS = 2048
_NEGLIGIBLE = 1e-11  # of the largest singular value; smaller ones are zero to double precision

OUTPUT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


class Centre:
    """Sums of n rows, and rows measured from their means without cancellation."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n = n
        self.whole = [s // n for s in sums]
        self.rest = [s - n * w for s, w in zip(sums, self.whole, strict=True)]

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly; Python's whole numbers where 64 bits could be too few."""
        off = x - np.array(self.whole, np.int64)
        if off.size and float(np.abs(off.astype(float)).max()) * self.n > 2.0**61:
            return off.astype(object) * self.n - np.array(self.rest, object)
        return off * self.n - np.array(self.rest, np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(float) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        numerators = self.numerators(x)
        if numerators.dtype != object and float(np.abs(numerators.astype(float)).max()) ** 2 * x.shape[1] < 2.0**62:
            return (numerators**2).sum(axis=1).tolist()
        exact = [sum(int(c) ** 2 for c in row) for row in numerators]
        return [d if d < 1 << 63 else None for d in exact]


def _blocks(batches):
    """Blocks of rows as (ids, whole numbers)."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            values = part.column("x").flatten().to_numpy(zero_copy_only=False)
            yield part.column("id"), values.reshape(part.num_rows, -1)


def _exact_sums(batches, width: int):
    """Rows (i, high, low): sums of each dimension, in halves that cannot overflow; the last i counts rows."""
    high, low, count = np.zeros(width, np.int64), np.zeros(width, np.int64), 0
    for _, x in _blocks(batches):
        high, low, count = high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0), count + len(x)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1, dtype=np.int32)), pa.array([*high.tolist(), 0]), pa.array([*low.tolist(), count])], ["i", "high", "low"])


def _added(batches, centre: Centre, of_block: Callable[[np.ndarray], np.ndarray], length: int):
    """Rows (i, value): the sums over this task's rows of what of_block gives for centred rows."""
    total = np.zeros(length)
    for _, x in _blocks(batches):
        total += of_block(centre.rows(x))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(length, dtype=np.int32)), pa.array(total)], ["i", "value"])


def _sums(rows: DataFrame, centre: Centre, of_block: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
    parts = rows.mapInArrow(partial(_added, centre=centre, of_block=of_block, length=length), "i int, value double")
    out = np.zeros(length)
    for row in parts.groupBy("i").agg(F.sum("value").alias("value")).collect():  # one row per number asked for
        out[row["i"]] = row["value"]
    return out


def _products(x: np.ndarray, a: np.ndarray, before: np.ndarray) -> np.ndarray:
    """For u = xa: x'u, u'u, and the products of u with the earlier ones."""
    u = x @ a
    return np.concatenate((x.T @ u, [u @ u], (x @ before).T @ u))


def bidiagonalise(multiply: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int, steps: int, size: float) -> tuple[np.ndarray, np.ndarray]:
    """(V, B): orthonormal columns of V, and the upper bidiagonal B with XV = UB.

    multiply(a, before) gives _products over all rows; size is the norm of X.
    Where a vector vanishes the chain goes on from a new direction, so repeated
    and zero singular values are met too.
    """
    fresh = np.random.default_rng(11)
    vs, coefficients, images = np.zeros((width, 0)), np.zeros((width, 0)), np.zeros((width, 0))
    bidiagonal = np.zeros((steps, steps))
    least = 1e-14 * size

    def apart(w: np.ndarray) -> np.ndarray:
        for _ in range(2):
            w = w - vs @ (vs.T @ w)
        return w

    v, beta, last = fresh.standard_normal(width), 0.0, None
    v /= np.linalg.norm(v)
    for k in range(steps):
        a = v - (beta * last if last is not None else 0)
        for _ in range(3):
            got = multiply(a, coefficients)
            image, square, overlap = got[:width], got[width], got[width + 1 :]
            a = a - coefficients @ overlap
            if not len(overlap) or np.abs(overlap).max() <= 1e-8 * square**0.5 or square**0.5 <= least:
                break  # what is left to take away is small enough to be taken from the products too
        image, square = image - images @ overlap, square - overlap @ overlap
        alpha = max(square, 0.0) ** 0.5
        vs = np.column_stack((vs, v))
        if alpha > least:
            a, image = a / alpha, image / alpha
            coefficients, images = np.column_stack((coefficients, a)), np.column_stack((images, image))
            bidiagonal[k, k], last = alpha, a
            w = apart(image - alpha * v)
            beta = float(np.linalg.norm(w))
        else:
            beta = 0.0
        if k + 1 == steps:
            break
        if beta > least:
            v = w / beta
        else:
            beta, last = 0.0, None
            v = apart(fresh.standard_normal(width))
        v = apart(v)
        v /= np.linalg.norm(v)
        bidiagonal[k, k + 1] = beta
    return vs, bidiagonal


def scaled(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x): usable vectors as whole numbers."""
    c = F.col(vector_col).cast("array<double>")
    usable = c.isNotNull() & (F.size(c) > 0) & F.coalesce(F.forall(c, lambda e: e.isNotNull() & (F.abs(e) < _LARGEST)), F.lit(False))
    whole = F.transform(c, lambda e: F.floor(e * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    return table.where(usable).select(F.col(id_col).cast("long").alias("id"), whole.alias("x"))


def components(rows: DataFrame, width: int, most: int = 32, steps: int | None = None) -> tuple[Centre, np.ndarray, np.ndarray, float] | None:
    """(centre, components as columns, their variances, total variance); None where no row or no variance is."""
    parts = rows.mapInArrow(partial(_exact_sums, width=width), "i int, high long, low long")
    sums = [0] * (width + 1)
    for row in parts.groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect():  # one row per dimension
        sums[row["i"]] = (row["high"] << 32) + row["low"]
    if not (n := sums.pop()):
        return None
    centre = Centre(n, sums)
    squares = float(_sums(rows, centre, lambda x: np.array([(x * x).sum()]), 1)[0])
    if not squares:
        return None
    steps = min(width, max(steps or width, most))

    def multiply(a: np.ndarray, before: np.ndarray) -> np.ndarray:
        return _sums(rows, centre, partial(_products, a=a, before=before), width + 1 + before.shape[1])

    vs, bidiagonal = bidiagonalise(multiply, width, steps, squares**0.5)
    _, sigma, right = np.linalg.svd(bidiagonal)
    keep = min(most, int((sigma > _NEGLIGIBLE * sigma[0]).sum()))
    found = vs @ right[:keep].T
    found = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(keep)])
    return centre, found, sigma[:keep] ** 2 / n, squares / n


def _projected(batches, centre: Centre, found: np.ndarray, variances: np.ndarray, explained: np.ndarray, error: float):
    m = len(variances)
    for ids, x in _blocks(batches):
        count = len(x)
        whitened = centre.rows(x) @ found / np.sqrt(variances)
        row = np.repeat(np.arange(count), m)
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(row)),
                pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), count)),
                pa.array(np.full(count * m, centre.n)),
                pa.array(centre.deviations(x), pa.int64()).take(pa.array(row)),
                pa.array(whitened.ravel()),
                pa.array(np.tile(explained, count)),
                pa.array(np.full(count * m, error)),
            ],
            ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
        )


def whiten(table: DataFrame, most: int = 32, steps: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component, up to `most`: (id, component, n, deviation, whitened, explained, identity_error).

    Vectors that are null, empty, hold null or non-finite entries or entries of
    2^56 and more (which no long can hold 64 times) are left out, and so are
    those of another width than most vectors have (equally many: the greater
    width). Null and repeated ids are rows like any other, equal vectors count
    as often as they occur, other columns are ignored. Directions without
    variance have no component, so an empty table and one of equal vectors give
    no rows. A deviation that no long holds is null. Components of equal
    variance are any orthonormal ones of their space.

    A pass over the rows is made for each of `steps` (the width, unless given):
    at full width the result is exact to rounding. Fewer steps serve wide
    vectors whose leading variances stand apart.
    """
    spark = table.sparkSession
    rows = staged(scaled(table, id_col, vector_col), "scaled")
    widths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    known = None
    if widths:
        width = widths[0]["width"]
        rows = rows.where(F.size("x") == width)
        known = components(rows, width, most, steps)
    if known is None:
        return spark.createDataFrame([], OUTPUT).withColumnRenamed("id", id_col)
    centre, found, variances, total = known
    m = len(variances)

    def moments(x: np.ndarray) -> np.ndarray:
        w = x @ found / np.sqrt(variances)
        return np.concatenate(((w.T @ w).ravel(), w.sum(axis=0)))

    sums = _sums(rows, centre, moments, m * m + m) / centre.n
    mean = sums[m * m :]
    error = float(np.abs(sums[: m * m].reshape(m, m) - np.outer(mean, mean) - np.eye(m)).max())
    out = rows.mapInArrow(partial(_projected, centre=centre, found=found, variances=variances, explained=variances / total, error=error), OUTPUT)
    return out.withColumnRenamed("id", id_col)
