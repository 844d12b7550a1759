"""Whitening of vectors by the leading components of their covariance.

Spark adds up exact sums and the centred covariance of the distinct vectors. Its
leading eigenpairs are found by contour integration (FEAST): a quadrature of
solves with the covariance shifted by points of a circle in the complex plane
projects a few vectors onto the space of the eigenvalues inside; Rayleigh-Ritz
takes the eigenpairs out of that space; inertia counts (the signs of a
factorisation of the shifted matrix) choose the interval and verify that none
inside it is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import stored

COMPONENTS = 4
SCALE = 256
NODES = 8  # of the quadrature, on the upper half of the circle
SPARE = 8  # vectors of the search space beyond twice the number of eigenvalues
ROUNDS = 40
BISECTIONS = 24
LONG_MAX = np.iinfo(np.int64).max


def negatives(matrix: np.ndarray) -> int:
    """The number of negative eigenvalues of a symmetric matrix, from the signs of its
    factorisation into L D L' with pivots of one or two rows (Bunch and Parlett)."""
    a = matrix.copy()
    turn = (1 + np.sqrt(17)) / 8
    count = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        i = int(diagonal.argmax())
        beside = np.abs(np.tril(a, -1))
        r, s = np.unravel_index(int(beside.argmax()), a.shape)
        if max(diagonal[i], beside[r, s]) == 0:
            return count
        pivot = [i] if diagonal[i] >= turn * beside[r, s] else [int(s), int(r)]
        rest = np.setdiff1d(np.arange(len(a)), pivot)
        block, side = a[np.ix_(pivot, pivot)], a[np.ix_(rest, pivot)]
        # a pivot of two rows has one negative and one positive eigenvalue
        count += int(block[0, 0] < 0) if len(pivot) == 1 else 1
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return count


def above(matrix: np.ndarray, at: float) -> int:
    """The number of eigenvalues above ``at``."""
    return negatives(at * np.eye(len(matrix)) - matrix)


def bracket(matrix: np.ndarray, number: int, low: float, high: float) -> tuple[float, float]:
    """Bounds of the ``number``-th largest eigenvalue, from inertia counts."""
    for _ in range(BISECTIONS):
        middle = (low + high) / 2
        if above(matrix, middle) >= number:
            low = middle
        else:
            high = middle
    return low, high


def interval(matrix: np.ndarray, wanted: int, floor: float) -> tuple[float, float, int]:
    """An interval that holds the ``wanted`` largest eigenvalues, with its number of them.

    It ends in the widest of the gaps below the last one wanted and the next few.
    """
    bound = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-12)
    top = bracket(matrix, 1, floor, bound)[1]
    high = top + 0.05 * (top - floor) + floor
    last = min(above(matrix, floor), wanted + SPARE)
    ends = [bracket(matrix, k, floor, high) for k in range(wanted, last + 1)]
    if last < wanted + SPARE:
        ends.append((floor, floor))
    gaps = [ends[k][0] - ends[k + 1][1] for k in range(len(ends) - 1)]
    k = int(np.argmax(gaps))
    low = (ends[k][0] + ends[k + 1][1]) / 2 if gaps[k] > 0 else floor
    return low, high, above(matrix, low)


def contour_pairs(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues between ``low`` and ``high``, falling, and unit eigenvectors as columns.

    ``count`` is their number by inertia; the search space grows until as many are found.
    """
    d = len(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    x, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(1j * np.pi * (x + 1) / 2)
    size = min(d, 2 * count + SPARE)
    accurate = 1e-14 * d * max(1e-300, float(np.abs(matrix).max()))
    while True:
        space = np.random.default_rng(0).standard_normal((d, size))
        for _ in range(ROUNDS):
            projected = np.zeros((d, size))
            for turn, weight in zip(turns, weights):
                shifted = (centre + radius * turn) * np.eye(d) - matrix
                projected += weight / 2 * np.real(radius * turn * np.linalg.solve(shifted, space.astype(complex)))
            basis = np.linalg.qr(projected)[0]
            basis = np.linalg.qr(basis)[0]
            reduced = basis.T @ matrix @ basis
            values, ritz = np.linalg.eigh((reduced + reduced.T) / 2)
            space = basis @ ritz
            inside = (values > low) & (values < high)
            residual = matrix @ space[:, inside] - space[:, inside] * values[inside]
            if inside.sum() == count and np.abs(residual).max(initial=0.0) <= accurate:
                order = np.argsort(-values[inside], kind="stable")
                vectors = space[:, inside][:, order]
                return values[inside][order], vectors / np.linalg.norm(vectors, axis=0)
        if size == d:
            raise RuntimeError(f"{inside.sum()} eigenvalues found, {count} counted by inertia")
        size = min(d, 2 * size)


def leading(matrix: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, at most ``components``, and their vectors; none that rounding alone makes."""
    floor = len(matrix) * np.finfo(float).eps * float(np.trace(matrix)) if len(matrix) else 0.0
    wanted = min(components, above(matrix, floor)) if floor > 0 else 0
    if not wanted:
        return np.empty(0), np.empty((len(matrix), 0))
    values, vectors = contour_pairs(matrix, *interval(matrix, wanted, floor))
    return values[:wanted], vectors[:, :wanted]


@dataclass
class Whitening:
    """``n`` vectors with exact ``sums`` per dimension and the ``values`` and ``vectors`` of the
    leading components; ``trace`` is the sum of all variances."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        mean = np.array([float(s) / self.n for s in self.sums])
        return (rows - mean) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, rows: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2, exact; null where they are beyond a long."""
        largest = self.n * int(np.abs(rows).max(initial=0)) + max(map(abs, self.sums), default=0)
        exact = np.int64 if len(self.sums) * largest * largest < LONG_MAX else object
        moved = rows.astype(exact) * self.n - np.array(self.sums, dtype=exact)
        return [int(v) if v <= LONG_MAX else None for v in (moved * moved).sum(axis=1)]


def integers(vector: str | Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, null unless all are finite numbers."""
    column = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(column, lambda x: F.floor(scale * x.cast("double"))))


def matrix_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    flat = batch["x"].flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, width)


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the vectors ``x`` of one width, each counted once.

    What reaches the driver are ``width`` sums and ``width``^2 sums of products,
    added up in Spark, however many vectors there are.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for batch in batches:
            rows = matrix_of(batch, width)
            n += len(rows)
            small = len(rows) and int(np.abs(rows.astype(float)).max()) * len(rows) < LONG_MAX // 2
            sums = rows.sum(axis=0) if small else rows.astype(object).sum(axis=0)
            total = [a + int(b) for a, b in zip(total, sums)] if len(rows) else total
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(-1, width), pa.int32()),
                pa.array([Decimal(v) for v in [n, *total]], pa.decimal128(38)),
            ],
            names=["i", "v"],
        )

    added = distinct.mapInArrow(add, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v"))
    totals = {r["i"]: int(r["v"]) for r in added.collect()}
    n, sums = totals.pop(-1, 0), [totals[i] for i in range(width)] if totals else [0] * width
    mean = np.array([s / n for s in sums]) if n else np.zeros(width)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = matrix_of(batch, width) - mean
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))],
            names=["i", "row"],
        )

    def add_rows(table: pa.Table) -> pa.Table:
        row = np.sum([r.values.to_numpy() for r in table["row"]], axis=0)
        return pa.table({"i": table["i"][:1], "row": pa.array([row], pa.list_(pa.float64()))})

    matrix = np.zeros((width, width))
    if n:
        rows = distinct.mapInArrow(products, "i int, row array<double>").groupBy("i")
        for r in rows.applyInArrow(add_rows, "i int, row array<double>").toLocalIterator():
            matrix[r["i"]] = r["row"]
        matrix = (matrix + matrix.T) / (2 * n)
    values, vectors = leading(matrix, components)
    return Whitening(n, sums, values, vectors, float(np.trace(matrix)))


def whitened_rows(rows: DataFrame, kept: list[str], model: Whitening) -> DataFrame:
    """``kept``, ``deviation`` and ``white`` (a list, a component each) of the vectors ``x``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = matrix_of(batch, len(own.sums))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c] for c in kept],
                    pa.array(own.deviation(found), pa.int64()),
                    pa.array(list(own.whitened(found)), pa.list_(pa.float64())),
                ],
                names=[*kept, "deviation", "white"],
            )

    return rows.mapInArrow(apply, ", ".join([*fields, "deviation long, white array<double>"]))


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened vectors less the identity."""
    k = len(model.values)
    white = whitened_rows(distinct, [], model)
    entries = [
        F.abs(F.covar_pop(F.col("white")[i], F.col("white")[j]) - float(i == j)) for i in range(k) for j in range(i, k)
    ]
    return float(white.agg(F.array_max(F.array(*entries)).alias("e")).first()["e"])


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """``<key>, component, n, deviation, whitened, explained, identity_error``.

    Vectors that are null or hold a null or non-finite entry are left out; every
    other row, copies and rows without a key included, has a row per component.
    Components that explain nothing but rounding have none: of n distinct vectors
    there are n - 1 at most, so one vector alone gives no row, like an empty
    table. Vectors of each width are a table of their own. Equal eigenvalues may
    share their space in any way.
    """
    clean = vectors.select(F.col(key).alias("id"), integers(vector).alias("x")).filter("x IS NOT NULL")
    widths = [r[0] for r in clean.select(F.size("x").alias("w")).filter("w > 0").distinct().orderBy("w").collect()]
    distinct = stored(clean.select("x").distinct(), "distinct")
    id_type = clean.schema["id"].dataType.simpleString()
    out = vectors.sparkSession.createDataFrame(
        [],
        f"`{key}` {id_type}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double",
    )
    for width in widths:
        own = distinct.filter(F.size("x") == width)
        model = fit(own, width, components)
        if not len(model.values):
            continue
        error = identity_error(own, model)
        explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
        rows = whitened_rows(clean.filter(F.size("x") == width), ["id"], model)
        out = out.unionByName(
            rows.select("id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
                F.col("id").alias(key),
                (F.col("at") + 1).alias("component"),
                F.lit(model.n).cast("long").alias("n"),
                "deviation",
                "whitened",
                explained[F.col("at")].alias("explained"),
                F.lit(error).alias("identity_error"),
            )
        )
    return out
