"""Embedding whitening by shifted CholeskyQR.

The centred rows are factored as Q R, R small: a distributed pass sums the Gram
matrix of the rows as orthogonalised so far, its Cholesky factor joins the
factors before it, and the next pass solves the rows through them.  The first
Gram matrix gets a shift, which keeps Cholesky from failing however badly
conditioned the rows are; the passes after it bring Q to orthonormal columns.
The product of the factors is R to double precision; its singular values and
right vectors are the standard deviations (times the root of n) and the
components.  The Gram matrix of the raw rows alone would square their condition
and lose half of the digits.

Vectors are taken as fixed-point integers, ``floor(scale * c) + shift``, so that
their number, their sums and each row's deviation are exact.  A pass reads the table,
keeps d x d sums a task, adds them up in Spark by cell (partial aggregation) and
brings d (d + 1) / 2 numbers to the driver, whatever the number of rows.  Nothing
is shuffled but those sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import ref
from eventide.llm.vectors import usable

COMPONENTS = 8
#: Passes of the factorisation at most, and the departure of Q from orthonormal
#: columns (times their number) at which they end.
PASSES, ORTHONORMAL = 6, 1e-13
#: A standard deviation below this part of the largest one is zero to double precision.
NO_VARIANCE = 1e-12
#: Largest first try of a shift, as a part of the matrix's norm.
SHIFT = 1e-8
#: Fixed-point entries lie within this bound; larger ones are taken as the bound.
LARGEST = 1 << 48
MATRIX_BYTES = 8 << 20


class Fixed(NamedTuple):
    """Fixed-point form of the vectors of ``length`` entries."""

    length: int
    scale: float
    shift: int

    def matrices(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """(batch, row numbers, integers) of the vectors, last column of the batches, in
        parts of bounded size."""
        for batch in batches:
            for rows, values in usable(batch.column(batch.num_columns - 1)):
                step = max(1, MATRIX_BYTES // (8 * max(1, self.length)))
                for s in range(0, len(rows) if values.shape[1] == self.length else 0, step):
                    x = np.floor(values[s:s + step] * self.scale) + self.shift
                    yield batch, rows[s:s + step], np.clip(x, -LARGEST, LARGEST).astype(np.int64)


class Centre(NamedTuple):
    """Mean of the integers: the number of rows, their exact sums, and the mean as
    whole part and rest, so that centring small integers loses nothing."""

    n: int
    sums: list[int]

    @property
    def whole(self) -> np.ndarray:
        return np.array([round(Fraction(s, self.n)) for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n) - w) for s, w in zip(self.sums, self.whole.tolist(), strict=True)])


class Whitening(NamedTuple):
    fixed: Fixed
    centre: Centre
    components: np.ndarray  # columns
    eigenvalues: np.ndarray
    explained: np.ndarray


def sums_of(df: DataFrame, vector: str, work: Callable[[Iterable[pa.RecordBatch]], np.ndarray], kind: str) -> dict[int, object]:
    """Sum over all tasks of the cells that ``work`` returns for each."""
    arrow = pa.int64() if kind == "long" else pa.float64()

    def told(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = work(batches)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells)), pa.int32()), pa.array(cells, arrow)], ["cell", "value"])

    parts = df.select(ref(vector)).mapInArrow(told, f"cell int, value {kind}")
    value = F.col("value").cast("decimal(20,0)") if kind == "long" else F.col("value")
    return {r["cell"]: r["total"] for r in parts.groupBy("cell").agg(F.sum(value).alias("total")).collect()}


def centre_of(df: DataFrame, vector: str, fixed: Fixed) -> Centre:
    low = (1 << 24) - 1

    def work(batches):
        total, n = [0] * fixed.length, 0
        for _, rows, x in fixed.matrices(batches):
            total = [t + s for t, s in zip(total, x.sum(axis=0).tolist(), strict=True)]
            n += len(rows)
        # two cells for each sum, as a task's sum may be longer than a long
        return np.array([n, *[t & low for t in total], *[t >> 24 for t in total]], np.int64)

    cells, d = sums_of(df, vector, work, "long"), fixed.length
    return Centre(int(cells.get(0, 0)), [int(cells.get(1 + i, 0)) + (int(cells.get(1 + d + i, 0)) << 24) for i in range(d)])


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows R^-1 for an upper triangular R."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def gram_of(df: DataFrame, vector: str, fixed: Fixed, centre: Centre, then: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of the outer products of what ``then`` makes of the centred rows."""
    upper, whole, rest = np.triu_indices(width), centre.whole, centre.rest

    def work(batches):
        gram = np.zeros((width, width))
        for _, _, x in fixed.matrices(batches):
            q = then((x - whole) - rest)
            gram += q.T @ q
        return gram[upper]

    cells, gram = sums_of(df, vector, work, "double"), np.zeros((width, width))
    gram[upper] = [cells.get(i, 0.0) for i in range(len(upper[0]))]
    return np.triu(gram) + np.triu(gram, 1).T


def factored(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper Cholesky factor, of the shifted matrix if it has to be."""
    d = len(gram)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    rounding = min(SHIFT, 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2)
    shift, size = rounding * np.linalg.norm(gram, 2), np.eye(d)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * size).T
        except np.linalg.LinAlgError:
            shift *= 10


def fit(df: DataFrame, vector: str, scale: float = 1.0, shift: int = 0, components: int = COMPONENTS) -> Whitening | None:
    """Components of the vectors' covariance by falling eigenvalue; those without
    variance are left out.  None if no row takes part or no entry varies."""
    lengths = df.select(F.size(ref(vector)).alias("length")).where("length > 0").groupBy("length").count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    if common is None:
        return None
    fixed = Fixed(common["length"], scale, shift)
    centre = centre_of(df, vector, fixed)
    if not centre.n:
        return None
    factors: list[np.ndarray] = []
    trace = 0.0
    for turn in range(PASSES):
        shared = df.sparkSession.sparkContext.broadcast(tuple(factors))

        def orthogonalised(z: np.ndarray, shared=shared) -> np.ndarray:
            for factor in shared.value:
                z = solved(z, factor)
            return z

        gram = gram_of(df, vector, fixed, centre, orthogonalised, fixed.length)
        if not turn:
            trace = float(np.trace(gram))
            if not trace:
                return None
        factors.append(factored(gram, centre.n, shifted=not turn))
        if turn > 1 and np.abs(gram - np.eye(fixed.length)).max() <= ORTHONORMAL * fixed.length:
            break
    r = factors[0]
    for factor in factors[1:]:
        r = factor @ r
    _, sizes, right = np.linalg.svd(r)
    kept = int(min(components, np.count_nonzero(sizes > NO_VARIANCE * sizes[0])))
    return Whitening(fixed, centre, right[:kept].T.copy(), sizes[:kept] ** 2 / centre.n, sizes[:kept] ** 2 / trace)


def projected(model: Whitening, z: np.ndarray) -> np.ndarray:
    return z @ model.components / np.sqrt(model.eigenvalues)


def deviations(x: np.ndarray, centre: Centre, whole: np.ndarray) -> list[int]:
    """Sum over the entries of (n x - S)^2 for each row, exactly: with x = whole + u and
    n whole - S = r it is n^2 sum(u^2) + 2 n sum(u r) + sum(r^2)."""
    r = [centre.n * w - s for w, s in zip(whole.tolist(), centre.sums, strict=True)]
    u = x - whole
    big, far, d = int(np.abs(u).max(initial=0)), max(map(abs, r), default=0), x.shape[1]
    if d * big * max(big, far) >= 1 << 62:
        u = u.astype(object)
    rest = np.array(r, np.int64 if far < 1 << 62 and u.dtype != object else object)
    squares, mixed, last = (u * u).sum(axis=1).tolist(), (u * rest).sum(axis=1).tolist(), sum(v * v for v in r)
    return [centre.n * (centre.n * a + 2 * b) + last for a, b in zip(squares, mixed, strict=True)]


def whitened(df: DataFrame, row_id: str, vector: str, scale: float = 1.0, shift: int = 0,
             components: int = COMPONENTS) -> DataFrame:
    """Per row that takes part and component: the row's id (under its name and type),
    ``component`` (from 1), ``n``, ``deviation`` (decimal; null beyond 38 digits),
    ``whitened``, ``explained`` and ``identity_error``, one value: the largest entry of
    the covariance of ``whitened`` minus the identity.

    Rows whose vector is null, empty, of another length than most (the longer of equally
    common ones), or holds a null or non-finite entry take no part.  Components without
    variance (fewer rows than entries, constant or dependent entries) are left out, so
    there may be fewer than ``components`` and, where all rows are equal, no result rows;
    so too for an empty table.  Repeated rows and null ids each keep their own rows.  Extra
    columns, whatever their names, aren't read.
    """
    schema = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    kind = df.schema[row_id].dataType.simpleString()
    rows = df.select(ref(row_id).alias("row_id"), ref(vector).alias("vector"))
    model = fit(rows, "vector", scale, shift, components)
    if model is None or not len(model.eigenvalues):
        return df.sparkSession.createDataFrame([], f"row_id {kind}, {schema}").withColumnRenamed("row_id", row_id)
    count = len(model.eigenvalues)
    shared = df.sparkSession.sparkContext.broadcast(model)
    gram = gram_of(rows, "vector", model.fixed, model.centre, lambda z: projected(shared.value, z), count)
    error = float(np.abs(gram / model.centre.n - np.eye(count)).max())

    def told(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        whole, rest, limit = m.centre.whole, m.centre.rest, 10 ** 38
        for batch, own, x in m.fixed.matrices(batches):
            values = projected(m, (x - whole) - rest)
            exact = pa.array([Decimal(v) if v < limit else None for v in deviations(x, m.centre, whole)], pa.decimal128(38, 0))
            each = np.repeat(np.arange(len(own)), count)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(own[each])), pa.array(np.tile(np.arange(1, count + 1), len(own)), pa.int32()),
                pa.array(np.full(len(each), m.centre.n), pa.int64()), exact.take(pa.array(each)), pa.array(values.ravel()),
                pa.array(np.tile(m.explained, len(own))), pa.array(np.full(len(each), error))],
                ["row_id", *[c.split()[0] for c in schema.split(", ")]])

    return rows.mapInArrow(told, f"row_id {kind}, {schema}").withColumnRenamed("row_id", row_id)
