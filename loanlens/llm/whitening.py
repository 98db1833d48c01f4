"""Whitening of embeddings by spectrum slicing of their covariance.

The covariance of the distinct quantised vectors is gathered in one aggregation. Its leading
eigenvalues are isolated by inertia: the LDL' factorisation of V - s I has as many positive
pivots as V has eigenvalues above s, so bisection on s brackets the k-th largest one. Inside
a bracket Rayleigh quotient iteration converges cubically; two more counts, right above and
right below the result, certify that it is number k.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import cut_lineage

SCALE = 256.0
# Vectors that are multiplied at once.
BLOCK = 4096
EPS = float(np.finfo(float).eps)


# --- spectrum of a symmetric matrix ------------------------------------------------------


def inertia_above(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of symmetric ``a`` above ``shift``: positive pivots of LDL' of a - shift I.

    Pivots are blocks of one or two rows, chosen as by Bunch and Kaufman, so that no growth
    spoils a sign. A pivot of exactly zero counts as below.
    """
    m = a - shift * np.eye(len(a))
    alpha = (1 + 17**0.5) / 8
    above = 0
    while len(m):
        column = np.abs(m[1:, 0])
        size = 1
        if len(column) and column.max() > 0 and abs(m[0, 0]) < alpha * column.max():
            r = int(column.argmax()) + 1
            row = np.abs(m[r])
            row[r] = 0
            sigma = row.max()
            if abs(m[0, 0]) * sigma >= alpha * column.max() ** 2:
                pass
            elif abs(m[r, r]) >= alpha * sigma:
                order = [r, *(i for i in range(len(m)) if i != r)]
                m = m[np.ix_(order, order)]
            else:
                order = [0, r, *(i for i in range(1, len(m)) if i != r)]
                m = m[np.ix_(order, order)]
                size = 2
        pivot, side = m[:size, :size], m[size:, :size]
        if size == 1:
            p = pivot[0, 0]
            above += p > 0
            m = m[1:, 1:] - (np.outer(side[:, 0], side[:, 0]) / p if p else 0.0)
        else:
            above += 1  # such a block has one eigenvalue of either sign
            m = m[2:, 2:] - side @ np.linalg.solve(pivot, side.T)
    return int(above)


def _orthogonal(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for v in found:
            x = x - v * (v @ x)
    length = np.linalg.norm(x)
    return x / length if length > 0 else x


def _solve(a: np.ndarray, shift: float, x: np.ndarray, norm: float) -> np.ndarray:
    """(a - shift I) y = x; a shift that hits an eigenvalue is moved by a rounding error."""
    for k in range(1, 9):
        try:
            y = np.linalg.solve(a - shift * np.eye(len(a)), x)
            if np.isfinite(y).all():
                return y
        except np.linalg.LinAlgError:
            pass
        shift += k * EPS * norm
    return x


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a positive semidefinite matrix, falling, and unit vectors.

    Values that are zero by rounding are left out, so fewer may come. Vectors of equal
    values are any orthonormal ones. The sign makes the largest entry positive.
    """
    n = len(a)
    norm = float(np.abs(a).sum(1).max(initial=0.0))
    if not norm > 0:
        return np.zeros(0), np.zeros((n, 0))
    a = a / norm
    tiny = 4 * n * EPS
    k = min(k, inertia_above(a, tiny))
    values: list[float] = []
    vectors: list[np.ndarray] = []
    rng = np.random.default_rng(7)
    for number in range(1, k + 1):
        low, high = tiny, 1.0 + tiny  # number `number` is above low and not above high
        start = rng.standard_normal(n)
        while True:
            # Isolated if exactly this one is in the bracket; equal ones end by its width.
            narrow = high - low <= 2 * tiny
            alone = inertia_above(a, low) == number and inertia_above(a, high) == number - 1
            if alone or narrow:
                x, shift = _orthogonal(start, vectors), (low + high) / 2
                for _ in range(3 if alone else 6):
                    x = _orthogonal(_solve(a, shift, x, 1.0), vectors)
                value = float(x @ a @ x)
                best, error = x, float(np.linalg.norm(a @ x - value * x))
                for _ in range(30):
                    y = _orthogonal(_solve(a, value, best, 1.0), vectors)
                    quotient = float(y @ a @ y)
                    rest = float(np.linalg.norm(a @ y - quotient * y))
                    if not rest < error:
                        break
                    best, value, error = y, quotient, rest
                off = error + tiny
                certain = inertia_above(a, value - off) >= number > inertia_above(a, value + off)
                if narrow or (certain and error <= 64 * tiny):
                    values.append(value)
                    vectors.append(best * np.sign(best[np.abs(best).argmax()]))
                    break
            middle = (low + high) / 2
            if inertia_above(a, middle) >= number:
                low = middle
            else:
                high = middle
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order] * norm, np.array(vectors).reshape(-1, n)[order].T


# --- vectors -----------------------------------------------------------------------------


def _sound(vector: Column) -> Column:
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != infinite))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def quantised(vector: Column, scale: float = SCALE) -> Column:
    """floor(scale * c) of every entry as a long; beyond longs the nearest one."""
    top = F.lit(float(1 << 62))
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, top), -top)))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield _matrix(batch.column(0).slice(at, BLOCK))


def _sums(points: DataFrame, function, width: int) -> np.ndarray:
    """Sum of ``function(block)``, a matrix of ``width`` columns, over all vectors.

    Every task adds up its blocks; the entries of the tasks' matrices are added by Spark,
    so the driver sees one matrix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches):
            part = function(block)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size)), pa.array(total.ravel(), pa.float64())], ["at", "value"]
            )

    cells = points.select("x").mapInArrow(run, "at long, value double")
    rows = cells.groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(max((r["at"] for r in rows), default=-1) + 1)
    for r in rows:
        out[r["at"]] = r["value"]
    return out.reshape(-1, width)


def _totals(points: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: list[int] | None = None
        n = 0
        for x in _blocks(batches):
            n += len(x)
            # Halves of 32 bits: sums of a block stay within a long.
            high, low = (x >> 32).sum(0).tolist(), (x & 0xFFFFFFFF).sum(0).tolist()
            part = [(h << 32) + v for h, v in zip(high, low)]
            totals = part if totals is None else [a + b for a, b in zip(totals, part)]
        if totals is not None:
            exact = pa.array([Decimal(v) for v in (n, *totals)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(exact)), pa.int64()), exact], ["at", "value"])

    parts = points.select("x").mapInArrow(run, "at long, value decimal(38,0)")
    rows = sorted(parts.groupBy("at").agg(F.sum("value").alias("value")).collect())
    whole = [int(r["value"]) for r in rows]
    return (whole[0], whole[1:]) if whole else (0, [])


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: x -> (x - sums / n) @ basis / sqrt(values)."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    basis: np.ndarray
    explained: np.ndarray
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        # n x - S is exact while it fits a double, so that x is centred before rounding.
        centred = (x.astype(np.float64) * self.n - np.array(self.sums, np.float64)) / self.n
        return centred @ (self.basis / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Exact sum over dimensions of (n x - S)^2; null where that exceeds a long."""
        width, top = x.shape[1], 2**63 - 1
        reach = self.n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
        if (reach + max(map(abs, self.sums))) ** 2 * width <= top:
            y = x * np.int64(self.n) - np.array(self.sums, np.int64)
            return pa.array((y * y).sum(1), pa.int64())
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return pa.array([v if v <= top else None for v in exact], pa.int64())


def usable(df: DataFrame, id_col: str, vector_col: str, scale: float = SCALE) -> tuple[DataFrame, int]:
    """Rows (id, x) whose vector is whole, and its width.

    The width is that of most vectors (of the shorter ones at a tie); vectors of another
    width are left out like broken ones.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(_sound(F.col("v")))
    widths = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    width = widths["w"] if widths else 0
    return rows.where(F.size("v") == width).select("id", quantised(F.col("v"), scale).alias("x")), width


def fit_whitening(points: DataFrame, width: int, components: int = 4) -> Whitening | None:
    """Transform fitted on the distinct vectors ``x`` of ``points``; None if there are none.

    Vectors are centred before they are multiplied: first on the whole number next to their
    mean, which keeps products of usual vectors exact in doubles, so the result does not
    depend on partitions; what is left of the mean is then taken off exactly. The driver
    holds matrices of width by width.
    """
    distinct = cut_lineage(points.select("x").distinct())
    n, sums = _totals(distinct)
    if not n:
        return None
    near = np.array([(2 * s + n) // (2 * n) for s in sums], np.float64)

    def products(block: np.ndarray) -> np.ndarray:
        y = block.astype(np.float64) - near
        return y.T @ y

    rest = np.array([s - n * int(m) for s, m in zip(sums, near)], np.float64)
    covariance = (_sums(distinct, products, width) - np.outer(rest, rest) / n) / n
    values, basis = leading_eigenpairs(covariance, min(components, width))
    explained = values / np.trace(covariance) if len(values) else values
    fitted = Whitening(n, tuple(sums), values, basis, explained, 0.0)
    if not len(values):
        return fitted

    def again(block: np.ndarray) -> np.ndarray:
        z = fitted.project(block)
        return np.vstack([z.T @ z, z.sum(0)])

    table = _sums(distinct, again, len(values))
    means = table[-1] / n
    error = np.abs(table[:-1] / n - np.outer(means, means) - np.eye(len(values))).max()
    return Whitening(n, tuple(sums), values, basis, explained, float(error))


WHITENED = (
    "id {id}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
)


def whiten(
    df: DataFrame,
    components: int = 4,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = SCALE,
) -> DataFrame:
    """Per usable row: id, ``n, deviation, whitened, explained, identity_error``.

    ``whitened`` and ``explained`` hold a number per component, by falling eigenvalue.
    There are fewer than ``components`` where the vectors have fewer dimensions or vary
    in fewer; none at all if they are all equal (their rows remain, with empty arrays).

    Rows whose vector is null, empty or holds null or non-finite entries are left out, as
    are those whose width is not that of most vectors. Repeated vectors count once in the
    fit and get a row each; repeated and null ids keep their rows. An empty table gives no
    rows. Other columns are not read.
    """
    points, width = usable(df, id_col, vector_col, scale)
    schema = WHITENED.format(id=points.schema["id"].dataType.simpleString())
    fitted = fit_whitening(points, width, components) if width else None
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fitted.values)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(at, BLOCK)
                n = rows.num_rows
                x = _matrix(rows.column(1))
                offsets = pa.array(np.arange(n + 1, dtype=np.int32) * k)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(np.full(n, fitted.n)),
                        fitted.deviation(x),
                        pa.ListArray.from_arrays(offsets, pa.array(fitted.project(x).ravel())),
                        pa.ListArray.from_arrays(offsets, pa.array(np.tile(fitted.explained, n))),
                        pa.array(np.full(n, fitted.identity_error)),
                    ],
                    ["id", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return points.mapInArrow(run, schema).withColumnRenamed("id", id_col)
