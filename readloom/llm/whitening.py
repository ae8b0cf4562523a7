"""Embedding whitening: principal components of exact integer vectors, refined from float32 to double precision.

Entries become integers, so sums and centred products are added up exactly, whatever the order of tasks. Each task
sends the sums of its rows, a matrix of the dimension squared, and never the rows.

Refinement. The eigenvectors of the covariance in float32 start the iteration of Ogita and Aishima: from the residual
of orthogonality R = I - X'X and of diagonality S = X'VX, both in extended precision, follows a correction E, and
X + XE has twice as many right digits. The correction divides by gaps of eigenvalues, so runs of eigenvalues that are
too close for the residuals are solved anew: their vectors are made orthonormal, the covariance less their mean is
projected on them, and the small matrix, which shows the differences alone, is solved in double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
# Integers of a product block stay exact in doubles: rows times the square of the largest entry.
ROWS, SMALL = 4096, 1 << 20
MOST = 1 << 53
STEPS = 20


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, c`` of the rows whose vector has no null, infinite or undefined entry."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    whole = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("c"))
    return whole.where(F.col("c").isNotNull() & F.forall("c", finite))


def integers(column: pa.Array, width: int) -> np.ndarray:
    """The integer vectors of a column of lists, shorter ones filled up with zeros before they are scaled."""
    out = np.zeros((len(column), width))
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(width) < lengths[:, None]] = values
    return np.clip(np.floor(SCALE * out), -MOST, MOST).astype(np.int64) + SHIFT


def products(y: np.ndarray) -> np.ndarray:
    """The exact sum of outer products of integer rows, as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), ROWS):
        part = y[at : at + ROWS]
        if len(part) and np.abs(part).max() < SMALL:
            part = part.astype(float)
            total += (part.T @ part).astype(np.int64).astype(object)
        else:
            total += part.T.astype(object) @ part.astype(object)
    return total


def _summed(rows: DataFrame, width: int, sums: Callable[[np.ndarray], np.ndarray], scale: int = 0) -> dict[int, Decimal]:
    """Sums over all rows, by number. Tasks add up their rows and send one row for each sum."""
    schema = pa.schema([("k", pa.int32()), ("v", pa.decimal128(38, scale))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in parts:
            if part.num_rows:
                found = sums(integers(part["c"], width)).ravel()
                total = found if total is None else total + found
        if total is not None:
            exact = [Decimal(int(v)) if not scale else round(Decimal(float(v)), scale) for v in total]
            yield pa.record_batch([pa.array(range(len(exact)), pa.int32()), pa.array(exact, schema.field("v").type)], schema=schema)

    partial = rows.select("c").mapInArrow(run, f"k int, v decimal(38,{scale})")
    return {r.k: r.v for r in partial.groupBy("k").agg(F.sum("v").cast(f"decimal(38,{scale})").alias("v")).collect()}


def eigen(v: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix in extended precision."""
    d = len(v)
    scale = np.abs(v).max() if d else 0
    if not scale:
        return np.zeros(d, np.longdouble), np.eye(d, dtype=np.longdouble)
    a = (v / scale).astype(np.longdouble)
    norm, unit = np.sqrt((a * a).sum()), np.eye(d, dtype=np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    best = None
    for _ in range(steps):
        x, r, s, values, noise = _state(a, x, unit, norm)
        runs = _clusters(values, noise)
        if runs:
            for lo, hi in runs:
                x[:, lo:hi] = _solved(a, x[:, lo:hi])
            x, r, s, values, noise = _state(a, x, unit, norm)
        if best is not None and noise >= best / 2:
            break
        best = noise
        gap = values[None, :] - values[:, None]
        clear = np.abs(gap) > noise
        # Vectors of one run have been solved against each other; what is left is their orthogonality.
        e = np.where(clear, (s + values[None, :] * r) / np.where(clear, gap, 1), r / 2)
        x = x + x @ e
    x /= np.sqrt((x * x).sum(0))
    values = (x * (a @ x)).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


def _state(a: np.ndarray, x: np.ndarray, unit: np.ndarray, norm):
    """Vectors by rising eigenvalue, their residuals, eigenvalues, and how far these may be off."""
    r, s = unit - x.T @ x, x.T @ a @ x
    values = np.diag(s) / (1 - np.diag(r))
    order = np.argsort(values, kind="stable")
    x, values, r, s = x[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
    off = s - np.diag(values)
    return x, r, s, values, 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))


def _clusters(values: np.ndarray, noise) -> list[tuple[int, int]]:
    """Runs of two or more neighbours no further apart than ``noise``."""
    cuts = [0, *(np.flatnonzero(np.diff(values) > noise) + 1), len(values)]
    return [(int(a), int(b)) for a, b in zip(cuts, cuts[1:]) if b - a > 1]


def _solved(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The vectors of one run, turned so that they diagonalise what the matrix differs by within the run."""
    x = x.copy()
    for _ in range(2):
        for j in range(x.shape[1]):
            x[:, j] -= x[:, :j] @ (x[:, :j].T @ x[:, j])
            x[:, j] /= np.sqrt((x[:, j] ** 2).sum())
    ax = a @ x
    t = x.T @ (ax - x * ((x * ax).sum() / x.shape[1]))
    size = np.abs(t).max()
    if not size:
        return x
    return x @ np.linalg.eigh(((t + t.T) / (2 * size)).astype(float))[1].astype(np.longdouble)


def whitened(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each usable row and component.

    Rows whose vector is null or has a null, infinite or undefined entry are left out; other rows, also repeated
    ones and those of null id, each count. The longest vector gives the dimension, shorter ones, also empty ones,
    are filled up with zeros. Integers are held within 2^53. A component without variance has no rows, so equal
    vectors, one row and an empty table give an empty result. A deviation that 64 bits can't hold is null.
    Only sums come to the driver: the dimension squared, whatever the rows.
    """
    kept = usable(rows, id_col, vec_col)
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, width = kept.agg(F.count("*"), F.max(F.size("c"))).first()
    empty = rows.sparkSession.createDataFrame([], out)
    if not n or not width:
        return empty
    sums = [int(v) for _, v in sorted(_summed(kept, width, lambda x: x.astype(object).sum(0)).items())]
    centre = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    rest = np.array([s - n * int(c) for s, c in zip(sums, centre)], object)
    found = _summed(kept, width, lambda x: products(x - centre))
    # The products are centred on the nearest integers; the rest of the centring is exact as well.
    square = np.array([int(found[k]) for k in range(width * width)], object).reshape(width, width)
    exact = square * n - np.outer(rest, rest)
    v = np.array([[Fraction(int(e), n * n) for e in row] for row in exact], object)
    v = np.array([[np.longdouble(e.numerator) / np.longdouble(e.denominator) for e in row] for row in v], np.longdouble)
    values, vectors = eigen(v)
    trace = np.trace(v)
    sure = [k for k in range(min(components, width)) if trace > 0 and values[k] > trace * width * 2.0**-50]
    if not sure:
        return empty
    turn = (vectors[:, sure] / np.sqrt(values[sure])).astype(float)
    offset = (np.array([int(r) / n for r in rest], float) @ turn).astype(float)
    project = lambda x: (x - centre) @ turn - offset
    count = len(sure)

    def moments(x: np.ndarray) -> np.ndarray:
        z = project(x)
        return np.concatenate([z.sum(0), (z.T @ z).ravel()])

    got = _summed(kept, width, moments, 12)
    total = np.array([float(got[k]) for k in range(count * (count + 1))])
    mean = total[:count] / n
    error = float(np.abs(total[count:].reshape(count, count) / n - np.outer(mean, mean) - np.eye(count)).max())
    explained = [float(values[k] / trace) for k in sure]
    schema = pa.schema(
        [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64())]
        + [(c, pa.float64()) for c in ("whitened", "explained", "identity_error")]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, ROWS):
                some = part.slice(at, ROWS)
                x = integers(some["c"], width)
                far = deviations(x - centre, rest, n)
                columns = [
                    some["vec_id"].take(pa.array(np.repeat(np.arange(len(x)), count))),
                    pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(x) * count, n)),
                    pa.array([v for v in far for _ in range(count)], pa.int64()),
                    pa.array(project(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(x) * count, error)),
                ]
                yield pa.record_batch(columns, schema=schema)

    return kept.mapInArrow(run, out)


def deviations(y: np.ndarray, rest: np.ndarray, n: int) -> list[int | None]:
    """The sum of squares of ``n * y - rest`` of each row, exactly; null beyond 64 bits."""
    largest = n * int(np.abs(y).max(initial=0)) + int(np.abs(rest).max())
    kind = np.int64 if largest * largest * y.shape[1] < 1 << 63 else object
    far = n * y.astype(kind) - rest.astype(kind)
    return [v if v < 1 << 63 else None for v in map(int, (far * far).sum(1))]


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
