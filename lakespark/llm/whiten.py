"""Embedding whitening by shifted CholeskyQR over distributed rows.

Each pass over the centred fit rows A orthogonalises them with the factors so far (Q = A / R1 / R2 ...,
triangular solves inside the tasks), adds up the Gram matrix of Q over all tasks, and takes
its Cholesky factor as the next R. The first factorisation is shifted, so that it exists for any
condition number. The composed factor R has the singular values and right vectors of A: its
SVD, a small matrix on the driver, gives the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakespark.llm.common import BATCH_ROWS, lists
from lakespark.session import settle

#: Entries become floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Scaled entries must be below this in size: larger doubles are no exact integers.
LARGEST = 2.0**52
COMPONENTS = 16
#: Most passes, and how far from the identity the Gram matrix of the last one may be.
PASSES, CLOSE = 5, 1e-11
_EPS = float(np.finfo(float).eps)
_LOW = 20


def integers(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and the exact integers ``x`` of every usable row.

    Rows whose vector is null or holds a null, NaN, infinite or huge entry (``LARGEST``) are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten()
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            missing = pc.is_null(flat).to_numpy(zero_copy_only=False)
            c = np.floor(SCALE * pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.float64))
            bad = missing | ~(np.abs(c) < LARGEST)
            row = np.repeat(np.arange(len(size)), size)
            good = np.bincount(row[bad], minlength=len(size)) == 0
            good &= pc.is_valid(column).to_numpy(zero_copy_only=False)
            x = c[good[row]].astype(np.int64) + OFFSET
            at = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), lists(x, size[good], pa.int64())], [key, "x"])

    plain = rows.select(F.col(key), F.col(vector).cast("array<double>"))
    kind = rows.schema[key].dataType.simpleString()
    return plain.mapInArrow(run, f"`{key}` {kind}, x array<long>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of fit rows and the exact sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in _pieces(batches):
            x = _matrix(batch.column("x"), width)
            n += len(x)
            high += (x >> _LOW).sum(axis=0)
            low += (x & ((1 << _LOW) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(np.full(width, n)), pa.array(high), pa.array(low)], ["i", "n", "high", "low"])

    parts = fit.mapInArrow(run, "i long, n long, high long, low long")
    # a row for each dimension
    total = parts.groupBy("i").agg(*(F.sum(c).alias(c) for c in ("n", "high", "low"))).orderBy("i").collect()
    return (total[0]["n"] if total else 0), [(r["high"] << _LOW) + r["low"] for r in total]


def _scaled(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n * x - s without rounding: 64-bit integers where they hold it, else Python's."""
    most = int(np.abs(x).max(initial=0)) * n + max(map(abs, s), default=0)
    if most < 2**62:
        return n * x - np.array(s, np.int64)
    return n * x.astype(object) - np.array(s, dtype=object)


def centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """x - s/n, rounded once."""
    return (_scaled(x, n, s) / n).astype(np.float64)


def deviations(x: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """Sum of (n x - s)^2 of every row; None beyond 64 bits."""
    d = _scaled(x, n, s)
    if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * max(1, d.shape[1]) >= 2**63:
        d = d.astype(object)
    total = (d * d).sum(axis=1)
    return [v if v < 2**63 else None for v in map(int, total)]


def solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a / r for an upper triangular r, column by column."""
    q = np.empty_like(a)
    for j in range(r.shape[1]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def gram(fit: DataFrame, n: int, s: list[int], factors: list[np.ndarray], last: np.ndarray | None = None) -> np.ndarray:
    """Gram matrix of the centred rows after ``factors`` (and a projection), summed over all tasks.

    A task sends one row for each dimension; the driver gets one for each entry of the matrix.
    """
    width = len(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((width, width))
        for batch in _pieces(batches):
            q = centred(_matrix(batch.column("x"), width), n, s)
            for r in factors:
                q = solve(q, r)
            if last is not None:
                q = q @ last
            k = q.shape[1]
            out[:k, :k] += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), lists(out.ravel(), np.full(width, width), pa.float64())], ["i", "g"])

    parts = fit.mapInArrow(run, "i long, g array<double>").select("i", F.posexplode("g").alias("j", "v"))
    total = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((width, width))
    out[total.column("i").to_numpy(), total.column("j").to_numpy()] = total.column("v").to_numpy()
    size = width if last is None else last.shape[1]
    return (out[:size, :size] + out[:size, :size].T) / 2


def shifted_factor(g: np.ndarray, n: int, shift: bool) -> np.ndarray:
    """Upper Cholesky factor of ``g``; shifted at first, or where rounding left ``g`` indefinite."""
    d = len(g)
    s = 11 * (n * d + d * (d + 1)) * _EPS * max(np.linalg.norm(g, 2), 1e-300) if shift else 0.0
    least = 11 * d * (d + 1) * _EPS * max(np.linalg.norm(g, 2), 1e-300)
    while True:
        try:
            return np.linalg.cholesky(g + s * np.eye(d)).T
        except np.linalg.LinAlgError:
            s = max(2 * s, least)


def composed_factor(fit: DataFrame, n: int, s: list[int]) -> np.ndarray:
    """R with R'R = A'A for the centred fit rows A, from repeated Gram passes."""
    factors: list[np.ndarray] = []
    total = np.eye(len(s))
    for p in range(PASSES):
        g = gram(fit, n, s, factors)
        if p > 1 and np.abs(g - np.eye(len(s))).max() < CLOSE:
            break
        # the shift need not grow with the rows: it only has to outweigh the rounding of the sums
        factors.append(shifted_factor(g, min(n, 1 << 20), p == 0))
        total = factors[-1] @ total
    return total


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened components of every usable row: key, component, n, deviation, whitened, explained, identity_error.

    The components come from the fit list, which holds every distinct integer vector once: each counts the same,
    however often it is repeated. Left out are rows whose vector is null or holds a null, non-finite or huge
    entry. Vectors must have one width: of several widths, the one that most distinct vectors have is used
    (of equals the larger), and rows of other widths are left out, as are empty vectors. Components without variance
    cannot be whitened and are not returned, so a single distinct vector, or an empty table, gives no rows. A
    null key stays; repeated rows are repeated. Columns other than ``key`` and ``vector`` are ignored.
    ``deviation`` is null where it does not fit a long.
    """
    clean = settle(integers(rows, key, vector))
    fit = settle(clean.select("x").distinct())
    widths = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    width = widths[0]["d"] if widths else 0
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not width:
        return rows.sparkSession.createDataFrame([], schema)
    fit = fit.where(F.size("x") == width)
    n, s = sums(fit, width)
    _, singular, right = np.linalg.svd(composed_factor(fit, n, s))
    variance = singular**2 / n
    k = min(components, int((singular > singular[0] * 16 * width * _EPS).sum()))
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    axes = right[:k].T.copy()
    axes *= np.where(axes[np.abs(axes).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    project = axes / np.sqrt(variance[:k])
    share = variance[:k] / variance.sum()
    # the fit rows are centred, so this Gram matrix over n is the covariance of what is returned
    error = float(np.abs(gram(fit, n, s, [], project) / n - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            x = _matrix(batch.column("x"), width)
            m = len(x)
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, n), pa.int64()),
                    pa.array(deviations(x, n, s), pa.int64()).take(at),
                    pa.array((centred(x, n, s) @ project).ravel()),
                    pa.array(np.tile(share, m)),
                    pa.array(np.full(m * k, error)),
                ],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return clean.where(F.size("x") == width).mapInArrow(run, schema)
