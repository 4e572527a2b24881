"""Whitening of vectors by shifted CholeskyQR.

Entries become whole numbers and rows are centred on the exact mean. Three passes over the rows each add up a Gram matrix
of rows already made more orthogonal, R <- chol(G) R: the first with a shift on the diagonal, which keeps the
factorisation safe however ill-conditioned the rows are, the next two solving each block of rows against the R so
far. The composed R has the singular values and right singular vectors of all rows, so its SVD gives the components
to working precision, without a covariance matrix whose condition is the square. What leaves the tasks is sums over dimensions
and pairs of dimensions, whose number does not depend on the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024, 100_000
#: Entries stay within this, so that a block's sums are exact in 64 bits.
LARGEST = 1 << 45
BLOCK = 1 << 13


def _blocks(batches, column: str = "vector") -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    """For each length in a batch: the batch, the length, the places of its rows, and the rows as whole numbers."""
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            part = batch.slice(first, BLOCK)
            vectors = part.column(column)
            n = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(n) - n
            for dims in np.unique(n).tolist():
                at = np.flatnonzero(n == dims)
                rows = flat[starts[at][:, None] + np.arange(dims)]
                scaled = np.floor(np.clip(rows, -LARGEST, LARGEST) * SCALE) if np.abs(rows).max() >= LARGEST / SCALE else np.floor(rows * SCALE)
                yield part, dims, at, np.clip(scaled, -LARGEST, LARGEST).astype(np.int64) + OFFSET


def usable(vectors: DataFrame, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """``vec_id, vector`` (doubles) of rows whose vector is there, is not empty and holds only finite entries."""
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.coalesce(finite & (F.size("vector") > 0), F.lit(False)))


class Sums:
    """Exact count and per-dimension sums of the vectors of one length."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self._whole = np.array(sums, np.int64) if max(map(abs, sums)) < 1 << 62 else np.array(sums, object)

    def spread(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit where that is large enough, Python's whole numbers otherwise."""
        safe = self._whole.dtype != object and self.n * int(np.abs(x).max(initial=0)) < 1 << 62
        return x * np.int64(self.n) - self._whole if safe else x.astype(object) * self.n - self._whole

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n with one rounding."""
        return (self.spread(x) / self.n).astype(np.float64)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S) squared, exact; none where it is beyond 64 bits."""
        y = self.spread(x)
        if y.dtype == object or y.shape[1] * float(np.abs(y).max(initial=0)) ** 2 >= 2.0**62:
            whole = [sum(v * v for v in map(int, row)) for row in y]
            return [v if v < 1 << 63 else None for v in whole]
        return (y * y).sum(axis=1).tolist()


def column_sums(rows: DataFrame) -> dict[int, Sums]:
    """Per length of vector: a task adds up its rows, Spark the tasks' sums, in exact decimals."""

    def add(batches):
        held: dict[int, list] = {}
        for _, dims, _, x in _blocks(batches):
            now = held.setdefault(dims, [0, [0] * dims])
            now[0] += len(x)
            now[1] = [a + b for a, b in zip(now[1], x.sum(axis=0).tolist())]
        for dims, (n, sums) in held.items():
            values = [Decimal(v) for v in [n, *sums]]
            arrays = [pa.array([dims] * (dims + 1), pa.int64()), pa.array(range(-1, dims), pa.int64()), pa.array(values, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(arrays, ["dims", "k", "v"])

    added = rows.select("vector").mapInArrow(add, "dims long, k long, v decimal(38,0)").groupBy("dims", "k").agg(F.sum("v").alias("v"))
    found: dict[int, dict[int, int]] = {}
    for r in added.collect():  # one number a dimension of each length
        found.setdefault(r["dims"], {})[r["k"]] = int(r["v"])
    return {dims: Sums(v[-1], [v[k] for k in range(dims)]) for dims, v in found.items()}


def gram(rows: DataFrame, turn: Callable[[int, np.ndarray], np.ndarray], width: Callable[[int], int], lengths: list[int]) -> dict[int, np.ndarray]:
    """Per length of vector the Gram matrix of ``turn(length, whole numbers)``: upper halves, added up by Spark."""

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for _, dims, _, x in _blocks(batches):
            a = turn(dims, x)
            held[dims] = held.get(dims, 0.0) + a.T @ a
        for dims, g in held.items():
            upper = g[np.triu_indices(len(g))]
            yield pa.RecordBatch.from_arrays([pa.array([dims] * len(upper), pa.int64()), pa.array(range(len(upper)), pa.int64()), pa.array(upper, pa.float64())], ["dims", "k", "v"])

    added = rows.select("vector").mapInArrow(add, "dims long, k long, v double").groupBy("dims", "k").agg(F.sum("v").alias("v"))
    out = {dims: np.zeros((width(dims),) * 2) for dims in lengths}
    for r in added.collect():  # one number a pair of dimensions of each length
        g = out[r["dims"]]
        i, j = (int(t[r["k"]]) for t in np.triu_indices(len(g)))
        g[i, j] = g[j, i] = r["v"]
    return out


def _cholesky(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper R with R'R = G + shift; the shift grows tenfold where rounding leaves G + shift indefinite."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, np.finfo(float).eps * max(1.0, np.trace(g)))


def _solve(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """rows R^-1, column by column from the left; a zero R leaves zeros."""
    if not r.any():
        return np.zeros_like(rows)
    out = np.empty_like(rows)
    for j in range(len(r)):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def r_factors(rows: DataFrame, sums: dict[int, Sums], refinements: int = 2) -> dict[int, np.ndarray]:
    """The R factor of the centred rows of each length: a shifted pass, then ``refinements`` passes on solved rows."""
    factors: dict[int, np.ndarray] = {}
    for turn in range(refinements + 1):

        def solved(dims: int, x: np.ndarray, known: dict[int, np.ndarray] = dict(factors)) -> np.ndarray:
            a = sums[dims].centred(x)
            return _solve(known[dims], a) if dims in known else a

        for dims, g in gram(rows, solved, lambda d: d, list(sums)).items():
            # The shift is of the size of the rounding in G; where rows are very many it stays small beside G.
            size = np.trace(g)
            rounding = 11 * np.finfo(float).eps * dims * (sums[dims].n + dims + 1)
            r = _cholesky(g, min(rounding, 1e-4) * size if turn == 0 else 0.0) if size else np.zeros((dims, dims))
            factors[dims] = r @ factors[dims] if turn else r
    return factors


def components(r: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling) and unit eigenvectors as columns, ``most`` at most, and the trace, from R of n centred rows.

    Directions without variance are left out. A vector's largest entry is positive.
    """
    _, s, v = np.linalg.svd(r)
    keep = min(most, int((s > s[0] * len(s) * 1e-13).sum()) if s[0] > 0 else 0)
    w = v[:keep].T
    w = w * np.sign(w[np.abs(w).argmax(axis=0), np.arange(keep)]) if keep else w
    return s[:keep] ** 2 / n, w, float((s**2).sum() / n)


def whiten(vectors: DataFrame, most: int = 8, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row and component up to ``most``.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out; all others, repeated rows and
    rows without an id among them, are fitted and returned. Vectors of different lengths are fitted apart, each length
    with its own ``n``. Directions in which no row differs have no component, so a table of equal rows gives none. ``deviation``
    is null beyond 64 bits; entries beyond 2**45 after scaling count as that. The input is read six times: stage one that is dear to make.
    """
    rows = usable(vectors, vector, id)
    sums = column_sums(rows)
    factors = r_factors(rows, sums)
    found = {dims: components(factors[dims], sums[dims].n, most) for dims in sums}

    def white(dims: int, x: np.ndarray) -> np.ndarray:
        values, w, _ = found[dims]
        return sums[dims].centred(x) @ (w / np.sqrt(values))

    errors = {d: np.abs(g / sums[d].n - np.eye(len(g))).max(initial=0.0) for d, g in gram(rows, white, lambda d: len(found[d][0]), list(sums)).items()}

    def project(batches):
        for part, dims, at, x in _blocks(batches):
            values, _, trace = found[dims]
            k = len(values)
            if not k:
                continue
            ids = part.column("vec_id").take(pa.array(np.repeat(at, k)))
            deviation = pa.array(sums[dims].deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k)))
            whole = len(at) * k
            arrays = [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(whole, sums[dims].n)), deviation]
            arrays += [pa.array(white(dims, x).reshape(-1)), pa.array(np.tile(values / trace, len(at))), pa.array(np.full(whole, float(errors[dims])))]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
