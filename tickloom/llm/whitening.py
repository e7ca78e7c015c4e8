"""Embedding whitening: blockwise QR of centred rows, Householder bidiagonalisation, dqds, twisted factorisations."""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import written

SCALE = 1024.0
OFFSET = 100_000
COMPONENTS = 8
ROWS_AT_ONCE = 2048
STATE_BYTES = 64 << 20
MOST_MERGED = 32
EPS = np.finfo(float).eps
_CLOSE = 1e-3
_LONG = 1 << 63


# --- the small dense part: a bidiagonal matrix, its singular values, its right singular vectors ---


def _reflector(x: np.ndarray) -> np.ndarray:
    """Unit u so that x - 2 u (u . x) has only its first entry; zeros where nothing is to be done."""
    u = x.copy()
    size = np.linalg.norm(u)
    if size == 0.0 or len(x) == 1:
        return np.zeros_like(u)
    u[0] += np.copysign(size, u[0])
    return u / np.linalg.norm(u)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, v) of the upper bidiagonal matrix b with r = u b v', u and v orthogonal."""
    a, d = np.array(r, float), len(r)
    v = np.eye(d)
    for k in range(d):
        u = _reflector(a[k:, k])
        a[k:, k:] -= 2.0 * np.outer(u, u @ a[k:, k:])
        if k + 2 < d:
            u = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= 2.0 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _shifts(q: list[float], e: list[float]) -> Iterator[float]:
    """Shifts to try, falling: the least pivot of a step without a shift bounds the least eigenvalue from above, one over
    the trace of the inverse, the sum of the pivots' inverses, from below. The last one, 0, is always allowed."""
    d = least = q[0]
    inverse = 1.0 / d if d > 1e-300 else float("inf")
    for k in range(len(e)):
        following = d + e[k]
        d = d * (q[k + 1] / following) if following > 0.0 else 0.0
        least = min(least, d)
        inverse += 1.0 / d if d > 1e-300 else float("inf")
    below = (1.0 - 8.0 * EPS * len(q)) / inverse
    yield from (least * (1.0 - 4.0 * EPS), (least + below) / 2, (least + 7.0 * below) / 8, below, below / 2, 0.0)


def _negligible(q: list[float], e: list[float], shifted: float, k: int) -> bool:
    """Whether leaving e[k] out changes the values by rounding only, relatively to each, or to what is shifted off already."""
    if e[k] <= EPS**2 * min(q[k], q[k + 1]) or e[k] < 1e-290:
        return True
    return e[k] <= EPS * shifted / 4 and q[k] * e[k] <= (EPS * shifted / 4) ** 2


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """The qd arrays of the next bidiagonal matrix, whose squared singular values lie lower by ``shift``; None if it is too large."""
    d, qs, es = q[0] - shift, [], []
    for k in range(len(e)):
        if d < 0.0:
            return None
        following = d + e[k]
        ratio = q[k + 1] / following if following > 0.0 else 0.0
        qs.append(following)
        es.append(e[k] * ratio)
        d = d * ratio - shift
    if d < 0.0:
        return None
    return [*qs, d], es


def dqds(diagonal: np.ndarray, superdiagonal: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling, by the differential qd algorithm with shifts.

    A shift above the least eigenvalue makes a pivot negative and is taken back, so all quantities stay positive and
    each value keeps its relative accuracy.
    """
    found: list[float] = []
    blocks = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in superdiagonal], 0.0)]
    while blocks:
        q, e, shifted = blocks.pop()
        steps = 0
        while q:
            if len(q) == 1:
                found.append(q[0] + shifted)
                break
            cut = next((k for k in reversed(range(len(e))) if _negligible(q, e, shifted, k)), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], shifted))
                q, e, steps = q[cut + 1 :], e[cut + 1 :], 0
                continue
            if q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            for shift in _shifts(q, e):
                if (following := _dqds_step(q, e, shift)) is not None:
                    break
            (q, e), shifted, steps = following, shifted + shift, steps + 1
            if steps > 100 + 10 * len(q):
                raise ArithmeticError("the qd iteration does not end")
    return np.sort(np.array(found))[::-1]


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, float, float]:
    """Unit eigenvector of b'b for an eigenvalue, its Rayleigh correction and its residual.

    A stationary qd transform runs down, a progressive one up; where they meet with the least pivot the factorisation
    is twisted, and the vector follows from there in both directions without a solve.
    """
    n = len(a)
    tiny = EPS * max(value, 1e-100)
    lower, upper = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + a[i] ** 2
        pivot = pivot if abs(pivot) > tiny * EPS else tiny * EPS
        lower[i] = a[i] * b[i] / pivot
        s[i + 1] = b[i] ** 2 * (s[i] / pivot) - value
    p[n - 1] = a[n - 1] ** 2 - value
    for i in range(n - 2, -1, -1):
        pivot = b[i] ** 2 + p[i + 1]
        pivot = pivot if abs(pivot) > tiny * EPS else tiny * EPS
        upper[i] = a[i] * b[i] / pivot
        p[i] = a[i] ** 2 * (p[i + 1] / pivot) - value
    gamma = s + p + value
    gamma[n - 1] = s[n - 1] + a[n - 1] ** 2
    k = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -upper[i] * z[i]
    size = np.linalg.norm(z)
    return z / size, gamma[k] / size**2, abs(gamma[k]) / size


def _apart(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in others:
            z = z - other * (other @ z)
    return z


def _block_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """Orthonormal eigenvectors of b'b for falling eigenvalues of one unreduced block.

    A value apart from the others takes its twisted vector. Within a cluster, twisted vectors may lean on each other:
    there each is made orthogonal to those before it and refined by inverse iteration.
    """
    full = np.diag(a**2 + np.r_[0.0, b**2]) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    norm = np.abs(full).sum(axis=1).max()
    found: list[np.ndarray] = []
    cluster: list[np.ndarray] = []
    for i, value in enumerate(values):
        if i and values[i - 1] - value > _CLOSE * values[i - 1]:
            cluster = []
        z, change, residual = twisted_vector(a, b, value)
        for _ in range(3):
            if residual <= 4 * EPS * norm:
                break
            other, *rest = twisted_vector(a, b, value + change)
            if rest[1] >= residual:
                break
            z, (step, residual) = other, rest
            change += step
        if cluster:
            z = _apart(z, cluster)
            if np.linalg.norm(z) < 0.1:
                z = _apart(np.random.default_rng(i).standard_normal(len(a)), cluster)
            z /= np.linalg.norm(z)
            shifted = full - (value + EPS * norm * (1 + len(cluster))) * np.eye(len(a))
            for _ in range(4):
                z = _apart(np.linalg.solve(shifted, z), cluster)
                z /= np.linalg.norm(z)
        cluster.append(z)
        found.append(z)
    return found


def principal(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, directions as columns): the largest eigenvalues of r'r, falling, and unit eigenvectors.

    Each direction's largest entry is positive.
    """
    d = len(r)
    size = np.abs(r).max(initial=0.0)
    if size == 0.0:
        return np.zeros(min(components, d)), np.eye(d)[:, : min(components, d)]
    a, b, v = bidiagonal(r / size)
    norm = max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    b[np.abs(b) <= EPS * norm] = 0.0
    a[np.abs(a) <= EPS * EPS * norm] = 0.0
    starts = [0, *(np.flatnonzero(b == 0.0) + 1).tolist(), d]
    every = []
    for start, end in zip(starts, starts[1:]):
        values = dqds(a[start:end], b[start : end - 1])
        every += [(value, start, end, k) for k, value in enumerate(values.tolist())]
    top = sorted(every, key=lambda x: (-x[0], x[1], x[3]))[:components]
    wanted = {start: [x[0] for x in top if x[1] == start] for _, start, _, _ in top}
    vectors = {}
    for _, start, end, _ in top:
        if start not in vectors:
            vectors[start] = _block_vectors(a[start:end], b[start : end - 1], np.array(wanted[start]))
    directions = np.zeros((d, len(top)))
    for column, (_, start, end, k) in enumerate(top):
        directions[:, column] = v[:, start:end] @ vectors[start][k]
    directions /= np.linalg.norm(directions, axis=0)
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), range(len(top))])
    return np.array([x[0] for x in top]) * size**2, directions * signs


# --- the passes over all vectors ---


def _matrices(batches, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches, with their vectors as whole numbers."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(at, ROWS_AT_ONCE)
            vectors = batch.column(column)
            sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            if len(set(sizes.tolist())) > 1:
                raise ValueError("vectors of different lengths")
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            scaled = np.floor(SCALE * flat)
            if np.abs(scaled).max(initial=0.0) >= 2.0**61:
                raise ValueError("entries beyond the range of whole numbers")
            yield batch, scaled.astype(np.int64).reshape(batch.num_rows, -1) + OFFSET


def _combined(parts: DataFrame, merge: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """One state from the states (part, state) of all tasks, merged in a tree; only the last few reach the driver."""
    schema = "part bigint, state array<double>"
    level = written(parts, "states")
    while True:
        size = level.agg(F.max(F.size("state"))).first()[0]
        if size is None:
            return None
        fan = int(min(MOST_MERGED, max(2, STATE_BYTES // (8 * size))))
        if level.count() <= fan:
            break

        def together(table: pa.Table) -> pa.Table:
            rows = sorted(zip(table["part"].to_pylist(), table["state"].to_pylist(), strict=True))
            state = np.array(rows[0][1])
            for _, other in rows[1:]:
                state = merge(state, np.array(other))
            return pa.table({"part": pa.array([rows[0][0] // fan], pa.int64()), "state": pa.array([state.tolist()], pa.list_(pa.float64()))})

        ranked = level.withColumn("to", F.expr(f"part div {fan}"))
        level = written(ranked.groupBy("to").applyInArrow(lambda t: together(t.select(["part", "state"])), schema), "states")
    state = None
    for row in sorted(level.collect()):
        state = np.array(row.state) if state is None else merge(state, np.array(row.state))
    return state


def _states(rows: DataFrame, fold: Callable[[np.ndarray | None, np.ndarray], np.ndarray]) -> DataFrame:
    """(part, state): what each task has folded its vectors into."""

    def run(batches):
        state = None
        for _, x in _matrices(batches, 0):
            state = fold(state, x)
        if state is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([state.ravel().tolist()], pa.list_(pa.float64()))], ["part", "state"]
            )

    return rows.select("vector").mapInArrow(run, "part bigint, state array<double>")


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of each dimension."""

    def run(batches):
        n, total = 0, None
        for _, x in _matrices(batches, 0):
            if total is not None and len(total) != x.shape[1]:
                raise ValueError("vectors of different lengths")
            total = total or [0] * x.shape[1]
            small = np.abs(x).max() < 1 << 50
            own = x.sum(axis=0).tolist() if small else [sum(c) for c in x.T.tolist()]
            total = [a + b for a, b in zip(total, own, strict=True)]
            n += len(x)
        if n:
            dims = range(len(total))
            values = pa.array([decimal.Decimal(t) for t in total], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(dims, pa.int32()), pa.array([n] * len(total), pa.int64()), values], ["dim", "n", "total"]
            )

    parts = rows.select("vector").mapInArrow(run, "dim int, n bigint, total decimal(38,0)")
    found = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dim").collect()
    if len({r.n for r in found}) > 1:
        raise ValueError("vectors of different lengths")
    return (found[0].n if found else 0), [int(r.total) for r in found]


class Centre:
    """n * x - S of whole-number vectors, exactly, and x - S / n."""

    def __init__(self, n: int, total: list[int]) -> None:
        self.n, self.total = n, total
        self.most = max(map(abs, total), default=0)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        if self.n * (int(np.abs(x).max(initial=0)) + 1) + self.most < _LONG:
            return x * self.n - np.array(self.total, np.int64)
        return x.astype(object) * self.n - np.array(self.total, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n

    def squares(self, x: np.ndarray) -> np.ndarray:
        """Exact sum of squared deviations of each vector."""
        apart = self.deviations(x)
        if apart.dtype != object and apart.shape[1] * int(np.abs(apart).max(initial=0)) ** 2 < _LONG:
            return (apart * apart).sum(axis=1)
        exact = [sum(int(v) ** 2 for v in row) for row in apart]
        if max(exact, default=0) >= _LONG:
            raise OverflowError("a sum of squared deviations does not fit a long")
        return np.array(exact, np.int64)


def triangle(rows: DataFrame, centre: Centre) -> np.ndarray:
    """The triangular factor of all centred vectors: its product with itself is n times their covariance."""
    d = len(centre.total)

    def fold(state, x):
        block = centre.centred(x)
        return np.linalg.qr(block if state is None else np.vstack([state, block]), mode="r")

    def merge(a, b):
        return np.linalg.qr(np.vstack([a.reshape(-1, d), b.reshape(-1, d)]), mode="r").ravel()

    found = _combined(_states(rows, fold), merge).reshape(-1, d)
    return np.vstack([found, np.zeros((d - len(found), d))]) if len(found) < d else found


def covariance(rows: DataFrame, centre: Centre, matrix: np.ndarray) -> np.ndarray:
    """Covariance of the projected vectors, divisor n, centred before multiplying; blocks are merged by their means."""
    k = matrix.shape[1]

    def joined(a, b):
        n, m = a[0], b[0]
        apart = b[1 : k + 1] - a[1 : k + 1]
        mean = a[1 : k + 1] + apart * (m / (n + m))
        products = a[k + 1 :] + b[k + 1 :] + np.outer(apart, apart).ravel() * (n * m / (n + m))
        return np.r_[n + m, mean, products]

    def fold(state, x):
        w = centre.centred(x) @ matrix
        mean = w.mean(axis=0)
        own = np.r_[float(len(w)), mean, ((w - mean).T @ (w - mean)).ravel()]
        return own if state is None else joined(state, own)

    found = _combined(_states(rows, fold), joined)
    return found[k + 1 :].reshape(k, k) / found[0]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows whose vector has entries, all of them finite."""
    finite = F.forall(vector_col, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return vectors.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite).select(
        F.col(id_col).alias("id"), F.col(vector_col).alias("vector")
    )


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every vector on the principal directions of all of them, scaled to variance 1.

    Columns: the id, ``component`` (from 1, by falling variance), ``n`` (vectors used), ``deviation`` (exact sum over
    dimensions of (n * x - S)^2), ``whitened``, ``explained`` (share of the total variance), ``identity_error``
    (largest absolute entry of the whitened covariance minus the identity). x is floor(1024 * entry) + 100000, S its sum.
    One row per usable vector and component, repeated rows and NULL ids included; as many components as asked for or as
    there are dimensions. Rows with a NULL or empty vector, or one with a NULL, infinite or NaN entry, are dropped.

    A component without variance (up to rounding: constant dimensions, fewer vectors than components) has a NULL
    ``whitened`` and does not count in ``identity_error``; where there is no variance at all, ``explained`` and
    ``identity_error`` are NULL. No usable vector gives no rows. Equal variances leave the directions open: any
    orthonormal ones are given. Vectors of different lengths are a ValueError, a deviation beyond a long is an
    OverflowError. Only id and vector are read, four times: sums, blockwise QR, check and result.
    """
    rows = usable(vectors, id_col, vector_col)
    n, total = sums(rows)
    schema = (
        f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, component int, n bigint, deviation bigint, "
        "whitened double, explained double, identity_error double"
    )
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    centre = Centre(n, total)
    r = triangle(rows, centre)
    values, directions = principal(r, components)
    k = len(values)
    live = values > (len(total) * EPS) ** 2 * max(values[0], 0.0)
    matrix = directions * np.where(live, 1.0 / np.sqrt(np.where(live, values, 1.0) / n), 0.0)
    trace = float((r**2).sum())
    explained = [float(v / trace) if trace > 0 else None for v in values]
    error = None
    if live.any():
        apart = covariance(rows, centre, matrix) - np.eye(k)
        error = float(np.abs(apart[np.ix_(live, live)]).max())

    def run(batches):
        for batch, x in _matrices(batches, 1):
            rows = len(x)
            projected = (centre.centred(x) @ matrix).ravel()
            dead = np.tile(~live, rows)
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                pa.array(np.full(rows * k, n), pa.int64()),
                pa.array(np.repeat(centre.squares(x), k), pa.int64()),
                pa.array(projected, pa.float64(), mask=dead),
                pa.array(explained * rows, pa.float64()),
                pa.array([error] * (rows * k), pa.float64()),
            ]
            names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)
