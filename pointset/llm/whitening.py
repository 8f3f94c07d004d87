"""Whitening of embeddings by a bidiagonal qd solver.

Entries become integers, so sums over all vectors and every vector's distance from the
mean are exact.  Tasks reduce their centred rows to a triangular factor block by block
(QR); the factors of tasks are merged in a tree.  Householder reflections bring the
last factor to bidiagonal form, the differential qd algorithm with shifts (dqds) finds
its singular values to high relative accuracy, and twisted factorisations give the
right singular vectors, which are the whitening directions.  No covariance matrix is
formed on the way.

Vectors of different length cannot share directions: each length is fitted on its own.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COMPONENTS = 32
# Integer entries: x = floor(SCALE * c) + OFFSET; larger entries count as not finite.
SCALE, OFFSET, LARGEST = 64.0, 1_000_000, 2.0**40
# Cells of a block of rows, factors merged in one task, cells of the factors and
# directions of the vector lengths that are fitted together.
BLOCK_CELLS, MERGED, FIT_CELLS = 1 << 20, 32, 1 << 24
# Neighbouring eigenvalues this close, relative to the larger, get their vectors together.
CLUSTER = 1e-4
EPS = np.finfo(float).eps


# The solver: one triangular factor in, directions out.


def reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit ``v`` for which ``x - 2 v (v . x)`` has its first element only."""
    size = np.abs(x).max(initial=0.0)
    if len(x) < 2 or not np.any(x[1:]):
        return None
    v = x / size
    v[0] += np.copysign(np.sqrt(v @ v), v[0])
    return v / np.sqrt(v @ v)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and ``w`` of ``r = u b w.T``, by Householder reflections."""
    a, n = np.array(r, dtype=float), len(r)
    w = np.eye(n)
    for k in range(n):
        v = reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= np.outer(2 * v, v @ a[k:, k:])
        v = reflector(a[k, k + 1 :])
        if v is not None:
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ v, 2 * v)
            w[:, k + 1 :] -= np.outer(w[:, k + 1 :] @ v, 2 * v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def dqds_step(q: list, e: list, tau: float) -> tuple[list, list, float]:
    """One differential qd transform with shift; also the least of its auxiliary values."""
    d = q[0] - tau
    least, new_q, new_e = d, [], []
    for j in range(len(e)):
        top = d + e[j]
        if top <= 0.0:
            return new_q, new_e, min(d, -tau)
        ratio = q[j + 1] / top
        new_q.append(top)
        new_e.append(e[j] * ratio)
        d = d * ratio - tau
        least = min(least, d)
    new_q.append(d)
    return new_q, new_e, least


def trailing(q: list, e: list) -> float:
    """Smaller eigenvalue of the last two rows and columns: an upper bound of the least."""
    a = q[-2] + (e[-2] if len(e) > 1 else 0.0)
    b, c = q[-1] + e[-1], q[-2] * e[-1]
    half = 0.5 * (a - b)
    root = np.hypot(half, np.sqrt(c))
    # det / larger keeps the digits of a small eigenvalue
    return max(0.0, (a * b - c) / (0.5 * (a + b) + root))


def dqds(diagonal: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, largest first."""
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(beside).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(len(diagonal))
    # A zero would stop the transforms; this lies far below what rounding leaves.
    q = np.maximum((diagonal / scale) ** 2, 1e-60).tolist()
    e = ((beside / scale) ** 2).tolist()
    found: list[float] = []
    parts = [(q, e, 0.0)]
    while parts:
        q, e, sigma = parts.pop()
        while len(q) > 1:
            least = EPS * EPS
            if e[-1] <= least * (sigma + q[-1]):
                found.append(sigma + q.pop())
                e.pop()
                continue
            # where the matrix falls apart
            at = next((j for j in range(len(e) - 1) if e[j] <= least * (sigma + min(q[j], q[j + 1]))), None)
            if at is not None:
                parts.append((q[: at + 1], e[:at], sigma))
                q, e = q[at + 1 :], e[at + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q.reverse()
                e.reverse()
            tau = trailing(q, e)
            while True:
                new_q, new_e, lowest = dqds_step(q, e, tau)
                if lowest >= 0.0 and len(new_q) == len(q):
                    break
                # too far: a late failure tells a good shift, an early one how far to go back
                tau = max(0.0, tau + lowest) * (1 - 4 * EPS) if tau + lowest > 0.5 * tau else 0.25 * tau
                tau = 0.0 if tau < EPS * EPS * (sigma + q[-1]) else tau
            q, e, sigma = new_q, new_e, sigma + tau
        found.append(sigma + q[0])
    return np.sort(np.array(found))[::-1] * scale * scale


class Twisted:
    """Twisted factorisation of ``b.T b - value``, with ``b`` bidiagonal."""

    def __init__(self, diagonal: np.ndarray, beside: np.ndarray, value: float):
        n = len(diagonal)
        tiny = max(1e-290, EPS * EPS * value)
        d, sub = diagonal * diagonal, beside / diagonal[:-1]
        down, up = np.empty(n), np.empty(n)
        self.low, self.high = np.empty(n - 1), np.empty(n - 1)
        s, p = np.empty(n), np.empty(n)
        s[0], p[-1] = -value, d[-1] - value
        for i in range(n - 1):
            down[i] = (s[i] + d[i]) or tiny
            self.low[i] = d[i] * sub[i] / down[i]
            s[i + 1] = self.low[i] * sub[i] * s[i] - value
        down[-1] = (s[-1] + d[-1]) or tiny
        for i in range(n - 2, -1, -1):
            up[i + 1] = (d[i] * sub[i] * sub[i] + p[i + 1]) or tiny
            t = d[i] / up[i + 1]
            self.high[i] = sub[i] * t
            p[i] = p[i + 1] * t - value
        up[0] = p[0]
        twist = s + p + value
        self.r = int(np.argmin(np.abs(twist)))

    def vector(self) -> np.ndarray:
        """The eigenvector that belongs to the least pivot."""
        z = np.zeros(len(self.low) + 1)
        z[self.r] = 1.0
        for i in range(self.r - 1, -1, -1):
            z[i] -= self.low[i] * z[i + 1]
        for i in range(self.r, len(z) - 1):
            z[i + 1] -= self.high[i] * z[i]
        return z / np.sqrt(z @ z)


class Shifted:
    """``b.T b - value`` eliminated with row exchanges, for steps of inverse iteration.

    Twisted factorisations exchange no rows, which is exact enough for one vector but
    not for solving where several eigenvalues agree.
    """

    def __init__(self, diagonal: np.ndarray, beside: np.ndarray, value: float):
        n = len(diagonal)
        main = diagonal * diagonal - value
        main[1:] += beside * beside
        off = diagonal[:-1] * beside
        least = EPS * max(value, np.abs(main).max(), np.abs(off).max(initial=0.0))
        # rows of the upper factor: main element and the two beside it
        self.rows, self.steps = np.zeros((n, 3)), []
        row = np.array([main[0], off[0] if n > 1 else 0.0, 0.0])
        for i in range(n - 1):
            below = np.array([off[i], main[i + 1], off[i + 1] if i + 2 < n else 0.0])
            swap = abs(below[0]) > abs(row[0])
            if swap:
                row, below = below, row
            if abs(row[0]) < least:
                row[0] = least
            ratio = below[0] / row[0]
            self.rows[i] = row
            self.steps.append((swap, ratio))
            row = np.array([below[1] - ratio * row[1], below[2] - ratio * row[2], 0.0])
        self.rows[-1] = row
        if abs(row[0]) < least:
            self.rows[-1, 0] = least

    def solve(self, b: np.ndarray) -> np.ndarray:
        """A unit vector along the solution for ``b``."""
        y, n = b.copy(), len(b)
        for i, (swap, ratio) in enumerate(self.steps):
            if swap:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= ratio * y[i]
        for i in range(n - 1, -1, -1):
            main, first, second = self.rows[i]
            known = (first * y[i + 1] if i + 1 < n else 0.0) + (second * y[i + 2] if i + 2 < n else 0.0)
            y[i] = (y[i] - known) / main
        y /= np.abs(y).max()
        return y / np.sqrt(y @ y)


def apart(z: np.ndarray, others: np.ndarray) -> np.ndarray:
    z = z - others.T @ (others @ z)
    return z / np.sqrt(z @ z)


def vectors(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of ``b.T b`` for its ``values``, in rows.

    Vectors of values that nearly agree are made orthogonal to each other, by inverse
    iteration.
    """
    scale = np.abs(diagonal).max()
    diagonal = np.where(np.abs(diagonal) < EPS * EPS * scale, EPS * EPS * scale, diagonal)
    out = np.empty((len(values), len(diagonal)))
    if len(diagonal) == 1:
        out[:] = 1.0
        return out
    rng, first = np.random.default_rng(12), 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * values[j - 1]:
            first = j
        if j == first:
            out[j] = Twisted(diagonal, beside, value).vector()
            continue
        shifted, z = Shifted(diagonal, beside, value), rng.normal(size=len(diagonal))
        for _ in range(4):
            z = shifted.solve(apart(z, out[first:j]))
        out[j] = apart(apart(z, out[first:j]), out[first:j])
    return out


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Largest squared singular values of a triangular factor, their right singular
    vectors (rows), and the sum of all squared singular values.

    Values that rounding cannot tell from zero are zero.
    """
    n = r.shape[1]
    square = np.zeros((n, n))
    square[: len(r)] = r[:n]
    total = float(np.sum(square * square))
    diagonal, beside, w = bidiagonalise(square)
    # signs do not matter to the values; with both made positive vectors change signs only
    signs = np.cumprod(np.concatenate([[1.0], np.where(diagonal[:-1] * beside < 0, -1.0, 1.0)]))
    values = dqds(diagonal, beside)
    values[values <= (n * EPS) ** 2 * values.max(initial=0.0)] = 0.0
    values = values[: min(most, n)]
    live = values > 0
    found = np.zeros((len(values), n))
    if live.any():
        z = vectors(np.abs(diagonal), np.abs(beside), values[live]) * signs
        found[live] = z @ w.T
        found /= np.where(np.sqrt(np.sum(found * found, axis=1)) > 0, np.sqrt(np.sum(found * found, axis=1)), 1.0)[:, None]
        top = np.argmax(np.abs(found), axis=1)
        found *= np.where(found[np.arange(len(found)), top] < 0, -1.0, 1.0)[:, None]
    return values, found, total


# What runs inside tasks.


def by_length(batch: pa.RecordBatch):
    """``(length, row numbers, integer entries)`` of the vectors of a batch, block by block."""
    column = batch.column("v")
    sizes = np.diff(column.offsets.to_numpy())
    for length in np.unique(sizes):
        rows = np.flatnonzero(sizes == length)
        step = max(1, BLOCK_CELLS // int(length))
        for a in range(0, len(rows), step):
            part = rows[a : a + step]
            flat = column.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False)
            yield int(length), part, np.floor(SCALE * flat).astype(np.int64).reshape(len(part), -1) + OFFSET


def add_up(batches):
    """Number and sums of the vectors of a task, a row per length."""
    held: dict[int, list] = {}
    for batch in batches:
        for length, _, x in by_length(batch):
            mine = held.setdefault(length, [0, np.zeros(length, np.int64)])
            mine[0] += len(x)
            mine[1] += x.sum(axis=0)
    for length, (n, sums) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([length], pa.int32()), pa.array([n], pa.int64()), pa.array([sums], pa.list_(pa.int64()))],
            ["dim", "n", "sums"],
        )


def triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def reduce_rows(fits: dict):
    """The triangular factor of a task's centred rows, one per length."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        part = 0
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for length, _, x in by_length(batch):
                n, sums = fits[length]
                y = (n * x - sums) / n
                held[length] = triangle(np.vstack([held[length], y]) if length in held else y)
        for length, r in held.items():
            yield factor_row(length, part, r)

    return run


def factor_row(length: int, part: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([length], pa.int32()), pa.array([part], pa.int64()), pa.array([r.astype(float).tobytes()], pa.binary())],
        ["dim", "part", "r"],
    )


def stacked(table: pa.Table) -> np.ndarray:
    length = table.column("dim")[0].as_py()
    ordered = table.sort_by("part")
    return triangle(np.vstack([np.frombuffer(r.as_py()).reshape(-1, length) for r in ordered.column("r")]))


def merge_factors(key, table):
    return pa.Table.from_batches([factor_row(key[0].as_py(), key[1].as_py(), stacked(table))])


def solve(most: int):
    def run(key, table):
        values, found, total = directions(stacked(table), most)
        return pa.Table.from_pydict(
            {
                "dim": pa.array([key[0].as_py()], pa.int32()),
                "values": pa.array([values], pa.list_(pa.float64())),
                "found": pa.array([found.ravel()], pa.list_(pa.float64())),
                "total": pa.array([total], pa.float64()),
            }
        )

    return run


def projections(fits: dict, models: dict):
    """For ``(length, x)``: exact gaps ``n x - sums`` and whitened coordinates."""

    def of(length: int, x: np.ndarray):
        n, sums = fits[length]
        values, found, _ = models[length]
        gaps = n * x - sums
        with np.errstate(divide="ignore", invalid="ignore"):
            return gaps, ((gaps / n) @ found.T) / np.sqrt(values / n)

    return of


def measure(fits: dict, models: dict):
    """Sums of products of a task's whitened coordinates, a row per length."""
    project = projections(fits, models)

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in by_length(batch):
                white = project(length, x)[1][:, models[length][0] > 0]
                held[length] = held.get(length, 0.0) + white.T @ white
        for length, sums in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([length], pa.int32()), pa.array([sums.ravel()], pa.list_(pa.float64()))], ["dim", "products"]
            )

    return run


def squares(gaps: np.ndarray) -> pa.Array:
    """Exact sums of squares; null where they do not fit a long."""
    rough = np.sum(np.square(gaps.astype(float)), axis=1)
    if rough.max(initial=0.0) < 2.0**62:
        return pa.array(np.sum(gaps * gaps, axis=1))
    exact = [sum(int(g) ** 2 for g in row) for row in gaps]
    return pa.array([s if s < 1 << 63 else None for s in exact], pa.int64())


def whitened_rows(fits: dict, models: dict, errors: dict, id_type: pa.DataType):
    project = projections(fits, models)

    def run(batches):
        for batch in batches:
            for length, rows, x in by_length(batch):
                values, _, total = models[length]
                gaps, white = project(length, x)
                k, m = len(values), len(rows)
                live = np.tile(values > 0, m)
                error = errors.get(length)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(np.repeat(rows, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, fits[length][0], np.int64)),
                        squares(gaps).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(white.ravel(), mask=~live),
                        pa.array(np.tile(values / total if total > 0 else values, m), mask=np.full(m * k, total <= 0)),
                        pa.array(np.full(m * k, 0.0 if error is None else error), mask=np.full(m * k, error is None)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of ``vec_id, embedding``: a row per vector and component.

    Columns ``vec_id, component, n, deviation, whitened, explained, identity_error``.
    Entries ``c`` become ``floor(64 c) + 1000000``; components are the eigenvectors of
    their covariance (divisor ``n``) by falling eigenvalue, up to ``components`` of
    them, each with its largest entry positive.  ``deviation`` is the exact sum of
    squares of ``n`` times a vector minus the sums of all (null beyond a long),
    ``identity_error`` the largest entry of the whitened covariance minus the identity,
    measured over all vectors.

    Vectors that are null, empty, or hold null or non-finite entries (or any of 2^40 or
    more) are dropped.  Vectors of one length are fitted together, those of other
    lengths on their own.  Rows that repeat count and are returned each; null ids stay.
    Components without variance (one vector, constant or dependent entries) have
    ``explained`` 0 and a null ``whitened``; without any variance ``explained`` and
    ``identity_error`` are null.  An empty table gives no rows; other columns are not
    read.  A vector and a triangular factor of its length squared fit into memory.
    """
    v = F.col("embedding").cast("array<double>")
    good = (F.size(v) > 0) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LARGEST))
    rows = table.select("vec_id", v.alias("v")).where(F.coalesce(good, F.lit(False)))
    kind = table.schema["vec_id"].dataType.simpleString()
    id_type = table.select("vec_id").limit(0).toArrow().schema.field("vec_id").type
    partial = rows.select("v").mapInArrow(add_up, "dim int, n long, sums array<long>")
    counted = partial.select("dim", "n", F.posexplode("sums").alias("pos", "s"))
    summed = counted.groupBy("dim", "pos").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    # at most as many numbers as the longest vector squared
    fits: dict[int, tuple] = {}
    for row in summed.groupBy("dim").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "s"))).alias("l")).collect():
        fits[row.dim] = (row.n, np.array([item.s for item in row.l], np.int64))
    out, left = None, sorted(fits)
    while left:
        batch = [left.pop(0)]
        while left and sum(d * d for d in batch) + left[0] ** 2 <= FIT_CELLS:
            batch.append(left.pop(0))
        own = rows if len(batch) == len(fits) else rows.where(F.size("v").isin(batch))
        some = _whiten_lengths(own, {d: fits[d] for d in batch}, components, kind, id_type)
        out = some if out is None else out.unionAll(some)
    shape = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return out if out is not None else table.sparkSession.createDataFrame([], shape)


def _whiten_lengths(rows: DataFrame, fits: dict, components: int, kind: str, id_type: pa.DataType) -> DataFrame:
    numbered = rows.select("v", F.spark_partition_id().cast("long").alias("part"))
    factors = materialize(numbered.mapInArrow(reduce_rows(fits), "dim int, part long, r binary"), "factors")
    parts = factors.agg(F.max("part").alias("m")).head().m + 1
    while parts > MERGED:
        group = F.floor(F.col("part") / MERGED).cast("long").alias("group")
        merged = materialize(
            factors.groupBy("dim", group).applyInArrow(merge_factors, "dim int, part long, r binary"), "factors"
        )
        discard(factors)
        factors, parts = merged, -(-parts // MERGED)
    solved = factors.groupBy("dim").applyInArrow(
        solve(components), "dim int, values array<double>, found array<double>, total double"
    )
    models = {
        row.dim: (np.array(row["values"]), np.array(row.found).reshape(-1, row.dim), row.total) for row in solved.collect()
    }
    discard(factors)
    products = rows.select("v").mapInArrow(measure(fits, models), "dim int, products array<double>")
    cells = products.select("dim", F.posexplode("products").alias("pos", "p")).groupBy("dim", "pos").agg(F.sum("p").alias("p"))
    errors: dict[int, float] = {}
    for row in cells.collect():
        k = int((models[row.dim][0] > 0).sum())
        gap = abs(row.p / fits[row.dim][0] - (row.pos // k == row.pos % k))
        errors[row.dim] = max(errors.get(row.dim, 0.0), gap)
    return rows.mapInArrow(
        whitened_rows(fits, models, errors, id_type),
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double",
    )
