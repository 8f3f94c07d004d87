"""Batch kernels that run on Arrow data inside Spark tasks.

Spark partitions, ships and aggregates; a kernel only answers, for one batch of
vectors, which of a bounded block of centroids is nearest.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Kernels travel to the workers whole, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Cells of a distance matrix held at once (doubles).
MATRIX_CELLS = 2_000_000
# Cells of a matrix of scores, which is gone over several times: it stays in the cache.
SCORE_CELLS = 131_072
# Centroids of which vectors are summed by one matrix product instead of in order.
FEW = 32
# Values of a block of points (doubles): a batch of 10,000 blocks has 40 MB.
BLOCK_CELLS = 512
# Many points to a row: the bytes of their matrix, and how many they are.
BLOCKS = "n int, x binary"

MATCH = "struct<cid:int,d2:double>"
# A match and the number of distances measured for it.
COUNTED = "struct<cid:int,d2:double,n:int>"
# Share of the distances of a batch up to which the ones that may matter are measured
# one by one; beyond it one matrix product is faster.
PICKED = 0.5
# Distances that differ by less than this, relatively, may be equal but for rounding.
SLACK = 1e-9


def matrix(vectors) -> np.ndarray:
    """Arrow list column as an ``(n, dim)`` array, without copying doubles."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values, n = vectors.flatten(), len(vectors)
    if vectors.null_count or values.null_count:
        raise ValueError("vectors must not be null or hold nulls")
    sizes = np.diff(vectors.offsets.to_numpy()) if n else np.empty(0)
    if n and np.any(sizes != sizes[0]):
        raise ValueError("vectors must have one length")
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if np.isnan(flat).any():
        raise ValueError("vectors must not hold NaN")
    return flat.reshape(n, len(flat) // n) if n else np.empty((0, 0))


def packed() -> Callable:
    """For ``mapInArrow``: points, many to a row, as the bytes of their matrix.

    The blocks of a batch lie one after the other and are one matrix to a kernel,
    without a copy; points of a row each are converted one by one in every pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"))
            if len(x):
                yield _blocks(block_sizes(batch, x), x=x)

    return run


def _blocks(sizes: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """Arrays with a row per point as the bytes of blocks of these sizes."""
    ends = np.r_[0, np.cumsum(sizes)]
    arrays = [pa.array(sizes.astype(np.int32))]
    for values in columns.values():
        width = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
        parts = [pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values).tobytes())]
        arrays.append(pa.Array.from_buffers(pa.binary(), len(sizes), [None, *parts]))
    return pa.RecordBatch.from_arrays(arrays, names=["n", *columns])


def in_blocks(batch: pa.RecordBatch) -> bool:
    return pa.types.is_binary(batch.schema.field("x").type)


def block_sizes(batch: pa.RecordBatch, x: np.ndarray) -> np.ndarray:
    """Points of every block, or of those that points ``x`` of a row each are to be put in."""
    if in_blocks(batch):
        return batch.column("n").to_numpy()
    step = max(1, BLOCK_CELLS // max(1, x.shape[1]))
    return np.minimum(step, len(x) - np.arange(0, len(x), step))


def unblocked(batch: pa.RecordBatch, name: str, dtype=np.float64) -> np.ndarray:
    """The values of all blocks of a batch, in one array."""
    column = batch.column(name)
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    data = column.buffers()[2]
    size = np.dtype(dtype).itemsize
    return np.frombuffer(data, dtype, (ends[-1] - ends[0]) // size, ends[0]) if data and ends[-1] > ends[0] else np.empty(0, dtype)


def points(batch: pa.RecordBatch) -> np.ndarray:
    """The points of a batch as a matrix, whether they have a row each or come in blocks."""
    if not in_blocks(batch):
        return matrix(batch.column("x"))
    if not batch.num_rows:
        return np.empty((0, 0))
    column, sizes = batch.column("x"), batch.column("n").to_numpy()
    lengths = np.diff(np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4))
    n = int(sizes.sum())
    dim = int(lengths[0]) // 8 // int(sizes[0])
    if np.any(lengths != sizes * dim * 8):
        raise ValueError("vectors must have one length")
    return unblocked(batch, "x").reshape(n, dim)


def pair_distances(x: np.ndarray, c: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows))
    step = max(1, MATRIX_CELLS // max(1, x.shape[1]))
    for a in range(0, len(rows), step):
        gap = x[rows[a : a + step]] - c[cols[a : a + step]]
        out[a : a + step] = np.sum(gap * gap, axis=1)
    return out


def nearest(x: np.ndarray, c: np.ndarray, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Position of the nearest row of ``c`` and the squared distance to it.

    One matrix product ranks the centroids; it loses digits to cancellation, so
    all centroids within its error bound of the best are measured again exactly.
    Equal distances go to the lowest position.  ``skip`` excludes one position
    per row (-1 for none).
    """
    n, k = len(x), len(c)
    if x.shape[1] != c.shape[1]:
        raise ValueError(f"vectors of length {x.shape[1]} cannot be compared with centroids of length {c.shape[1]}")
    where, best = np.zeros(n, dtype=np.int64), np.empty(n)
    norms = np.sum(c * c, axis=1)
    reach = np.sqrt(norms.max())
    unit = np.finfo(float).eps * 4 * (x.shape[1] + 8)
    step = max(1, SCORE_CELLS // max(k, x.shape[1]))
    for a in range(0, n, step):
        part = x[a : a + step]
        # a row per centroid: going over them is fast whatever their number
        score = norms[:, None] - 2.0 * (c @ part.T)
        if skip is not None:
            own = skip[a : a + step]
            hit = np.flatnonzero(own >= 0)
            score[own[hit], hit] = np.inf
        size = np.sqrt(np.einsum("ij,ij->i", part, part)) + reach
        close = score <= score.min(axis=0) + unit * size * size
        if skip is not None:
            close &= np.isfinite(score)
        found, rows = np.nonzero(close)
        # of several the lowest is written last, and measured below
        pos = np.zeros(len(part), dtype=np.int64)
        pos[rows[::-1]] = found[::-1]
        if len(rows) > len(part) or skip is not None:
            unsure = np.flatnonzero(np.count_nonzero(close, axis=0) > 1)
            if len(unsure):
                r, q = np.nonzero(close[:, unsure].T)
                d = pair_distances(part, c, unsure[r], q)
                order = np.lexsort((q, d, r))
                first = order[np.r_[True, r[order][1:] != r[order][:-1]]]
                pos[unsure] = q[first]
        where[a : a + step] = pos
        gap = part - c[pos]
        gap *= gap
        best[a : a + step] = np.sum(gap, axis=1)
    if skip is not None:
        best[where == skip] = np.inf
    return where, best


def _matches(ids: np.ndarray, d2: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(ids.astype(np.int32)), pa.array(d2)], names=["cid", "d2"])


def _match_udf(run: Callable):
    # Declared non-deterministic because the optimizer copies deterministic
    # functions into pushed-down filters, which runs the kernel twice per row.
    return F.arrow_udf(run, MATCH).asNondeterministic()


def nearest_column(x: Column, ids: np.ndarray, c: np.ndarray) -> Column:
    """Struct column ``(cid, d2)`` of the nearest centroid.

    Only ``x`` travels to Python and only the match comes back; Spark ships a
    large centroid block as a broadcast of the pickled function.
    """

    def run(vectors: pa.Array) -> pa.Array:
        pts = matrix(vectors)
        if not len(pts):
            return _matches(np.empty(0), np.empty(0))
        where, d2 = nearest(pts, c)
        return _matches(ids[where], d2)

    return _match_udf(run)(x)


def nearest_other_column(x: Column, own: Column, ids: np.ndarray, c: np.ndarray) -> Column:
    """Like ``nearest_column``, but a centroid never matches itself.

    ``ids`` must ascend.
    """

    def run(vectors: pa.Array, own_ids: pa.Array) -> pa.Array:
        pts, mine = matrix(vectors), own_ids.to_numpy(zero_copy_only=False)
        if not len(pts):
            return _matches(np.empty(0), np.empty(0))
        slot = np.searchsorted(ids, mine)
        slot = np.where((slot < len(ids)) & (ids[np.minimum(slot, len(ids) - 1)] == mine), slot, -1)
        where, d2 = nearest(pts, c, skip=slot)
        return _matches(ids[where], d2)

    return _match_udf(run)(x, own)


def lower_column(x: Column, cid: Column, d2: Column, ids: np.ndarray, c: np.ndarray, rank: np.ndarray | None) -> Column:
    """The better of the known match and the nearest row of ``c``.

    At equal distance the id with the lower ``rank`` wins (default: lower id).
    """

    def run(vectors: pa.Array, old_ids: pa.Array, old_d2: pa.Array) -> pa.Array:
        pts = matrix(vectors)
        if not len(pts):
            return _matches(np.empty(0), np.empty(0))
        old, known = old_ids.to_numpy(zero_copy_only=False), old_d2.to_numpy(zero_copy_only=False)
        where, found = nearest(pts, c)
        new = ids[where]
        before = rank[new] < rank[old] if rank is not None else new < old
        better = (found < known) | ((found == known) & before)
        return _matches(np.where(better, new, old), np.where(better, found, known))

    return _match_udf(run)(x, cid, d2)


def nearer(
    x: np.ndarray, old: np.ndarray, known: np.ndarray, gaps: np.ndarray | None, c: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest row of ``c`` for points with a centre ``old`` at squared distance ``known``.

    ``gaps`` holds the squared distances of all centres to the rows of ``c``.  A row at
    least twice as far from the centre as the point cannot be nearer to the point than
    the centre is, and is not measured: the position is -1 if there is no other.  Also
    returns how many distances were measured for each point.
    """
    n, k = len(x), len(c)
    where, best, counts = np.full(n, -1), np.full(n, np.inf), np.full(n, k)
    if gaps is None:
        return *nearest(x, c), counts
    step = max(1, MATRIX_CELLS // k)
    for a in range(0, n, step):
        part = slice(a, a + step)
        may = gaps[old[part]] <= (4.0 * (1.0 + SLACK)) * known[part, None]
        counts[part] = may.sum(axis=1)
        if counts[part].sum() > PICKED * may.size:
            rows = a + np.flatnonzero(counts[part])
            where[rows], best[rows] = nearest(x[rows], c)
            counts[rows] = k
            continue
        rows, cols = np.nonzero(may)
        if len(rows):
            d = pair_distances(x[part], c, rows, cols)
            order = np.lexsort((cols, d, rows))
            first = order[np.r_[True, rows[order][1:] != rows[order][:-1]]]
            where[a + rows[first]], best[a + rows[first]] = cols[first], d[first]
    return where, best, counts


def first_counted_column(x: Column, ids: np.ndarray, c: np.ndarray) -> Column:
    """Like ``nearest_column``, with the number of distances measured."""

    def run(vectors: pa.Array) -> pa.Array:
        pts = matrix(vectors)
        if not len(pts):
            return _counted(np.empty(0), np.empty(0), np.empty(0))
        where, d2 = nearest(pts, c)
        return _counted(ids[where], d2, np.full(len(pts), len(c)))

    return F.arrow_udf(run, COUNTED).asNondeterministic()(x)


def lower_counted_column(
    x: Column, cid: Column, d2: Column, ids: np.ndarray, c: np.ndarray, rank: np.ndarray, gaps: np.ndarray | None
) -> Column:
    """The better of the known match and the nearest row of ``c``, by ``nearer``.

    ``gaps`` holds the squared distances of all known centres to the rows of ``c``.  At
    equal distance the id with the lower ``rank`` wins.
    """

    def run(vectors: pa.Array, old_ids: pa.Array, old_d2: pa.Array) -> pa.Array:
        pts = matrix(vectors)
        if not len(pts):
            return _counted(np.empty(0), np.empty(0), np.empty(0))
        old, known = old_ids.to_numpy(zero_copy_only=False), old_d2.to_numpy(zero_copy_only=False)
        where, found, counts = nearer(pts, old, known, gaps, c)
        new = ids[where]
        before = (where >= 0) & (rank[new] < rank[old])
        better = (found < known) | ((found == known) & before)
        return _counted(np.where(better, new, old), np.where(better, found, known), counts)

    return F.arrow_udf(run, COUNTED).asNondeterministic()(x, cid, d2)


def _counted(ids: np.ndarray, d2: np.ndarray, counts: np.ndarray) -> pa.StructArray:
    arrays = [pa.array(ids.astype(np.int32)), pa.array(d2), pa.array(counts.astype(np.int32))]
    return pa.StructArray.from_arrays(arrays, names=["cid", "d2", "n"])


def _matched(batch: pa.RecordBatch, x: np.ndarray, ids, c, rank, gaps) -> tuple[np.ndarray, ...]:
    """Centre, squared distance and distances measured, given the ones the blocks have."""
    if "cid" not in batch.schema.names:
        where, d2 = nearest(x, c)
        return ids[where], d2, np.full(len(x), len(c))
    old, known = unblocked(batch, "cid", np.int32), unblocked(batch, "d2")
    where, found, counts = nearer(x, old, known, gaps, c)
    new = ids[where]
    better = (found < known) | ((found == known) & (where >= 0) & (rank[new] < rank[old]))
    return np.where(better, new, old), np.where(better, found, known), counts


def matched_blocks(ids: np.ndarray, c: np.ndarray, rank: np.ndarray, gaps: np.ndarray | None) -> Callable:
    """For ``mapInArrow`` over points or blocks: blocks with centres and squared distances.

    Blocks that have them get the better of these and the nearest row of ``c``, as in
    ``lower_counted_column``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = points(batch)
            if len(x):
                cid, d2, _ = _matched(batch, x, ids, c, rank, gaps)
                yield _blocks(block_sizes(batch, x), x=x, cid=cid.astype(np.int32), d2=d2)

    return run


def matched_sums(
    ids: np.ndarray, c: np.ndarray, rank: np.ndarray, gaps: np.ndarray | None, sizes: bool = False
) -> Callable:
    """For ``mapInArrow`` over points or blocks: what ``matched_blocks`` would hold, added up.

    A task leaves one row, or one per centre with ``sizes``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, d2, measured = (np.zeros(len(rank) if sizes else 1) for _ in range(3))
        for batch in batches:
            x = points(batch)
            if not len(x):
                continue
            cid, found, counts = _matched(batch, x, ids, c, rank, gaps)
            at = cid if sizes else np.zeros(len(x), dtype=np.int64)
            for total, weights in ((n, None), (d2, found), (measured, counts)):
                total += np.bincount(at, weights=weights, minlength=len(total))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used.astype(np.int32)),
                pa.array(n[used].astype(np.int64)),
                pa.array(d2[used]),
                pa.array(measured[used].astype(np.int64)),
            ],
            names=["cid", "n", "d2", "measured"],
        )

    return run


MATCHED_BLOCKS = BLOCKS + ", cid binary, d2 binary"
BOUNDED_BLOCKS = BLOCKS + ", cid binary, own binary, other binary"
MATCHED_SUMS = "cid int, n bigint, d2 double, measured bigint"


def two_nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest row of ``c``, the squared distance to it, and a lower bound of the distance
    to every other row."""
    where, d2 = nearest(x, c)
    other = np.full(len(x), np.inf)
    if len(c) > 1:
        norms = np.sum(c * c, axis=1)
        unit = np.finfo(float).eps * 4 * (x.shape[1] + 8)
        step = max(1, SCORE_CELLS // max(c.shape))
        for a in range(0, len(x), step):
            part, own = x[a : a + step], where[a : a + step]
            score = norms[:, None] - 2.0 * (c @ part.T)
            score[own, np.arange(len(part))] = np.inf
            sizes = np.einsum("ij,ij->i", part, part)
            reach = np.sqrt(sizes) + np.sqrt(norms.max())
            second = score.min(axis=0) + sizes - unit * reach * reach
            other[a : a + step] = np.sqrt(np.maximum(second, 0.0))
    return where, d2, other


def bounded_blocks(ids: np.ndarray, c: np.ndarray) -> Callable:
    """For ``mapInArrow`` over points or blocks: blocks with the nearest centroid, the
    distance to it and the bound of ``two_nearest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = points(batch)
            if len(x):
                where, d2, other = two_nearest(x, c)
                yield _blocks(block_sizes(batch, x), x=x, cid=ids[where].astype(np.int32), own=np.sqrt(d2), other=other)

    return run


def centred_sums(ids: np.ndarray, origin: np.ndarray, chunk: int) -> Callable:
    """For ``mapInArrow`` over blocks with centroids: counts, vector sums and squares per
    centroid, vectors taken from ``origin``."""
    k, dim = len(ids), len(origin)
    n_chunks = max(1, -(-dim // chunk))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, squares, total = np.zeros(k, dtype=np.int64), np.zeros(k), np.zeros((k, n_chunks * chunk))
        for batch in batches:
            x = points(batch)
            if not len(x):
                continue
            where, x = np.searchsorted(ids, unblocked(batch, "cid", np.int32)), x - origin
            count += np.bincount(where, minlength=k)
            squares += np.bincount(where, weights=np.einsum("ij,ij->i", x, x), minlength=k)
            _add_rows(total, where, x)
        used = np.flatnonzero(count)
        yield from _sum_rows(ids[used], count[used], np.zeros(len(used)), squares[used], total[used], chunk)

    return run


def _sum_rows(ids, n, w, sd2, total: np.ndarray, chunk: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``PARTIAL_SUMS``, a batch per chunk."""
    for i in range(total.shape[1] // chunk if len(ids) else 0):
        part = np.ascontiguousarray(total[:, i * chunk : (i + 1) * chunk])
        offsets = np.arange(0, part.size + 1, chunk, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.asarray(ids, dtype=np.int32)),
                pa.array(np.full(len(ids), i, dtype=np.int32)),
                pa.array(np.asarray(n, dtype=np.int64)),
                pa.array(np.asarray(w, dtype=float)),
                pa.array(np.asarray(sd2, dtype=float)),
                pa.ListArray.from_arrays(offsets, pa.array(part.ravel())),
            ],
            names=["cid", "chunk", "n", "w", "sd2", "s"],
        )


def shifted_sums(ids: np.ndarray, c: np.ndarray, ways: np.ndarray, fall: float, chunk: int) -> Callable:
    """For ``mapInArrow`` over the blocks of a generation: what leaves and joins each cluster.

    ``cid`` is a point's cluster there, whose centroid went ``ways[cid]`` since, ``own`` the
    distance to it, and ``other`` a lower bound for all others, which has fallen by at most
    ``fall``.  Where the bounds tell that the point stays its vector is not looked at.  A
    loose point still nearer to its own centroid stays, at the cost of one distance; the
    others are measured against all.  A task leaves a row per cluster that changed (and chunk), and one with
    id -1 that holds the number of points seen and of those measured against all.
    """
    k, dim = c.shape
    n_chunks = max(1, -(-dim // chunk))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: dict[int, int] = {}
        count, total = [], []
        seen = full = 0

        def add(names: np.ndarray, x: np.ndarray, sign: int) -> None:
            for name in np.unique(names):
                rows = names == name
                slot = slots.setdefault(int(name), len(slots))
                if slot == len(count):
                    count.append(0)
                    total.append(np.zeros(n_chunks * chunk))
                count[slot] += sign * int(rows.sum())
                total[slot][:dim] += sign * x[rows].sum(axis=0)

        for batch in batches:
            x = points(batch)
            if not len(x):
                continue
            old = unblocked(batch, "cid", np.int32)
            bound = unblocked(batch, "other") - fall
            passed = np.flatnonzero((unblocked(batch, "own") + ways[old]) * (1.0 + SLACK) >= bound)
            if not len(passed):
                continue
            x, old, bound = x[passed], old[passed].astype(np.int64), bound[passed]
            at = np.searchsorted(ids, old)
            live = (at < k) & (ids[np.minimum(at, k - 1)] == old)
            own = np.full(len(x), np.inf)
            some = np.flatnonzero(live)
            own[some] = np.sqrt(pair_distances(x, c, some, at[some]))
            loose = np.flatnonzero(own * (1.0 + SLACK) >= bound)
            seen, full = seen + len(x), full + len(loose)
            if not len(loose):
                continue
            new = ids[nearest(x[loose], c)[0]]
            changed = np.flatnonzero(new != old[loose])
            add(old[loose][changed], x[loose][changed], -1)
            add(new[changed], x[loose][changed], 1)
        names = [-1, *slots]
        sums = np.vstack([np.zeros(n_chunks * chunk), *total])
        nothing = np.zeros(len(names))
        yield from _sum_rows(names, [seen, *count], [float(full), *nothing[1:]], nothing, sums, chunk)

    return run


def _add_rows(total: np.ndarray, where: np.ndarray, x: np.ndarray) -> None:
    """Add every row of ``x`` to the row of ``total`` it belongs to."""
    k, dim = len(total), x.shape[1]
    if k <= FEW:
        step = max(1, SCORE_CELLS // max(k, dim))
        for a in range(0, len(x), step):
            own = where[a : a + step] == np.arange(k)[:, None]
            total[:, :dim] += own.astype(float) @ x[a : a + step]
        return
    order = np.argsort(where, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(where[order]) > 0])
    total[where[order][starts], :dim] += np.add.reduceat(x[order], starts, axis=0)


def partial_sums(ids: np.ndarray, c: np.ndarray, chunk: int, weighted: bool) -> Callable:
    """For ``mapInArrow`` over points or blocks: assign each and keep only sums per centroid.

    A task emits at most one row per centroid and chunk of ``chunk`` elements,
    however many points it reads.
    """
    k, dim = c.shape
    n_chunks = max(1, -(-dim // chunk))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, mass, cost = np.zeros(k, dtype=np.int64), np.zeros(k), np.zeros(k)
        total = np.zeros((k, n_chunks * chunk))
        for batch in batches:
            x = points(batch)
            w = batch.column("w").to_numpy(zero_copy_only=False) if weighted else None
            if weighted:
                x, w = x[w > 0], w[w > 0]
            if not len(x):
                continue
            where, d2 = nearest(x, c)
            count += np.bincount(where, minlength=k)
            mass += np.bincount(where, weights=w, minlength=k)
            cost += np.bincount(where, weights=d2, minlength=k)
            _add_rows(total, where, x if w is None else x * w[:, None])
        used = np.flatnonzero(count)
        if not len(used):
            return
        yield from _sum_rows(ids[used], count[used], mass[used], cost[used], total[used], chunk)

    return run


PARTIAL_SUMS = "cid int, chunk int, n bigint, w double, sd2 double, s array<double>"
