"""Lloyd iterations."""

from __future__ import annotations

import math
import time

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.durable import Cache, discard, is_kept, materialize, measured
from ..sources.runlog import RunLog
from . import kernels
from .nearest import assign, centroid_table, local_centroids, update_centroids
from .state import in_blocks, keep_points

# Elements per partial-sum row, so that any dimensionality gives the same plan.
CHUNK = 32
# Partial rows that are merged on the driver instead of in a shuffle.
MERGE_ROWS = 10_000
# Share of the points looked at again from which the next iteration renews their bounds.
LOOSE = 0.3
# Relative movement below which centroids count as unmoved (rounding only).
STILL = 1e-13


def partial_table(pts: DataFrame, ids: np.ndarray, c: np.ndarray, weight: str | None = None) -> DataFrame:
    """One fused step per task: assign, count, cost and vector sums per centroid.

    The points are read once and stay where they are; a task leaves at most one
    row per centroid and chunk.
    """
    mass = [F.col(weight).cast("double").alias("w")] if weight else []
    run = kernels.partial_sums(ids, c, chunk_of(c), weight is not None)
    columns = ["n", "x"] if in_blocks(pts) else ["x", *mass]
    return pts.select(*columns).mapInArrow(run, kernels.PARTIAL_SUMS)


def step_sums(pts: DataFrame, ids: np.ndarray, c: np.ndarray, weight: str | None = None) -> DataFrame:
    """The partial rows of all tasks, added up per centroid and chunk."""
    return _added(partial_table(pts, ids, c, weight), chunk_of(c))


def _added(partial: DataFrame, chunk: int) -> DataFrame:
    sums = ", ".join(f"sum(s[{j}])" for j in range(chunk))
    return partial.groupBy("cid", "chunk").agg(
        F.sum("n").alias("n"), F.sum("w").alias("w"), F.sum("sd2").alias("sd2"), F.expr(f"array({sums}) AS s")
    )


def chunk_of(c: np.ndarray) -> int:
    return max(1, min(CHUNK, c.shape[1]))


def lloyd_step(
    pts: DataFrame, ids: np.ndarray, c: np.ndarray, weight: str | None = None, tasks: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """New ids, centroids, sizes and the cost against the old centroids.

    If the number of ``tasks`` is known and leaves few partial rows, they are
    added up right here, which saves the shuffle.
    """
    chunk, dim = chunk_of(c), c.shape[1]
    n_chunks = max(1, -(-dim // chunk))
    few = tasks is not None and tasks * len(ids) * n_chunks <= MERGE_ROWS
    rows = (partial_table if few else step_sums)(pts, ids, c, weight).toArrow()
    if not rows.num_rows:
        raise ValueError("no points to cluster")
    kept, n, w, sd2, sums = _merged(rows, n_chunks, dim)
    mass = w if weight else n
    return kept, sums / mass[:, None], n.astype(np.int64), float(sd2.sum())


def _merged(rows, n_chunks: int, dim: int):
    """Ids, counts, masses, costs and vector sums of partial rows, added up per centroid."""
    column = {name: rows.column(name).to_numpy() for name in ("cid", "chunk", "n", "w", "sd2")}
    kept, slot = np.unique(column["cid"], return_inverse=True)
    parts = kernels.matrix(rows.column("s"))
    sums = np.zeros((len(kept), n_chunks, parts.shape[1]))
    np.add.at(sums, (slot, column["chunk"]), parts)
    # Counts are repeated in every chunk of a centroid.
    head = column["chunk"] == 0
    n, w, sd2 = (
        np.bincount(slot[head], weights=column[name][head], minlength=len(kept)) for name in ("n", "w", "sd2")
    )
    return kept.astype(np.int64), n, w, sd2, sums.reshape(len(kept), -1)[:, :dim]


def lloyd(
    pts: DataFrame,
    cents: DataFrame,
    max_iter: int,
    tol: float | None = 1e-3,
    weight: str | None = None,
    log: RunLog | None = None,
    cache: str = "none",
    bounds: bool = False,
    tasks: int | None = None,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """Lloyd iterations from ``cents``; returns ``(cid, c, n)``.

    Stops after ``max_iter`` iterations or once the cost gains less than ``tol``.
    With ``tol=None`` it only stops early when no centroid moves any more, which
    leaves the result as it is.  The cost of an iteration is measured against
    the centroids it starts from.  Centroids without points are dropped, ids
    stay as they are.

    With ``bounds`` points are kept with the distance to their centroid and a bound for
    all others (in a table of the shared folder if ``cache`` keeps nothing).  Only
    points that centroids may have moved past are looked at again, and sums change by
    those that go over to another cluster.  Weighted points do without.

    ``tasks`` is the number of partitions at most, if it is known and cannot be asked for;
    ``vectors`` are those of the points if they are kept already (``keep_points``).

    The log gets the cost, the time, the rows and the distances measured of every
    iteration, from the job that does it.
    """
    if bounds and weight:
        raise ValueError("bounds are kept for points without weights only")
    log = log or RunLog()
    policy = Cache(cache)
    with log.timed("lloyd"):
        small = local_centroids(cents)
        if small is None or weight:
            base = policy.hold_once(pts, pts.select("x", *([weight] if weight else [])))
        else:
            base = keep_points(pts, policy) if vectors is None else vectors
        if small is not None and bounds:
            result = _lloyd_by_bounds(base, *small, max_iter, tol, log, policy)
        elif small is None:
            result = _lloyd_as_tables(base, cents, max_iter, tol, weight, log)
        else:
            if tasks is None and (policy.keeps or is_kept(pts)):
                tasks = base.rdd.getNumPartitions()
            result = _lloyd_small(base, *small, max_iter, tol, weight, log, tasks)
    if base is not vectors:
        policy.release_once(pts, base)
    return result


def _converged(costs: list[float], tol: float | None) -> bool:
    return tol is not None and len(costs) > 1 and costs[-1] > (1 - tol) * costs[-2]


def _log_step(log: RunLog, t: int, start: float, cost: float, rows: float, distances: float) -> None:
    log.add("lloyd", "CostsKmeans", cost, t)
    log.add("lloyd", "nRows", rows, t)
    log.add("lloyd", "nDistances", distances, t)
    log.add("lloyd", "tIterations", time.perf_counter() - start, t)


def _still(ids: np.ndarray, c: np.ndarray, kept: np.ndarray, moved: np.ndarray) -> bool:
    return len(kept) == len(ids) and bool(np.all(np.abs(moved - c) <= STILL * (1 + np.abs(c))))


def _lloyd_small(base, ids, c, max_iter, tol, weight, log, tasks) -> DataFrame:
    costs: list[float] = []
    n = np.zeros(len(ids), dtype=np.int64)
    for t in range(max_iter):
        start = time.perf_counter()
        kept, moved, n, value = lloyd_step(base, ids, c, weight, tasks)
        still, k = _still(ids, c, kept, moved), len(ids)
        ids, c = kept, moved
        costs.append(value)
        _log_step(log, t, start, value, n.sum(), n.sum() * k)
        if _converged(costs, tol) or (tol is None and still):
            break
    return centroid_table(base.sparkSession, ids, c, n=n)


def _lloyd_by_bounds(base, ids, c, max_iter, tol, log, policy) -> DataFrame:
    """Iterations that look at those points only whose centroid may have changed.

    A generation holds the points with their centroid, the distance to it and a lower
    bound for all others; its sums are on the driver.  Centroids move since by known
    distances: where the one plus its centroid's way is less than the other minus the
    longest way, the point stays, and its vector is not looked at.  When too many points
    do not, the next iteration is a generation.
    """
    costs: list[float] = []
    n = np.zeros(len(ids), dtype=np.int64)
    generation = None
    for t in range(max_iter):
        start = time.perf_counter()
        if generation is None:
            generation = Generation(base, ids, c, policy)
            found = generation.sums
            loose, distances = 0, found.total * len(ids)
        else:
            found, loose, full = generation.since(ids, c)
            distances = loose + full * len(ids)
        kept, moved, n, value = found.centroids(), found.means(), found.counts(), found.cost(ids, c)
        still = _still(ids, c, kept, moved)
        ids, c = kept, moved
        costs.append(value)
        _log_step(log, t, start, value, found.total, distances)
        if _converged(costs, tol) or (tol is None and still):
            break
        if loose > LOOSE * found.total:
            generation = generation.close()
    if generation is not None:
        generation.close()
    return centroid_table(base.sparkSession, ids, c, n=n)


class ClusterSums:
    """Counts and vector sums of the clusters, and the squares of all points.

    Vectors are taken from ``origin``, a point amid the centroids, so that the cost,
    a difference, keeps its digits.
    """

    def __init__(self, origin: np.ndarray, squares: float, sums: dict[int, tuple[int, np.ndarray]]):
        self.origin, self.squares = origin, squares
        self.sums = {cid: part for cid, part in sums.items() if part[0] > 0}
        self.total = sum(part[0] for part in sums.values())

    def centroids(self) -> np.ndarray:
        return np.array(sorted(self.sums), dtype=np.int64)

    def counts(self) -> np.ndarray:
        return np.array([self.sums[cid][0] for cid in sorted(self.sums)], dtype=np.int64)

    def means(self) -> np.ndarray:
        return np.array([self.sums[cid][1] / self.sums[cid][0] + self.origin for cid in sorted(self.sums)])

    def cost(self, ids: np.ndarray, c: np.ndarray) -> float:
        """Squared distances of all points to the centroids ``c`` they belong to."""
        at = {int(cid): row - self.origin for cid, row in zip(ids, c)}
        gains = [2.0 * (at[cid] @ s) - n * (at[cid] @ at[cid]) for cid, (n, s) in self.sums.items()]
        return max(0.0, self.squares - math.fsum(gains))

    def moved(self, changes: dict[int, tuple[int, np.ndarray]]) -> ClusterSums:
        """The sums after points, with their plain vectors, left and joined clusters."""
        sums = dict(self.sums)
        for cid, (n, s) in changes.items():
            before = sums.get(cid, (0, np.zeros(len(self.origin))))
            sums[cid] = (before[0] + n, before[1] + s - n * self.origin)
        return ClusterSums(self.origin, self.squares, sums)


class Generation:
    """All points with their nearest centroid and what bounds their distances."""

    def __init__(self, base: DataFrame, ids: np.ndarray, c: np.ndarray, policy: Cache):
        self.ids, self.c, self.policy = ids, c, policy
        frame = base.mapInArrow(kernels.bounded_blocks(ids, c), kernels.BOUNDED_BLOCKS)
        self.df = policy.hold(frame) if policy.keeps else materialize(frame, "bounds")
        origin, chunk = c.mean(axis=0), chunk_of(c)
        partial = self.df.mapInArrow(kernels.centred_sums(ids, origin, chunk), kernels.PARTIAL_SUMS)
        rows = _added(partial, chunk).toArrow()
        if not rows.num_rows:
            raise ValueError("no points to cluster")
        names, n, _, squares, sums = _merged(rows, max(1, -(-c.shape[1] // chunk)), c.shape[1])
        parts = {int(cid): (int(m), s) for cid, m, s in zip(names, n, sums)}
        self.sums = ClusterSums(origin, math.fsum(squares), parts)

    def since(self, ids: np.ndarray, c: np.ndarray) -> tuple[ClusterSums, int, int]:
        """The sums for centroids that moved since, the points that were looked at and
        those of them that were measured against all centroids."""
        ways = np.full(int(self.ids.max()) + 1, np.inf)
        at = np.searchsorted(self.ids, ids)
        gaps = np.sqrt(np.sum((self.c[at] - c) ** 2, axis=1))
        ways[ids] = gaps
        longest = float(gaps.max())
        chunk = chunk_of(c)
        run = kernels.shifted_sums(ids, c, ways, longest, chunk)
        partial = self.df.mapInArrow(run, kernels.PARTIAL_SUMS)
        rows = _added(partial, chunk).toArrow()
        names, n, w, _, sums = _merged(rows, max(1, -(-c.shape[1] // chunk)), c.shape[1])
        facts = dict(zip(names.tolist(), zip(n.astype(int).tolist(), sums)))
        seen = facts.pop(-1)[0]
        return self.sums.moved(facts), seen, int(w[names == -1][0])

    def close(self) -> None:
        if not self.policy.keeps:
            discard(self.df)
        else:
            self.policy.release(self.df)


def _lloyd_as_tables(base, cents, max_iter, tol, weight, log) -> DataFrame:
    """The same iterations for centroid sets that do not fit a task."""
    costs: list[float] = []
    current, written = cents.select("cid", "c"), None
    k = None
    for t in range(max_iter):
        start = time.perf_counter()
        live = base.where(F.col(weight) > 0) if weight else base
        k = current.count() if k is None else k
        assigned, seen = measured(assign(live, current), "assigned", cost=F.sum("d2"), rows=F.count("*"))
        if not seen["rows"]:
            raise ValueError("no points to cluster")
        costs.append(float(seen["cost"]))
        moved, left = measured(update_centroids(assigned, weight).select("cid", "c", "n"), "centroids", k=F.count("*"))
        discard(assigned)
        still = tol is None and _unmoved(current, moved)
        current = moved
        if written is not None:
            discard(written)
        written = moved
        _log_step(log, t, start, costs[-1], seen["rows"], seen["rows"] * k)
        k = left["k"]
        if _converged(costs, tol) or still:
            break
    return current


def _unmoved(before: DataFrame, after: DataFrame) -> bool:
    """Whether all centroids are left and none moved by more than rounding."""
    pair = before.select("cid", F.col("c").alias("_b")).join(after.select("cid", "c"), "cid", "left")
    gaps = F.zip_with("c", "_b", lambda a, b: F.abs(a - b) > STILL * (1 + F.abs(b)))
    moved = F.col("c").isNull() | F.exists(gaps, lambda g: g)
    return pair.where(moved).isEmpty()
