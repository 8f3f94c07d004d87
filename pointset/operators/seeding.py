"""Choosing start centroids."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import bound_digits, digits_of, draw_start, exponential_race, tag_dim, uniform
from ..functions.random import uniform_sql
from ..sources import durable
from ..sources.durable import Cache, discard, is_small, materialize, measured
from ..sources.points import TAKEN_ROWS, subset
from ..sources.runlog import RunLog
from . import kernels
from .iterations import lloyd
from .nearest import assign, centroid_table, cluster_sizes, cost, local_centroids
from .prepare import dense_index
from .state import BlockState, NearestState, keep_points

RECLUSTER_ITERATIONS = 100
# A round also fetches the candidates it would need if the cost fell this much, and, for
# up to AHEAD rounds, more as often as there are rounds to come.
COST_DROP = 4.0
AHEAD = 3
# Draws of the weighted seeding looked at in one pass, and arrivals expected for each.
DRAWS = 16
FETCHED = 64
# Standard deviations by which more keys than wanted are looked at.
KEYS_SPARE = 8.0
# Early hits that are fetched for more than one round at once.
HIT_ROWS = 16_384


def init_from_set(
    pts: DataFrame, k: int, seed: int = 12345, log: RunLog | None = None, total: int | None = None
) -> DataFrame:
    """``k`` points drawn uniformly without replacement.

    Up to ``TAKEN_ROWS`` points are the smallest keys of every task, merged: one job.
    With the number of points in ``total``, no task offers keys that are all but sure
    not to be among the smallest, so the merge sees about ``k`` rows whatever the
    number of tasks.
    """
    timer = log or RunLog()
    with timer.timed("init"):
        if k <= min(TAKEN_ROWS, durable.SMALL_ROWS):
            return _smallest_keys(pts, k, seed, total)
        drawn = subset(pts.select("id", "x"), k, seed, tag="init")
        order = drawn.select(F.struct(uniform(seed, "init").alias("u"), "id").alias("o"), F.col("x").alias("c"))
        cents = dense_index(order, "o", "cid").select(F.col("cid").cast("int").alias("cid"), "c")
        small = local_centroids(cents) if log is not None else None
        return centroid_table(pts.sparkSession, *small) if small else cents


def _smallest_keys(pts: DataFrame, k: int, seed: int, total: int | None) -> DataFrame:
    keyed = pts.select("id", "x", uniform(seed, "init").alias("u"))
    near = keyed
    if total and (k + KEYS_SPARE * math.sqrt(k)) < total:
        top = (k + KEYS_SPARE * math.sqrt(k)) / total
        few = pts.where(digits_of(f"'{draw_start(seed, 'init')}'") < bound_digits(f"{top!r}D"))
        near = few.select("id", "x", uniform(seed, "init").alias("u")).where(F.col("u") < F.lit(top))
    got = near.orderBy("u", "id").limit(k).select("x").toArrow()
    if near is not keyed and got.num_rows < k:
        got = keyed.orderBy("u", "id").limit(k).select("x").toArrow()
    if not got.num_rows:
        raise ValueError("cannot pick centroids from an empty table")
    return centroid_table(pts.sparkSession, range(got.num_rows), kernels.matrix(got.column("x")))


def init_from_space(spark: SparkSession, k: int, dim: int, seed: int = 12345) -> DataFrame:
    """``k`` points drawn uniformly from the unit cube of ``dim`` dimensions."""
    draw = F.expr(f"transform(sequence(0, {dim - 1}), j -> {uniform_sql(seed, 'space', f'id * {dim} + j')})")
    return spark.range(k).select(F.col("id").cast("int").alias("cid"), tag_dim(draw, "c", dim))


def rounds(psi: float) -> int:
    """Sampling rounds for a first cost: its natural logarithm, at least one."""
    return max(1, math.floor(math.log(psi))) if psi > 0 else 0


def oversample(pts: DataFrame, l: float, psi: float, seed: int, round: int) -> DataFrame:
    """Keep each point with probability ``min(1, l * d2 / psi)``."""
    return pts.where(uniform(seed, str(round)) < F.lit(float(l)) * F.col("d2") / F.lit(float(psi)))


def extend(cents: DataFrame, candidates: DataFrame) -> DataFrame:
    """Append candidate points to the centroids; ids continue after the highest."""
    last = cents.agg(F.max("cid").alias("m")).head().m
    numbered = dense_index(candidates.select(F.col("id").alias("id"), F.col("x").alias("c")), "id", "pos")
    added = numbered.select((F.col("pos") + F.lit(last + 1)).cast("int").alias("cid"), "c")
    return cents.select("cid", "c").unionByName(added)


def dedup(cents: DataFrame) -> DataFrame:
    """Distinct centroids, numbered in vector order."""
    numbered = dense_index(cents.select("c").distinct(), "c", "cid")
    return numbered.select(F.col("cid").cast("int").alias("cid"), "c")


def candidate_weights(pts: DataFrame, cents: DataFrame) -> DataFrame:
    """How many points are nearest to each centroid, 0 included."""
    counts = cluster_sizes(assign(pts.select("x"), cents))
    joined = cents.select("cid", "c").join(counts, "cid", "left")
    return joined.select("cid", "c", F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("w"))


def seed_plus_plus(
    pts: DataFrame, k: int, weight: str | None = None, seed: int = 12345, cache: str = "none"
) -> DataFrame:
    """Up to ``k`` centroids by weighted distance-squared seeding.

    A draw is won by the earliest arrival of a race whose odds fall with the distance
    to the nearest centroid.  Distances only fall, so arrivals only get later: a pass
    over the points fetches all early arrivals of each of the next ``DRAWS`` draws, and
    a draw is settled from these for as long as its winner, measured against the new
    centroids too, arrives before all that were not fetched.  Only then are the points
    read again.  Draws stop early when all points coincide with a centroid.

    How early is told by the sum of the odds: about ``FETCHED`` of any number of points
    arrive before ``FETCHED`` divided by it.  So many rows come to the driver, from all
    tasks together (ids are taken to be distinct).
    """
    spark, mass = pts.sparkSession, F.col(weight) if weight else F.lit(1.0)
    policy = Cache(cache)
    base = policy.hold_once(pts, pts.select("id", "x", mass.cast("double").alias("w")).where(F.col("w") > 0))
    state = NearestState(base, policy)
    frame = base.withColumn("d2", F.lit(1.0))
    chosen: list[np.ndarray] = []
    odds, stuck = None, True
    while len(chosen) < k:
        # until the sum of the odds is known a draw stands alone
        wanted = range(len(chosen), len(chosen) + 1 if stuck else min(k, len(chosen) + DRAWS))
        if stuck:
            races, horizon, odds = _first_arrivals(frame, seed, wanted)
        else:
            horizon = dict.fromkeys(wanted, (FETCHED / odds, None))
            races, odds = _early_arrivals(frame, seed, wanted, FETCHED / odds)
        state.settled()
        new: list[np.ndarray] = []
        for draw in wanted:
            winner = _winner(races.get(draw, []), horizon.get(draw), new)
            if winner is None:
                break
            new.append(winner)
        if not odds or (stuck and not new):
            break
        # the odds of the first draw are weights, which tell nothing about distances
        stuck = not new or not chosen
        chosen += new
        if len(chosen) < k and new:
            frame = state.add(np.array(new))
    state.close()
    policy.release_once(pts, base)
    if not chosen:
        raise ValueError("no point has a positive weight")
    return centroid_table(spark, range(len(chosen)), np.array(chosen))


def _arrival(seed: int, draw: int):
    return exponential_race(seed, f"pp{draw}", "id", "1.0D")


def _first_arrivals(frame: DataFrame, seed: int, draws: range) -> tuple[dict, dict, float]:
    """The earliest arrival of each draw, the time up to which arrivals are known, and the
    sum of the odds.  A minimum is merged before it leaves a task."""
    odds = F.col("w") * F.col("d2")
    live = frame.where("w * d2 > 0").select("id", "x", "w", "d2", *[_arrival(seed, j).alias(f"e{j}") for j in draws])
    least = [
        F.min(F.struct((F.col(f"e{j}") / odds).alias("t"), "id", F.col(f"e{j}").alias("e"), "w", "d2", "x")).alias(f"r{j}")
        for j in draws
    ]
    row = live.agg(F.sum(odds).alias("odds"), *least).head()
    first = {j: row[f"r{j}"] for j in draws if row[f"r{j}"] is not None}
    return {j: [r] for j, r in first.items()}, {j: (r.t, r.id) for j, r in first.items()}, row.odds or 0.0


def _early_arrivals(frame: DataFrame, seed: int, draws: range, until: float) -> tuple[dict, float]:
    """All arrivals up to a time, by draw, and the sum of the odds, from one pass."""
    seen = Observation()
    odds = F.col("w") * F.col("d2")
    live = frame.where("w * d2 > 0").observe(seen, F.sum(odds).alias("odds"))
    names = [f"e{j}" for j in draws]
    timed = live.select("id", "x", "w", "d2", *[_arrival(seed, j).alias(name) for j, name in zip(draws, names)])
    first = F.least(*names) if len(names) > 1 else F.col(names[0])
    races: dict[int, list] = {}
    for row in timed.where(first / odds <= F.lit(until)).collect():
        for j, name in zip(draws, names):
            if row[name] / (row.w * row.d2) <= until:
                races.setdefault(j, []).append(Row(id=row.id, x=row.x, w=row.w, d2=row.d2, e=row[name]))
    return races, seen.get.get("odds") or 0.0


def _winner(race: list, horizon: tuple | None, new: list[np.ndarray]) -> np.ndarray | None:
    """The winner of a draw given the centroids since the pass; ``None``: not settled.

    All arrivals up to ``horizon``, a time and the last id at it (``None``: all), are in
    the race.
    """
    best = None
    for row in race:
        d2 = min([row.d2, *[float(np.sum((np.array(row.x) - c) ** 2)) for c in new]])
        if row.w * d2 > 0:
            arrival = (row.e / (row.w * d2), row.id)
            best = min(best, (arrival, row.x)) if best and best[0] != arrival else (arrival, row.x)
    if best is None or best[0][0] > horizon[0] or horizon[1] is not None and best[0] > horizon:
        return None
    return np.array(best[1], dtype=float)


def recluster(candidates: DataFrame, k: int, seed: int = 12345, cache: str = "none") -> DataFrame:
    """Reduce weighted candidates ``(cid, c, w)`` to at most ``k`` centroids."""
    n = candidates.count()
    if n <= k:
        return candidates.select("cid", "c")
    pts = candidates.select(F.col("cid").alias("id"), F.col("c").alias("x"), "w")
    tasks = max(1, n // 10_000) if is_small(n, 0) else None
    if tasks:
        pts = pts.coalesce(tasks)
    policy = Cache(cache)
    pts = policy.hold(pts)
    start = seed_plus_plus(pts, k, "w", seed)
    final = lloyd(pts, start, RECLUSTER_ITERATIONS, tol=None, weight="w", tasks=tasks)
    policy.release(pts)
    return final


def init_parallel(
    pts: DataFrame,
    k: int,
    l: float | None = None,
    seed: int = 12345,
    log: RunLog | None = None,
    cache: str = "none",
    total: int | None = None,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """Scalable k-means seeding by oversampling (k-means||).

    One pass over the vectors per round tells the new cost.  Draws are keyed by round and
    id, and odds only rise as the cost falls: a pass over the points with their ids
    fetches every point that the rounds to come could draw unless the cost falls by more
    than was allowed for; if it does, the next rounds are fetched again.  ``total``, the
    number of points, speeds up the first draw; ``vectors`` are those of the points, kept
    already.
    """
    l = float(2 * k if l is None else l)
    timer = log or RunLog()
    with timer.timed("init"):
        candidates = oversampled_candidates(pts, l, seed, timer, cache, total, vectors)
        if candidates is None:
            return init_from_set(pts, 1, seed, total=total)
        return recluster(candidates, k, seed, cache)


def _fits(n: float, dim: int) -> bool:
    """Whether so many candidates may be held on the driver and in every task."""
    return is_small(n, n * (dim + 4) * 8)


def oversampled_candidates(
    pts: DataFrame,
    l: float,
    seed: int,
    log: RunLog | None = None,
    cache: str = "none",
    total: int | None = None,
    vectors: DataFrame | None = None,
) -> DataFrame | None:
    """Weighted distinct candidates ``(cid, c, w)``; ``None`` if the first cost is 0.

    Candidates stay on the driver while they, and those the next round may fetch, are
    within the bounds; from then on the rounds go on with tables.
    """
    log = log or RunLog()
    spark = pts.sparkSession
    policy = Cache(cache)
    rows = pts.select("id", "x")
    base = keep_points(pts, policy) if vectors is None else vectors
    first = local_centroids(init_from_set(rows, 1, seed, total=total))[1]
    dim = first.shape[1]
    state = BlockState(base, policy)
    state.add(first)
    psi, facts = _cost(state)
    _log_pass(log, psi, facts, 0)
    if psi == 0:
        _release(pts, vectors, base, policy)
        return None
    n_rounds = rounds(psi)
    early = None
    for r in range(n_rounds):
        if not _fits(len(state.centres) + COST_DROP * l, dim):
            cents = centroid_table(spark, range(len(state.centres)), state.centres)
            table = materialize(_nearest_known(rows, state), "state")
            state.close()
            weighted = _candidates_as_tables(rows, cents, table, psi, l, seed, log, range(r, n_rounds), facts)
            _release(pts, vectors, base, policy)
            return weighted
        with log.timed("init", "tSamples", r):
            if early is None or not early.hold(psi, r):
                early = EarlyHits(rows, state, psi, l, seed, range(r, n_rounds))
            drawn = early.drawn(psi, r)
        with log.timed("init", "tCentroids", r):
            if len(drawn):
                state.add(drawn)
                early.lower(drawn)
                psi, facts = _cost(state)
                state.settled()
        _log_pass(log, psi, facts, r + 1)
        if psi == 0:
            break
    # `rank` numbers the distinct candidates in vector order, so equal ones merge.
    counts = state.sizes()
    state.close()
    _release(pts, vectors, base, policy)
    distinct = np.unique(state.centres, axis=0)
    weights = np.zeros(len(distinct))
    for cid, n in counts.items():
        weights[state.rank[cid]] += n
    return centroid_table(spark, range(len(distinct)), distinct, w=weights)


def _release(pts: DataFrame, vectors: DataFrame | None, base: DataFrame, policy: Cache) -> None:
    if vectors is None:
        policy.release_once(pts, base)


def _nearest_known(rows: DataFrame, state: NearestState) -> DataFrame:
    """The points with the nearest of all centres so far."""
    order = np.argsort(state.rank, kind="stable")
    found = kernels.nearest_column(F.col("x"), order, state.centres[order]).alias("_m")
    return rows.select("id", "x", found).select("id", "x", F.col("_m.cid").alias("cid"), F.col("_m.d2").alias("d2"))


class EarlyHits:
    """Points that the next rounds may draw, fetched in one pass over ids and vectors.

    A round draws a point if its uniform number is below ``l * d2 / psi``.  Distances only
    fall, so those of now and a cost that may still fall give a bound for several rounds,
    as many as are expected to fetch ``HIT_ROWS`` rows at most, one at least.
    """

    def __init__(self, rows: DataFrame, state: NearestState, psi: float, l: float, seed: int, left: range):
        self.l = l
        most = HIT_ROWS if _fits(HIT_ROWS, state.centres.shape[1]) else 0
        few = [n for n in range(1, len(left) + 1) if n * l * COST_DROP ** min(AHEAD, n) <= most]
        wanted = left[: max(few, default=1)]
        self.floor = psi / COST_DROP ** min(AHEAD, len(wanted))
        measured = _nearest_known(rows, state)
        bound = f"{float(l)!r}D * d2 / {float(self.floor)!r}D"
        starts = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(draw_start(seed, str(r))).alias("start")) for r in wanted])
        draws = measured.withColumn("most", bound_digits(bound)).select("*", F.inline(starts))
        # text is compared: of the few hits only the numbers are made
        hits = draws.select("id", "x", "d2", "r", "most", digits_of("start").alias("digits")).where("digits < most")
        self.hits: dict = {r: [] for r in wanted}
        for row in hits.select("id", "x", "d2", "r", "digits").collect():
            self.hits[row.r].append(row)
        for r in wanted:
            found = sorted(self.hits.pop(r), key=lambda row: row.id)
            u = [int(row.digits, 16) / 16.0 ** len(row.digits) for row in found]
            self.hits[r] = np.array(u), np.array([row.x for row in found], dtype=float), np.array([row.d2 for row in found])

    def hold(self, psi: float, r: int) -> bool:
        """Whether all that round ``r`` may draw at this cost is here."""
        return r in self.hits and psi >= self.floor

    def drawn(self, psi: float, r: int) -> np.ndarray:
        u, x, d2 = self.hits[r]
        return x[u < self.l * d2 / psi]

    def lower(self, new: np.ndarray) -> None:
        """Distances after more candidates."""
        for r, (u, x, d2) in self.hits.items():
            if len(x):
                self.hits[r] = u, x, np.minimum(d2, kernels.nearest(x, new)[1])


# What a pass of k-means|| tells besides its cost: points read and distances measured.
FACTS = {"nRows": "n", "nDistances": "measured"}


def _log_pass(log: RunLog, psi: float, facts: dict, r: int) -> None:
    log.add("init", "CostInit", psi, r)
    for metric, value in facts.items():
        log.add("init", metric, value, r)


def _cost(state: BlockState) -> tuple[float, dict]:
    row = state.totals()
    return _checked(row.psi), {metric: row[name] for metric, name in FACTS.items()}


def _checked(psi) -> float:
    if psi is None:
        raise ValueError("cannot pick centroids from an empty table")
    return float(psi)


def _candidates_as_tables(
    base: DataFrame, cents: DataFrame, frame: DataFrame, psi: float, l: float, seed: int, log: RunLog, left: range, facts: dict
) -> DataFrame:
    """The rounds ``left`` for candidate sets too large for the driver.

    Candidates and assigned points live in tables of the shared folder; the
    candidates are compared in blocks.  The log gets what the other way logs: numbers
    come from the tasks that write the tables.
    """
    written = []
    for r in left:
        with log.timed("init", "tSamples", r):
            drawn, found = measured(oversample(frame, l, psi, seed, r).select("id", "x"), "drawn", n=F.count("*"))
        with log.timed("init", "tCentroids", r):
            if found["n"]:
                previous, known = frame, frame.select("id", "x", F.col("d2").alias("d2_before"))
                cents = materialize(extend(cents, drawn), "candidates")
                written.append(cents)
                fresh = dense_index(drawn.select("id", F.col("x").alias("c")), "id", "cid").select("cid", "c")
                lowered = assign(known, fresh).withColumn("d2", F.least("d2", "d2_before")).drop("d2_before")
                frame, seen = measured(lowered, "state", psi=F.sum("d2"), nRows=F.count("*"))
                discard(previous)
                psi = _checked(seen["psi"])
                facts = {"nRows": seen["nRows"], "nDistances": seen["nRows"] * found["n"]}
        discard(drawn)
        _log_pass(log, psi, facts, r + 1)
        if psi == 0:
            break
    discard(frame)
    distinct = materialize(dedup(cents), "distinct")
    for table in written:
        discard(table)
    weighted = materialize(candidate_weights(base, distinct), "weighted")
    discard(distinct)
    return weighted
