"""End-to-end runs: prepare, seed, iterate, and the timing sweep over them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dim_of
from ..operators.evaluate import expected_centroids, match_centroids, nearest_other, rms_radius
from ..operators.iterations import lloyd
from ..operators.nearest import assign
from ..operators.prepare import minmax_rescale, numeric_columns
from ..operators.seeding import init_from_set, init_from_space, init_parallel
from ..operators.state import keep_points
from ..operators.vectors import vector_aggregate
from ..sources.durable import Cache, Lifetime, table_scope
from ..sources.points import to_points, with_partitions
from ..sources.runlog import RUN, RunLog, append_run_log, read_run_logs, unfinished

INITS = ("parallel", "naive", "space")
# Inputs of at most this many rows per core are spread evenly before they are kept,
# in tasks of at least MIN_ROWS_PER_TASK rows.
MAX_ROWS_PER_CORE = 250_000
MIN_ROWS_PER_TASK = 20_000


@dataclass
class Clustering:
    """Result of a run."""

    points: DataFrame
    centroids: DataFrame
    k: int
    log: RunLog
    lifetime: Lifetime | None = None

    def release(self) -> None:
        """Give up what the run kept on the executors and wrote to the shared folder.

        Centroids that did not fit the driver are among it.
        """
        if self.lifetime is not None:
            self.lifetime.close()

    def assigned(self) -> DataFrame:
        """Points with the id of and squared distance to their final centroid."""
        return assign(self.points, self.centroids.select("cid", "c"))

    def costs(self, stage: str = "lloyd") -> list[float]:
        return self.log.values(stage, "CostsKmeans" if stage == "lloyd" else "CostInit")


def numeric_points(df: DataFrame, id: str | Column, label: str, features: list[str] | None = None) -> DataFrame:
    """Points from the numeric attributes of a table, categorical ones dropped."""
    hidden = {label} | ({id} if isinstance(id, str) else set())
    columns = features or [c for c in numeric_columns(df) if c not in hidden]
    return to_points(df, id, [c for c in columns if c in set(numeric_columns(df))], label)


def prepare(pts: DataFrame, rescale: bool = True) -> tuple[DataFrame, int, int]:
    """Rescaled points, the number of labels and the number of points."""
    if not rescale:
        row = pts.agg(F.countDistinct("y").alias("k"), F.count("*").alias("n")).head()
        return pts, row.k, row.n
    # one scan for the bounds, the labels and the rows
    dim = dim_of(pts)
    facts = {"k": F.countDistinct("y"), "n": F.count("*")}
    row = vector_aggregate(pts, [], "x", dim, {"lo": "min", "hi": "max"}, facts).head()
    bounds = [(j, row.lo[j], row.hi[j]) for j in range(dim)]
    return minmax_rescale(pts, pts.sparkSession.createDataFrame(bounds, "pos int, lo double, hi double")), row.k, row.n


def spread(pts: DataFrame, partitions: int | None, policy: Cache, n: int) -> DataFrame:
    """The ``n`` points in ``partitions`` partitions.

    By default they stay where the scan put them, unless the points are kept for
    many passes and are so few that the scan may have left cores idle.
    """
    if partitions:
        return with_partitions(pts, partitions)
    if not policy.keeps:
        return pts
    cores = pts.sparkSession.sparkContext.defaultParallelism
    if MIN_ROWS_PER_TASK * 2 <= n <= cores * MAX_ROWS_PER_CORE:
        return with_partitions(pts, min(cores, n // MIN_ROWS_PER_TASK))
    return pts


def cluster(
    pts: DataFrame,
    init: str = "parallel",
    k: int | None = None,
    l: float | None = None,
    max_iter: int = 20,
    tol: float | None = 1e-3,
    seed: int = 12345,
    cache: str = "none",
    partitions: int | None = None,
    rescale: bool = True,
    run_id: str | None = None,
    n_rows: int | None = None,
    bounds: bool = False,
) -> Clustering:
    """Rescale, pick start centroids and run Lloyd iterations, with ``bounds`` if wished.

    ``k`` defaults to the number of labels and ``l`` to ``2k``.  ``run_id`` and
    ``n_rows`` go to the log; a run gets an id of its own if none is given.  What the
    run keeps and writes is owned by it and goes with ``release``.
    """
    if init not in INITS:
        raise ValueError(f"init must be one of {INITS}, not {init!r}")
    log = RunLog(run_id, init, cache, partitions or 0, n_rows)
    policy = Cache(cache)
    lifetime = Lifetime()
    with lifetime.active(), log.timed("total"):
        with log.timed("pre"):
            ready, labels, n = prepare(pts, rescale)
            # What is released after the run is kept without the labels, and for the passes
            # over many points without the ids, which only draws ask for.
            keeps_all = cache == "persist"
            rows = ready if keeps_all else ready.select("id", "x")
            kept = spread(rows, partitions, policy, n)
            if keeps_all or kept is not rows:
                kept = policy.hold(kept)
            vectors = keep_points(kept, policy, again=not keeps_all)
        k = labels if k is None else k
        if init == "parallel":
            start = init_parallel(kept, k, l, seed, log, cache, n, vectors)
        elif init == "naive":
            start = init_from_set(kept, k, seed, log, n)
        else:
            start = init_from_space(pts.sparkSession, k, dim_of(ready), seed)
        cents = lloyd(kept, start, max_iter, tol, log=log, cache=cache, bounds=bounds, vectors=vectors)
    for frame in (vectors, kept):
        policy.release(frame)
    return Clustering(kept if keeps_all else ready, cents, k, log, lifetime)


def sweep(
    pts: DataFrame,
    partitions: list[int],
    inits: tuple[str, ...] = ("parallel", "naive"),
    caches: tuple[str, ...] = ("persist",),
    repetitions: int = 1,
    path: str | None = None,
    name: str | None = None,
    most_runs: int | None = None,
    **options,
) -> DataFrame:
    """Run logs of every combination of partition count, start and caching mode.

    Every run has an id of its own and carries the number of rows, so logs of several
    sweeps can be kept together.  What a run keeps is released before the next begins.

    With ``path`` every run is merged into that log as soon as it is done, and runs of
    a sweep of this ``name`` the log holds already are not repeated: a sweep that was
    stopped goes on where it was.  ``most_runs`` stops it after so many.
    """
    spark = pts.sparkSession
    n_rows = pts.count()
    name = name or uuid.uuid4().hex
    plan = [
        (f"{name}-{init}-{cache}-{n}-{repetition}", init, cache, n, n_rows)
        for n in partitions for init in inits for cache in caches for repetition in range(repetitions)
    ]
    # a row per combination asked for
    planned = spark.createDataFrame(plan, "run_id string, init string, cache_mode string, partitions int, n_rows long")
    left = plan if path is None else [tuple(row) for row in unfinished(planned, path).collect()]
    merged = RunLog()
    for run_id, init, cache, n, _ in [run for run in plan if run in set(left)][:most_runs]:
        with table_scope():
            run = cluster(pts, init=init, cache=cache, partitions=n, run_id=run_id, n_rows=n_rows, **options)
            if path is not None:
                append_run_log(run.log.to_df(spark), path)
        merged.rows += run.log.rows
    if path is None:
        return merged.to_df(spark)
    return read_run_logs(spark, path).join(F.broadcast(planned), RUN, "left_semi")


def evaluate(run: Clustering, label: str = "y") -> DataFrame:
    """A finished clustering against the true labels, a row per label.

    ``y, n`` and the position ``cid`` of the label, the final centroid ``matched`` to
    its mean and their squared distance ``d2``, the label's ``radius`` and the distance
    ``other`` to the nearest mean of another label.
    """
    expected = expected_centroids(run.points, label)
    matched = match_centroids(expected, run.centroids.select("cid", "c")).select("cid", "matched", "d2")
    others = nearest_other(expected).select("cid", F.col("dist").alias("other"))
    joined = expected.select("cid", label, "n").join(matched, "cid").join(others, "cid")
    return joined.join(rms_radius(run.points, label, expected), label)
