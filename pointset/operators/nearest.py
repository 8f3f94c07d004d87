"""Distances, assignment to the nearest centroid, and centroid updates.

A centroid table has the columns ``cid INT`` and ``c ARRAY<DOUBLE>``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dim_of, sq_dist, tag_dim
from ..sources import durable
from ..sources.durable import discard, fetch_small, lookup_join, materialize
from . import kernels
from .vectors import vector_aggregate

KERNELS = ("arrow", "sql")
# Blocks of centroids compared in one pass over the points.
PASS_BLOCKS = 8


def centroid_table(spark: SparkSession, ids, c: np.ndarray, **more) -> DataFrame:
    """Centroid rows held on the driver as a table, with further columns by name.

    Arrow data becomes a local relation: its size is known to the optimizer.
    """
    c = np.ascontiguousarray(c, dtype=np.float64)
    starts = np.arange(len(c) + 1, dtype=np.int32) * np.int32(c.shape[1])
    columns = {
        "cid": pa.array(np.asarray(ids, dtype=np.int32)),
        "c": pa.ListArray.from_arrays(starts, pa.array(c.ravel())),
        **{name: pa.array(np.asarray(values)) for name, values in more.items()},
    }
    return spark.createDataFrame(pa.table(columns)).withColumn("c", tag_dim(F.col("c"), "c", c.shape[1]))


def local_centroids(cents: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids (ascending) and matrix of a centroid table within the bounds, else ``None``."""
    table = fetch_small(cents.select(F.col("cid").cast("int").alias("cid"), "c"))
    if table is None:
        return None
    ids = table.column("cid").to_numpy()
    if not len(ids):
        raise ValueError("no centroids")
    order = np.argsort(ids, kind="stable")
    return ids[order], kernels.matrix(table.column("c"))[order]


def centroid_blocks(cents: DataFrame, depth: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The centroids as blocks that each fit a task: one block if they are few."""
    small = local_centroids(cents)
    if small is not None:
        yield small
        return
    table = materialize(cents.select("cid", "c"), "centroids")
    facts = table.agg(F.count("*").alias("n"), F.sum(F.size("c") * 8 + 16).alias("bytes")).head()
    n_blocks = 2 * max(-(-facts.n // durable.SMALL_ROWS), -(-facts.bytes // durable.SMALL_BYTES))
    # a block that is still too large is dealt out by another hash
    slot = F.pmod(F.xxhash64("cid", F.lit(depth)), F.lit(n_blocks))
    for i in range(n_blocks):
        block = table.where(slot == i)
        if not block.isEmpty():
            yield from centroid_blocks(block, depth + 1)
    discard(table)


def assign(
    pts: DataFrame,
    cents: DataFrame,
    update_d2: bool = True,
    kernel: str = "arrow",
) -> DataFrame:
    """Nearest centroid of every point; equal distances go to the lowest id.

    A map over the points: nothing is shuffled.  Centroids beyond the size bound
    are taken block by block, each block keeping the better match: ``PASS_BLOCKS``
    of them in one pass over the points.  With ``update_d2=False`` only ``cid``
    changes.  ``kernel="sql"`` uses array functions instead of Arrow batches.

    A filter on the result does not reach the scan (see ``kernels``); filter first.
    """
    if kernel not in KERNELS:
        raise ValueError(f"kernel must be one of {KERNELS}, not {kernel!r}")
    rest = [c for c in pts.columns if c not in ("cid", "d2")]
    out, done = None, None
    for i, (ids, c) in enumerate(centroid_blocks(cents)):
        if out is None:
            out = _first_match(pts, ids, c, kernel)
            continue
        if i % PASS_BLOCKS == 0:
            previous, done = done, materialize(out, "assign")
            out = done
            if previous is not None:
                discard(previous)
        if kernel == "sql":
            better = _first_match(out.withColumnRenamed("_m", "_old"), ids, c, kernel)
            both = [F.struct(F.col(f"{m}.d2").alias("d2"), F.col(f"{m}.cid").alias("cid")) for m in ("_old", "_m")]
            best = F.least(*both)
            out = better.withColumn("_m", F.struct(best.cid.alias("cid"), best.d2.alias("d2"))).drop("_old")
        else:
            found = kernels.lower_column(F.col("x"), F.col("_m.cid"), F.col("_m.d2"), ids, c, None)
            out = out.withColumn("_m", found)
    if update_d2:
        d2 = [F.col("_m.d2").alias("d2")]
    else:
        d2 = [F.col("d2")] if "d2" in pts.columns else []
    return out.select(*rest, F.col("_m.cid").alias("cid"), *d2)


def _first_match(pts: DataFrame, ids: np.ndarray, c: np.ndarray, kernel: str) -> DataFrame:
    """The points with ``_m``, their match among a block of centroids."""
    if kernel == "arrow":
        return pts.select("*", kernels.nearest_column(F.col("x"), ids, c).alias("_m"))
    # one row that holds the block, so the plan keeps its size
    packed = centroid_table(pts.sparkSession, ids, c).agg(F.collect_list(F.struct("cid", "c")).alias("_cents"))
    scored = F.transform(
        "_cents", lambda e: F.struct(sq_dist(F.col("x"), e.c).alias("d2"), e.cid.alias("cid"))
    )
    best = F.array_min(scored)
    wide = pts.join(F.broadcast(packed))
    return wide.select(*pts.columns, F.struct(best.cid.alias("cid"), best.d2.alias("d2")).alias("_m"))


def update_distances(pts: DataFrame, cents: DataFrame, key: str = "cid") -> DataFrame:
    """Squared distance of every point to the centroid it already belongs to.

    Points without a known centroid stay, with a null distance.
    """
    joined = lookup_join(pts.drop("d2"), cents.select(key, "c"), key, "left")
    return joined.withColumn("d2", sq_dist(F.col("x"), F.col("c"), dim_of(pts))).drop("c")


def cost(pts: DataFrame) -> DataFrame:
    """Sum of the squared distances."""
    return pts.agg(F.sum("d2").alias("cost"))


def cluster_sizes(pts: DataFrame, key: str = "cid", order: str | None = None) -> DataFrame:
    """Points per cluster; ``order="desc"`` puts the largest first."""
    sizes = pts.groupBy(key).agg(F.count("*").alias("n"))
    return sizes.orderBy(F.desc("n"), key) if order == "desc" else sizes


def update_centroids(pts: DataFrame, weight: str | None = None, key: str = "cid") -> DataFrame:
    """Mean of each cluster, optionally weighted; rows without weight do not count.

    Sums and counts are combined inside the tasks before the shuffle, so a
    cluster holding most of the points costs no more than a small one.
    """
    used = pts.where(F.col(weight) > 0) if weight else pts
    dim = dim_of(pts)
    mass = F.sum(weight) if weight else F.count("*").cast("double")
    sums = vector_aggregate(
        used.select(key, "x", *([weight] if weight else [])),
        [key],
        "x",
        dim,
        {"s": "sum"},
        {"n": F.count("*"), "w": mass},
        weight,
    )
    mean = F.transform("s", lambda v: v / F.col("w"))
    return sums.select(key, tag_dim(mean, "c", dim), "n", "w")


def as_points(cents: DataFrame) -> DataFrame:
    """Centroids taken as points."""
    rest = [c for c in cents.columns if c not in ("cid", "c")]
    return cents.select(F.col("cid").alias("id"), F.col("c").alias("x"), *rest)

