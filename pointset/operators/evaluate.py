"""Comparing clusters with true labels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.durable import discard, materialize
from . import kernels
from .nearest import as_points, assign, centroid_blocks, update_centroids, update_distances
from .prepare import dense_index


def expected_centroids(pts: DataFrame, label: str = "y") -> DataFrame:
    """Mean of every true label; ids are the positions of the sorted labels.

    Grouping on the label itself leaves only one row per label to be numbered.
    """
    means = update_centroids(pts.where(F.col(label).isNotNull()), key=label)
    return dense_index(means, label, "cid").select(F.col("cid").cast("int").alias("cid"), label, "c", "n")


def expected_distances(pts: DataFrame, label: str = "y", expected: DataFrame | None = None) -> DataFrame:
    """Squared distance of every point to the mean of its own label; null without one."""
    means = expected_centroids(pts, label) if expected is None else expected
    return update_distances(pts.drop("cid"), means, key=label)


def match_centroids(expected: DataFrame, predicted: DataFrame) -> DataFrame:
    """Nearest predicted centroid of each expected one; several may share one."""
    found = assign(as_points(expected).select("id", "x"), predicted)
    return found.select(
        F.col("id").alias("cid"), F.col("cid").alias("matched"), "d2", F.sqrt("d2").alias("dist")
    )


def match_mse(expected: DataFrame, predicted: DataFrame) -> DataFrame:
    """Mean squared distance of the match."""
    return match_centroids(expected, predicted).agg(F.avg("d2").alias("mse"))


def rms_radius(pts: DataFrame, label: str = "y", expected: DataFrame | None = None) -> DataFrame:
    """Root mean square distance of the points of a label to their mean."""
    distances = expected_distances(pts.where(F.col(label).isNotNull()), label, expected)
    return distances.groupBy(label).agg(F.sqrt(F.avg("d2")).alias("radius"))


def nearest_other(cents: DataFrame) -> DataFrame:
    """Nearest other centroid of each centroid.

    A lone centroid has none: its distance is infinite and its match null.
    """
    out, done = None, None
    pts = as_points(cents.select("cid", "c"))
    for ids, c in centroid_blocks(cents.select("cid", "c")):
        found = kernels.nearest_other_column(F.col("x"), F.col("id"), ids, c)
        if out is None:
            out = pts.withColumn("_m", found)
        else:
            previous, done = done, materialize(out, "other")
            if previous is not None:
                discard(previous)
            out = done.withColumn("_n", found).withColumn(
                "_m", _better(F.col("_m"), F.col("_n"))
            ).drop("_n")
    alone = F.col("_m.d2") == F.lit(np.inf)
    return out.select(
        F.col("id").alias("cid"),
        F.when(~alone, F.col("_m.cid")).alias("nearest"),
        F.sqrt("_m.d2").alias("dist"),
    )


def _better(a, b):
    ordered = [F.struct(m.d2.alias("d2"), m.cid.alias("cid")) for m in (a, b)]
    best = F.least(*ordered)
    return F.struct(best.cid.alias("cid"), best.d2.alias("d2"))
