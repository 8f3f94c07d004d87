"""Turning raw attributes into clean, rescaled points."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dim_of, vector_literal
from ..functions.vector import UNROLL_LIMIT
from ..sources.durable import fetch_small, local_table, lookup_join, materialize
from .profile import TEXT, type_class
from .vectors import vector_aggregate


def numeric_columns(df: DataFrame) -> list[str]:
    """Attributes that can be elements of a vector."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def drop_categorical(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """All attributes but those that hold text, plus the columns named in ``keep``.

    Decided on the schema, so the other columns are not even read.
    """
    wanted = {f.name for f in df.schema.fields if type_class(f.dataType) != TEXT} | set(keep or [])
    return df.select(*[c for c in df.columns if c in wanted])


def min_max(pts: DataFrame) -> DataFrame:
    """Smallest and largest value per dimension: ``(pos, lo, hi)``."""
    packed = vector_aggregate(pts, [], "x", dim_of(pts), {"lo": "min", "hi": "max"})
    return packed.select(F.posexplode(F.arrays_zip("lo", "hi")).alias("pos", "r")).select("pos", "r.lo", "r.hi")


def minmax_rescale(pts: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Rescale every dimension to [0, 1]; dimensions with one value are dropped.

    The bounds are one number pair per dimension and are fetched first: then the
    rescaling is plain arithmetic on the elements that remain.
    """
    rows = (bounds if bounds is not None else min_max(pts)).orderBy("pos").collect()
    lo = np.array([r.lo for r in rows], dtype=float)
    hi = np.array([r.hi for r in rows], dtype=float)
    keep = np.flatnonzero(lo < hi)
    return pts.withColumn("x", rescaled(F.col("x"), lo, hi, keep)).withMetadata("x", {"dim": len(keep)})


def rescaled(x: Column, lo: np.ndarray, hi: np.ndarray, keep: np.ndarray) -> Column:
    if len(keep) == 0:
        return F.array().cast("array<double>")
    if len(keep) <= UNROLL_LIMIT:
        return F.array(*[(x[int(j)] - F.lit(float(lo[j]))) / F.lit(float(hi[j] - lo[j])) for j in keep])
    kept = x
    if len(keep) < len(lo):
        kept = F.transform(F.array(*[F.lit(int(j)) for j in keep]), lambda j: x[j])
    shifted = F.zip_with(kept, vector_literal(lo[keep]), lambda v, m: v - m)
    return F.zip_with(shifted, vector_literal((hi - lo)[keep]), lambda v, r: v / r)


def dense_index(values: DataFrame, by: str, name: str) -> DataFrame:
    """Number distinct rows 0, 1, … (bigint) in the order of ``by``.

    A small set is numbered by one window.  A large one is range-partitioned and
    numbered inside each partition, shifted by the sizes of the partitions before
    it, so no task ever sees all of it.
    """
    small = fetch_small(values)
    if small is not None:
        position = (F.row_number().over(Window.orderBy(by)) - 1).cast("bigint")
        return local_table(values.sparkSession, small, values.schema).withColumn(name, position)
    return range_index(values, by, name)


def range_index(values: DataFrame, by: str, name: str, ranges: int | None = None) -> DataFrame:
    """Numbers by ranges; the partitions are written out, so that they stay as counted."""
    parts = [ranges] if ranges else []
    ranged = materialize(values.repartitionByRange(*parts, by).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(by)) - 1
    numbered = ranged.withColumn("_pos", inside).join(F.broadcast(starts), "_range")
    return numbered.withColumn(name, F.col("_start") + F.col("_pos")).drop("_range", "_pos", "_start")


def labels_in_order(pts: DataFrame, label: str = "y", name: str = "label_id") -> DataFrame:
    """The distinct labels with their position in sorted order."""
    return dense_index(pts.select(label).where(F.col(label).isNotNull()).distinct(), label, name)


def label_index(pts: DataFrame, label: str = "y", name: str = "label_id") -> DataFrame:
    """Add to each point the position of its label among the sorted labels; null: null."""
    return lookup_join(pts, labels_in_order(pts, label, name), label, "left")
