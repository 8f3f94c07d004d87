"""Loading labelled feature tables and laying them out as points.

A point table has the columns ``id``, ``x ARRAY<DOUBLE>``, ``y STRING`` and,
once assigned, ``cid INT`` and ``d2 DOUBLE``.
"""

from __future__ import annotations

import math
import sys

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import tag_dim, uniform
from .durable import discard, measured

# Functions that run in tasks travel whole, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that may be taken as the smallest of every task in one pass.
TAKEN_ROWS = 1024
# Keys that may be sorted in one task to find one of them.
TOP_N_LIMIT = 10_000
HISTOGRAM_BINS = 1024


def load_points(
    spark: SparkSession,
    path: str,
    id: str | Column,
    features: str | list[str],
    label: str | None = None,
) -> DataFrame:
    """Read a Parquet table as points.

    ``features`` is a list of numeric columns or the name of one array column.
    Only these columns are read.
    """
    return to_points(spark.read.parquet(path), id, features, label)


def to_points(
    df: DataFrame,
    id: str | Column,
    features: str | list[str],
    label: str | None = None,
) -> DataFrame:
    key = F.col(id) if isinstance(id, str) else id
    y = F.col(label).cast("string") if label else F.lit(None).cast("string")
    if isinstance(features, str):
        x = F.col(features).cast("array<double>").alias("x")
    else:
        x = tag_dim(_pack(features), "x", len(features))
    return df.select(key.alias("id"), x, y.alias("y"))


def assemble(df: DataFrame, id: str | Column, features: str | list[str], label: str | None = None) -> DataFrame:
    """Point records that are not assigned yet: ``cid`` and ``d2`` are null."""
    return to_points(df, id, features, label).select(
        "id",
        "x",
        "y",
        F.lit(None).cast("int").alias("cid"),
        F.lit(None).cast("double").alias("d2"),
    )


def _pack(columns: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def shuffle(df: DataFrame, seed: int, id: str = "id", tag: str = "shuffle") -> DataFrame:
    """All rows in a random order that only depends on the seed and the ids.

    The draw becomes a column first: an expression in the sort order would be
    evaluated again at every comparison.
    """
    return df.withColumn("_u", uniform(seed, tag, id)).orderBy("_u", id).drop("_u")


def subset(df: DataFrame, n: int, seed: int, id: str = "id", tag: str = "shuffle") -> DataFrame:
    """The first ``n`` rows of ``shuffle``, as a set; of rows with one id, any.

    Up to ``TAKEN_ROWS`` rows are the smallest keys of every task, merged: one pass.
    For more, rows with keys below ``(n + 8 sqrt n) / total``, about ``n`` of them, are
    kept in the shared folder; the n-th smallest key is located among these.  Nothing
    but the rows of its bin is ever sorted.
    """
    keyed = df.withColumn("_u", uniform(seed, tag, id))
    if n <= TAKEN_ROWS:
        return keyed.orderBy("_u", id).limit(n).drop("_u")
    total = df.count()
    if n >= total:
        return df
    top = min(1.0, (n + 8 * math.sqrt(n)) / total)
    while True:
        near, seen = measured(keyed.where(F.col("_u") < F.lit(top)), "subset", rows=F.count("*"))
        have = seen["rows"] or 0
        if have >= n or top >= 1.0:
            break
        # repeated ids vary more than single ones: take more
        discard(near)
        top = min(1.0, 2 * top)
    if have == n:
        return near.drop("_u")
    last, rest = _key_at(near.select(F.col("_u").alias("u"), F.col(id).alias("id")), n, top)
    key, cut = F.struct(F.col("_u"), F.col(id)), F.struct(F.lit(last.u).alias("_u"), F.lit(last.id).alias(id))
    return near.where(key < cut).unionAll(near.where(key == cut).limit(rest)).drop("_u")


def _key_at(keys: DataFrame, n: int, top: float):
    """The n-th smallest of ``(u, id)``, and how many rows with this key are wanted."""
    low, need, inside = 0.0, n, keys
    while True:
        width = (top - low) / HISTOGRAM_BINS
        bin_no = F.least(F.floor((F.col("u") - low) / width), F.lit(HISTOGRAM_BINS - 1))
        counts = inside.groupBy(bin_no.alias("b")).count().orderBy("b").collect()
        for row in counts:
            if need <= row["count"]:
                break
            need -= row["count"]
        inside = inside.where(bin_no == row.b)
        if row["count"] <= TOP_N_LIMIT or width < 1e-15:
            break
        low, top = low + row.b * width, low + (row.b + 1) * width
    # Rows of one id share a key: counted, the bin has few keys left.
    for row in inside.groupBy("u", "id").count().orderBy("u", "id").limit(TOP_N_LIMIT + 1).collect():
        if need <= row["count"]:
            return row, need
        need -= row["count"]
    raise ValueError("more different ids with one key than a keyed draw can have")


def with_partitions(df: DataFrame, n: int | None = None) -> DataFrame:
    """Spread the rows evenly over ``n`` partitions (default: all cores)."""
    return df.repartition(n or df.sparkSession.sparkContext.defaultParallelism)


def partition_layout(df: DataFrame) -> DataFrame:
    """A row per partition, empty ones included: ``partition, n_rows, share, skew``.

    ``skew`` is the number of rows over the mean of all partitions.  Every task counts
    its own rows, so a partition without rows is seen as well.
    """
    narrow = df.select(F.lit(True).alias("one"))
    counted = narrow.mapInArrow(_count_rows, "partition int, n_rows long")
    whole = Window.partitionBy()
    total, mean = F.sum("n_rows").over(whole), F.avg("n_rows").over(whole)
    # one row per partition: the window over all of them is small
    return counted.select(
        "partition",
        "n_rows",
        F.when(total > 0, F.col("n_rows") / total).alias("share"),
        F.when(mean > 0, F.col("n_rows") / mean).alias("skew"),
    )


def _count_rows(batches):
    context = TaskContext.get()
    rows = sum(batch.num_rows for batch in batches)
    yield pa.RecordBatch.from_arrays(
        [pa.array([context.partitionId()], pa.int32()), pa.array([rows], pa.int64())], ["partition", "n_rows"]
    )


def partition_count(df: DataFrame) -> DataFrame:
    """Number of partitions, empty ones included, of those with rows, and of rows; the largest skew."""
    return partition_layout(df).agg(
        F.count("*").alias("n_partitions"),
        F.count_if(F.col("n_rows") > 0).alias("n_filled"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.max("skew").alias("skew"),
    )
