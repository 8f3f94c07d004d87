"""Run logs: one row per measured value, kept as a Parquet table of merged runs.

Writing only appends: a stage of a run that is written again is a later version, and
readers see the latest one.  A retry therefore changes nothing, and a writer that dies
leaves the log as it was.
"""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .durable import discard, exists, materialize

SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("init", T.StringType()),
        T.StructField("cache_mode", T.StringType()),
        T.StructField("partitions", T.IntegerType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("stage", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("iter", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)


class RunLog:
    """Collects the scalar measurements of one run on the driver."""

    def __init__(
        self, run_id: str | None = None, init: str = "", cache_mode: str = "", partitions: int = 0, n_rows: int | None = None
    ):
        self.head = (run_id or uuid.uuid4().hex, init, cache_mode, int(partitions), n_rows)
        self.rows: list[tuple] = []

    def add(self, stage: str, metric: str, value: float, iter: int = 0) -> None:
        self.rows.append((*self.head, stage, metric, int(iter), float(value)))

    def values(self, stage: str, metric: str) -> list[float]:
        return [row[-1] for row in self.rows if row[-4] == stage and row[-3] == metric]

    @contextmanager
    def timed(self, stage: str, metric: str = "tTotal", iter: int = 0):
        start = time.perf_counter()
        yield
        self.add(stage, metric, time.perf_counter() - start, iter)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, SCHEMA)


# What is written at once and replaced by a later version: one stage of one run.
VERSIONED = ["run_id", "init", "cache_mode", "partitions", "n_rows", "stage"]
# As stored: readers that ask for a partition count open its folder only.
LAYOUT = "partitions"
STORED = T.StructType([*SCHEMA.fields, T.StructField("written", T.LongType())])


def append_run_log(df: DataFrame, path: str) -> None:
    """Merge measurements into a log.

    A stage of a run that the log holds already is replaced, everything else stays.
    Versions are ordered by the writers' clocks.
    """
    stored = df.select(*SCHEMA.names).withColumn("written", F.lit(time.time_ns()))
    stored.write.mode("append").partitionBy(LAYOUT).parquet(path)


def _latest(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(STORED).parquet(path)
    # partitioned by the whole key, so filters on its columns still reach the scan
    newest = F.max("written").over(Window.partitionBy(*VERSIONED))
    return rows.withColumn("_newest", newest).where(F.col("written").eqNullSafe(F.col("_newest"))).drop("_newest")


def read_run_logs(spark: SparkSession, path: str) -> DataFrame:
    """All measurements of a log folder, each stage of a run in its latest version."""
    return _latest(spark, path).select(*SCHEMA.names)


def compact_run_log(spark: SparkSession, path: str) -> None:
    """Rewrite a log without superseded versions, one file for each partition count.

    Folders are replaced one by one when the rewritten rows are complete.  Nothing may
    be appended meanwhile.
    """
    latest = materialize(_latest(spark, path), "runlog")
    (
        latest.repartition(LAYOUT)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LAYOUT)
        .parquet(path)
    )
    discard(latest)


def unfinished(planned: DataFrame, path: str) -> DataFrame:
    """The planned runs ``(run_id, init, cache_mode, partitions, n_rows)`` a log does not hold whole.

    A run is whole once its total time is logged, which comes last.
    """
    spark = planned.sparkSession
    if not exists(spark, path):
        return planned
    done = read_run_logs(spark, path).where("stage = 'total' AND metric = 'tTotal'").select(*RUN)
    return planned.join(done, RUN, "left_anti")


# A run, and the setting it was made in.
RUN = VERSIONED[:-1]
