"""Analytics over run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.runlog import RUN

STAGES = ["pre", "init", "lloyd"]
TIMES = ["pre", "init_time", "lloyd"]


def _totals(log: DataFrame) -> DataFrame:
    return log.where((F.col("metric") == "tTotal") & F.col("stage").isin(STAGES))


def stage_times(log: DataFrame) -> DataFrame:
    """One row per run with the time of each stage."""
    wide = _totals(log).groupBy(*RUN).pivot("stage", STAGES).agg(F.sum("value"))
    return wide.toDF(*RUN, *TIMES)


def stage_stats(log: DataFrame) -> DataFrame:
    """Mean and population deviation over the runs of one setting, per stage."""
    per_run = _totals(log).groupBy(*RUN, "stage").agg(F.sum("value").alias("t"))
    return per_run.groupBy(*RUN[1:], "stage").agg(
        F.avg("t").alias("mean"), F.stddev_pop("t").alias("std"), F.count("*").alias("n_runs")
    )


def series(log: DataFrame, stage: str, metric: str) -> DataFrame:
    """A metric per iteration of each run, in order."""
    wanted = log.where((F.col("stage") == stage) & (F.col("metric") == metric))
    return wanted.select(*RUN, "iter", "value").orderBy("run_id", "init", "partitions", "iter")


def cache_comparison(log: DataFrame, partitions: int = 8) -> DataFrame:
    """Total time of a run per caching mode and number of rows at one partition count."""
    used = _totals(log).where(F.col("partitions") == partitions)
    per_run = used.groupBy(*RUN).agg(F.sum("value").alias("t"))
    return per_run.groupBy("cache_mode", "n_rows").agg(F.avg("t").alias("mean_total"), F.count("*").alias("n_runs"))
