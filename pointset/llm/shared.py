"""Helpers the operators share: row keys, running totals, freed shuffles."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.durable import discard, fresh_path, materialize

__all__ = ["discard", "fresh_path", "free_shuffles", "materialize", "narrow", "part_offsets", "read_table", "text_key"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame) -> DataFrame:
    """A table of few bytes a row in at most two partitions a core, without a shuffle.

    As written after a shuffle it would be as many files as the shuffle has partitions,
    most of them tiny.
    """
    return df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of plans nothing refers to any more.

    The files go when the driver collects its garbage, which a small driver heap
    may not do for a long time; between two levels of a job they would add up.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_key(text: str = "text") -> Column:
    """Tells rows with one id but different texts apart; null texts count as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def part_offsets(totals: DataFrame, part: str, value: str, *within: str) -> DataFrame:
    """Sum of ``value`` over all earlier parts: one row per part, and per ``within`` key.

    ``totals`` holds one row per part (and key), so its size is bounded by the
    number of partitions (plus the number of keys), not by the number of rows.
    """
    before = Window.partitionBy(*within).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("_before", F.coalesce(F.sum(value).over(before), F.lit(0).cast("long"))).drop(value)
