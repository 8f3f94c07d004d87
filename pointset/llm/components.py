"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, materialize, narrow


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or smaller) neighbours of every node on its smallest one."""
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    if large:
        least = least.select("u", F.least("u", "m").alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # a node's smaller neighbours, and the node itself, go to the smallest
        moved = both.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionAll(least.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(u, v)``: the smallest node reachable.

    Each round writes the links to the shared folder, so a lost executor repeats
    one round at most.  Neighbour lists are never gathered: a round takes minima
    (merged before the shuffle) and joins, whose hot nodes Spark splits.
    """
    ordered = links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = materialize(narrow(ordered.distinct()), "links")
    state = _fingerprint(links)
    while True:
        grown = materialize(narrow(_star(links, large=True)), "large")
        shrunk = materialize(narrow(_star(grown, large=False)), "small")
        discard(grown)
        discard(links)
        links, before = shrunk, state
        state = _fingerprint(links)
        if state == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _fingerprint(links: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    row = links.agg(F.count("*"), F.bit_xor(h), F.sum(h % 1_000_003)).head()
    return tuple(row)
