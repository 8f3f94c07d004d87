"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations.

Every source is a queue of its documents in a keyed random order, passed through
at most ``repeats`` times.  The virtual finish time of a copy is the number of its
source's words up to and including it, divided by the source's weight.  Serving
copies by finish time serves every source at its weight; a source that runs out
leaves its share to the others.  The copies are range-sorted by finish time, running
totals over this schedule tell where the budget is spent, and there it is truncated.
The copy a source is serving just then is cut at that point, so each source ends
within a word of its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, text_key
from .words import WORD

WEIGHTS = (5, 2, 1)
# Of a word: what a product of a time and a weight may be short of.
ROUNDING = 1e-6


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _running(ranged: DataFrame, value: str, order: list, *within: str) -> DataFrame:
    """Running total of ``value`` over range-sorted rows with their ``_part``."""
    return _running_all(ranged, {"_total": value}, order, *within)


def _running_all(ranged: DataFrame, values: dict[str, str], order: list, *within: str) -> DataFrame:
    """Running totals, by their names, over range-sorted rows with their ``_part``."""
    keys = [*within, "_part"]
    totals = ranged.groupBy(*keys).agg(*[F.sum(value).alias(name) for name, value in values.items()])
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = {f"_before{name}": F.coalesce(F.sum(name).over(before), F.lit(0)) for name in values}
    # one row per part, and per key: bounded by the number of partitions and keys
    offsets = totals.withColumns(earlier).drop(*values)
    own = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(offsets, keys)
    sums = {name: F.sum(value).over(own) + F.col(f"_before{name}") for name, value in values.items()}
    return joined.withColumns(sums).drop(*earlier)


def source_targets(sizes: DataFrame, weights: tuple, budget: float, repeats: int) -> DataFrame:
    """``source, source_size, weight, target`` from one row per source.

    Targets are shares of the budget by weight; a source is never asked for more
    than ``repeats`` times its size, and what it cannot take goes to the others.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    # Sources are few against documents, but not assumed few: ranks and prefix sums
    # over them are running totals over ranges too.
    named = sizes.withColumn("_null", F.col("source").isNull().cast("int")).withColumn("_one", F.lit(1).cast("long"))
    ranged = materialize(
        named.repartitionByRange("_null", "source").withColumn("_part", F.spark_partition_id()), "sources"
    )
    ranked = _running(ranged, "_one", ["_null", "source"])
    weighed = ranked.select(
        "source", "_null", "source_size",
        F.element_at(cycle, ((F.col("_total") - 1) % len(weights) + 1).cast("int")).alias("weight"),
    ).withColumn("_cap", (F.col("source_size") * repeats).cast("double")).withColumn(
        "_full", F.col("_cap") / F.col("weight")
    )
    # Sources run dry in the order of cap / weight.  Up to the time `_full` of one,
    # those before it have given their caps and the others weight * time.
    order = ["_full", "_null", "source"]
    dry = materialize(weighed.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "dry")
    dry = _running_all(dry, {"_caps": "_cap", "_weights": "weight"}, order)
    all_weights = float(sizes_total(dry, "weight"))
    # at each source: the budget left after those before it, and the weights not yet dry
    line = dry.select(
        F.col("_full"),
        (F.lit(float(budget)) - (F.col("_caps") - F.col("_cap"))).alias("_left"),
        (F.lit(all_weights) - F.col("_weights") + F.col("weight")).alias("_rest"),
    )
    # The first source that can still be served to the end tells the cut; the bound
    # of a later one lies below it.  None: all run dry.
    cut = line.where("_left <= _full * _rest").agg(F.max(F.col("_left") / F.col("_rest")).alias("c")).head().c
    target = F.col("_cap") if cut is None else F.least(F.col("_cap"), F.col("weight") * F.lit(float(cut)))
    return weighed.select("source", "source_size", "weight", target.alias("target"))


def sizes_total(df: DataFrame, value: str):
    return df.agg(F.coalesce(F.sum(value), F.lit(0)).alias("n")).head().n


def cut_time(schedule: DataFrame, budget: float) -> float | None:
    """Virtual time at which the sources together have been served ``budget`` words.

    Read off the range-sorted ``schedule``: up to the finish time of a copy the sources
    that ran dry before it have given all they hold, every other one its weight times
    that time.  The budget is spent at the first copy up to whose finish time more would
    be served.  ``None`` if all sources run dry first.
    """
    ends = schedule.withColumn("_dry_weight", F.when(F.col("_last"), F.col("weight")).otherwise(0.0)).withColumn(
        "_dry_words", F.when(F.col("_last"), F.col("source_size") * (F.col("copy") + 1)).otherwise(0).cast("long")
    )
    dry = _running_all(ends, {"_weights": "_dry_weight", "_words": "_dry_words"}, ["finish", *TIES])
    all_weights = float(sizes_total(ends, "_dry_weight"))
    live = F.lit(all_weights) - (F.col("_weights") - F.col("_dry_weight"))
    left = F.lit(float(budget)) - (F.col("_words") - F.col("_dry_words"))
    # after the last source ran dry nothing is served
    time = F.when(live > ROUNDING * all_weights, left / live)
    return dry.select("finish", time.alias("v")).where("v <= finish").agg(F.min_by("v", "finish").alias("v")).head().v


# Order of copies that finish at one time.
TIES = ["_h_source", "copy", "_h", "doc_id", "_th", "_row"]


def mix_sources(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 17,
) -> DataFrame:
    """The schedule of a mixture: one row per document copy, ordered by ``finish``.

    The schedule is written range-sorted; whoever reads it in order sorts by ``finish``.
    Columns ``doc_id, _th, copy, size, source, source_size, target, finish, taken``:
    ``finish`` is the virtual finish time and ``taken`` the words the mixture takes of
    this copy, 0 beyond the truncation.
    The budget is ``share`` times all words; weights go to the sources by code point,
    null last, over and over.

    Null and empty texts have size 0 and take nothing; a very long text is a row like
    any other, of which words may be taken in part.  Rows that repeat are documents of
    their own.  An empty table gives no rows; other columns are not read.  The order
    within a source depends on ids, texts and the seed only.
    """
    base = docs.select(
        "doc_id", text_key().alias("_th"), "source", word_count().alias("size"),
        F.monotonically_increasing_id().alias("_row"),
    ).withColumn("_h", F.xxhash64(F.col("doc_id"), F.col("_th"), F.lit(seed)))
    order = ["_h", "doc_id", "_th", "_row"]
    ranged = materialize(
        base.withColumn("_null", F.col("source").isNull().cast("int"))
        .withColumn("source", F.coalesce("source", F.lit("")))
        .repartitionByRange("_null", "source", *order)
        .withColumn("_part", F.spark_partition_id()),
        "queue",
    )
    sizes = ranged.groupBy("_null", "source").agg(F.sum("size").alias("source_size")).select(
        F.when(F.col("_null") == 0, F.col("source")).alias("source"), "source_size"
    )
    budget = share * sizes_total(ranged, "size")
    targets = materialize(source_targets(sizes, weights, budget, repeats), "targets")
    queued = _running(ranged, "size", order, "_null", "source")
    named = targets.select(
        F.col("source").isNull().cast("int").alias("_null"),
        F.coalesce("source", F.lit("")).alias("source"),
        "source_size", "weight", "target",
    )
    served = queued.join(named, ["_null", "source"])
    copies = served.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    end = F.col("copy") * F.col("source_size") + F.col("_total")
    last = (F.col("copy") == repeats - 1) & (F.col("_total") == F.col("source_size")) & (F.col("size") > 0)
    schedule = copies.select(
        "doc_id", "_th", "_row", "_h", "copy", "size",
        F.when(F.col("_null") == 0, F.col("source")).alias("source"),
        "source_size", "target", "weight",
        (end - F.col("size")).alias("_start"),
        (end / F.col("weight")).alias("finish"),
        last.alias("_last"),
    ).withColumn("_h_source", F.xxhash64("source"))
    keys = ["finish", *TIES]
    schedule = materialize(
        schedule.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id()), "schedule"
    )
    cut = cut_time(schedule, budget)
    words = F.col("source_size") * repeats if cut is None else F.floor(F.lit(cut) * F.col("weight") + ROUNDING)
    taken = F.greatest(F.lit(0).cast("long"), F.least("size", words.cast("long") - F.col("_start")))
    return schedule.withColumn("taken", taken).drop("_h_source", "_h", "_last", "_start", "weight", "_part")
