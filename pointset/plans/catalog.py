"""The registered queries: one per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import sq_dist, uniform
from ..sources import (
    RunLog,
    append_run_log,
    assemble,
    compact_run_log,
    load_points,
    lookup_join,
    partition_count,
    read_run_logs,
    shuffle,
    subset,
    with_partitions,
)
from ..sources.durable import fresh_path
from ..sources.runlog import RUN
from .cluster import cluster, evaluate, numeric_points, sweep

SEED = 7
K = 10
SUBSET_ROWS = 40_000
LINEITEM_FEATURES = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r(column, name: str):
    """Six decimals for comparison; adding zero turns -0.0 into 0.0.

    ``rint`` compiles to one instruction, ``round`` goes through BigDecimal.
    """
    value = F.col(column) if isinstance(column, str) else column
    return (F.rint(value * F.lit(1e6)) / F.lit(1e6) + F.lit(0.0)).alias(name)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_points(spark, f"{sf_dir}/embeddings.parquet", "vec_id", "embedding", "label")


def lineitem_key():
    """No short key of lineitem is unique; these six columns together are."""
    return F.concat_ws(
        "|",
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"),
        F.col("l_shipdate").cast("date").cast("string"),
        F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("string"),
    )


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as points over all their numeric attributes."""
    return numeric_points(_table(spark, sf_dir, "lineitem"), lineitem_key(), "l_returnflag")


def scaled_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.minmax_rescale(lineitem(spark, sf_dir))


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a constant attribute, which rescaling has to remove."""
    return _table(spark, sf_dir, "lineitem").withColumn("konst", F.lit(1.0))


def start(pts: DataFrame, k: int = K) -> DataFrame:
    return op.init_from_set(pts, k, SEED)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log made from the events table."""
    stage = (
        F.when(F.col("event_type") == "click", "pre")
        .when(F.col("event_type") == "view", "init")
        .when(F.col("event_type") == "purchase", "lloyd")
        .otherwise("other")
    )
    mode = F.element_at(F.array(F.lit("none"), F.lit("persist"), F.lit("unpersist")), (F.col("event_id") % 3 + 1).cast("int"))
    return _table(spark, sf_dir, "events").select(
        F.floor(F.col("user_id") / 14).cast("string").alias("run_id"),
        F.when(F.col("user_id") % 2 == 0, "parallel").otherwise("naive").alias("init"),
        mode.alias("cache_mode"),
        F.pow(F.lit(2), 1 + F.col("user_id") % 7).cast("int").alias("partitions"),
        ((F.col("user_id") % 3 + 1) * 1000).cast("bigint").alias("n_rows"),
        stage.alias("stage"),
        F.lit("tTotal").alias("metric"),
        F.col("event_id").alias("iter"),
        F.col("value").alias("value"),
    )


def _vectors(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    long = df.select(*keys, F.posexplode(vector).alias("pos", "v"))
    return long.select(*keys, "pos", _r("v", "v"))


def _matches(df: DataFrame) -> DataFrame:
    return df.select("id", "cid", _r("d2", "d2"))


def _summary(assigned: DataFrame) -> DataFrame:
    """Size and cost of every cluster."""
    return assigned.groupBy("cid").agg(F.count("*").alias("n"), _r(F.sum("d2"), "cost"))


def _first_state(spark, d):
    pts = embeddings(spark, d)
    assigned = op.assign(pts, start(pts, 1))
    return assigned, op.cost(assigned).head().cost


def _sampled(spark, d):
    assigned, psi = _first_state(spark, d)
    return assigned, op.oversample(assigned, 2 * K, psi, SEED, 0)


def q_type_profile(spark, d):
    return op.type_profile(mixed(spark, d))


def q_value_types(spark, d):
    """Types at every path of the events' properties."""
    return op.value_types(_table(spark, d, "events"), "props")


def nested_events(events: DataFrame) -> DataFrame:
    """Events as JSON texts whose members differ in type from row to row; some are broken."""
    kind = F.col("event_id") % 6
    value = F.rint(F.col("value") * 100).cast("bigint").cast("string")
    text = (
        F.when(kind == 0, F.concat(F.lit('{"p": '), "props", F.lit(', "v": '), value, F.lit("}")))
        .when(kind == 1, F.concat(F.lit('{"p": null, "v": "'), "event_type", F.lit('"}')))
        .when(kind == 2, F.concat(F.lit('{"v": ['), value, F.lit(', null, {"t": "'), "event_type", F.lit('"}, [true, 0.5]]}')))
        .when(kind == 3, F.concat(F.lit("["), "props", F.lit(", []]")))
        .when(kind == 4, F.lit("{broken"))
    )
    return events.select(text.alias("doc"))


def q_value_types_nested(spark, d):
    return op.value_types(nested_events(_table(spark, d, "events")), "doc")


def q_distinct_counts(spark, d):
    return op.distinct_counts(_table(spark, d, "lineitem"))


def q_distinct_counts_approx(spark, d):
    """Sketches against exact counts: three standard errors are allowed."""
    lines = _table(spark, d, "lineitem")
    rough = op.distinct_counts(lines, approx=True).withColumnRenamed("n_distinct", "rough")
    both = lookup_join(op.distinct_counts(lines), rough, "attribute")
    close = F.abs(F.col("rough") - F.col("n_distinct")) <= 0.15 * F.col("n_distinct")
    return both.select("attribute", "n_distinct", close.alias("close"))


def q_shuffle(spark, d):
    mixed_up = shuffle(lineitem(spark, d), SEED)
    return mixed_up.select("id", "y", _r(uniform(SEED, "shuffle"), "u"))


def q_assemble(spark, d):
    pts = assemble(_table(spark, d, "lineitem"), lineitem_key(), LINEITEM_FEATURES, "l_returnflag")
    return pts.select("id", "y", "cid", "d2", *[F.col("x")[j].alias(f"x{j}") for j in range(len(LINEITEM_FEATURES))])


def q_minmax_rescale(spark, d):
    columns = op.numeric_columns(mixed(spark, d))
    ready = op.minmax_rescale(assemble(mixed(spark, d), lineitem_key(), columns, "l_returnflag"))
    n = ready.schema["x"].metadata["dim"]
    return ready.select("id", F.lit(n).alias("dim"), *[_r(F.col("x")[j], f"x{j}") for j in range(n)])


def q_min_max(spark, d):
    columns = op.numeric_columns(mixed(spark, d))
    return op.min_max(assemble(mixed(spark, d), lineitem_key(), columns)).select("pos", _r("lo", "lo"), _r("hi", "hi"))


def q_init_from_space(spark, d):
    """As many random centroids as labels, and what they attract."""
    pts = embeddings(spark, d)
    facts = pts.agg(F.countDistinct("y").alias("k"), F.max(F.size("x")).alias("dim")).head()
    return _summary(op.assign(pts, op.init_from_space(spark, facts.k, facts.dim, SEED)))


def q_rounds(spark, d):
    psi = _first_state(spark, d)[1]
    return spark.createDataFrame([(psi, op.rounds(psi))], "psi double, n_rounds int").select(
        _r("psi", "psi"), "n_rounds"
    )


def q_extend(spark, d):
    """Distances after the candidates of one round joined the first centroid."""
    pts = embeddings(spark, d)
    first = start(pts, 1)
    grown = op.extend(first, _sampled(spark, d)[1])
    return _matches(op.assign(pts, grown))


def q_dedup(spark, d):
    pts = embeddings(spark, d)
    drawn = _sampled(spark, d)[1]
    twice = op.extend(op.extend(start(pts, 1), drawn), drawn)
    return _vectors(op.dedup(twice), "c", "cid")


def q_candidate_weights(spark, d):
    pts = embeddings(spark, d)
    cents = op.dedup(op.extend(start(pts, 1), _sampled(spark, d)[1]))
    return op.candidate_weights(pts, cents).select("cid", "w")


def q_candidates(spark, d):
    cands = op.oversampled_candidates(embeddings(spark, d), 2 * K, SEED)
    return _vectors(cands, "c", "cid", "w")


def q_seed_plus_plus(spark, d):
    return _vectors(op.seed_plus_plus(embeddings(spark, d), 3, seed=SEED), "c", "cid")


def q_seed_plus_plus_20(spark, d):
    return _vectors(op.seed_plus_plus(embeddings(spark, d), 20, seed=SEED), "c", "cid")


def q_recluster_all_rounds(spark, d):
    return _vectors(op.recluster(op.oversampled_candidates(embeddings(spark, d), 2 * K, SEED), 3, SEED), "c", "cid")


def q_seed_plus_plus_weighted(spark, d):
    pts = embeddings(spark, d).withColumn("w", 1 + F.col("y").cast("double"))
    return _vectors(op.seed_plus_plus(pts, 3, "w", SEED), "c", "cid")


def q_recluster(spark, d):
    pts = embeddings(spark, d)
    cents = op.dedup(op.extend(start(pts, 1), _sampled(spark, d)[1]))
    return _vectors(op.recluster(op.candidate_weights(pts, cents), 3, SEED), "c", "cid")


def q_init_parallel(spark, d):
    return _vectors(op.init_parallel(embeddings(spark, d), K, seed=SEED), "c", "cid")


def q_lloyd_2_iter(spark, d):
    pts = embeddings(spark, d)
    return _vectors(op.lloyd(pts, start(pts), 2, tol=None), "c", "cid", "n")


def q_lloyd_weighted_2_iter(spark, d):
    pts = embeddings(spark, d).withColumn("w", 1 + F.col("y").cast("double"))
    return _vectors(op.lloyd(pts, start(pts), 2, tol=None, weight="w"), "c", "cid", "n")


def q_lloyd_20_iter(spark, d):
    pts = embeddings(spark, d)
    return _vectors(op.lloyd(pts, start(pts), 20, tol=None), "c", "cid", "n")


def q_lloyd_weighted_100_iter(spark, d):
    pts = embeddings(spark, d).withColumn("w", 1 + F.col("y").cast("double"))
    return _vectors(op.lloyd(pts, start(pts), 100, tol=None, weight="w"), "c", "cid", "n")


def q_lloyd_cost_log(spark, d):
    pts = scaled_lineitem(spark, d)
    log = RunLog("1", "naive", "unpersist")
    op.lloyd(with_partitions(pts), start(pts, 3), 20, log=log, cache="unpersist")
    costs = op.series(log.to_df(spark), "lloyd", "CostsKmeans")
    return costs.select("iter", _r("value", "cost"))


def q_cluster_naive(spark, d):
    return _summary(cluster(embeddings(spark, d), init="naive", seed=SEED, rescale=False).assigned())


def q_cluster_parallel(spark, d):
    return _summary(cluster(embeddings(spark, d), seed=SEED).assigned())


def q_cluster_space(spark, d):
    return _summary(cluster(embeddings(spark, d), init="space", seed=SEED).assigned())


def q_cluster_naive_lineitem(spark, d):
    return _summary(cluster(lineitem(spark, d), init="naive", seed=SEED, cache="unpersist").assigned())


def q_cluster_parallel_lineitem(spark, d):
    return _summary(cluster(lineitem(spark, d), seed=SEED, cache="unpersist").assigned())


def _finished(spark, d):
    return cluster(lineitem(spark, d), init="naive", seed=SEED, cache="unpersist")


def q_evaluate_lineitem(spark, d):
    """A finished clustering against the true labels."""
    found = evaluate(_finished(spark, d))
    return found.select("y", "n", "cid", "matched", _r("d2", "d2"), _r("radius", "radius"), _r("other", "other"))


def q_evaluate_lineitem_mse(spark, d):
    run = _finished(spark, d)
    return op.match_mse(op.expected_centroids(run.points), run.centroids.select("cid", "c")).select(_r("mse", "mse"))


def unlabelled_in_part(pts: DataFrame) -> DataFrame:
    """Line items of which those with line number 3 have no label."""
    return pts.withColumn("y", F.when(F.col("x")[LINEITEM_FEATURES.index("l_linenumber")] != 3, F.col("y")))


def q_label_index_nulls(spark, d):
    return op.label_index(unlabelled_in_part(lineitem(spark, d))).select("id", "y", "label_id")


def q_expected_distances_nulls(spark, d):
    pts = op.minmax_rescale(unlabelled_in_part(lineitem(spark, d)))
    return op.expected_distances(pts).select("id", "y", _r("d2", "d2"))


def q_drop_categorical(spark, d):
    """What is left of the line items; the time is shown as a day."""
    return op.drop_categorical(mixed(spark, d)).withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


def _scaled_and_start(spark, d):
    pts = scaled_lineitem(spark, d)
    return pts, start(pts)


def _expected_and_start(spark, d):
    pts, cents = _scaled_and_start(spark, d)
    return op.expected_centroids(pts), cents


def q_run_log_roundtrip(spark, d):
    """Two appends to a log folder and what is read back."""
    path = fresh_path(spark, "runlog")
    log = event_log(spark, d)
    append_run_log(log.where(F.col("init") == "parallel"), path)
    append_run_log(log.where(F.col("init") == "naive"), path)
    return read_run_logs(spark, path)


def q_run_log_merge(spark, d):
    """A log in which some runs were written again, once with other values and once more."""
    path = fresh_path(spark, "runlog")
    log = event_log(spark, d)
    append_run_log(log, path)
    again = log.where(F.col("init") == "naive").where(F.col("iter") % 2 == 0).withColumn("value", F.col("value") + 1)
    append_run_log(again, path)
    append_run_log(again, path)
    compact_run_log(spark, path)
    return read_run_logs(spark, path)


def q_sweep_resumed(spark, d):
    """Runs and iterations of a sweep that was stopped twice and went on."""
    path = fresh_path(spark, "runlog")
    pts = embeddings(spark, d)
    options = {"inits": ("naive",), "caches": ("none", "unpersist"), "k": K, "seed": SEED, "rescale": False}
    for most in (1, 1, None, None):
        log = sweep(pts, [2, 4], path=path, name="resumed", most_runs=most, **options)
    costs = log.where(F.col("metric") == "CostsKmeans")
    return costs.groupBy("run_id", "cache_mode", "partitions", "iter").agg(F.count("*").alias("n"), _r(F.max("value"), "cost"))


def q_partition_layout(spark, d):
    """Three points in eight partitions, and all points in eight."""
    pts = embeddings(spark, d)
    few = partition_count(with_partitions(pts.where("id < 3"), 8)).withColumn("points", F.lit("few"))
    every = partition_count(with_partitions(pts, 8)).withColumn("points", F.lit("all"))
    both = few.unionByName(every)
    return both.select("points", "n_partitions", "n_rows", (F.col("n_filled") <= F.col("n_rows")).alias("filled_by_rows"))


def q_lloyd_bounds_20_iter(spark, d):
    pts = embeddings(spark, d)
    return _vectors(op.lloyd(pts, start(pts), 20, tol=None, bounds=True), "c", "cid", "n")


def q_cluster_bounds_lineitem(spark, d):
    run = cluster(lineitem(spark, d), init="naive", seed=SEED, cache="unpersist", bounds=True)
    return _summary(run.assigned())


def q_candidates_generations(spark, d):
    """Candidates of k-means|| with kept distances, by which far ones are passed over."""
    return _vectors(op.oversampled_candidates(embeddings(spark, d), 2 * K, SEED, cache="unpersist"), "c", "cid", "w")


def q_sweep(spark, d):
    """Costs of every combination; they do not depend on the partition count."""
    log = sweep(embeddings(spark, d), [2, 8], k=K, seed=SEED, rescale=False)
    costs = log.where(F.col("metric") == "CostsKmeans")
    return costs.select("init", "partitions", "iter", _r("value", "cost"))


def q_cache_modes(spark, d):
    caches = ("none", "persist", "unpersist")
    log = sweep(embeddings(spark, d), [8], inits=("parallel",), caches=caches, k=K, seed=SEED, rescale=False)
    costs = log.where(F.col("metric") == "CostsKmeans")
    return costs.select("cache_mode", "iter", _r("value", "cost"))


def q_sweep_runs(spark, d):
    """Runs and stages counted over a log that two sweeps have written."""
    path = fresh_path(spark, "runlog")
    pts = embeddings(spark, d)
    for caches, repetitions in ((("none", "persist"), 2), (("persist",), 1)):
        done = sweep(pts, [2], inits=("naive",), caches=caches, repetitions=repetitions, k=K, seed=SEED, rescale=False)
        append_run_log(done, path)
    stats = op.stage_stats(read_run_logs(spark, path))
    return stats.select("init", "cache_mode", "partitions", "n_rows", "stage", "n_runs")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources and layout
    "load_points": lambda s, d: _vectors(embeddings(s, d), "x", "id", "y"),
    "assemble": q_assemble,
    "shuffle": q_shuffle,
    "shuffle_subset": lambda s, d: subset(lineitem(s, d), SUBSET_ROWS, SEED).select("id", "y"),
    "partition_count": lambda s, d: partition_count(with_partitions(lineitem(s, d), 8)).select("n_partitions", "n_rows"),
    "cache_modes": q_cache_modes,
    "run_log_roundtrip": q_run_log_roundtrip,
    # profiling
    "shape": lambda s, d: op.shape(embeddings(s, d)),
    "table_shape": lambda s, d: op.table_shape(_table(s, d, "lineitem")),
    "type_profile": q_type_profile,
    "distinct_counts": q_distinct_counts,
    "distinct_counts_approx": q_distinct_counts_approx,
    "true_k": lambda s, d: op.true_k(_table(s, d, "part"), "p_brand"),
    "label_counts": lambda s, d: op.label_counts(_table(s, d, "part"), "p_brand"),
    "numeric_dim": lambda s, d: op.numeric_dim(_table(s, d, "lineitem")),
    # preparation
    "drop_categorical": q_drop_categorical,
    "min_max": q_min_max,
    "minmax_rescale": q_minmax_rescale,
    "label_index": lambda s, d: op.label_index(lineitem(s, d)).select("id", "y", "label_id"),
    "label_index_nulls": q_label_index_nulls,
    # distances, assignment, update
    "sq_dist": lambda s, d: embeddings(s, d).select("id", _r(sq_dist(F.col("x"), F.reverse("x")), "d2")),
    "assign": lambda s, d: _matches(op.assign(embeddings(s, d), start(embeddings(s, d)))),
    "assign_sql_kernel": lambda s, d: _matches(
        op.assign(embeddings(s, d), start(embeddings(s, d)), kernel="sql")
    ),
    "assign_lineitem": lambda s, d: _matches(op.assign(*_scaled_and_start(s, d))),
    "assign_keep_d2": lambda s, d: _matches(
        op.assign(_first_state(s, d)[0], start(embeddings(s, d)), update_d2=False)
    ),
    "update_distances": lambda s, d: _matches(
        op.update_distances(
            embeddings(s, d).withColumn("cid", F.col("y").cast("int")), start(embeddings(s, d))
        )
    ),
    "cost": lambda s, d: op.cost(op.assign(*_scaled_and_start(s, d))).select(_r("cost", "cost")),
    "update_centroids": lambda s, d: _vectors(
        op.update_centroids(op.assign(embeddings(s, d), start(embeddings(s, d)))), "c", "cid", "n"
    ),
    "update_centroids_weighted": lambda s, d: _vectors(
        op.update_centroids(
            op.assign(embeddings(s, d).withColumn("w", 1 + F.col("y").cast("double")), start(embeddings(s, d))), "w"
        ),
        "c",
        "cid",
        "w",
    ),
    "cluster_sizes": lambda s, d: op.cluster_sizes(op.assign(embeddings(s, d), start(embeddings(s, d)))),
    # initialisation
    "init_from_set": lambda s, d: _vectors(_scaled_and_start(s, d)[1], "c", "cid"),
    "init_from_space": q_init_from_space,
    "first_centroid_cost": lambda s, d: op.cost(_first_state(s, d)[0]).select(_r("cost", "cost")),
    "rounds": q_rounds,
    "oversample": lambda s, d: _sampled(s, d)[1].select("id", _r("d2", "d2")),
    "extend": q_extend,
    "dedup": q_dedup,
    "candidate_weights": q_candidate_weights,
    "candidates": q_candidates,
    "seed_plus_plus": q_seed_plus_plus,
    "seed_plus_plus_20": q_seed_plus_plus_20,
    "seed_plus_plus_weighted": q_seed_plus_plus_weighted,
    "recluster": q_recluster,
    "recluster_all_rounds": q_recluster_all_rounds,
    "init_parallel": q_init_parallel,
    # iterations and whole runs
    "lloyd_2_iter": q_lloyd_2_iter,
    "lloyd_weighted_2_iter": q_lloyd_weighted_2_iter,
    "lloyd_20_iter": q_lloyd_20_iter,
    "lloyd_weighted_100_iter": q_lloyd_weighted_100_iter,
    "lloyd_cost_log": q_lloyd_cost_log,
    "cluster_naive": q_cluster_naive,
    "cluster_parallel": q_cluster_parallel,
    "cluster_space": q_cluster_space,
    "cluster_naive_lineitem": q_cluster_naive_lineitem,
    "cluster_parallel_lineitem": q_cluster_parallel_lineitem,
    # evaluation
    "sizes_desc": lambda s, d: op.cluster_sizes(op.assign(*_scaled_and_start(s, d)), order="desc"),
    "label_sizes_desc": lambda s, d: op.label_counts(embeddings(s, d), order="desc"),
    "expected_centroids": lambda s, d: _vectors(op.expected_centroids(embeddings(s, d)), "c", "cid", "y", "n"),
    "expected_distances": lambda s, d: op.expected_distances(scaled_lineitem(s, d)).select("id", "y", _r("d2", "d2")),
    "expected_distances_nulls": q_expected_distances_nulls,
    "evaluate_lineitem": q_evaluate_lineitem,
    "evaluate_lineitem_mse": q_evaluate_lineitem_mse,
    "match_centroids": lambda s, d: op.match_centroids(*_expected_and_start(s, d)).select(
        "cid", "matched", _r("d2", "d2"), _r("dist", "dist")
    ),
    "match_mse": lambda s, d: op.match_mse(*_expected_and_start(s, d)).select(_r("mse", "mse")),
    "rms_radius": lambda s, d: op.rms_radius(embeddings(s, d)).select("y", _r("radius", "radius")),
    "nearest_other": lambda s, d: op.nearest_other(op.expected_centroids(embeddings(s, d))).select(
        "cid", "nearest", _r("dist", "dist")
    ),
    # run-log analytics
    "stage_times": lambda s, d: op.stage_times(event_log(s, d)).select(
        *RUN, _r("pre", "pre"), _r("init_time", "init_time"), _r("lloyd", "lloyd")
    ),
    "stage_stats": lambda s, d: op.stage_stats(event_log(s, d)).select(
        *RUN[1:], "stage", _r("mean", "mean"), _r("std", "std"), "n_runs"
    ),
    "series": lambda s, d: op.series(event_log(s, d), "lloyd", "tTotal"),
    "cache_comparison": lambda s, d: op.cache_comparison(event_log(s, d)).select(
        "cache_mode", "n_rows", _r("mean_total", "mean_total"), "n_runs"
    ),
    "lloyd_bounds_20_iter": q_lloyd_bounds_20_iter,
    "cluster_bounds_lineitem": q_cluster_bounds_lineitem,
    "candidates_generations": q_candidates_generations,
    "run_log_merge": q_run_log_merge,
    "sweep_resumed": q_sweep_resumed,
    "partition_layout": q_partition_layout,
    "value_types": q_value_types,
    "value_types_nested": q_value_types_nested,
    "sweep": q_sweep,
    "sweep_runs": q_sweep_runs,
}
