import importlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import pointset as ps
from pointset.operators import iterations, seeding
from pointset.operators.state import NearestState
from pointset.sources import Cache, durable

EMB = "/root/testdata/sf0.001/embeddings.parquet"


def make_points(spark, x, y=None):
    rows = [(i, [float(v) for v in row], str(0 if y is None else y[i])) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, x array<double>, y string")


def cents_of(spark, c):
    return ps.centroid_table(spark, range(len(c)), np.asarray(c, dtype=float))


def as_dict(cents):
    return {r.cid: r.c for r in cents.collect()}


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(11)
    y = np.arange(600) % 6
    centres = np.array([[0, 0, 0], [9, 0, 0], [0, 9, 0], [0, 0, 9], [9, 9, 0], [9, 9, 9]])
    return make_points(spark, centres[y] + rng.normal(scale=0.3, size=(600, 3)), y).persist()


@pytest.fixture(scope="module")
def embeddings(spark):
    return ps.load_points(spark, EMB, "vec_id", "embedding", "label").persist()


def numpy_lloyd(x, c, n):
    costs = []
    for _ in range(n):
        d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        cid = d.argmin(axis=1)
        costs.append(d.min(axis=1).sum())
        c = np.array([x[cid == i].mean(axis=0) for i in sorted(set(cid))])
    return c, costs


def test_kernels_agree(spark, embeddings):
    cents = ps.init_from_set(embeddings, 12, 1)
    a = {r.id: (r.cid, r.d2) for r in ps.assign(embeddings, cents).collect()}
    b = {r.id: (r.cid, r.d2) for r in ps.assign(embeddings, cents, kernel="sql").collect()}
    assert a.keys() == b.keys()
    assert all(a[i][0] == b[i][0] and a[i][1] == pytest.approx(b[i][1]) for i in a)


def test_lloyd_matches_numpy(spark, embeddings):
    x = np.array([r.x for r in embeddings.orderBy("id").collect()])
    log = ps.RunLog()
    cents = ps.lloyd(embeddings, cents_of(spark, x[:8]), 4, tol=None, log=log)
    want, costs = numpy_lloyd(x, x[:8], 4)
    got = as_dict(cents)
    assert np.allclose([got[i] for i in sorted(got)], want)
    assert np.allclose(log.values("lloyd", "CostsKmeans"), costs)


def test_stop_rule(spark, embeddings):
    log = ps.RunLog()
    ps.lloyd(embeddings, ps.init_from_set(embeddings, 10, 3), 50, log=log)
    costs = log.values("lloyd", "CostsKmeans")
    assert 1 < len(costs) < 50
    assert all(b <= a for a, b in zip(costs, costs[1:]))
    gains = [b > 0.999 * a for a, b in zip(costs, costs[1:])]
    assert gains[-1] and not any(gains[:-1])


def test_result_depends_on_neither_partitions_nor_caching(spark, embeddings):
    base = ps.cluster(embeddings, seed=5, k=4, cache="none")
    for partitions, cache in [(1, "persist"), (8, "unpersist")]:
        run = ps.cluster(embeddings, partitions=partitions, seed=5, k=4, cache=cache)
        assert np.allclose(run.costs(), base.costs())
        assert np.allclose(run.costs("init"), base.costs("init"))
    spark.catalog.clearCache()


def test_one_cluster_may_hold_most_points(spark):
    """Sums leave a task as one row per cluster, however many points it has."""
    pts = spark.range(200_000).select(
        "id",
        F.array(F.when(F.col("id") % 10 == 0, F.col("id") * 1.0).otherwise(0.25)).alias("x"),
        F.when(F.col("id") % 10 == 0, F.lit("few")).otherwise("many").alias("y"),
    )
    got = {r.y: (r.c[0], r.n) for r in ps.update_centroids(pts, key="y").collect()}
    assert got == {"few": (99995.0, 20_000), "many": (0.25, 180_000)}
    cents = as_dict(ps.lloyd(pts, cents_of(spark, [[0.0], [1e6]]), 1, tol=None))
    assert cents.keys() == {0} and cents[0][0] == pytest.approx((99995.0 * 20_000 + 0.25 * 180_000) / 200_000)


@pytest.mark.parametrize("init", ["parallel", "naive", "space"])
def test_runs_cover_all_points(spark, blobs, init):
    run = ps.cluster(blobs, init=init, seed=2)
    sizes = ps.cluster_sizes(run.assigned()).collect()
    assert run.k == 6 and sum(r.n for r in sizes) == 600 and len(sizes) <= 6


def test_well_separated_blobs_are_found(spark, blobs):
    run = ps.cluster(blobs, seed=1, rescale=False)
    assert ps.match_mse(ps.expected_centroids(blobs), run.centroids).head().mse < 0.01
    assert sorted(r.n for r in ps.cluster_sizes(run.assigned()).collect()) == [100] * 6


def test_cost_is_close_to_that_of_mllib(spark, embeddings):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    model = KMeans(k=10, seed=1, maxIter=20).fit(embeddings.select(array_to_vector("x").alias("features")))
    mine = ps.cost(ps.cluster(embeddings, k=10, seed=1, rescale=False).assigned()).head().cost
    assert mine < 1.05 * model.summary.trainingCost


def test_coinciding_points_give_one_centroid(spark):
    pts = make_points(spark, [[1.0, 2.0]] * 20)
    assert as_dict(ps.init_parallel(pts, 3)) == {0: [1.0, 2.0]}
    assert as_dict(ps.seed_plus_plus(pts, 3)) == {0: [1.0, 2.0]}
    assert as_dict(ps.lloyd(pts, cents_of(spark, [[1.0, 2.0]]), 5)) == {0: [1.0, 2.0]}


def test_run_without_any_varying_dimension(spark):
    pts = make_points(spark, [[3.0, 4.0]] * 12, [i % 2 for i in range(12)])
    for init in ("parallel", "naive"):
        run = ps.cluster(pts, init=init)
        assert [(r.cid, r.n) for r in ps.cluster_sizes(run.assigned()).collect()] == [(0, 12)]
        assert set(run.costs()) == {0.0}


def test_fewer_distinct_points_than_k(spark):
    pts = make_points(spark, [[0.0], [0.0], [1.0], [5.0]] * 5)
    cents = as_dict(ps.init_parallel(pts, 10, seed=4))
    assert sorted(c[0] for c in cents.values()) == [0.0, 1.0, 5.0]


def test_empty_clusters_are_dropped_and_ids_stay(spark):
    pts = make_points(spark, [[0.0], [1.0], [10.0], [11.0]])
    assert as_dict(ps.lloyd(pts, cents_of(spark, [[0.0], [500.0], [10.0]]), 3)) == {0: [0.5], 2: [10.5]}


def test_empty_table_is_an_error(spark, embeddings):
    nothing = embeddings.where("id < 0")
    with pytest.raises(ValueError):
        ps.init_parallel(nothing, 3)
    with pytest.raises(ValueError):
        ps.lloyd(nothing, ps.init_from_set(embeddings, 3), 2)


def test_no_draw_leaves_the_state_alone(spark, embeddings):
    log = ps.RunLog()
    cands = ps.oversampled_candidates(embeddings, 1e-9, 3, log)
    costs = log.values("init", "CostInit")
    assert cands.count() == 1 and len(costs) == ps.rounds(costs[0]) + 1 and len(set(costs)) == 1


def test_rounds():
    assert [ps.rounds(v) for v in (0.0, 0.5, 2.0, 20.1, 500.0)] == [0, 1, 1, 3, 6]


def test_zero_weights_do_not_count(spark):
    pts = make_points(spark, [[0.0], [2.0], [100.0], [6.0]]).withColumn(
        "w", F.expr("CASE id WHEN 0 THEN 1.0D WHEN 1 THEN 3.0D WHEN 2 THEN 0.0D ELSE 2.0D END")
    )
    got = as_dict(ps.lloyd(pts, cents_of(spark, [[0.0], [90.0]]), 1, tol=None, weight="w"))
    assert got == {0: [18.0 / 6]}
    one = pts.withColumn("cid", F.lit(4))
    assert as_dict(ps.update_centroids(one, "w")) == {4: [3.0]}
    seeds = as_dict(ps.seed_plus_plus(pts, 4, "w"))
    assert sorted(c[0] for c in seeds.values()) == [0.0, 2.0, 6.0]


def test_candidates_are_those_of_the_plain_definition(spark, embeddings):
    """Brute force over the operators, one pass per statement."""
    pts = embeddings.select("id", "x")
    cents = ps.init_from_set(pts, 1, 3)
    frame = ps.assign(pts, cents)
    psi = ps.cost(frame).head().cost
    for r in range(ps.rounds(psi)):
        drawn = ps.oversample(frame, 20, psi, 3, r)
        cents = cents_of(spark, np.array(list(as_dict(ps.extend(cents, drawn)).values())))
        frame = ps.assign(pts, cents)
        psi = ps.cost(frame).head().cost
    want = {r.cid: (r.c, r.w) for r in ps.candidate_weights(pts, ps.dedup(cents)).collect()}
    for mode in ("none", "persist", "unpersist"):
        got = {r.cid: (r.c, r.w) for r in ps.oversampled_candidates(pts, 20, 3, cache=mode).collect()}
        assert got == want
    spark.catalog.clearCache()


def test_generations_and_checkpoints_change_nothing(spark, embeddings):
    x = np.array([r.x for r in embeddings.orderBy("id").collect()])
    pts = embeddings.select("id", "x")
    for mode in ("none", "persist", "unpersist"):
        state = NearestState(pts, Cache(mode), fold_cells=0, checkpoint_every=2)
        for i in range(6):
            frame = state.add(x[3 * i : 3 * i + 3])
            cost = ps.cost(frame).head().cost
            state.settled()
        want = ps.assign(pts, cents_of(spark, x[:18]))
        assert cost == pytest.approx(ps.cost(want).head().cost)
        a = {r.id: r.cid for r in frame.collect()}
        assert a == {r.id: r.cid for r in want.collect()}
        state.close()


def test_duplicate_centres_merge(spark, embeddings):
    x = np.array([r.x for r in embeddings.orderBy("id").limit(4).collect()])
    state = NearestState(embeddings.select("id", "x"), Cache("unpersist"), fold_cells=0)
    state.add(x[:2])
    frame = state.add(x[[1, 2, 1]])
    assert {r.cid for r in frame.select("cid").distinct().collect()} <= {0, 1, 3}
    assert state.rank[1] == state.rank[2] == state.rank[4]


def test_assign_in_blocks(spark, embeddings, monkeypatch):
    cents = cents_of(spark, [r.x for r in embeddings.orderBy("id").limit(40).collect()])
    want = {r.id: (r.cid, r.d2) for r in ps.assign(embeddings, cents).collect()}
    monkeypatch.setattr(durable, "SMALL_ROWS", 7)
    got = {r.id: (r.cid, r.d2) for r in ps.assign(embeddings, cents).collect()}
    assert got == want


def test_nearest_other_in_blocks(spark, embeddings, monkeypatch):
    cents = cents_of(spark, [r.x for r in embeddings.orderBy("id").limit(30).collect()])
    want = {r.cid: (r.nearest, r.dist) for r in ps.nearest_other(cents).collect()}
    monkeypatch.setattr(durable, "SMALL_ROWS", 7)
    got = {r.cid: (r.nearest, r.dist) for r in ps.nearest_other(cents).collect()}
    assert got == want and len(got) == 30


def test_lone_centroid(spark):
    row = ps.nearest_other(cents_of(spark, [[1.0]])).head()
    assert row.nearest is None and row.dist == float("inf")


@pytest.mark.parametrize("limit", [9, 110])
def test_large_candidate_sets(spark, embeddings, monkeypatch, limit):
    """From the start, and from a round in between, the rounds go on with tables."""
    # scaled down, so that the first cost asks for three rounds
    pts = embeddings.select("id", F.transform("x", lambda v: v * 0.22).alias("x"))
    log = ps.RunLog()
    want = {r.cid: (r.c, r.w) for r in ps.oversampled_candidates(pts, 20, 3, log).collect()}
    assert len(log.values("init", "CostInit")) == 4 and len(want) > 30
    monkeypatch.setattr(durable, "SMALL_ROWS", limit)
    again = ps.RunLog()
    got = {r.cid: (r.c, r.w) for r in ps.oversampled_candidates(pts, 20, 3, again).collect()}
    assert got == want
    assert np.allclose(again.values("init", "CostInit"), log.values("init", "CostInit"))
    assert [len(again.values("init", m)) for m in ("tSamples", "tCentroids")] == [3, 3]


@pytest.mark.parametrize("block", [50_000, 7])
def test_sql_kernel_in_every_block(spark, embeddings, monkeypatch, block):
    cents = cents_of(spark, [r.x for r in embeddings.orderBy("id").limit(20).collect()])
    want = {r.id: r.cid for r in ps.assign(embeddings, cents).collect()}
    monkeypatch.setattr(durable, "SMALL_ROWS", block)
    frame = ps.assign(embeddings, cents, kernel="sql")
    assert {r.id: r.cid for r in frame.collect()} == want
    assert "ArrowEvalPython" not in frame._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        ps.assign(embeddings, cents, kernel="nonsense")


@pytest.mark.parametrize(
    "vectors", [[[1.0, 2.0, 3.0], [4.0]], [[1.0, None], [2.0, 3.0]], [[1.0, float("nan")]], [None, [1.0, 2.0]], [[0.0, 0.0, 9.0]]]
)
def test_malformed_vectors_raise(spark, vectors):
    pts = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "id bigint, x array<double>").coalesce(1)
    with pytest.raises(Exception, match="vectors"):
        ps.assign(pts, cents_of(spark, [[0.0, 0.0], [1.0, 1.0]])).collect()


def test_seeding_takes_few_jobs(spark, embeddings):
    pts = embeddings.select("id", "x").coalesce(1).persist()
    pts.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("seeding", "seeding")
    seeds = ps.seed_plus_plus(pts, 40, seed=5)
    jobs = len(tracker.getJobIdsForGroup("seeding"))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs < 12
    got = [r.c for r in seeds.orderBy("cid").collect()]
    # one draw at a time
    rows = {r.id: np.array(r.x) for r in pts.collect()}
    d2, chosen = {i: 1.0 for i in rows}, []
    for j in range(40):
        e = {r.id: r.e for r in pts.select("id", ps.exponential_race(5, f"pp{j}", "id", "1.0D").alias("e")).collect()}
        best = min((e[i] / d2[i], i) for i in rows if d2[i] > 0)[1]
        chosen.append(rows[best])
        d2 = {i: min(d2[i] if j else np.inf, float(np.sum((rows[i] - rows[best]) ** 2))) for i in rows}
    assert np.array_equal(np.array(got), np.array(chosen))
    pts.unpersist()


def test_lloyd_stops_when_still_on_both_ways(spark, monkeypatch):
    x = [[float(i % 3) * 10 + (i % 5) * 0.1] for i in range(60)]
    pts = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "id bigint, x array<double>")
    cents = cents_of(spark, [[0.0], [11.0], [19.0]])
    one, two = ps.RunLog(), ps.RunLog()
    ps.lloyd(pts, cents, 30, tol=None, log=one)
    monkeypatch.setattr(durable, "SMALL_ROWS", 2)
    ps.lloyd(pts, cents, 30, tol=None, log=two)
    assert len(one.values("lloyd", "CostsKmeans")) == len(two.values("lloyd", "CostsKmeans")) < 30


def test_nothing_is_left_behind(spark, embeddings, monkeypatch):
    import pathlib

    folder = pathlib.Path(durable.shared_folder(spark).split(":", 1)[-1]) / "pointset"
    before = set(folder.glob("*")) if folder.exists() else set()
    monkeypatch.setattr(durable, "SMALL_ROWS", 30)
    small = embeddings.select("id", F.transform("x", lambda v: v * 0.22).alias("x"), "y")
    with ps.table_scope():
        ps.cluster(small, k=5, max_iter=2, rescale=False).centroids.collect()
        ps.dedup(small.select(F.col("id").alias("cid"), F.col("x").alias("c"))).collect()
        ps.init_parallel(small.select("id", "x"), 5).collect()
    assert set(folder.glob("*")) == before


def test_sweep_runs_keep_their_own_times(spark, embeddings, tmp_path):
    log = ps.sweep(
        embeddings, [2], inits=("naive",), caches=("none", "unpersist"), repetitions=2, k=3, max_iter=2, rescale=False
    )
    path = str(tmp_path / "log")
    ps.append_run_log(log, path)
    back = ps.read_run_logs(spark, path)
    assert back.select("run_id").distinct().count() == 4 and {r.n_rows for r in back.collect()} == {500}
    assert ps.stage_times(back).count() == 4
    assert {(r.cache_mode, r.n_runs) for r in ps.stage_stats(back).collect()} == {("none", 2), ("unpersist", 2)}


def test_early_arrivals_do_not_grow_with_the_tasks(spark, embeddings):
    pts = embeddings.select("id", "x", F.lit(1.0).alias("w"), F.lit(0.5).alias("d2"))
    draws = range(3, 9)
    few, odds = seeding._early_arrivals(pts.coalesce(1), 5, draws, 64 / 250)
    many, same = seeding._early_arrivals(pts.repartition(300), 5, draws, 64 / 250)
    assert odds == same == 250
    ids = lambda races: {j: sorted(r.id for r in races[j]) for j in races}
    assert ids(few) == ids(many) and 200 < sum(map(len, many.values())) < 600
    first, horizon, _ = seeding._first_arrivals(pts.repartition(40), 5, draws)
    assert {j: r[0].id for j, r in first.items()} == {j: min(few[j], key=lambda r: r.e).id for j in draws}


def pruned_run(pts, mode, monkeypatch):
    monkeypatch.setattr(seeding, "FACTS", dict(seeding.FACTS))
    log = ps.RunLog()
    with ps.table_scope():
        found = ps.oversampled_candidates(pts, 12.0, 5, log, mode).orderBy("cid").collect()
    return [(r.c, r.w) for r in found], log


def test_far_candidates_are_not_measured(spark, blobs, monkeypatch):
    from pointset.operators import state

    pts = blobs.select("id", "x").coalesce(2).persist()
    monkeypatch.setattr(state, "FOLD_CELLS", 1)
    plain, all_log = pruned_run(pts, "none", monkeypatch)
    kept, log = pruned_run(pts, "unpersist", monkeypatch)
    assert kept == plain
    measured, rows = log.values("init", "nDistances"), log.values("init", "nRows")
    assert set(rows) == {600.0} and log.values("init", "CostInit") == all_log.values("init", "CostInit")
    # against comparing with all new candidates, and against comparing with all there are
    monkeypatch.setattr(state, "GAP_CELLS", 0)
    again, unpruned = pruned_run(pts, "unpersist", monkeypatch)
    assert again == plain
    assert sum(measured[1:]) < 0.5 * sum(unpruned.values("init", "nDistances")[1:])
    pts.unpersist()


def test_pruned_distances_are_exact():
    from pointset.operators import kernels

    rng = np.random.default_rng(4)
    for trial in range(60):
        old = rng.normal(size=(7, 3)).round(1)
        new = np.vstack([rng.normal(size=(5, 3)).round(1), old[:2]])
        x = np.vstack([rng.normal(size=(40, 3)).round(1), old])
        own, known = kernels.nearest(x, old)
        gaps = ((old[:, None] - new[None]) ** 2).sum(axis=2)
        where, best, counts = kernels.nearer(x, own, known, gaps, new)
        every, d2 = kernels.nearest(x, new)
        closer = d2 <= known
        assert np.array_equal(where[closer], every[closer]) and np.array_equal(best[closer], d2[closer])
        assert not (best[~closer] < known[~closer]).any() and counts.max() <= len(new)


@pytest.mark.parametrize("mode", ["none", "unpersist", "persist"])
def test_bounds_change_nothing_but_the_work(spark, blobs, mode):
    # of three neighbouring centroids two share a blob at first, so many iterations follow
    c = [[0.0, 0.0, 0.1], [0.1, 0.2, 0.0], [9.0, 0.1, 0.0], [0.0, 8.0, 1.0], [1.0, 0.0, 8.0], [50.0, 50.0, 50.0]]
    plain, log = ps.RunLog(), ps.RunLog()
    want = ps.lloyd(blobs, cents_of(spark, c), 20, tol=None, log=plain).orderBy("cid").collect()
    with ps.table_scope():
        got = ps.lloyd(blobs, cents_of(spark, c), 20, tol=None, log=log, cache=mode, bounds=True).orderBy("cid").collect()
    assert [(r.cid, r.n) for r in got] == [(r.cid, r.n) for r in want]
    assert np.allclose([r.c for r in got], [r.c for r in want], rtol=0, atol=1e-12)
    for metric in ("CostsKmeans", "nRows"):
        assert np.allclose(log.values("lloyd", metric), plain.values("lloyd", metric), rtol=1e-12)
    measured = log.values("lloyd", "nDistances")
    assert sum(measured) < 0.7 * sum(plain.values("lloyd", "nDistances"))
    assert measured[-1] < 0.2 * measured[0]


def test_bounds_on_points_that_do_not_cluster(spark, embeddings, monkeypatch):
    for loose in (0.0, 0.3, 1.1):
        monkeypatch.setattr(iterations, "LOOSE", loose)
        log, start = ps.RunLog(), ps.init_from_set(embeddings, 10, 3)
        want, got = (as_dict(ps.lloyd(embeddings, start, 20, tol=None, log=log, bounds=b)) for b in (False, True))
        assert want.keys() == got.keys() and all(np.allclose(want[i], got[i], rtol=0, atol=1e-12) for i in want)
    with pytest.raises(ValueError):
        ps.lloyd(embeddings.withColumn("w", F.lit(1.0)), start, 3, weight="w", bounds=True)


def persisted(spark):
    """Frames that hold blocks; what was released a moment ago may still be among them."""
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_nothing_stays_kept_after_a_sweep(spark, embeddings, monkeypatch):
    from pointset.operators import state

    monkeypatch.setattr(state, "FOLD_CELLS", 1)
    pts = embeddings.select("id", "x", "y")
    before = persisted(spark)
    log = ps.sweep(pts, [2], inits=("parallel",), caches=("persist", "unpersist"), k=3, max_iter=2, rescale=False)
    assert persisted(spark) <= before and log.where("stage = 'total'").count() == 2
    run = ps.cluster(pts, k=3, max_iter=2, cache="persist", rescale=False)
    assert persisted(spark) > before
    run.release()
    assert persisted(spark) <= before


def test_recluster_keeps_what_it_is_told_to(spark, embeddings, monkeypatch):
    held = []
    monkeypatch.setattr(Cache, "hold", lambda self, df, keep=Cache.hold: held.append(self.mode) or keep(self, df))
    cands = ps.oversampled_candidates(embeddings, 6.0, 5)
    before = persisted(spark)
    ps.recluster(cands, 3, 5)
    assert persisted(spark) <= before and set(held) == {"none"}


def test_a_stopped_sweep_goes_on(spark, embeddings, tmp_path, monkeypatch):
    plans = importlib.import_module("pointset.plans.cluster")
    path, ran = str(tmp_path / "log"), []
    once = plans.cluster

    def failing(*args, **options):
        if len(ran) == 2 and "stop" not in ran:
            ran.append("stop")
            raise KeyboardInterrupt
        ran.append(options["run_id"])
        return once(*args, **options)

    monkeypatch.setattr(plans, "cluster", failing)
    options = {"inits": ("naive",), "caches": ("none",), "repetitions": 2, "path": path, "name": "s", "k": 3, "max_iter": 2, "rescale": False}
    with pytest.raises(KeyboardInterrupt):
        ps.sweep(embeddings, [2, 3], **options)
    assert ps.read_run_logs(spark, path).where("stage = 'total'").count() == 2
    log = ps.sweep(embeddings, [2, 3], **options)
    names = [f"s-naive-none-{n}-{r}" for n in (2, 3) for r in (0, 1)]
    assert ran == [*names[:2], "stop", *names[2:]]
    done = log.where("stage = 'total'").collect()
    assert sorted(r.run_id for r in done) == names
    assert ps.sweep(embeddings, [2, 3], **options).count() == log.count() and len(ran) == 5


def test_both_ways_log_the_same(spark, embeddings, monkeypatch):
    pts = embeddings.select("id", "x")

    def logged():
        log = ps.RunLog()
        start = ps.init_parallel(pts, 5, seed=3, log=log)
        ps.lloyd(pts, start, 4, tol=None, log=log)
        return log

    small = logged()
    monkeypatch.setattr(durable, "SMALL_ROWS", 4)
    large = logged()
    head = lambda log: sorted((r[5], r[6], r[7]) for r in log.rows)
    assert head(small) == head(large)
    for stage, metric in (("init", "CostInit"), ("init", "nRows"), ("lloyd", "CostsKmeans"), ("lloyd", "nRows"), ("lloyd", "nDistances")):
        assert np.allclose(small.values(stage, metric), large.values(stage, metric))


def test_evaluate_a_finished_clustering(spark, blobs):
    run = ps.cluster(blobs, init="parallel", k=3, rescale=False)
    rows = ps.evaluate(run).collect()
    assert len(rows) == blobs.select("y").distinct().count()
    assert all(r.radius > 0 and r.other > 0 and r.d2 >= 0 for r in rows)


def test_lloyd_with_many_centroids(spark, embeddings, monkeypatch):
    cents = cents_of(spark, [r.x for r in embeddings.orderBy("id").limit(20).collect()])
    want = as_dict(ps.lloyd(embeddings, cents, 2, tol=None))
    monkeypatch.setattr(durable, "SMALL_ROWS", 9)
    got = as_dict(ps.lloyd(embeddings, cents, 2, tol=None))
    assert want.keys() == got.keys()
    assert all(np.allclose(want[i], got[i]) for i in want)


def test_many_start_centroids(spark, embeddings, monkeypatch):
    want = as_dict(ps.init_from_set(embeddings, 50, 3))
    monkeypatch.setattr(durable, "SMALL_ROWS", 20)
    assert as_dict(ps.init_from_set(embeddings, 50, 3)) == want
    assert as_dict(ps.init_from_set(embeddings, 50, 3, ps.RunLog())) == want


def test_dedup_of_many(spark, embeddings, monkeypatch):
    twice = embeddings.select(F.col("id").alias("cid"), F.col("x").alias("c"))
    twice = twice.unionByName(twice)
    want = as_dict(ps.dedup(twice))
    monkeypatch.setattr(durable, "SMALL_ROWS", 20)
    got = as_dict(ps.dedup(twice))
    assert got == want and len(got) == 500
    assert [got[i] for i in range(500)] == sorted(got.values())


def test_cost_drop_beyond_the_guess(spark, blobs, monkeypatch):
    want = {r.cid: (r.c, r.w) for r in ps.oversampled_candidates(blobs, 12, 3).collect()}
    monkeypatch.setattr(seeding, "COST_DROP", 1.0001)
    assert {r.cid: (r.c, r.w) for r in ps.oversampled_candidates(blobs, 12, 3).collect()} == want


def test_kernel_runs_once_under_a_filter(spark, embeddings):
    frame = ps.assign(embeddings, ps.init_from_set(embeddings, 3, 1))
    plan = frame.where("d2 > 0.5")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan


def test_step_shuffles_partial_sums_only(spark, embeddings):
    c = np.array([r.x for r in embeddings.limit(3).collect()])
    plan = iterations.step_sums(embeddings, np.arange(3), c)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1 and plan.index("MapInArrow") > plan.index("HashAggregate")


def test_blocks_hold_the_points_as_they_are(spark, embeddings):
    from pointset.operators import kernels, state

    want = np.array([r.x for r in embeddings.coalesce(1).select("x").collect()])
    blocks = state.keep_points(embeddings.coalesce(1), Cache("unpersist"))
    table = blocks.toArrow().combine_chunks().to_batches()[0]
    got, sizes = kernels.points(table), kernels.block_sizes(table, want)
    assert np.array_equal(got, want) and sizes.sum() == len(want)
    assert sizes.max() * want.shape[1] <= kernels.BLOCK_CELLS
    blocks.unpersist()
    # vectors without elements are still counted
    none = embeddings.select(F.array().cast("array<double>").alias("x"))
    empty = state.keep_points(none, Cache("unpersist"))
    assert empty.agg(F.sum("n")).head()[0] == len(want)
    empty.unpersist()


@pytest.mark.parametrize("mode", ["none", "persist", "unpersist"])
def test_runs_on_blocks_are_those_on_rows(spark, blobs, mode):
    run = ps.cluster(blobs, k=4, cache=mode, seed=3, rescale=False)
    want = ps.cluster(blobs, k=4, seed=3, rescale=False)
    found = [{r.cid: (r.n, *r.c) for r in done.centroids.collect()} for done in (run, want)]
    assert found[0].keys() == found[1].keys()
    assert all(found[0][cid] == pytest.approx(found[1][cid]) for cid in found[0])
    for metric in ("CostInit", "nRows", "nDistances"):
        assert run.log.values("init", metric) == pytest.approx(want.log.values("init", metric))
    run.release()


def test_rounds_read_the_ids_of_all_points_once(spark, embeddings, monkeypatch):
    """A pass of k-means|| takes no ids: draws of all rounds come from one."""
    pts = embeddings.select("id", F.transform("x", lambda v: v * 0.22).alias("x"))
    passes = []
    early = seeding.EarlyHits.__init__
    monkeypatch.setattr(seeding.EarlyHits, "__init__", lambda self, *a: passes.append(a[-1]) or early(self, *a))
    log = ps.RunLog()
    ps.oversampled_candidates(pts, 12, 3, log, "unpersist").collect()
    assert len(log.values("init", "CostInit")) == 4 and [len(left) for left in passes] == [3]


def test_bounds_in_digits(spark):
    from pointset.functions import bound_digits, digits_of, draw_start

    bounds = [0.0, 1e-9, 0.25, 0.3, 0.5, 0.999999, 1.0, 7.5, 1e300]
    rows = spark.range(300).crossJoin(spark.createDataFrame([(b,) for b in bounds], "b double"))
    start = f"'{draw_start(5, 'r')}'"
    less = digits_of(start) < bound_digits("b")
    assert rows.where(less != (ps.uniform(5, "r") < F.col("b"))).count() == 0
    own = spark.range(300).withColumn("b", ps.uniform(5, "r"))
    assert own.where(digits_of(start) < bound_digits("b")).count() == 0


@pytest.mark.parametrize("mode", ["none", "unpersist"])
def test_a_generation_holds_blocks(spark, blobs, mode):
    from pointset.operators import iterations, state

    x = np.array([r.x for r in blobs.orderBy("id").collect()])
    pts, c = blobs.select("x").coalesce(2), x[:3]
    found = iterations.Generation(pts, np.arange(3), c, Cache(mode))
    assert state.in_blocks(found.df) and found.df.agg(F.sum("n")).head()[0] == len(x) > found.df.count()
    near = np.argmin(((x[:, None] - c) ** 2).sum(axis=2), axis=1)
    assert found.sums.counts().tolist() == np.bincount(near).tolist()
    assert np.allclose(found.sums.means(), [x[near == j].mean(axis=0) for j in range(3)])
    # all look alike to the bounds, if centroids have not moved
    sums, loose, full = found.since(np.arange(3), c)
    assert sums.counts().tolist() == found.sums.counts().tolist() and full <= loose < len(x)
    moved = found.sums.means()
    sums, _, _ = found.since(np.arange(3), moved)
    again = np.argmin(((x[:, None] - moved) ** 2).sum(axis=2), axis=1)
    assert sums.counts().tolist() == np.bincount(again).tolist()
    found.close()
