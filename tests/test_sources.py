import numpy as np
import pytest
from pyspark.sql import functions as F

import pointset as ps
from pointset.sources import durable, points

EMB = "/root/testdata/sf0.001/embeddings.parquet"


def test_only_used_columns_are_read(spark):
    pts = ps.load_points(spark, "/root/testdata/sf0.001/lineitem.parquet", "l_orderkey", ["l_quantity", "l_tax"], "l_returnflag")
    plan = pts._jdf.queryExecution().executedPlan().toString()
    assert "l_comment" not in plan and "l_shipdate" not in plan
    assert pts.schema["x"].metadata == {"dim": 2}


def test_shuffle_is_a_permutation_in_keyed_order(spark):
    df = spark.range(2000)
    order = [r.id for r in ps.shuffle(df, 3).collect()]
    again = [r.id for r in ps.shuffle(df.repartition(5), 3).collect()]
    assert order == again != list(range(2000))
    assert sorted(order) == list(range(2000))


@pytest.mark.parametrize("n", [1, 700, 4999, 5000, 6000])
@pytest.mark.parametrize("bins", [4, 1024])
def test_subset_by_threshold_equals_top_n(spark, monkeypatch, n, bins):
    df = spark.range(5000)
    want = {r.id for r in ps.shuffle(df, 3).limit(n).collect()}
    monkeypatch.setattr(points, "TAKEN_ROWS", 0)
    monkeypatch.setattr(points, "TOP_N_LIMIT", 0 if bins == 1024 else 50)
    monkeypatch.setattr(points, "HISTOGRAM_BINS", bins)
    got = ps.subset(df, n, 3)
    assert {r.id for r in got.collect()} == want


@pytest.mark.parametrize("n", [1, 15, 50, 60, 99, 100])
@pytest.mark.parametrize("limit", [5, 10_000])
def test_subset_of_repeated_ids_has_n_rows(spark, monkeypatch, n, limit):
    monkeypatch.setattr(points, "TOP_N_LIMIT", max(limit, 10))
    monkeypatch.setattr(points, "TAKEN_ROWS", 0 if limit == 5 else 20)
    df = spark.range(100).select((F.col("id") % 10).alias("id"))
    got = [r.id for r in ps.subset(df, n, 3).collect()]
    order = [r.id for r in ps.shuffle(spark.range(10), 3).collect()]
    assert sorted(got) == sorted((order * 10)[i] for i in [j // 10 for j in range(n)])


def test_few_rows_enter_the_sort_of_a_subset(spark, monkeypatch):
    written = []
    keep = points.measured
    monkeypatch.setattr(points, "measured", lambda df, name, **m: written.append(keep(df, name, **m)) or written[-1])
    assert ps.subset(spark.range(200_000), 1600, 3).count() == 1600
    assert [t.count() <= 1600 + 2 * 8 * 40 for t, _ in written] == [True]


def jobs_of(spark, work):
    spark.sparkContext.setJobGroup(f"g{id(work)}", "counted")
    result = work()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"g{id(work)}"))
    spark.sparkContext.setJobGroup("other", "other")
    return result, jobs


def test_a_small_subset_is_one_pass(spark):
    sub, jobs = jobs_of(spark, lambda: ps.subset(spark.range(5000), 100, 3))
    assert jobs == 0
    plan = sub._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    assert {r.id for r in sub.collect()} == {r.id for r in ps.shuffle(spark.range(5000), 3).limit(100).collect()}


@pytest.mark.parametrize("total", [None, 500, 10**9])
def test_start_points_take_one_job(spark, total):
    pts = ps.load_points(spark, EMB, "vec_id", "embedding", "label")
    # a wrong total is noticed, at the price of a second job
    cents, jobs = jobs_of(spark, lambda: ps.init_from_set(pts, 10, 3, total=total))
    assert jobs == (2 if total == 10**9 else 1)
    want = [r.x for r in ps.shuffle(pts, 3, tag="init").limit(10).collect()]
    assert [r.c for r in cents.orderBy("cid").collect()] == want


def test_measured_by_the_write_itself(spark):
    made, jobs = jobs_of(spark, lambda: durable.measured(spark.range(100), "t", n=F.count("*"), s=F.sum("id")))
    assert made[1] == {"n": 100, "s": 4950} and jobs == 1
    assert durable.measured(spark.range(9).where("id < 0"), "t", n=F.count("*"), s=F.sum("id"))[1] == {"n": 0, "s": None}


def test_wide_rows_are_not_small(spark, monkeypatch):
    monkeypatch.setattr(durable, "SMALL_BYTES", 100_000)
    wide = spark.range(40).select(F.array_repeat(F.lit(1.0), 4096).alias("c"))
    assert durable.fetch_small(wide) is None
    assert durable.fetch_small(wide.limit(3)).num_rows == 3
    assert durable.fetch_small(wide.limit(0)).num_rows == 0


def test_tables_of_a_scope_are_deleted(spark):
    import os

    with ps.table_scope():
        table = durable.materialize(spark.range(5), "t")
        folder = table.inputFiles()[0].rsplit("/", 1)[0].split(":", 1)[1]
        assert table.count() == 5 and os.path.exists(folder)
    assert not os.path.exists(folder)


def test_lifetimes_own_frames_and_tables(spark):
    import os

    def folder(table):
        return table.inputFiles()[0].rsplit("/", 1)[0].split(":", 1)[1]

    with ps.table_scope():
        outer = durable.materialize(spark.range(5), "t")
        inner = ps.Lifetime()
        with inner.active():
            kept = ps.Cache("persist").hold(spark.range(7))
            table = durable.materialize(kept, "t")
            released = ps.Cache("unpersist").hold(spark.range(8))
            ps.Cache("unpersist").release(released)
        # left open, it ends with the one around it
        places = [folder(outer), folder(table)]
        assert durable.is_kept(kept) and all(os.path.exists(p) for p in places)
        other = ps.Lifetime()
        with other.active():
            early = durable.materialize(spark.range(3), "t")
        other.close()
        assert not os.path.exists(folder_of(early)) and durable.is_kept(kept)
    assert not durable.is_kept(kept) and not any(os.path.exists(p) for p in places)
    inner.close()


def folder_of(table):
    return table._jdf.inputFiles()[0].rsplit("/", 1)[0].split(":", 1)[1]


def test_partitions(spark):
    row = ps.partition_count(ps.with_partitions(spark.range(100), 7)).head()
    assert (row.n_partitions, row.n_rows) == (7, 100)
    few = spark.range(0, 3, 1, 8)
    layout = ps.partition_layout(few).orderBy("partition").collect()
    assert [r.partition for r in layout] == list(range(8)) and sum(r.n_rows for r in layout) == 3
    assert [r.skew for r in layout] == [r.n_rows * 8 / 3 for r in layout]
    row = ps.partition_count(few).head()
    assert (row.n_partitions, row.n_filled, row.n_rows, row.skew) == (8, 3, 3, 8 / 3)
    none = ps.partition_count(spark.range(0, 3, 1, 4).where("id > 9")).head()
    assert (none.n_partitions, none.n_filled, none.n_rows, none.skew) == (4, 0, 0, None)


def test_materialize_and_discard(spark):
    df = ps.load_points(spark, EMB, "vec_id", "embedding", "label")
    scaled = ps.minmax_rescale(df)
    table = durable.materialize(scaled, "t")
    assert table.schema["x"].metadata == {"dim": 64}
    assert table.count() == 500
    files = table.inputFiles()
    durable.discard(table)
    import os

    assert not any(os.path.exists(f.split(":", 1)[1]) for f in files)
    durable.discard(df)  # not ours: stays
    assert os.path.exists(EMB)


class FakeSession:
    """Stands for a cluster session; the setting is fixed once a session runs."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_shared_folder_is_the_one_of_the_session():
    assert durable.shared_folder(FakeSession("hdfs:///shared", "yarn")) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        durable.shared_folder(FakeSession(None, "yarn"))


@pytest.mark.parametrize("limit, hot", [(50_000, 10**6), (3, 10**6), (3, 200)])
def test_lookup_join_with_a_hot_key(spark, monkeypatch, limit, hot):
    monkeypatch.setattr(durable, "SMALL_ROWS", limit)
    monkeypatch.setattr(durable, "HOT_ROWS", hot)
    monkeypatch.setattr(durable, "SALTED_ROWS", 100)
    big = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int"))
    small = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    rows = ps.lookup_join(big, small, "k").collect()
    want = [(i, 0 if i % 3 == 0 else i % 50) for i in range(3000)]
    assert sorted((r.id, r.k, r.v) for r in rows) == [(i, k, 2 * k) for i, k in want if k < 40]


def test_run_log_round_trip(spark, tmp_path):
    log = ps.RunLog("a", "naive", "none", 8)
    log.add("lloyd", "CostsKmeans", 2.5, 0)
    log.add("lloyd", "CostsKmeans", 1.5, 1)
    with log.timed("pre"):
        pass
    path = str(tmp_path / "log")
    ps.append_run_log(log.to_df(spark), path)
    ps.append_run_log(log.to_df(spark), path)
    # written twice, it is there once
    back = ps.read_run_logs(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, log.to_df(spark).collect()))
    assert [r.value for r in ps.series(log.to_df(spark), "lloyd", "CostsKmeans").collect()] == [2.5, 1.5]


def test_uniform_is_uniform_and_independent_of_layout(spark):
    u = ps.uniform(1, "t")
    a = np.array([r.u for r in spark.range(20000).select(u.alias("u")).collect()])
    b = {r.id: r.u for r in spark.range(20000).repartition(3).select("id", u.alias("u")).collect()}
    assert [b[i] for i in range(20000)] == a.tolist()
    assert 0 <= a.min() and a.max() < 1 and abs(a.mean() - 0.5) < 0.01 and abs(a.var() - 1 / 12) < 0.003


def test_weighted_draw_follows_the_weights(spark):
    wins = np.zeros(4)
    draws = spark.range(4000).select(F.col("id").alias("d"), F.explode(F.array(*map(F.lit, range(4)))).alias("id"))
    draws = draws.withColumn("w", F.col("id") + 1.0)
    race = ps.exponential_race(5, "d", "d * 10 + id", "w")
    for r in draws.groupBy("d").agg(F.min_by("id", race).alias("id")).groupBy("id").count().collect():
        wins[r.id] = r["count"]
    assert np.allclose(wins / 4000, [0.1, 0.2, 0.3, 0.4], atol=0.03)


def entries(log):
    return sorted((r.run_id, r.partitions, r.stage, r.metric, r.iter, r.value) for r in log.collect())


def test_a_stage_written_again_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "log")
    one, two = ps.RunLog("a", "naive", "none", 8), ps.RunLog("b", "naive", "none", 4)
    for i in range(3):
        one.add("lloyd", "CostsKmeans", 10.0 - i, i)
        two.add("lloyd", "CostsKmeans", 20.0 - i, i)
    one.add("pre", "tTotal", 1.0)
    ps.append_run_log(one.to_df(spark).unionAll(two.to_df(spark)), path)
    again = ps.RunLog("a", "naive", "none", 8)
    again.add("lloyd", "CostsKmeans", 5.0, 0)
    ps.append_run_log(again.to_df(spark), path)
    want = sorted(
        [("a", 8, "lloyd", "CostsKmeans", 0, 5.0), ("a", 8, "pre", "tTotal", 0, 1.0)]
        + [("b", 4, "lloyd", "CostsKmeans", i, 20.0 - i) for i in range(3)]
    )
    assert entries(ps.read_run_logs(spark, path)) == want
    one_count = ps.read_run_logs(spark, path).where("partitions = 4")
    assert entries(one_count) == [w for w in want if w[1] == 4]
    assert "PartitionFilters: [isnotnull(partitions" in one_count._jdf.queryExecution().toString()
    ps.compact_run_log(spark, path)
    assert entries(ps.read_run_logs(spark, path)) == want
    assert spark.read.parquet(path).count() == 5
    ps.append_run_log(again.to_df(spark), path)
    assert entries(ps.read_run_logs(spark, path)) == want


def test_runs_a_log_does_not_hold_whole(spark, tmp_path):
    path = str(tmp_path / "log")
    plan = spark.createDataFrame(
        [("a", "naive", "none", 2, 9), ("b", "naive", "none", 2, 9)], "run_id string, init string, cache_mode string, partitions int, n_rows long"
    )
    assert ps.unfinished(plan, path).count() == 2
    half = ps.RunLog("a", "naive", "none", 2, 9)
    half.add("init", "tTotal", 1.0)
    ps.append_run_log(half.to_df(spark), path)
    assert ps.unfinished(plan, path).count() == 2
    half.add("total", "tTotal", 2.0)
    ps.append_run_log(half.to_df(spark), path)
    assert [r.run_id for r in ps.unfinished(plan, path).collect()] == ["b"]
