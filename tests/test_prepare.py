import datetime

import pytest
from pyspark.sql import functions as F

import pointset as ps
from pointset.operators import prepare
from pointset.sources import durable


@pytest.fixture
def table(spark):
    rows = [
        (1, 2.0, b"tcp", "a", None, datetime.date(2020, 1, 1)),
        (2, -0.0, b"udp", "b", None, datetime.date(2020, 1, 1)),
        (3, 0.0, b"tcp", "b", None, datetime.date(2020, 1, 2)),
    ]
    return spark.createDataFrame(rows, "n int, v double, proto binary, y string, hole double, day date")


def test_types_seen(table):
    got = {r.attribute: r.types for r in ps.type_profile(table).collect()}
    assert got == {"n": "integer", "v": "float", "proto": "text", "y": "text", "hole": "null", "day": "time"}


def test_distinct_counts(table):
    exact = {r.attribute: r.n_distinct for r in ps.distinct_counts(table).collect()}
    assert exact == {"n": 3, "v": 2, "proto": 2, "y": 2, "hole": 0, "day": 2}
    assert {r.attribute for r in ps.distinct_counts(table, approx=True).collect()} == set(exact)
    assert [r.n_distinct for r in ps.distinct_counts(table, ["n"]).collect()] == [3]


def test_binary_and_text_columns_are_categorical(table):
    assert ps.drop_categorical(table).columns == ["n", "v", "hole", "day"]
    assert ps.drop_categorical(table, keep=["y"]).columns == ["n", "v", "y", "hole", "day"]


def test_dimensions_are_what_dropping_leaves(table):
    wide = table.withColumns(
        {"flag": F.lit(True), "none": F.lit(None).cast("string"), "vec": F.array(F.lit(1.0)), "at": F.lit(None).cast("timestamp")}
    )
    left = ps.drop_categorical(wide).columns
    row = ps.numeric_dim(wide).head()
    assert row.dim == len(left) == 7 and "none" not in left
    assert row.n_rows == wide.count() and row.n_filled == sum(wide.where(F.col(c).isNotNull()).count() > 0 for c in left) == 5
    assert tuple(ps.numeric_dim(wide.where("false")).head()) == (7, 0, 0)
    assert tuple(ps.numeric_dim(wide.select("y")).head()) == (0, 0, wide.count())


def test_types_found_in_values(spark):
    docs = [
        None, "", "{", '{"a": 1, "b": [1, "x", null, {"c": true}]}', '{"a": 2.5, "b": {"c": null}}', "[]", "7", '"t"', "null",
        '{"a": {"a": {"a": {"a": [[[]]]}}}}', '{"a.b": 1e300}',
    ]
    table = spark.createDataFrame([(d,) for d in docs], "doc string")
    want = {
        "$": ("array,integer,malformed,null,object,text", 9, 2),
        "$.a": ("float,integer,object", 3, 0),
        "$.b": ("array,object", 2, 0),
        "$.b[*]": ("integer,null,object,text", 3, 1),
        "$.b[*].c": ("boolean", 1, 0),
        "$.b.c": ("null", 0, 1),
        "$.a.a": ("object", 1, 0),
        "$.a.a.a": ("object", 1, 0),
        "$.a.a.a.a": ("array", 1, 0),
        "$.a.a.a.a[*]": ("array", 1, 0),
        "$.a.a.a.a[*][*]": ("array", 1, 0),
        "$.a.b": ("float", 1, 0),
    }
    assert {r.path: (r.types, r.n_values, r.n_nulls) for r in ps.value_types(table, "doc").collect()} == want
    variants = table.select(F.try_parse_json("doc").alias("v"))
    found = {r.path: r.types for r in ps.value_types(variants, "v").collect()}
    assert found == {p: t.replace("malformed,", "") for p, (t, _, _) in want.items()}
    assert ps.value_types(table.where("false"), "doc").count() == 0


def test_vectors_are_counted(table):
    wide = table.withColumn("vec", F.array(F.col("n") % 2))
    assert [r.n_distinct for r in ps.distinct_counts(wide, ["vec"]).collect()] == [2]
    assert ps.distinct_counts(wide).count() == 7


@pytest.mark.parametrize("limit", [50_000, 1])
def test_points_without_a_label_stay(spark, monkeypatch, limit):
    monkeypatch.setattr(durable, "SMALL_ROWS", limit)
    rows = [(0, [1.0], "a"), (1, [3.0], "a"), (2, [5.0], None), (3, [6.0], "b")]
    pts = spark.createDataFrame(rows, "id bigint, x array<double>, y string")
    assert sorted((r.id, r.label_id) for r in ps.label_index(pts).collect()) == [(0, 0), (1, 0), (2, None), (3, 1)]
    assert sorted((r.id, r.d2) for r in ps.expected_distances(pts).collect()) == [(0, 1.0), (1, 1.0), (2, None), (3, 0.0)]
    assert sorted((r.y, r.radius) for r in ps.rms_radius(pts).collect()) == [("a", 1.0), ("b", 0.0)]
    cents = spark.createDataFrame([(0, [0.0]), (7, [1.0])], "cid int, c array<double>")
    known = pts.withColumn("cid", F.when(F.col("id") < 2, F.lit(0)).when(F.col("id") == 3, F.lit(9)))
    assert sorted((r.id, r.d2) for r in ps.update_distances(known, cents).collect()) == [(0, 1.0), (1, 9.0), (2, None), (3, None)]


def _points(spark, vectors):
    return spark.createDataFrame([(i, v, str(i % 2)) for i, v in enumerate(vectors)], "id bigint, x array<double>, y string")


def test_constant_dimensions_are_removed(spark):
    out = ps.minmax_rescale(_points(spark, [[1.0, 5.0, 3.0], [3.0, 5.0, 7.0], [2.0, 5.0, 5.0]]))
    assert [r.x for r in out.orderBy("id").collect()] == [[0.0, 0.0], [1.0, 1.0], [0.5, 0.5]]
    assert out.schema["x"].metadata["dim"] == 2


def test_all_dimensions_constant(spark):
    out = ps.minmax_rescale(_points(spark, [[1.0], [1.0]]))
    assert [r.x for r in out.collect()] == [[], []]


@pytest.mark.parametrize("dim", [3, 40, 130])
def test_wide_vectors(spark, dim):
    pts = _points(spark, [[float((i * j) % 7) for j in range(dim)] for i in range(1, 30)])
    bounds = {r.pos: (r.lo, r.hi) for r in ps.min_max(pts).collect()}
    assert bounds == {j: (min((i * j) % 7 for i in range(1, 30)), max((i * j) % 7 for i in range(1, 30))) for j in range(dim)}
    scaled = ps.minmax_rescale(pts)
    kept = [j for j in range(dim) if bounds[j][0] < bounds[j][1]]
    for r in scaled.collect():
        want = [(((r.id + 1) * j) % 7 - bounds[j][0]) / (bounds[j][1] - bounds[j][0]) for j in kept]
        assert r.x == pytest.approx(want)
    means = ps.update_centroids(pts, key="y").collect()
    for r in means:
        mine = [i for i in range(1, 30) if str((i - 1) % 2) == r.y]
        assert r.c == pytest.approx([sum((i * j) % 7 for i in mine) / len(mine) for j in range(dim)])


@pytest.mark.parametrize("limit", [50_000, 2])
def test_label_positions(spark, monkeypatch, limit):
    monkeypatch.setattr(durable, "SMALL_ROWS", limit)
    labels = ["b", "a", "Z", "é", "aa", "b", "b", "10", "9"]
    pts = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "id bigint, y string")
    order = sorted(set(labels), key=lambda s: s.encode())
    got = {r.id: r.label_id for r in ps.label_index(pts).collect()}
    assert got == {i: order.index(y) for i, y in enumerate(labels)}


@pytest.mark.parametrize("ranges", [1, 2, 7, 500])
def test_range_index_numbers_without_one_big_task(spark, ranges):
    values = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    rows = prepare.range_index(values, "v", "n", ranges).collect()
    assert all(r.n == r.v for r in rows) and len(rows) == 1000


def test_range_index_of_vectors_and_structs(spark):
    values = spark.range(100).select(F.array(F.col("id") % 7 * 1.0, F.col("id") * 1.0).alias("v"), "id")
    for column in ("v", "s"):
        table = values.withColumn("s", F.struct(F.col("v")[0].alias("a"), "id"))
        rows = prepare.range_index(table, column, "n", 5).collect()
        order = sorted(rows, key=lambda r: tuple(r[column]))
        assert [r.n for r in order] == list(range(100))
