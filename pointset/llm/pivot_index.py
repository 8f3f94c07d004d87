"""Near-duplicate embeddings by a pivot-permutation index.

A vector is described by its nearest reference points (pivots), nearest first.
Inverted lists are kept per set of ``SHARED`` pivots: two vectors meet in a list if they
share that many of their nearest pivots.  Of a pair that meets, shared pivots stand at
nearly the same places of both orders; pairs that have them far apart are dropped.  The
others are verified by cosine in double precision, in one list only, that of the
smallest pivots they share.  The number of pivots grows with that of the vectors, which
keeps the lists short.

Equal vectors are one class and are indexed once.  A long list is cut into blocks, and
a task compares two blocks.  Tasks return sums of links and a spanning forest of the
links they found, never the links themselves.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import materialize
from .words import whole_runs

PIVOTS = 128
# Vectors of one length up to which so many pivots are enough; beyond, their number grows
# with the cube root, as lists are told apart by three of them.
ENOUGH_FOR, MOST_PIVOTS = 100_000, 4_096
# Places by which shared pivots may differ in the two orders, on average: of pairs at the
# threshold one in a thousand differs by more.
DISPLACED = 3.0
# Lengths of vectors whose pivots are chosen among them; those of others are random.
SAMPLED_LENGTHS = 16
# Vectors looked at to choose pivots, and how alike two pivots may be.
PIVOT_SAMPLE = 2_000
ALIKE = 0.8
NEAREST = 6
SHARED = 3
BLOCK = 1_500


def matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    # scaled first: squares of very large or small components stay finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.sum(x * x, axis=1, keepdims=True))


def choose_pivots(vectors: np.ndarray, most: int) -> np.ndarray:
    """Pivots in the given order, without those much like an earlier one.

    Random directions make up what is missing: if most vectors are alike, pivots among
    them would be told apart by noise only.
    """
    chosen = np.empty((0, vectors.shape[1]))
    for v in unit(vectors) if len(vectors) else vectors:
        if len(chosen) == most:
            break
        if not len(chosen) or np.max(chosen @ v) <= ALIKE:
            chosen = np.vstack([chosen, v])
    more = np.random.default_rng(8).normal(size=(most - len(chosen), vectors.shape[1]))
    return np.vstack([chosen, unit(more)]) if len(more) else chosen


def pivots_for(n: int, least: int) -> int:
    return max(least, min(MOST_PIVOTS, int(least * (n / ENOUGH_FOR) ** (1 / 3))))


def describe(pivots: dict[int, np.ndarray], most: int, nearest: int, shared: int):
    """Nearest pivots of every vector, in order, and the lists it belongs to."""

    drawn: dict[int, np.ndarray] = {}

    def pivots_of(dim: int) -> np.ndarray:
        if dim in pivots:
            return pivots[dim]
        if dim not in drawn:
            drawn.clear()
            drawn[dim] = choose_pivots(np.empty((0, dim)), most)
        return drawn[dim]

    def run(batches):
        for batch in batches:
            sizes = batch.column("_dim").to_numpy()
            order = np.argsort(sizes, kind="stable")
            rows = batch.take(pa.array(order))
            at = 0
            while at < rows.num_rows:
                dim = int(sizes[order[at]])
                stop = int(np.searchsorted(sizes[order], dim, side="right"))
                part = rows.slice(at, stop - at)
                own = pivots_of(dim)
                k = min(nearest, len(own))
                close = unit(matrix(part.column("v"))) @ own.T
                top = np.argsort(-close, axis=1, kind="stable")[:, :k]
                t, named = min(shared, k), np.sort(top, axis=1)
                codes = np.stack(
                    [sum(named[:, c].astype(np.int64) << (20 * i) for i, c in enumerate(cs)) for cs in combinations(range(k), t)], 1
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(list(top.astype(np.int32))), pa.array(list(codes))],
                    [*part.schema.names, "top", "codes"],
                )
                at = stop

    return run


def forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest row reachable from each of ``n`` rows."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if np.array_equal(label, before):
            return label


def compare(least: float, shared: int):
    """Links within runs of rows of one list and pair of blocks."""

    def verify(table: pa.Table):
        ids, sizes = table.column("id").to_pylist(), table.column("n").to_numpy()
        side = table.column("_side").to_numpy()
        same_block = (table.column("_i").to_numpy() == table.column("_j").to_numpy())
        group = np.cumsum(
            np.concatenate([[True], np.any(
                [np.diff(table.column(c).to_numpy()) != 0 for c in ("_dim", "_list", "_i", "_j")] +
                [_changes(table.column("label"))], axis=0)])
        )
        top = matrix(table.column("top")).astype(np.int32)
        # with few pivots a list stands for fewer
        t = min(shared, top.shape[1])
        apart_by = np.abs(np.arange(top.shape[1])[:, None] - np.arange(top.shape[1]))
        limit = (table.column("_list").to_numpy() >> (20 * (t - 1))) & ((1 << 20) - 1)
        x = unit(matrix(table.column("v")))
        found_u, found_v = [], []
        step = 1
        while step < table.num_rows:
            a = np.flatnonzero(group[step:] == group[:-step])
            if not len(a):
                break
            b = a + step
            if not same_block[a].all():
                apart = same_block[a] | (side[a] != side[b])
                a, b = a[apart], b[apart]
            for i in range(0, len(a), 50_000):
                p, q = a[i : i + 50_000], b[i : i + 50_000]
                met = top[p][:, :, None] == top[q][:, None, :]
                inside = met.any(2)
                first = (inside & (top[p] <= limit[p][:, None])).sum(1) == t
                first &= (met * apart_by).sum((1, 2)) <= DISPLACED * inside.sum(1)
                p, q = p[first], q[first]
                near = np.einsum("ij,ij->i", x[p], x[q]) >= least
                found_u.append(p[near])
                found_v.append(q[near])
            step += 1
        u, v = (np.concatenate(f) if f else np.empty(0, np.int64) for f in (found_u, found_v))
        links = np.bincount(u, sizes[v], table.num_rows) + np.bincount(v, sizes[u], table.num_rows)
        root = forest(u, v, table.num_rows)
        at = np.flatnonzero(links)
        kind = table.schema.field("id").type
        return pa.RecordBatch.from_arrays(
            [
                pa.array([ids[i] for i in at], kind),
                pa.array([ids[root[i]] for i in at], kind),
                pa.array(links[at].astype(np.int64)),
            ],
            ["u", "v", "links"],
        )

    def run(batches):
        for table in whole_runs(batches, ["_dim", "label", "_list", "_i", "_j"]):
            yield from by_dim(table)

    def by_dim(table: pa.Table):
        dims = table.column("_dim").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(dims)) + 1), len(dims)]
        for a, b in zip(edges[:-1], edges[1:]):
            yield verify(table.slice(a, b - a).combine_chunks())

    return run


def _changes(column) -> np.ndarray:
    values = column.combine_chunks().dictionary_encode() if not isinstance(column, pa.Array) else column.dictionary_encode()
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return np.diff(values.indices.to_numpy()) != 0


def near_vectors(
    table: DataFrame,
    least: float = 0.98,
    pivots: int = PIVOTS,
    nearest: int = NEAREST,
    shared: int = SHARED,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding, label``.

    Vectors are linked if their labels are equal and their cosine is ``least`` or
    more.  ``n_links`` counts other rows linked directly, equal vectors included, and
    ``component_id`` is the smallest id reachable.  Rows without a label, and vectors
    that are null, empty, zero or hold null or non-finite components, are linked with
    nothing; vectors of different length are not compared.  Rows that repeat an id are
    rows of their own, linked when their vectors are.  An empty table gives no rows;
    other columns are not read.

    Pivots are chosen among ``PIVOT_SAMPLE`` vectors of each of the ``SAMPLED_LENGTHS``
    most frequent lengths; vectors of any other length have random pivots.
    """
    kind = table.schema["vec_id"].dataType.simpleString()
    label_kind = table.schema["label"].dataType.simpleString()
    v = F.col("embedding").cast("array<double>")
    good = (
        F.col("label").isNotNull()
        & (F.size(v) > 0)
        & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
        & F.exists(v, lambda e: e != 0)
    )
    # 0.0 turns -0.0 into 0.0, so equal vectors are equal bit by bit
    clean = F.when(F.coalesce(good, F.lit(False)), F.transform(v, lambda e: e + F.lit(0.0)))
    rows = table.select("vec_id", "label", clean.alias("v"))
    usable = rows.where("v IS NOT NULL AND vec_id IS NOT NULL")
    # 128 bits stand for a vector wherever rows are matched
    prints = {"_h1": F.xxhash64("v"), "_h2": F.xxhash64(F.lit(8), "v")}
    classes = materialize(
        usable.groupBy("label", "v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n")).select(
            F.struct("vec_id", F.xxhash64("label", "v").alias("h")).alias("id"), "label", "v", "n", F.size("v").alias("_dim")
        ).withColumns(prints),
        "classes",
    )
    id_kind = f"struct<vec_id:{kind},h:bigint>"
    references, most = {}, pivots
    lengths = classes.groupBy("_dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "_dim").limit(SAMPLED_LENGTHS).collect()
    for dim, n in lengths:
        most = max(most, pivots_for(n, pivots))
        sample = classes.where(F.col("_dim") == dim).orderBy(F.xxhash64("id"), "id").limit(max(PIVOT_SAMPLE, 2 * most))
        references[dim] = choose_pivots(matrix(sample.select("v").toArrow().column("v").combine_chunks()), pivots_for(n, pivots))
    described = materialize(
        classes.drop(*prints).mapInArrow(
            describe(references, most, nearest, shared),
            f"id {id_kind}, label {label_kind}, v array<double>, n long, _dim int, top array<int>, codes array<long>",
        ),
        "described",
    )
    postings = described.select("id", "label", "_dim", F.explode("codes").alias("_list"))
    lists = ["label", "_dim", "_list"]
    long_lists = postings.groupBy(*lists).agg(F.count("*").alias("m")).where("m > 1")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    met = postings.join(long_lists, lists).withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    dealt = met.select(
        "id", *lists,
        F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"),
        (F.col("_own") > F.col("_other")).cast("int").alias("_side"),
    ).join(described.select("id", "v", "n", "top"), "id")
    runs = ["_dim", "label", "_list", "_i", "_j"]
    found = materialize(
        dealt.repartition(*runs).sortWithinPartitions(*runs, "id").mapInArrow(
            compare(least, shared), f"u {id_kind}, v {id_kind}, links long"
        ),
        "found",
    )
    links = found.groupBy("u").agg(F.sum("links").alias("_links"))
    label = components(found.where("u != v").select("u", "v"))
    by_class = (
        classes.select("id", "label", *prints, "n")
        .join(links, F.col("id") == F.col("u"), "left")
        .join(label.withColumnRenamed("node", "_node"), F.col("id") == F.col("_node"), "left")
        .select(
            "label", *prints,
            (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("_n_links"),
            F.coalesce("component.vec_id", "id.vec_id").alias("_component"),
        )
    )
    narrow = rows.select("vec_id", "label", F.col("v").isNotNull().alias("_good"), *[value.alias(name) for name, value in prints.items()])
    out = narrow.join(by_class, ["label", *prints], "left")
    linked = F.col("_good") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    component = F.when(linked, F.col("_component")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.when(linked, F.col("_n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
