"""Near-duplicate documents by min-max hashing.

A signature keeps the smallest and the largest value of a document's shingles
under each permutation: two samples for one hash evaluation.  A band holds both
values of ``ROWS_PER_BAND / 2`` permutations.

Texts with equal shingle sets are one class and take part once.  Documents that
share a band are compared with one pivot of their bucket, the same order of pivots
in every band, so that a group of thousands of copies costs one comparison per
member.  Members that a bucket leaves in different components are then compared
with each other, those outside the largest component against all: no pair that
shares a band and could join two components goes untested.  Every link is confirmed
on the full shingle sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import discard, free_shuffles, materialize, narrow, text_key
from .words import Block, find_words, grams, lower_ascii, mix, text_blocks, whole_runs, word_hashes

# 40 bands of 6 values: a pair at a similarity of 0.8 is missed with odds of 5e-6,
# a pair at 0.1 is met with odds of 4e-5.
BANDS = 40
ROWS_PER_BAND = 6
# Members of a bucket that a task compares with as many queries.
BUCKET_BLOCK = 2_000
# Lower bits of a hash that comparisons inside buckets leave out first: 24 are left.
SHORT_SHIFT = 40


def shingle_sets(block: Block, shingle: int):
    """Distinct shingle hashes of each text, sorted, and where each text begins."""
    words = find_words(block)
    h = word_hashes(lower_ascii(block.data), words)
    counts = words.counts()
    owner = words.owner()
    runs = grams(h, shingle)
    whole = np.flatnonzero((counts > 0) & (counts < shingle))
    same = owner[: len(runs)] == owner[shingle - 1 :] if len(runs) else np.zeros(0, bool)
    values, owners = [runs[same]], [owner[: len(runs)][same]]
    for n in range(1, shingle):
        # shorter texts: the whole sequence is the only shingle
        texts = whole[counts[whole] == n]
        if len(texts):
            values.append(grams(h, n)[words.bounds[texts]])
            owners.append(texts)
    value, own = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, own))
    value, own = value[order], own[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
    value, own = value[new], own[new]
    return value, np.searchsorted(own, np.arange(block.size + 1))


def signatures(value: np.ndarray, bounds: np.ndarray, permutations: int) -> np.ndarray:
    """Minimum and maximum under each permutation, for the texts that have shingles."""
    rng = np.random.default_rng(77)
    factor = rng.integers(0, 1 << 32, permutations, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    flip = rng.integers(0, 1 << 32, permutations, dtype=np.uint64).astype(np.uint32)
    short = (value >> np.uint64(32)).astype(np.uint32)
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(starts), 2 * permutations), np.uint32)
    for k in range(permutations):
        p = (short ^ flip[k]) * factor[k]
        p ^= p >> np.uint32(15)
        out[:, 2 * k] = np.minimum.reduceat(p, starts)
        out[:, 2 * k + 1] = np.maximum.reduceat(p, starts)
    return out


def band_keys(sign: np.ndarray, bands: int) -> np.ndarray:
    rows = sign.reshape(len(sign), bands, -1).astype(np.uint64)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sign), 1))
    for r in range(rows.shape[2]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return key


def sketch(shingle: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            for block in text_blocks(batch.column("text")):
                value, bounds = shingle_sets(block, shingle)
                n = np.diff(bounds)
                some = n > 0
                keys = np.zeros((block.size, bands), np.int64)
                prints = np.zeros((block.size, 2), np.uint64)
                if some.any():
                    keys[some] = band_keys(signatures(value, bounds, bands * rows // 2), bands).view(np.int64)
                    starts = bounds[:-1][some]
                    prints[some, 0] = np.add.reduceat(value, starts)
                    prints[some, 1] = np.add.reduceat(mix(value + np.uint64(12345)), starts)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, (block.size + 1) * bands, bands, dtype=np.int32)), pa.array(keys.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, block.size),
                        batch.column("_th").slice(block.first, block.size),
                        pa.array(n.astype(np.int64)),
                        pa.array(prints[:, 0].view(np.int64).copy()),
                        pa.array(prints[:, 1].view(np.int64).copy()),
                        lists,
                    ],
                    ["doc_id", "_th", "n_shingles", "_p1", "_p2", "_bands"],
                )

    return run


def full_sets(shingle: int):
    def run(batches):
        for batch in batches:
            for block in text_blocks(batch.column("text")):
                value, bounds = shingle_sets(block, shingle)
                sets = [value[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(block.first, block.size), pa.array(sets, pa.binary())], ["node", "shingles"]
                )

    return run


def confirm(percent: int):
    """Keep the pairs whose full sets reach the similarity."""

    def run(batches):
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            left, right = batch.column("_a"), batch.column("_b")
            known: tuple = (None, None)
            for i in range(batch.num_rows):
                raw = left[i].as_buffer()
                if known[0] is None or not raw.equals(known[0]):
                    known = (raw, np.frombuffer(raw, np.uint64))
                a, b = known[1], np.frombuffer(right[i].as_buffer(), np.uint64)
                if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                    continue
                small, large = (a, b) if len(a) <= len(b) else (b, a)
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                both = int(np.count_nonzero(large[at] == small))
                ok[i] = 100 * both >= percent * (len(a) + len(b) - both)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays(
                [pc.filter(batch.column("u"), keep), pc.filter(batch.column("v"), keep)], ["u", "v"]
            )

    return run


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("_a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("_b"))
    wide = pairs.join(b, "v").join(a, "u").select("u", "v", "_a", "_b")
    kind = pairs.schema["u"].dataType.simpleString()
    return wide.mapInArrow(confirm(percent), f"u {kind}, v {kind}")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS_PER_BAND,
) -> DataFrame:
    """Near-duplicate classes: ``doc_id, n_shingles, component_id, kept``, a row per input row.

    ``text_key`` and ``component_text_key`` tell different texts under one id apart:
    the representative of a class has the id and the key of its component.

    Words are compared with A-Z in lower case.  Two documents are linked when
    100 * intersection >= ``percent`` * union of their sets of ``shingle``-word runs;
    ``component_id`` is the smallest id reachable by links.  A text with fewer words
    is one shingle.  Null texts and texts without words have an empty set and are
    linked with nothing.  Rows that repeat an id and text are one class; rows with a
    null id are linked with nothing and have a null component.  A very long text is one
    set, held whole by the task that reads it.  An empty table gives no rows; other
    columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", text_key().alias("_th"), "text")
    sketched = materialize(
        keyed.mapInArrow(
            sketch(shingle, bands, rows),
            f"doc_id {kind}, _th long, n_shingles long, _p1 long, _p2 long, _bands array<long>",
        ),
        "sketch",
    )
    usable = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # one node per set of shingles, named by its smallest document (and its text,
    # in case different texts share an id)
    classes = materialize(
        usable.groupBy("_p1", "_p2").agg(
            F.min(F.struct("doc_id", "_th")).alias("node"),
            F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("_bands").alias("_bands"),
        ),
        "classes",
    )
    # a node without a second one in any of its buckets ends here
    order = F.struct(F.xxhash64("node").alias("h"), F.col("node"))
    rows_of = classes.select("node", "n_shingles", F.explode("_bands").alias("_key"))
    shared = rows_of.groupBy("_key").agg(F.count("*").alias("n"), F.min(order).alias("p")).where("n > 1")
    members = materialize(
        rows_of.join(shared.select("_key", F.col("p.node").alias("pivot")), "_key"), "members"
    )
    free_shuffles(spark)
    sizes = classes.select(F.col("node").alias("pivot"), F.col("n_shingles").alias("m"))
    stars = materialize(
        narrow(
            members.where("node != pivot").select("node", "pivot", "n_shingles").distinct().join(sizes, "pivot")
            .where(_sizes_fit(percent)).select(F.col("pivot").alias("u"), F.col("node").alias("v"))
        ),
        "stars",
    )
    wanted = members.select("node.*").distinct()
    sets = materialize(
        keyed.join(wanted, ["doc_id", "_th"]).select(F.struct("doc_id", "_th").alias("node"), "text")
        .mapInArrow(full_sets(shingle), f"node struct<doc_id:{kind},_th:bigint>, shingles binary")
        .dropDuplicates(["node"]),
        "sets",
    )
    free_shuffles(spark)
    found = materialize(verify(stars, sets, percent), "confirmed")
    free_shuffles(spark)
    grouped = components(found.unionAll(rest_of_buckets(members, found, sets, percent)))
    for table in (members, stars, sets, found):
        discard(table)
    free_shuffles(spark)
    label = grouped.select("node", F.col("component").alias("_least"))
    nodes = classes.select("_p1", "_p2", "node").join(label, "node", "left").select(
        "_p1", "_p2", F.coalesce("_least", "node").alias("_least")
    )
    # rows without a set or an id have no class
    out = sketched.join(nodes, ["_p1", "_p2"], "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.col("_least.doc_id")).otherwise(F.col("doc_id"))
    first_text = F.when(linked, F.col("_least._th")).otherwise(F.col("_th"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        F.col("_th").alias("text_key"),
        first_text.alias("component_text_key"),
    )


def _sizes_fit(percent: int):
    return F.expr(f"100 * least(n_shingles, m) >= {percent} * greatest(n_shingles, m)")


def short_sets(batches):
    """The distinct 24-bit parts of each set's hashes, for comparisons inside buckets."""
    for batch in batches:
        out = []
        for raw in batch.column("shingles"):
            part = np.unique(np.frombuffer(raw.as_buffer(), np.uint64) >> np.uint64(SHORT_SHIFT)).astype(np.uint32)
            out.append(part.view(np.uint8).reshape(-1, 4)[:, :3].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.binary())], ["node", "set"])


def _codes(group: pa.Table, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """The sets of a group one after another, as numbers from 0, and their sizes."""
    if exact:
        raw = [np.frombuffer(s.as_buffer(), np.uint64) for s in group.column("set")]
        flat = np.concatenate(raw)
    else:
        raw = [np.frombuffer(s.as_buffer(), np.uint8).reshape(-1, 3) for s in group.column("set")]
        wide = np.concatenate(raw).astype(np.uint32)
        flat = wide[:, 0] | wide[:, 1] << 8 | wide[:, 2] << 16
    return np.unique(flat, return_inverse=True)[1], np.array([len(r) for r in raw])


def _forest(best: dict[tuple, tuple]) -> list[tuple[int, int]]:
    """The most similar pairs that join components, without those that close a circle."""
    root: dict = {}

    def find(x):
        while x in root:
            x = root[x]
        return x

    pairs = []
    for (a, b), (*_, i, q) in sorted(best.items(), key=lambda item: item[1]):
        a, b = find(a), find(b)
        if a != b:
            root[a] = b
            pairs.append((i, q))
    return pairs


def meet(percent: int, exact: bool):
    """Pairs of a query and a member that may link the components of a bucket.

    A task returns a spanning forest: of two components the most similar pair, and no
    pair whose components others join already.  More is not needed unless a pair fails
    on the full sets.  A set's 24-bit parts are fewer than its shingles by those
    that coincide; so many are added to the intersection, which makes it an upper bound.
    ``exact`` sets are the full ones, and the pairs are links.
    """

    def group_pairs(group: pa.Table):
        role = group.column("_role").to_numpy()
        queries, others = np.flatnonzero(role == 1), np.flatnonzero(role == 0)
        if not len(queries) or not len(others):
            return []
        code, sizes = _codes(group, exact)
        ends = np.cumsum(sizes)
        mark = np.zeros(int(code.max()) + 1, np.int32)
        theirs = np.concatenate([code[ends[i] - sizes[i] : ends[i]] for i in others])
        starts = np.cumsum(sizes[others]) - sizes[others]
        n, label, name = (group.column(c).to_numpy() for c in ("n_shingles", "label", "name"))
        top = group.column("is_top").to_numpy(zero_copy_only=False)[others]
        lost = n - sizes
        best: dict[tuple, tuple] = {}
        for q in queries:
            fits = (label[others] != label[q]) & (top | (name[others] < name[q]))
            fits &= 100 * np.minimum(n[others], n[q]) >= percent * np.maximum(n[others], n[q])
            if not fits.any():
                continue
            own = code[ends[q] - sizes[q] : ends[q]]
            mark[own] = 1
            both = np.add.reduceat(mark[theirs], starts) + np.minimum(lost[others], lost[q])
            mark[own] = 0
            union = n[others] + n[q] - both
            fits &= 100 * both >= percent * union
            at = np.flatnonzero(fits)
            if not len(at):
                continue
            # the most similar of each component, of equal ones the first name
            near = both[at] / union[at]
            order = np.lexsort((name[others[at]], -near, label[others[at]]))
            mine = label[others[at[order]]]
            for k in order[np.r_[True, mine[1:] != mine[:-1]]]:
                i = int(others[at[k]])
                pair = (min(label[i], label[q]), max(label[i], label[q]))
                offer = (-near[k], name[i], name[q], i, int(q))
                if pair not in best or offer < best[pair]:
                    best[pair] = offer
        return _forest(best)

    def run(batches):
        for table in whole_runs(batches, ["_key", "_i", "_j"]):
            keys = [table.column(c).to_numpy() for c in ("_key", "_i", "_j")]
            edges = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
            for a, b in zip([0, *edges], [*edges, table.num_rows]):
                group = table.slice(a, b - a)
                pairs = group_pairs(group)
                if pairs:
                    node = group.column("node").combine_chunks()
                    u, v = (pa.array(side, pa.int64()) for side in zip(*pairs))
                    yield pa.RecordBatch.from_arrays(
                        [node.take(u), node.take(v), group.column("_key").take(u).combine_chunks()], ["u", "v", "_key"]
                    )

    return run


def deal(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, at the places they are compared at.

    The members outside a bucket's largest component are its queries.  Queries and
    members are cut into blocks apart; a task compares one of each, so a member is
    copied once for every block of queries: a stray query costs one more row a member.
    """
    known = members.join(labels, "node", "left").select(
        "_key", "node", "n_shingles", F.xxhash64("node").alias("name"),
        F.xxhash64(F.coalesce("component", "node")).alias("label"),
    )
    parts = known.groupBy("_key", "label").agg(F.count("*").alias("n"))
    largest = parts.groupBy("_key").agg(
        F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("k"), F.sum("n").alias("m")
    ).where("k > 1").select(
        "_key", F.col("top.label").alias("_top"),
        F.ceil(F.col("m") / BUCKET_BLOCK).cast("int").alias("_blocks"),
        F.ceil((F.col("m") - F.col("top.n")) / BUCKET_BLOCK).cast("int").alias("_query_blocks"),
    )
    mixed = known.join(largest, "_key").withColumn("is_top", F.col("label") == F.col("_top"))
    own = F.pmod("name", "_blocks").cast("int")
    own_query = F.pmod(F.xxhash64("name"), "_query_blocks").cast("int")
    of_members, of_queries = (F.sequence(F.lit(0), F.col(c) - 1) for c in ("_blocks", "_query_blocks"))
    as_member = F.transform(of_queries, lambda i: F.struct(F.lit(0).alias("_role"), i.alias("_i"), own.alias("_j")))
    as_query = F.transform(of_members, lambda j: F.struct(F.lit(1).alias("_role"), own_query.alias("_i"), j.alias("_j")))
    places = F.when(F.col("is_top"), as_member).otherwise(F.concat(as_member, as_query))
    return mixed.select(
        "_key", "node", "n_shingles", "name", "label", "is_top", F.explode(places).alias("_p")
    ).select("_key", "_p.*", "node", "n_shingles", "name", "label", "is_top")


def _met(dealt: DataFrame, sets: DataFrame, percent: int, exact: bool) -> DataFrame:
    kind = sets.schema["node"].dataType.simpleString()
    runs = ["_key", "_i", "_j"]
    rows = dealt.join(sets, "node").repartition(*runs).sortWithinPartitions(*runs, "name")
    return rows.mapInArrow(meet(percent, exact), f"u {kind}, v {kind}, _key long")


def rest_of_buckets(members: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join components which meet in a bucket, besides the links ``found``.

    Compared are short sets; the pairs they suggest are confirmed on the full ones.
    Buckets in which a suggested pair fails are compared once more, on the full sets.
    """
    kind = members.schema["node"].dataType.simpleString()
    first = materialize(narrow(components(found)), "components")
    short = sets.mapInArrow(short_sets, f"node {kind}, set binary")
    pairs = materialize(_met(deal(members, first), short, percent, False), "pairs")
    links = materialize(verify(pairs.select("u", "v").distinct(), sets, percent), "confirmed")
    failed = pairs.join(links, ["u", "v"], "left_anti").select("_key").distinct()
    if not failed.isEmpty():
        second = materialize(components(found.unionAll(links)), "components")
        failed = materialize(failed, "failed")
        again = deal(members.join(failed, "_key", "left_semi"), second)
        more = _met(again, sets.withColumnRenamed("shingles", "set"), percent, True)
        links = materialize(links.unionAll(more.select("u", "v")), "confirmed")
        discard(second)
        discard(failed)
    for table in (first, pairs):
        discard(table)
    return links
