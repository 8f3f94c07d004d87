"""The registered queries as DuckDB SQL, for the correctness check.

Iterations become chains of materialised common table expressions; rounds that
a run would not reach are switched off by a condition inside the query.
"""

from __future__ import annotations

from .catalog import K, LINEITEM_FEATURES, SEED, SUBSET_ROWS

# Chained rounds; more than a run takes on the checked tables.
MAX_ROUNDS = 16
MAX_LLOYD = 20
RECLUSTER_ITERATIONS = 100

LINE_KEY = (
    "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'), "
    "CAST(floor(l_extendedprice * 100 + 0.5::DOUBLE) AS BIGINT))"
)


def bits(tag: str, key: str = "id", seed: int = SEED) -> str:
    return f"('0x' || substr(md5('{seed}|{tag}|' || {key}), 1, 13))::BIGINT"


def uniform(tag: str, key: str = "id", seed: int = SEED) -> str:
    return f"({bits(tag, key, seed)} / 4503599627370496.0::DOUBLE)"


def race(tag: str, weight: str) -> str:
    return f"(-ln(({bits(tag)} + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / ({weight}))"


def sq(a: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])))"


def r6(value: str, name: str) -> str:
    return f"round(({value}) * 1e6::DOUBLE) / 1e6::DOUBLE + 0.0 AS {name}"


class Script:
    """Builds one query from named steps."""

    def __init__(self):
        self.steps: list[str] = []
        self.count = 0

    def add(self, body: str, stem: str = "t") -> str:
        self.count += 1
        name = f"{stem}_{self.count}"
        self.steps.append(f"{name} AS MATERIALIZED ({body})")
        return name

    def select(self, text: str) -> str:
        return "WITH " + ",\n".join(self.steps) + "\n" + text

    # tables

    def embeddings(self) -> str:
        return self.add(
            "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, CAST(label AS VARCHAR) AS y FROM embeddings", "emb"
        )

    def lineitem(self, extra: str = "") -> str:
        x = ", ".join(f"CAST({c} AS DOUBLE)" for c in LINEITEM_FEATURES)
        return self.add(f"SELECT {LINE_KEY} AS id, [{x}{extra}] AS x, l_returnflag AS y FROM lineitem", "line")

    # operators

    def bounds(self, src: str) -> str:
        return self.add(
            f"SELECT pos, min(v) AS lo, max(v) AS hi FROM (SELECT unnest(range(1, len(x) + 1)) AS pos, unnest(x) AS v "
            f"FROM {src}) GROUP BY pos",
            "bounds",
        )

    def rescale(self, src: str) -> str:
        kept = self.add(
            "SELECT list(pos ORDER BY pos) AS ps, list(lo ORDER BY pos) AS lo, list(hi ORDER BY pos) AS hi "
            f"FROM {self.bounds(src)} WHERE lo < hi",
            "kept",
        )
        return self.add(
            "SELECT id, list_transform(range(1, len(ps) + 1), lambda j: (x[ps[j]] - lo[j]) / (hi[j] - lo[j])) AS x, y "
            f"FROM {src}, {kept}",
            "scaled",
        )

    def scaled_lineitem(self) -> str:
        return self.rescale(self.lineitem())

    def from_set(self, src: str, k: int | str) -> str:
        place = f"row_number() OVER (ORDER BY {uniform('init')}, id) - 1"
        return self.add(
            f"SELECT CAST(cid AS INT) AS cid, c FROM (SELECT {place} AS cid, x AS c FROM {src}) WHERE cid < {k}", "start"
        )

    def from_space(self, facts: str) -> str:
        """``facts`` has one row with ``k`` and ``dim``."""
        draw = uniform("space", "CAST(i * dim + j AS BIGINT)")
        grid = f"SELECT unnest(range(0, k)) AS i, dim FROM {facts}"
        cells = f"SELECT i, dim, unnest(range(0, dim)) AS j FROM ({grid})"
        return self.add(
            f"SELECT CAST(i AS INT) AS cid, list(u ORDER BY j) AS c FROM (SELECT i, j, {draw} AS u FROM ({cells})) "
            "GROUP BY i",
            "space",
        )

    def assign(self, src: str, cents: str) -> str:
        pairs = f"SELECT p.*, c.cid AS new_cid, {sq('p.x', 'c.c')} AS new_d2 FROM {src} p, {cents} c"
        ranked = f"SELECT *, row_number() OVER (PARTITION BY id ORDER BY new_d2, new_cid) AS place FROM ({pairs})"
        return self.add(
            f"SELECT * EXCLUDE (place, new_cid, new_d2), new_cid AS cid, new_d2 AS d2 FROM ({ranked}) WHERE place = 1",
            "assigned",
        )

    def means(self, src: str, key: str = "cid", weight: str = "1.0::DOUBLE", when: str = "true") -> str:
        long = (
            f"SELECT {key}, {weight} AS w, unnest(range(1, len(x) + 1)) AS pos, unnest(x) AS v "
            f"FROM {src} WHERE {weight} > 0 AND {when}"
        )
        flat = f"SELECT {key}, pos, sum(w * v) / sum(w) AS m, count(*) AS n, sum(w) AS w FROM ({long}) GROUP BY {key}, pos"
        return self.add(
            f"SELECT {key}, list(m ORDER BY pos) AS c, any_value(n) AS n, any_value(w) AS w FROM ({flat}) GROUP BY {key}",
            "means",
        )

    def lloyd(self, src: str, cents: str, iterations: int, tol: float | None = None, weight: str = "1.0::DOUBLE"):
        """Final centroids and the cost of each iteration.

        With ``tol`` every iteration carries whether the run has stopped before it.
        """
        costs = []
        done = None
        for t in range(iterations):
            assigned = self.assign(src, cents)
            live = f"NOT (SELECT done FROM {done})" if done else "true"
            moved = self.means(assigned, weight=weight, when=live)
            value = self.add(f"SELECT {t} AS iter, sum(d2) AS cost FROM {assigned} WHERE {live}", "cost")
            if tol is None:
                cents = moved
            else:
                cents = self.add(
                    f"SELECT cid, c FROM {moved} UNION ALL SELECT cid, c FROM {cents} WHERE NOT ({live})", "cents"
                )
                hit = f"(SELECT cost FROM {value}) > (1 - {tol}) * (SELECT cost FROM {costs[-1]})" if t else "false"
                before = f"(SELECT done FROM {done})" if done else "false"
                done = self.add(f"SELECT {before} OR coalesce({hit}, false) AS done", "done")
            costs.append(value)
        return cents, costs

    def oversample(self, state: str, l: float, psi: str, r: int, when: str = "true") -> str:
        return self.add(
            f"SELECT id, x, d2 FROM {state} WHERE {when} AND {uniform(str(r))} < {l}::DOUBLE * d2 / (SELECT v FROM {psi})",
            "drawn",
        )

    def first_state(self, src: str) -> tuple[str, str, str]:
        first = self.from_set(src, 1)
        state = self.assign(src, first)
        return first, state, self.add(f"SELECT sum(d2) AS v FROM {state}", "psi")

    def dedup(self, *parts: str) -> str:
        every = " UNION ".join(f"SELECT c FROM ({part})" for part in parts)
        return self.add(f"SELECT CAST(row_number() OVER (ORDER BY c) - 1 AS INT) AS cid, c FROM ({every})", "distinct_c")

    def weights(self, src: str, cents: str) -> str:
        counts = f"SELECT cid, count(*) AS n FROM {self.assign(src, cents)} GROUP BY cid"
        return self.add(
            f"SELECT cid, c, coalesce(n, 0)::DOUBLE AS w FROM {cents} LEFT JOIN ({counts}) USING (cid)", "weights"
        )

    def one_round(self, src: str) -> tuple[str, str]:
        first, state, psi = self.first_state(src)
        drawn = self.oversample(state, 2 * K, psi, 0)
        return first, drawn

    def candidates(self, src: str, l: float, rounds: int = MAX_ROUNDS) -> str:
        first, state, psi = self.first_state(src)
        wanted = "greatest(1, floor(ln(v)))"
        limit = self.add(
            f"SELECT CASE WHEN {wanted} > {rounds} THEN error('more than {rounds} rounds') ELSE {wanted} END AS r FROM {psi}",
            "rounds",
        )
        parts = [f"SELECT c FROM {first}"]
        for r in range(rounds):
            drawn = self.oversample(state, l, psi, r, f"{r} < (SELECT r FROM {limit}) AND (SELECT v FROM {psi}) > 0")
            parts.append(f"SELECT x AS c FROM {drawn}")
            near = f"SELECT s.id, min({sq('s.x', 'h.x')}) AS d FROM {state} s, {drawn} h GROUP BY s.id"
            state = self.add(
                f"SELECT s.id, s.x, least(s.d2, coalesce(d, s.d2)) AS d2 FROM {state} s LEFT JOIN ({near}) USING (id)",
                "state",
            )
            psi = self.add(f"SELECT sum(d2) AS v FROM {state}", "psi")
        return self.weights(src, self.dedup(*parts))

    def seed_plus_plus(self, src: str, k: int) -> str:
        """``src`` has ``id``, ``x`` and ``w``."""
        state = self.add(f"SELECT id, x, w, w AS odds FROM {src} WHERE w > 0", "race")
        winners = []
        for j in range(k):
            won = self.add(
                f"SELECT {j} AS cid, x AS c FROM {state} WHERE odds > 0 ORDER BY {race(f'pp{j}', 'odds')}, id LIMIT 1",
                "won",
            )
            winners.append(won)
            known = "s.d2" if j else "NULL::DOUBLE"
            near = f"SELECT s.id, s.x, s.w, least({known}, {sq('s.x', 'v.c')}) AS d2 FROM {state} s, {won} v"
            if j + 1 < k:
                state = self.add(f"SELECT id, x, w, d2, w * d2 AS odds FROM ({near})", "race")
        return self.add(" UNION ALL ".join(f"SELECT * FROM {w}" for w in winners), "seeds")

    def recluster(self, weighted: str, k: int) -> str:
        pts = self.add(f"SELECT cid AS id, c AS x, w FROM {weighted}", "cand")
        seeds = self.seed_plus_plus(pts, k)
        return self.lloyd(pts, seeds, RECLUSTER_ITERATIONS, weight="w")[0]

    def init_parallel(self, src: str, k: int) -> str:
        return self.recluster(self.candidates(src, 2 * k), k)

    # outputs

    def vectors(self, src: str, vector: str = "c", *keys: str) -> str:
        names = "".join(f"{key}, " for key in keys)
        return self.select(
            f"SELECT {names}CAST(pos AS INT) AS pos, {r6('v', 'v')} FROM "
            f"(SELECT {names}unnest(range(0, len({vector}))) AS pos, unnest({vector}) AS v FROM {src})"
        )

    def matches(self, src: str) -> str:
        return self.select(f"SELECT id, cid, {r6('d2', 'd2')} FROM {src}")

    def summary(self, src: str, cents: str) -> str:
        assigned = self.assign(src, cents)
        return self.select(f"SELECT cid, count(*) AS n, {r6('sum(d2)', 'cost')} FROM {assigned} GROUP BY cid")


EVENT_LOG = """
    SELECT CAST(user_id // 14 AS VARCHAR) AS run_id,
           CASE WHEN user_id % 2 = 0 THEN 'parallel' ELSE 'naive' END AS init,
           CASE event_id % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'persist' ELSE 'unpersist' END AS cache_mode,
           CAST(pow(2, 1 + user_id % 7) AS INT) AS partitions,
           CAST((user_id % 3 + 1) * 1000 AS BIGINT) AS n_rows,
           CASE event_type WHEN 'click' THEN 'pre' WHEN 'view' THEN 'init'
                           WHEN 'purchase' THEN 'lloyd' ELSE 'other' END AS stage,
           'tTotal' AS metric, event_id AS iter, value
    FROM events"""
SETTING = "init, cache_mode, partitions, n_rows"
TIMED = "metric = 'tTotal' AND stage IN ('pre', 'init', 'lloyd')"

# Attributes of the checked line items, in table order.
LINE_COLUMNS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def _types(column: str) -> str:
    return f"""
    SELECT '{column}' AS attribute, string_agg(DISTINCT kind, ',' ORDER BY kind) AS types FROM (
      SELECT CASE WHEN {column} IS NULL THEN 'null'
                  WHEN typeof({column}) IN ('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT') THEN 'integer'
                  WHEN typeof({column}) IN ('DOUBLE', 'FLOAT') OR typeof({column}) LIKE 'DECIMAL%' THEN 'float'
                  WHEN typeof({column}) LIKE 'TIMESTAMP%' OR typeof({column}) = 'DATE' THEN 'time'
                  ELSE 'text' END AS kind
      FROM (SELECT *, 1.0::DOUBLE AS konst FROM lineitem))"""


NESTED_EVENTS = """
    SELECT CASE event_id % 6
             WHEN 0 THEN '{"p": ' || props || ', "v": ' || CAST(round_even(value * 100, 0) AS BIGINT) || '}'
             WHEN 1 THEN '{"p": null, "v": "' || event_type || '"}'
             WHEN 2 THEN '{"v": [' || CAST(round_even(value * 100, 0) AS BIGINT) || ', null, {"t": "' || event_type || '"}, [true, 0.5]]}'
             WHEN 3 THEN '[' || props || ', []]'
             WHEN 4 THEN '{broken' END AS doc
    FROM events"""


def _value_types(docs: str) -> str:
    return f"""
    WITH RECURSIVE docs AS ({docs}),
    nodes AS (
      SELECT '$' AS path, CASE WHEN json_valid(doc) THEN doc::JSON END AS v, doc IS NOT NULL AND NOT json_valid(doc) AS broken FROM docs
      UNION ALL
      SELECT CASE json_type(n.v) WHEN 'ARRAY' THEN n.path || '[*]' ELSE n.path || '.' || e.key END, e.value, false
      FROM nodes n, json_each(n.v) e WHERE json_type(n.v) IN ('ARRAY', 'OBJECT')),
    typed AS (
      SELECT path, CASE WHEN broken THEN 'malformed' WHEN v IS NULL THEN 'null' ELSE
        CASE json_type(v) WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'UBIGINT' THEN 'integer'
          WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'text' WHEN 'OBJECT' THEN 'object'
          ELSE 'array' END END AS type FROM nodes)
    SELECT path, string_agg(DISTINCT type, ',' ORDER BY type) AS types, count(*) FILTER (type <> 'null') AS n_values,
           count(*) FILTER (type = 'null') AS n_nulls
    FROM typed GROUP BY path"""


def _distinct(column: str) -> str:
    return f"SELECT '{column}' AS attribute, count(DISTINCT {column}) AS n_distinct FROM lineitem"


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _predicted(s: Script) -> tuple[str, str]:
    pts = s.scaled_lineitem()
    return pts, s.from_set(pts, K)


def _started(s: Script, k: int = K) -> tuple[str, str]:
    pts = s.embeddings()
    return pts, s.from_set(pts, k)


def _weighted(s: Script, src: str) -> str:
    return s.add(f"SELECT *, 1 + CAST(y AS DOUBLE) AS w FROM {src}", "weighted")


def _expected(s: Script, pts: str) -> str:
    means = s.means(pts, key="y")
    return s.add(f"SELECT CAST(row_number() OVER (ORDER BY y) - 1 AS INT) AS cid, y, c, n FROM {means}", "expected")


def _grown(s: Script, pts: str) -> str:
    first, drawn = s.one_round(pts)
    return s.dedup(f"SELECT c FROM {first}", f"SELECT x AS c FROM {drawn}")


def _own_distances(s: Script, pts: str) -> str:
    means = _expected(s, pts)
    return s.add(f"SELECT p.id, p.y, {sq('p.x', 'e.c')} AS d2 FROM {pts} p JOIN {means} e USING (y)", "own")


def _unlabelled_in_part(s: Script) -> str:
    place = LINEITEM_FEATURES.index("l_linenumber") + 1
    return s.add(f"SELECT id, x, CASE WHEN x[{place}] <> 3 THEN y END AS y FROM {s.lineitem()}", "part_labelled")


def _matched(s: Script) -> str:
    pts, predicted = _predicted(s)
    expected = _expected(s, pts)
    wanted = s.add(f"SELECT cid AS id, c AS x FROM {expected}", "wanted")
    return s.assign(wanted, predicted)


def _build() -> dict[str, str]:
    sql: dict[str, str] = {}

    s = Script()
    sql["load_points"] = s.vectors(s.embeddings(), "x", "id", "y")

    xs = ", ".join(f"CAST({c} AS DOUBLE) AS x{j}" for j, c in enumerate(LINEITEM_FEATURES))
    sql["assemble"] = (
        f"SELECT {LINE_KEY} AS id, l_returnflag AS y, CAST(NULL AS INT) AS cid, CAST(NULL AS DOUBLE) AS d2, {xs} FROM lineitem"
    )
    s = Script()
    sql["shuffle"] = s.select(f"SELECT id, y, {r6(uniform('shuffle'), 'u')} FROM {s.lineitem()} ORDER BY u, id")
    s = Script()
    sql["shuffle_subset"] = s.select(
        f"SELECT id, y FROM {s.lineitem()} ORDER BY {uniform('shuffle')}, id LIMIT {SUBSET_ROWS}"
    )
    sql["partition_count"] = "SELECT CAST(8 AS BIGINT) AS n_partitions, count(*) AS n_rows FROM lineitem"

    def run_costs(s: Script, pts: str, cents: str) -> str:
        costs = s.lloyd(pts, cents, MAX_LLOYD, 0.001)[1]
        every = _union(f"SELECT * FROM {c}" for c in costs)
        return s.add(
            f"SELECT CAST(iter AS BIGINT) AS iter, {r6('cost', 'cost')} FROM ({every}) WHERE cost IS NOT NULL", "costs"
        )

    s = Script()
    pts = s.embeddings()
    costs = run_costs(s, pts, s.init_parallel(pts, K))
    sql["cache_modes"] = s.select(f"SELECT unnest(['none', 'persist', 'unpersist']) AS cache_mode, iter, cost FROM {costs}")
    naive = run_costs(s, pts, s.from_set(pts, K))
    both = f"SELECT 'parallel' AS init, * FROM {costs} UNION ALL SELECT 'naive', * FROM {naive}"
    sql["sweep"] = s.select(f"SELECT init, unnest([2::INT, 8::INT]) AS partitions, iter, cost FROM ({both})")
    sql["sweep_runs"] = """
        SELECT 'naive' AS init, cache_mode, 2::INT AS partitions, (SELECT count(*) FROM embeddings) AS n_rows,
               unnest(['pre', 'init', 'lloyd']) AS stage, n_runs
        FROM (VALUES ('none', 2::BIGINT), ('persist', 3::BIGINT)) AS t(cache_mode, n_runs)"""
    sql["run_log_roundtrip"] = EVENT_LOG
    versioned = "run_id, init, cache_mode, partitions, n_rows, stage"
    again = f"SELECT * REPLACE (value + 1 AS value) FROM ({EVENT_LOG}) WHERE init = 'naive' AND iter % 2 = 0"
    sql["run_log_merge"] = (
        f"WITH old AS ({EVENT_LOG}), again AS ({again}) SELECT * FROM again UNION ALL "
        f"SELECT * FROM old ANTI JOIN (SELECT DISTINCT {versioned} FROM again) USING ({versioned})"
    )
    s = Script()
    pts = s.embeddings()
    costs = run_costs(s, pts, s.from_set(pts, K))
    runs = "SELECT unnest(['none', 'unpersist']) AS cache_mode"
    sql["sweep_resumed"] = s.select(
        f"SELECT 'resumed-naive-' || cache_mode || '-' || partitions || '-0' AS run_id, cache_mode, partitions, iter, 1::BIGINT AS n, "
        f"cost FROM {costs}, ({runs}), (SELECT unnest([2::INT, 4::INT]) AS partitions)"
    )
    sql["partition_layout"] = """
        SELECT 'few' AS points, 8::BIGINT AS n_partitions, count(*) AS n_rows, true AS filled_by_rows FROM embeddings
        WHERE vec_id < 3 UNION ALL SELECT 'all', 8::BIGINT, count(*), true FROM embeddings"""

    sql["shape"] = "SELECT count(*) AS n_rows, CAST(max(len(embedding)) AS INT) AS dim FROM embeddings"
    sql["table_shape"] = f"SELECT count(*) AS n_rows, CAST({len(LINE_COLUMNS)} AS INT) AS dim FROM lineitem"
    sql["type_profile"] = _union(_types(c) for c in [*LINE_COLUMNS, "konst"])
    sql["distinct_counts"] = _union(_distinct(c) for c in LINE_COLUMNS)
    sql["distinct_counts_approx"] = f"SELECT *, true AS close FROM ({sql['distinct_counts']})"
    sql["true_k"] = "SELECT count(DISTINCT p_brand) AS k FROM part"
    sql["label_counts"] = "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand"
    every_type = _union(_types(c) for c in LINE_COLUMNS)
    numeric = f"SELECT count(*) AS dim FROM ({every_type}) WHERE NOT list_contains(string_split(types, ','), 'text')"
    held = "SELECT count(*) FROM ({}) WHERE kind <> 'null' AND attribute IN (SELECT attribute FROM ({}) WHERE types <> 'text')"
    seen = _union(f"SELECT DISTINCT '{c}' AS attribute, CASE WHEN {c} IS NULL THEN 'null' ELSE 'held' END AS kind FROM lineitem" for c in LINE_COLUMNS)
    sql["numeric_dim"] = (
        f"SELECT dim, ({held.format(seen, every_type)}) AS n_filled, (SELECT count(*) FROM lineitem) AS n_rows FROM ({numeric})"
    )
    sql["value_types"] = _value_types("SELECT props AS doc FROM events")
    sql["value_types_nested"] = _value_types(NESTED_EVENTS)

    columns = ", ".join(LINEITEM_FEATURES)
    day = "strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate"
    sql["drop_categorical"] = f"SELECT {columns}, {day}, 1.0::DOUBLE AS konst FROM lineitem"
    s = Script()
    bounds = s.bounds(s.lineitem(", 1.0::DOUBLE"))
    sql["min_max"] = s.select(f"SELECT CAST(pos - 1 AS INT) AS pos, {r6('lo', 'lo')}, {r6('hi', 'hi')} FROM {bounds}")
    s = Script()
    scaled = s.rescale(s.lineitem(", 1.0::DOUBLE"))
    xs = ", ".join(r6(f"x[{j + 1}]", f"x{j}") for j in range(len(LINEITEM_FEATURES)))
    sql["minmax_rescale"] = s.select(f"SELECT id, CAST(len(x) AS INT) AS dim, {xs} FROM {scaled}")
    s = Script()
    sql["label_index"] = s.select(
        f"SELECT id, y, CAST(dense_rank() OVER (ORDER BY y) - 1 AS BIGINT) AS label_id FROM {s.lineitem()}"
    )
    s = Script()
    place = "CASE WHEN y IS NOT NULL THEN CAST(dense_rank() OVER (ORDER BY y NULLS LAST) - 1 AS BIGINT) END"
    sql["label_index_nulls"] = s.select(f"SELECT id, y, {place} AS label_id FROM {_unlabelled_in_part(s)}")

    s = Script()
    sql["sq_dist"] = s.select(
        f"SELECT id, {r6(sq('x', 'z'), 'd2')} FROM (SELECT id, x, list_reverse(x) AS z FROM {s.embeddings()})"
    )
    s = Script()
    sql["assign"] = s.matches(s.assign(*_started(s)))
    sql["assign_sql_kernel"] = sql["assign"]
    s = Script()
    sql["assign_lineitem"] = s.matches(s.assign(*_predicted(s)))
    s = Script()
    pts, cents = _started(s)
    before, now = s.first_state(pts)[1], s.assign(pts, cents)
    sql["assign_keep_d2"] = s.select(
        f"SELECT id, n.cid, {r6('b.d2', 'd2')} FROM {before} b JOIN {now} n USING (id)"
    )
    s = Script()
    pts, cents = _started(s)
    sql["update_distances"] = s.select(
        f"SELECT p.id, c.cid, {r6(sq('p.x', 'c.c'), 'd2')} FROM {pts} p JOIN {cents} c ON c.cid = CAST(p.y AS INT)"
    )
    s = Script()
    assigned = s.assign(*_predicted(s))
    sql["cost"] = s.select(f"SELECT {r6('sum(d2)', 'cost')} FROM {assigned}")
    s = Script()
    sql["update_centroids"] = s.vectors(s.means(s.assign(*_started(s))), "c", "cid", "n")
    s = Script()
    pts, cents = _started(s)
    sql["update_centroids_weighted"] = s.vectors(
        s.means(s.assign(_weighted(s, pts), cents), weight="w"), "c", "cid", "w"
    )
    s = Script()
    sql["cluster_sizes"] = s.select(f"SELECT cid, count(*) AS n FROM {s.assign(*_started(s))} GROUP BY cid")

    s = Script()
    sql["init_from_set"] = s.vectors(_predicted(s)[1], "c", "cid")

    def space(s: Script, pts: str) -> str:
        return s.from_space(s.add(f"SELECT count(DISTINCT y) AS k, max(len(x)) AS dim FROM {pts}", "facts"))

    s = Script()
    pts = s.embeddings()
    sql["init_from_space"] = s.summary(pts, space(s, pts))
    s = Script()
    psi = s.first_state(s.embeddings())[2]
    sql["first_centroid_cost"] = s.select(f"SELECT {r6('v', 'cost')} FROM {psi}")
    sql["rounds"] = s.select(f"SELECT {r6('v', 'psi')}, CAST(greatest(1, floor(ln(v))) AS INT) AS n_rounds FROM {psi}")
    s = Script()
    sql["oversample"] = s.select(f"SELECT id, {r6('d2', 'd2')} FROM {s.one_round(s.embeddings())[1]}")
    s = Script()
    pts = s.embeddings()
    first, drawn = s.one_round(pts)
    grown = s.add(
        f"SELECT cid, c FROM {first} UNION ALL "
        f"SELECT CAST(row_number() OVER (ORDER BY id) AS INT) AS cid, x AS c FROM {drawn}",
        "grown",
    )
    sql["extend"] = s.matches(s.assign(pts, grown))
    s = Script()
    sql["dedup"] = s.vectors(_grown(s, s.embeddings()), "c", "cid")
    s = Script()
    pts = s.embeddings()
    sql["candidate_weights"] = s.select(f"SELECT cid, w FROM {s.weights(pts, _grown(s, pts))}")
    s = Script()
    sql["candidates"] = s.vectors(s.candidates(s.embeddings(), 2 * K), "c", "cid", "w")
    s = Script()
    plain = s.add(f"SELECT *, 1.0::DOUBLE AS w FROM {s.embeddings()}")
    sql["seed_plus_plus"] = s.vectors(s.seed_plus_plus(plain, 3), "c", "cid")
    s = Script()
    plain = s.add(f"SELECT *, 1.0::DOUBLE AS w FROM {s.embeddings()}")
    sql["seed_plus_plus_20"] = s.vectors(s.seed_plus_plus(plain, 20), "c", "cid")
    s = Script()
    sql["recluster_all_rounds"] = s.vectors(s.recluster(s.candidates(s.embeddings(), 2 * K), 3), "c", "cid")
    s = Script()
    sql["seed_plus_plus_weighted"] = s.vectors(s.seed_plus_plus(_weighted(s, s.embeddings()), 3), "c", "cid")
    s = Script()
    pts = s.embeddings()
    sql["recluster"] = s.vectors(s.recluster(s.weights(pts, _grown(s, pts)), 3), "c", "cid")
    s = Script()
    sql["init_parallel"] = s.vectors(s.init_parallel(s.embeddings(), K), "c", "cid")

    s = Script()
    pts, cents = _started(s)
    sql["lloyd_2_iter"] = s.vectors(s.lloyd(pts, cents, 2)[0], "c", "cid", "n")
    s = Script()
    pts, cents = _started(s)
    sql["lloyd_weighted_2_iter"] = s.vectors(s.lloyd(_weighted(s, pts), cents, 2, weight="w")[0], "c", "cid", "n")
    s = Script()
    pts, cents = _started(s)
    sql["lloyd_20_iter"] = s.vectors(s.lloyd(pts, cents, 20)[0], "c", "cid", "n")
    s = Script()
    pts, cents = _started(s)
    sql["lloyd_weighted_100_iter"] = s.vectors(s.lloyd(_weighted(s, pts), cents, 100, weight="w")[0], "c", "cid", "n")
    s = Script()
    pts = s.scaled_lineitem()
    costs = s.lloyd(pts, s.from_set(pts, 3), MAX_LLOYD, 0.001)[1]
    every = _union(f"SELECT * FROM {c}" for c in costs)
    sql["lloyd_cost_log"] = s.select(
        f"SELECT CAST(iter AS BIGINT) AS iter, {r6('cost', 'cost')} FROM ({every}) WHERE cost IS NOT NULL"
    )

    sql["lloyd_bounds_20_iter"] = sql["lloyd_20_iter"]
    sql["candidates_generations"] = sql["candidates"]

    def run(s: Script, pts: str, cents: str) -> str:
        return s.summary(pts, s.lloyd(pts, cents, MAX_LLOYD, 0.001)[0])

    s = Script()
    pts = s.embeddings()
    sql["cluster_naive"] = run(s, pts, s.from_set(pts, K))
    s = Script()
    pts = s.rescale(s.embeddings())
    sql["cluster_parallel"] = run(s, pts, s.init_parallel(pts, K))
    s = Script()
    pts = s.rescale(s.embeddings())
    sql["cluster_space"] = run(s, pts, space(s, pts))
    s = Script()
    pts = s.scaled_lineitem()
    sql["cluster_naive_lineitem"] = run(s, pts, s.from_set(pts, 3))
    sql["cluster_bounds_lineitem"] = sql["cluster_naive_lineitem"]
    s = Script()
    pts = s.scaled_lineitem()
    sql["cluster_parallel_lineitem"] = run(s, pts, s.init_parallel(pts, 3))

    s = Script()
    assigned = s.assign(*_predicted(s))
    sql["sizes_desc"] = s.select(f"SELECT cid, count(*) AS n FROM {assigned} GROUP BY cid ORDER BY n DESC, cid")
    sql["label_sizes_desc"] = (
        "SELECT CAST(label AS VARCHAR) AS y, count(*) AS n FROM embeddings GROUP BY label ORDER BY n DESC, y"
    )
    s = Script()
    sql["expected_centroids"] = s.vectors(_expected(s, s.embeddings()), "c", "cid", "y", "n")
    s = Script()
    sql["expected_distances"] = s.select(
        f"SELECT id, y, {r6('d2', 'd2')} FROM {_own_distances(s, s.scaled_lineitem())}"
    )
    s = Script()
    pts = s.rescale(_unlabelled_in_part(s))
    means = _expected(s, s.add(f"SELECT * FROM {pts} WHERE y IS NOT NULL"))
    own = s.add(f"SELECT p.id, p.y, {sq('p.x', 'e.c')} AS d2 FROM {pts} p LEFT JOIN {means} e USING (y)", "own")
    sql["expected_distances_nulls"] = s.select(f"SELECT id, y, {r6('d2', 'd2')} FROM {own}")

    s = Script()
    pts = s.scaled_lineitem()
    final = s.lloyd(pts, s.from_set(pts, 3), MAX_LLOYD, 0.001)[0]
    means = _expected(s, pts)
    near = s.assign(s.add(f"SELECT cid AS id, c AS x FROM {means}", "wanted"), final)
    gaps = f"SELECT a.cid, min({sq('a.c', 'b.c')}) AS other FROM {means} a JOIN {means} b ON a.cid <> b.cid GROUP BY a.cid"
    radius = (
        f"SELECT y, sqrt(avg(d2)) AS radius FROM (SELECT p.y, {sq('p.x', 'e.c')} AS d2 FROM {pts} p JOIN {means} e "
        "USING (y)) GROUP BY y"
    )
    sql["evaluate_lineitem"] = s.select(
        f"SELECT e.y, e.n, e.cid, m.cid AS matched, {r6('m.d2', 'd2')}, {r6('r.radius', 'radius')}, "
        f"{r6('sqrt(o.other)', 'other')} FROM {means} e JOIN {near} m ON m.id = e.cid JOIN ({radius}) r ON r.y = e.y "
        f"JOIN ({gaps}) o ON o.cid = e.cid"
    )
    sql["evaluate_lineitem_mse"] = s.select(f"SELECT {r6('avg(d2)', 'mse')} FROM {near}")

    s = Script()
    found = _matched(s)
    sql["match_centroids"] = s.select(
        f"SELECT CAST(id AS INT) AS cid, cid AS matched, {r6('d2', 'd2')}, {r6('sqrt(d2)', 'dist')} FROM {found}"
    )
    sql["match_mse"] = s.select(f"SELECT {r6('avg(d2)', 'mse')} FROM {found}")
    s = Script()
    own = _own_distances(s, s.embeddings())
    sql["rms_radius"] = s.select(f"SELECT y, {r6('sqrt(avg(d2))', 'radius')} FROM {own} GROUP BY y")
    s = Script()
    cents = _expected(s, s.embeddings())
    pairs = f"SELECT a.cid, b.cid AS nearest, {sq('a.c', 'b.c')} AS d2 FROM {cents} a JOIN {cents} b ON a.cid <> b.cid"
    ranked = f"SELECT *, row_number() OVER (PARTITION BY cid ORDER BY d2, nearest) AS place FROM ({pairs})"
    sql["nearest_other"] = s.select(f"SELECT cid, nearest, {r6('sqrt(d2)', 'dist')} FROM ({ranked}) WHERE place = 1")

    times = ", ".join(
        r6(f"sum(value) FILTER (stage = '{stage}')", name)
        for stage, name in [("pre", "pre"), ("init", "init_time"), ("lloyd", "lloyd")]
    )
    sql["stage_times"] = (
        f"SELECT run_id, {SETTING}, {times} FROM ({EVENT_LOG}) WHERE {TIMED} GROUP BY run_id, {SETTING}"
    )
    per_run = (
        f"SELECT {SETTING}, stage, sum(value) AS t FROM ({EVENT_LOG}) WHERE {TIMED} GROUP BY run_id, {SETTING}, stage"
    )
    sql["stage_stats"] = (
        f"SELECT {SETTING}, stage, {r6('avg(t)', 'mean')}, {r6('stddev_pop(t)', 'std')}, count(*) AS n_runs "
        f"FROM ({per_run}) GROUP BY {SETTING}, stage"
    )
    sql["series"] = (
        f"SELECT run_id, {SETTING}, iter, value FROM ({EVENT_LOG}) "
        "WHERE stage = 'lloyd' AND metric = 'tTotal' ORDER BY run_id, init, partitions, iter"
    )
    per_mode = (
        f"SELECT cache_mode, n_rows, sum(value) AS t FROM ({EVENT_LOG}) WHERE {TIMED} AND partitions = 8 "
        f"GROUP BY run_id, {SETTING}"
    )
    sql["cache_comparison"] = (
        f"SELECT cache_mode, n_rows, {r6('avg(t)', 'mean_total')}, count(*) AS n_runs FROM ({per_mode}) "
        "GROUP BY cache_mode, n_rows"
    )
    return sql


def oracle_sql() -> dict[str, str]:
    return _build()
