"""SQL that grows the same trees as the library: isolation forests and boosted trees, level by level."""

from __future__ import annotations

from math import ceil, factorial, log2

from panelkit import config
from panelkit.functions import normal
from panelkit.operators.boosting import BINS
from panelkit.operators.isolation_forest import EULER


def _fraction(text: str) -> str:
    """The number from 0 up to 1 that a text decides."""
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def _mean_path(n: str) -> str:
    return f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + {EULER}::DOUBLE) - 2 * ({n} - 1)::DOUBLE / {n} WHEN {n} = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


def isolation_forest(trees=200, sample=256, seed=42, contamination=0.05) -> str:
    """CTEs over ``fact`` that end in ``scored``: iso_code, year, co2_per_capita, anomaly_score, is_anomaly."""
    k = len(config.ANOMALY_FEATURES)
    each = lambda text: ", ".join(text.format(i=i) for i in range(k))
    clean = ", ".join(f"CASE WHEN isnan({f}) OR isinf({f}) THEN NULL ELSE {f} END AS c{i}" for i, f in enumerate(config.ANOMALY_FEATURES))
    z, limit = each("z{i}"), ceil(log2(sample))
    parts = [f"""known AS (SELECT iso_code, year, co2_per_capita, {clean} FROM fact WHERE co2_per_capita IS NOT NULL),
mids AS (SELECT {each("quantile_cont(c{i}, 0.5) AS m{i}")} FROM known),
filled AS (SELECT iso_code, year, co2_per_capita, {each("coalesce(c{i}, m{i}, 0) AS v{i}")} FROM known, mids),
points AS MATERIALIZED (SELECT row_number() OVER () AS id, iso_code, year, co2_per_capita, count(*) OVER () AS n,
  {each("(v{i} - avg(v{i}) OVER ()) / coalesce(nullif(stddev_pop(v{i}) OVER (), 0), 1) AS z{i}")} FROM filled),
thinned AS (SELECT *, least(1.0::DOUBLE, {trees * sample * 1.25}::DOUBLE / n) AS keep FROM points),
pool AS (SELECT *, least(1.0::DOUBLE, {sample * 1.25}::DOUBLE / (n * keep)) AS per_tree FROM thinned WHERE {_fraction(f"'{seed}:pool:' || iso_code || ':' || year")} < keep),
slots AS (SELECT *, unnest(CASE WHEN per_tree >= 0.5 THEN range({trees}) ELSE range(ceil(-{trees} * ln(1 - least(per_tree, 0.5::DOUBLE)))::BIGINT) END) AS slot FROM pool),
picked_trees AS (SELECT DISTINCT * EXCLUDE (slot), CASE WHEN per_tree >= 0.5 THEN slot ELSE floor({_fraction(f"'{seed}:tree:' || slot || ':' || iso_code || ':' || year")} * {trees})::BIGINT END AS tree FROM slots
  WHERE per_tree >= 0.5 OR {_fraction(f"'{seed}:join:' || slot || ':' || iso_code || ':' || year")} < -{trees} * ln(1 - least(per_tree, 0.5::DOUBLE)) / ceil(-{trees} * ln(1 - least(per_tree, 0.5::DOUBLE)))),
draws AS (SELECT *, {_fraction(f"'{seed}:' || tree || ':' || iso_code || ':' || year")} AS draw FROM picked_trees),
s0 AS MATERIALIZED (SELECT tree, 1 AS node, n AS all_rows, {z} FROM draws WHERE per_tree < 0.5 OR draw < per_tree
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY draw, iso_code, year) <= least({sample}, n))"""]
    for d in range(limit + 1):
        spans = "list_filter([" + ", ".join(f"CASE WHEN hi{i} > lo{i} THEN {i} END" for i in range(k)) + "], lambda i: i IS NOT NULL)"
        draw = lambda what: _fraction(f"'{seed}:' || tree || ':' || node || ':{what}'")
        parts.append(f"""box{d} AS MATERIALIZED (SELECT tree, node, count(*) AS n, max(all_rows) AS all_rows, {each("min(z{i}) AS lo{i}, max(z{i}) AS hi{i}")} FROM s{d} GROUP BY tree, node),
way{d} AS (SELECT *, {spans} AS span FROM box{d}),
pick{d} AS (SELECT *, span[1 + floor({draw("feature")} * len(span))::INT] AS f FROM way{d}
  WHERE n > 1 AND len(span) > 0 AND {d} < ceil(log2(greatest(2, least({sample}, all_rows))))),
split{d} AS MATERIALIZED (SELECT tree, node, f, CASE WHEN cut >= hi THEN lo ELSE cut END AS cut FROM (
  SELECT *, lo + {draw("cut")} * (hi - lo) AS cut FROM (SELECT tree, node, f, [{each("lo{i}")}][f + 1] AS lo, [{each("hi{i}")}][f + 1] AS hi FROM pick{d}))),
end{d} AS (SELECT tree, node, {d} + {_mean_path("n")} AS length FROM box{d} ANTI JOIN split{d} USING (tree, node)),
s{d + 1} AS MATERIALIZED (SELECT s.tree, 2 * s.node + CASE WHEN [{each("s.z{i}")}][f + 1] <= cut THEN 0 ELSE 1 END AS node, all_rows, {each("s.z{i}")}
  FROM s{d} s JOIN split{d} USING (tree, node))""")
    parts.append("w0 AS (SELECT id, tree, 1 AS node FROM points, range(%d) t(tree) WHERE EXISTS (SELECT 1 FROM s0))" % trees)
    for d in range(limit):
        parts.append(f"""w{d + 1} AS (SELECT w.id, w.tree, CASE WHEN f IS NULL THEN w.node ELSE 2 * w.node + CASE WHEN [{each("z{i}")}][f + 1] <= cut THEN 0 ELSE 1 END END AS node
  FROM w{d} w JOIN points p ON p.id = w.id LEFT JOIN split{d} s ON s.tree = w.tree AND s.node = w.node)""")
    ends = " UNION ALL ".join(f"SELECT * FROM end{d}" for d in range(limit + 1))
    at = f"{contamination}::DOUBLE * (count(*) OVER () - 1)"
    parts.append(f"""ends AS ({ends}),
paths AS (SELECT id, sum(length) / count(*) AS length FROM w{limit} JOIN ends USING (tree, node) GROUP BY id),
raws AS (SELECT p.*, round(-pow(2.0::DOUBLE, -length / coalesce(nullif({_mean_path(f"least({sample}, n)")}, 0), 1)), 12) AS raw FROM points p JOIN paths USING (id)),
ranks AS (SELECT raw, row_number() OVER (ORDER BY raw) - 1 AS r, {at} AS pos FROM raws),
bound AS (SELECT max(raw) FILTER (WHERE r = floor(pos)) AS lo, max(raw) FILTER (WHERE r = ceil(pos)) AS hi, max(pos - floor(pos)) AS part FROM ranks),
scored AS (SELECT iso_code, year, co2_per_capita, raw - (lo + (hi - lo) * part) AS anomaly_score, CAST(raw - (lo + (hi - lo) * part) < 0 AS INTEGER) AS is_anomaly FROM raws, bound)""")
    return ",\n".join(parts)


def boosted_trees(trees: int, depth: int, rate=0.1, bins=BINS, l2=1.0, features=config.RISK_FEATURES, target=config.RISK_TARGET) -> str:
    """CTEs over ``fact`` that boost trees for the scaled target; see ``boosted_over``."""
    clean = ", ".join(f"coalesce(CASE WHEN isnan({f}) OR isinf({f}) THEN NULL ELSE {f} END, 0) AS x{i}" for i, f in enumerate(features))
    known = " AND ".join(f"{c} IS NOT NULL" for c in [*features, target])
    low, high = f"min({target}) OVER ()", f"max({target}) OVER ()"
    return boosted_over(f"""SELECT row_number() OVER () AS id, {clean},
  CASE WHEN {high} = {low} THEN 50.0::DOUBLE ELSE ({target} - {low}) / ({high} - {low}) * 100 END AS y FROM fact WHERE {known}""", len(features), trees, depth, rate, bins, l2)


def boosted_over(rows: str, k: int, trees: int, depth: int, rate=0.1, bins=BINS, l2=1.0) -> str:
    """CTEs ``train`` (id, x0.., y: the given rows), ``fitted`` (id, y, margin), ``nodes`` (tree, place, f, cut, value, rows; f is null at a leaf)."""
    long = " UNION ALL ".join(f"SELECT id, {i} AS f, x{i} AS v FROM train" for i in range(k))
    parts = [f"""train AS MATERIALIZED ({rows}),
long AS MATERIALIZED ({long}),
ranked AS (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS r, count(*) OVER (PARTITION BY f) AS n, max(v) OVER (PARTITION BY f) AS top FROM long),
edges AS MATERIALIZED (SELECT f, c, row_number() OVER (PARTITION BY f ORDER BY c) - 1 AS b FROM (
  SELECT DISTINCT f, v AS c FROM ranked, range(1, {bins}) t(q) WHERE r = floor(q / {bins}.0::DOUBLE * (n - 1)) AND v < top)),
bins AS MATERIALIZED (SELECT id, f, count(c) AS b FROM (SELECT id, long.f, c FROM long LEFT JOIN edges ON edges.f = long.f AND c < v) GROUP BY id, f),
m0 AS MATERIALIZED (SELECT id, y, avg(y) OVER () AS margin FROM train)"""]
    for t in range(trees):
        parts.append(f"a{t}_0 AS (SELECT id, 1 AS node, margin - y AS g FROM m{t})")
        for d in range(depth):
            here = f"a{t}_{d}"
            parts.append(f"""h{t}_{d} AS (SELECT node, f, b, sum(g) AS g, count(*) AS n FROM {here} JOIN bins USING (id) GROUP BY node, f, b),
c{t}_{d} AS (SELECT node, f, b, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER (PARTITION BY node, f) AS gt, sum(n) OVER (PARTITION BY node, f) AS nt
  FROM h{t}_{d} WINDOW w AS (PARTITION BY node, f ORDER BY b)),
s{t}_{d} AS MATERIALIZED (SELECT node, f, b FROM (
  SELECT node, f, b, (gl * gl / (nl + {l2}) + (gt - gl) * (gt - gl) / (nt - nl + {l2}) - gt * gt / (nt + {l2}))::FLOAT AS gain FROM c{t}_{d} WHERE nt > nl)
  WHERE gain > 1e-6 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b) = 1),
a{t}_{d + 1} AS MATERIALIZED (SELECT a.id, CASE WHEN s.node IS NULL THEN a.node ELSE 2 * a.node + CASE WHEN x.b > s.b THEN 1 ELSE 0 END END AS node, g
  FROM {here} a LEFT JOIN s{t}_{d} s ON s.node = a.node LEFT JOIN bins x ON x.id = a.id AND x.f = s.f)""")
        parts.append(f"""l{t} AS MATERIALIZED (SELECT node, -{rate}::DOUBLE * sum(g) / (count(*) + {l2}) AS value FROM a{t}_{depth} GROUP BY node),
m{t + 1} AS MATERIALIZED (SELECT id, y, margin + value AS margin FROM m{t} JOIN a{t}_{depth} USING (id) JOIN l{t} USING (node))""")
    # A leaf of a lower level is found again at every deeper one, so rows are counted where a node first stands.
    inner = " UNION ALL ".join(f"SELECT {t} AS tree, node, f, b FROM s{t}_{d}" for t in range(trees) for d in range(depth))
    rows = " UNION ".join(f"SELECT {t} AS tree, node, count(*) AS rows FROM a{t}_{d} GROUP BY node" for t in range(trees) for d in range(depth + 1))
    values = " UNION ALL ".join(f"SELECT {t} AS tree, node, value FROM l{t}" for t in range(trees))
    parts.append(f"""inner_nodes AS ({inner}), sizes AS ({rows}), leaf_values AS ({values}),
nodes AS MATERIALIZED (SELECT sizes.tree, sizes.node AS place, i.f, c AS cut, value, rows FROM sizes LEFT JOIN inner_nodes i USING (tree, node)
  LEFT JOIN edges ON edges.f = i.f AND edges.b = i.b LEFT JOIN leaf_values v ON v.tree = sizes.tree AND v.node = sizes.node AND i.f IS NULL),
fitted AS (SELECT id, y, margin FROM m{trees})""")
    return ",\n".join(parts)


def walked(rows: str, ids: str, trees: int, depth: int, features=config.RISK_FEATURES) -> str:
    """CTE ``predicted``: the ids of a table of rows with their prediction, walked down ``nodes``."""
    clean = ", ".join(f"coalesce(CASE WHEN isnan({f}) OR isinf({f}) THEN NULL ELSE {f} END, 0)" for f in features)
    parts = [f"p0 AS (SELECT {ids}, tree, 1 AS place, [{clean}] AS x FROM {rows}, range({trees}) t(tree))"]
    for d in range(depth):
        parts.append(f"""p{d + 1} AS (SELECT {', '.join('p.' + i.strip() for i in ids.split(','))}, p.tree, CASE WHEN f IS NULL THEN p.place ELSE 2 * p.place + CASE WHEN x[f + 1] <= cut THEN 0 ELSE 1 END END AS place, x
  FROM p{d} p JOIN nodes USING (tree, place))""")
    parts.append(f"predicted AS (SELECT {ids}, (SELECT avg(y) FROM train) + sum(value) AS prediction FROM p{depth} JOIN nodes USING (tree, place) GROUP BY {ids})")
    return ",\n".join(parts)


def fed_back(state: str, trees: int, depth: int, horizon: int, lags: int) -> str:
    """CTE ``fed`` (iso_code, path): predictions by ``nodes`` fed back as the newest of the lags; path begins with the newest."""
    parts = [f"f0 AS MATERIALIZED ({state})"]
    for h in range(horizon):
        parts.append(f"f{h}_0 AS (SELECT iso_code, path, tree, 1 AS place FROM f{h}, range({trees}) t(tree))")
        for d in range(depth):
            parts.append(f"""f{h}_{d + 1} AS (SELECT iso_code, path, p.tree, CASE WHEN f IS NULL THEN p.place ELSE 2 * p.place + CASE WHEN path[f + 1] <= cut THEN 0 ELSE 1 END END AS place FROM f{h}_{d} p JOIN nodes USING (tree, place))""")
        parts.append(f"""f{h + 1} AS MATERIALIZED (SELECT iso_code, list_concat([(SELECT avg(y) FROM train) + sum(value)], path) AS path FROM f{h}_{depth} JOIN nodes USING (tree, place) GROUP BY iso_code, path)""")
    parts.append(f"fed AS (SELECT * FROM f{horizon})")
    return ",\n".join(parts)


def solved(system: str, k: int, name: str) -> str:
    """CTE ``name`` (r, v): the solution of k equations given as (r, c, v) with right side in column k."""
    parts = [f"{name}0 AS MATERIALIZED ({system})"]
    for i in range(k):
        parts.append(f"""{name}{i + 1} AS MATERIALIZED (SELECT m.r, m.c, CASE WHEN m.r = {i} THEN m.v / p.v ELSE m.v - g.v * h.v / p.v END AS v FROM {name}{i} m
  JOIN {name}{i} p ON p.r = {i} AND p.c = {i} JOIN {name}{i} g ON g.r = m.r AND g.c = {i} JOIN {name}{i} h ON h.r = {i} AND h.c = m.c)""")
    parts.append(f"{name} AS (SELECT r, v FROM {name}{k} WHERE c = {k})")
    return ",\n".join(parts)


def coalitions(rows: str, depth: int, features=config.RISK_FEATURES) -> str:
    """CTE ``shap`` (iso_code, f, phi): Shapley values by the sum over all coalitions of features.

    In a coalition a row goes down the side its feature says; at any other node both sides count, by their training rows.
    """
    k = len(features)
    clean = ", ".join(f"coalesce(CASE WHEN isnan({f}) OR isinf({f}) THEN NULL ELSE {f} END, 0)" for f in features)
    share = "(c.rows::DOUBLE / n.rows)"
    right = "CASE WHEN (s.mask >> n.f) & 1 = 1 THEN CASE WHEN (x[n.f + 1] <= n.cut) = (c.place % 2 = 0) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ELSE " + share + " END"
    parts = [f"game0 AS (SELECT iso_code, mask, tree, 1 AS place, 1.0::DOUBLE AS weight, [{clean}] AS x FROM {rows}, range({2 ** k}) s(mask), (SELECT DISTINCT tree FROM nodes))"]
    for d in range(depth):
        parts.append(f"""game{d + 1} AS (SELECT s.iso_code, s.mask, s.tree, CASE WHEN n.f IS NULL THEN s.place ELSE c.place END AS place, CASE WHEN n.f IS NULL THEN weight ELSE weight * {right} END AS weight, x
  FROM game{d} s JOIN nodes n ON n.tree = s.tree AND n.place = s.place LEFT JOIN nodes c ON c.tree = n.tree AND n.f IS NOT NULL AND c.place IN (2 * n.place, 2 * n.place + 1)
  WHERE weight > 0)""")
    weights = ", ".join(f"{factorial(s) * factorial(k - 1 - s) / factorial(k)!r}::DOUBLE" for s in range(k))
    parts.append(f"""game AS MATERIALIZED (SELECT iso_code, mask, sum(weight * value) AS v FROM game{depth} JOIN nodes USING (tree, place) GROUP BY iso_code, mask),
shap AS (SELECT a.iso_code, f, sum([{weights}][bit_count(a.mask::BIGINT) + 1] * (b.v - a.v)) AS phi
  FROM game a, range({k}) t(f), game b WHERE (a.mask >> f) & 1 = 0 AND b.iso_code = a.iso_code AND b.mask = a.mask + (1 << f) GROUP BY a.iso_code, f)""")
    return ",\n".join(parts)


def _series(constants, x: str) -> str:
    out = f"{constants[0]!r}::DOUBLE"
    for c in constants[1:]:
        out = f"({out} * {x} + {c!r}::DOUBLE)"
    return out


def _share(x: str) -> str:
    t = f"(1 / (1 + {normal.SHARE_AT!r}::DOUBLE * abs({x})))"
    beyond = f"(exp(-({x}) * ({x}) / 2) / sqrt(2 * pi()) * {t} * {_series(normal.SHARE, t)})"
    return f"CASE WHEN {x} >= 0 THEN 1 - {beyond} ELSE {beyond} END"


def _quantile(p: str) -> str:
    middle, r = f"({p} - 0.5)", f"(({p} - 0.5) * ({p} - 0.5))"
    tail = f"sqrt(-2 * ln(greatest(least({p}, 1 - {p}), 1e-300::DOUBLE)))"
    far = f"{_series(normal.TAIL_OVER, tail)} / {_series([*normal.TAIL_UNDER, 1.0], tail)}"
    return (f"CASE WHEN {p} < {normal.TAIL}::DOUBLE THEN {far} WHEN {p} > 1 - {normal.TAIL}::DOUBLE THEN -({far}) "
            f"ELSE {_series(normal.MIDDLE_OVER, r)} * {middle} / {_series([*normal.MIDDLE_UNDER, 1.0], r)} END")


def local_weights(trees: int, depth: int, samples: int, seed=42, ridge=1.0, features=config.RISK_FEATURES) -> str:
    """CTE ``weights`` (iso_code, f, weight): the ridge regression around every row of ``top``.

    Over ``clean`` (all rows), ``cuts`` (their quartiles), ``top`` (the explained rows) and ``nodes`` (the model).
    """
    k = len(features)
    bin_of = lambda v, f: f"CASE WHEN {v} <= q1_{f} THEN 0 WHEN {v} <= q2_{f} THEN 1 WHEN {v} <= q3_{f} THEN 2 ELSE 3 END"
    long = " UNION ALL ".join(f"SELECT {i} AS f, {bin_of(f, f)} AS bin, {f} AS v FROM clean, cuts" for i, f in enumerate(features))
    own = " UNION ALL ".join(f"SELECT iso_code, {i} AS f, '{f}' AS name, {bin_of(f, f)} AS own, {f} AS v FROM top, cuts" for i, f in enumerate(features))
    draw = lambda what: _fraction(f"'{seed}:' || o.iso_code || ':' || sample || ':' || name || ':{what}'")
    parts = [f"""profile AS (SELECT f, bin, count(*) AS n, avg(v) AS mean, stddev_pop(v) AS std, min(v) AS lo, max(v) AS hi FROM ({long}) GROUP BY f, bin),
ends AS MATERIALIZED (SELECT *, CASE WHEN std > 0 THEN {_share("((lo - mean) / std)")} ELSE 0.5::DOUBLE END AS low, CASE WHEN std > 0 THEN {_share("((hi - mean) / std)")} ELSE 0.5::DOUBLE END AS high,
  sum(n) OVER (PARTITION BY f ORDER BY bin)::DOUBLE / sum(n) OVER (PARTITION BY f) AS upto, bin = max(bin) OVER (PARTITION BY f) AS is_last FROM profile),
own AS (SELECT * FROM ({own})),
picked AS (SELECT o.iso_code, o.f, o.name, o.own, o.v, sample, CASE WHEN sample = 0 THEN o.own ELSE (SELECT min(bin) FROM ends e WHERE e.f = o.f AND ({draw("bin")} < e.upto OR e.is_last)) END AS bin
  FROM own o, range({samples}) s(sample)),
parted AS (SELECT o.*, mean, std, low + {draw("value")} * (high - low) AS p FROM picked o LEFT JOIN ends e ON e.f = o.f AND e.bin = o.bin),
drawn AS MATERIALIZED (SELECT iso_code, sample, f, CASE WHEN sample = 0 THEN v ELSE mean + std * ({_quantile("p")}) END AS v, CASE WHEN bin = own THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS same FROM parted),
wide_draws AS MATERIALIZED (SELECT iso_code, sample, list(v ORDER BY f) AS x, list_concat([1.0::DOUBLE], list(same ORDER BY f)) AS same, sum(1 - same) AS away FROM drawn GROUP BY iso_code, sample),
t0 AS (SELECT iso_code, sample, tree, 1 AS place FROM wide_draws, range({trees}) t(tree))"""]
    for d in range(depth):
        parts.append(f"""t{d + 1} AS (SELECT t.iso_code, t.sample, t.tree, CASE WHEN n.f IS NULL THEN t.place ELSE 2 * t.place + CASE WHEN x[n.f + 1] <= cut THEN 0 ELSE 1 END END AS place
  FROM t{d} t JOIN nodes n ON n.tree = t.tree AND n.place = t.place JOIN wide_draws w ON w.iso_code = t.iso_code AND w.sample = t.sample)""")
    width = 0.75**2 * k
    parts.append(f"""answers AS (SELECT t.iso_code, t.sample, (SELECT avg(y) FROM train) + sum(value) AS y FROM t{depth} t JOIN nodes n ON n.tree = t.tree AND n.place = t.place GROUP BY ALL),
weighted AS MATERIALIZED (SELECT iso_code, same, y, sqrt(exp(-away / {width!r}::DOUBLE)) AS w FROM wide_draws JOIN answers USING (iso_code, sample)),
e0 AS MATERIALIZED (SELECT iso_code, r, c, sum(w * same[r + 1] * CASE WHEN c <= {k} THEN same[c + 1] ELSE y END) + CASE WHEN r = c AND r > 0 THEN {ridge}::DOUBLE ELSE 0 END AS v
  FROM weighted, range({k + 1}) rows_(r), range({k + 2}) columns_(c) GROUP BY iso_code, r, c)""")
    for i in range(k + 1):  # one unknown after the other
        parts.append(f"""e{i + 1} AS MATERIALIZED (SELECT m.iso_code, m.r, m.c, CASE WHEN m.r = {i} THEN m.v / p.v ELSE m.v - g.v * h.v / p.v END AS v FROM e{i} m
  JOIN e{i} p ON p.iso_code = m.iso_code AND p.r = {i} AND p.c = {i} JOIN e{i} g ON g.iso_code = m.iso_code AND g.r = m.r AND g.c = {i} JOIN e{i} h ON h.iso_code = m.iso_code AND h.r = {i} AND h.c = m.c)""")
    parts.append(f"weights AS (SELECT iso_code, r - 1 AS f, v AS weight FROM e{k + 1} WHERE c = {k + 1} AND r > 0)")
    return ",\n".join(parts)
