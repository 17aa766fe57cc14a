"""Models: clustering, silhouette, isolation forest, boosted risk model, explanations, pooled forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks import forests
from checks.analytics import CLOSED, TEMP, with_scores
from checks.panel import stored_fact, wide, with_fact, with_sources
from checks.registry import query, r4, rounded
from panelkit import config
from panelkit.operators import cluster, density, explain, forecast, isolation_forest as forest, risk_model, silhouette
from panelkit.operators.trend import changepoint_forecast
from panelkit.plans import marts
from panelkit.session import store

FEATURES = config.CLUSTER_FEATURES


PROFILES = f"""profiles AS (
  SELECT iso_code, country, {", ".join(f"coalesce(CASE WHEN isinf({f}) THEN NULL ELSE {f} END, 0) AS {f}" for f in FEATURES)} FROM fact WHERE co2_per_capita IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY iso_code ORDER BY year DESC) = 1),
points AS (SELECT *, {", ".join(f"({f} - avg({f}) OVER ()) / coalesce(nullif(stddev_pop({f}) OVER (), 0), 1) AS z_{f}" for f in FEATURES)} FROM profiles)"""


def points(spark, sf, grain="month") -> DataFrame:
    return store(cluster.standardise(store(cluster.profiles(stored_fact(spark, sf, grain)), "profiles"), FEATURES), "points")


Z = [f"z_{f}" for f in FEATURES]


@query("cluster_profiles", with_fact(f"SELECT iso_code, country, {', '.join(f'round({f}, 4) AS {f}' for f in FEATURES)} FROM profiles", "month", PROFILES))
def cluster_profiles(spark, sf):
    return rounded(cluster.profiles(stored_fact(spark, sf, "month")))


@query("cluster_standardise", with_fact(f"SELECT iso_code, {', '.join(f'round({z}, 4) AS {z}' for z in Z)} FROM points", "month", PROFILES))
def cluster_standardise(spark, sf):
    return rounded(points(spark, sf).select("iso_code", *Z))


GIVEN = """given AS (SELECT p.*, CASE WHEN s_acctbal > 6500 THEN 2 WHEN s_acctbal > 2500 THEN 1 ELSE 0 END AS cluster_id FROM points p JOIN sup ON p.iso_code = sup.iso_code)"""


def given(spark, sf) -> DataFrame:
    from checks.panel import suppliers
    s = suppliers(spark, sf).select("iso_code", F.when(F.col("s_acctbal") > 6500, 2).when(F.col("s_acctbal") > 2500, 1).otherwise(0).alias("cluster_id"))
    return points(spark, sf).join(s, "iso_code")


def _distance(a, b):
    return "sqrt(" + " + ".join(f"({a}.{z} - {b}.{z}) * ({a}.{z} - {b}.{z})" for z in Z) + ")"


@query("cluster_silhouette", with_fact(f"""
SELECT iso_code, cluster_id, round(a, 4) AS a, round(b, 4) AS b, round(CASE WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END, 4) AS s FROM (
 SELECT iso_code, own AS cluster_id, max(m) FILTER (WHERE own = other) AS a, min(m) FILTER (WHERE own <> other) AS b FROM (
  SELECT p.iso_code, p.cluster_id AS own, q.cluster_id AS other,
   sum({_distance("p", "q")}) / (count(*) - CASE WHEN p.cluster_id = q.cluster_id THEN 1 ELSE 0 END) AS m
  FROM given p, given q GROUP BY p.iso_code, p.cluster_id, q.cluster_id) GROUP BY iso_code, own)""", "month", f"{PROFILES}, {GIVEN}"))
def cluster_silhouette(spark, sf):
    return rounded(silhouette.silhouette_values(given(spark, sf), Z, "cluster_id", block=64))


NAMED = """med AS (SELECT cluster_id, quantile_cont(co2_per_capita, 0.5) AS median, count(*) AS members FROM given GROUP BY cluster_id),
names AS (SELECT *, CASE WHEN count(*) OVER () >= 3 THEN ['Green Economies', 'Transition Economies', 'High Emitters'][row_number() OVER (ORDER BY median, cluster_id)]
  ELSE 'Cluster ' || (row_number() OVER (ORDER BY median, cluster_id) - 1) END AS cluster_name FROM med),
clusters AS (SELECT given.*, cluster_name FROM given JOIN names USING (cluster_id))"""
ALL_GIVEN = ", ".join([PROFILES, GIVEN, NAMED])


@query("cluster_names", with_fact("SELECT iso_code, cluster_id, cluster_name FROM clusters", "month", ALL_GIVEN))
def cluster_names(spark, sf):
    return cluster.name_clusters(given(spark, sf)).select("iso_code", "cluster_id", "cluster_name")


@query("cluster_summary", with_fact("SELECT cluster_name, members, round(median, 4) AS median FROM names", "month", ALL_GIVEN))
def cluster_summary(spark, sf):
    return rounded(cluster.summary(store(cluster.name_clusters(given(spark, sf)), "clusters")))


@query("mart_cluster_sizes", with_fact("SELECT cluster_name, members FROM names", "month", ALL_GIVEN))
def mart_cluster_sizes(spark, sf):
    return marts.cluster_sizes(cluster.name_clusters(given(spark, sf)))


@query("mart_cluster_table", with_fact("SELECT iso_code, cluster_name, round(co2_per_capita, 4) AS co2_per_capita FROM clusters", "month", ALL_GIVEN))
def mart_cluster_table(spark, sf):
    return rounded(marts.cluster_table(cluster.name_clusters(given(spark, sf)).select("iso_code", "cluster_name", "co2_per_capita")))


@query("sql_cluster_summary", with_fact("""
SELECT cluster_name, count(*) AS countries, round(avg(co2_per_capita), 1) AS avg_co2_pc, round(avg(renewables_share), 1) AS avg_renewables FROM clusters GROUP BY cluster_name""", "month", ALL_GIVEN))
def sql_cluster_summary(spark, sf):
    return marts.run_sql(spark, marts.SQL_CLUSTER_SUMMARY, clusters=cluster.name_clusters(given(spark, sf)))


EPS = 0.9


DBSCAN_SQL = with_fact(f"""
SELECT p.iso_code, CAST(coalesce(l.number, -1) AS INTEGER) AS dbscan_cluster FROM points p LEFT JOIN labels l ON p.iso_code = l.iso_code""", "month", PROFILES + f""",
near AS (SELECT p.iso_code AS a, q.iso_code AS b FROM points p, points q WHERE {" + ".join(f"(p.{z} - q.{z}) * (p.{z} - q.{z})" for z in Z)} <= {EPS} * {EPS}),
core AS (SELECT a FROM near GROUP BY a HAVING count(*) >= 5),
link AS (SELECT a, b FROM near WHERE a IN (SELECT a FROM core) AND b IN (SELECT a FROM core)),
reach AS (SELECT * FROM (WITH RECURSIVE r(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, link.b FROM r JOIN link ON r.b = link.a) SELECT a, min(b) AS root FROM r GROUP BY a)),
numbered AS (SELECT a, dense_rank() OVER (ORDER BY root) - 1 AS number FROM reach),
labels AS (SELECT a AS iso_code, number FROM numbered UNION ALL
  SELECT near.a, min(number) FROM near JOIN numbered ON near.b = numbered.a WHERE near.a NOT IN (SELECT a FROM core) GROUP BY near.a)""")


@query("cluster_dbscan", DBSCAN_SQL)
def cluster_dbscan(spark, sf):
    return density.dbscan(points(spark, sf), Z, EPS)


@query("cluster_dbscan_grid", DBSCAN_SQL)
def cluster_dbscan_grid(spark, sf):
    """The way of large tables, by cells and boxes."""
    return density.dbscan_on_grid(points(spark, sf), Z, EPS)


def _kmeans_sql(k=3, restarts=10, seed=42, steps=60) -> str:
    """Draws and steps of all runs over ``points``; ends in ``kmeans`` (iso_code, cluster_id, d2) and ``costs`` (run, cost)."""
    zs = ", ".join(Z)
    squares = " + ".join(f"(p.{z} - c.{z}) * (p.{z} - c.{z})" for z in Z)
    wait = lambda j: f"-ln({forests._fraction(f"'{seed}:' || run || ':{j}:' || iso_code")} + {2.0**-33!r}::DOUBLE)"
    parts = [f"""c0 AS MATERIALIZED (SELECT run, 0 AS cluster, {zs} FROM points, range({restarts}) r(run) QUALIFY row_number() OVER (PARTITION BY run ORDER BY {wait(0)}, iso_code) = 1)"""]
    for j in range(1, k):
        parts.append(f"""d{j} AS (SELECT c.run, p.iso_code, {", ".join("p." + z for z in Z)}, min({squares}) AS d2 FROM points p, c{j - 1} c GROUP BY ALL),
c{j} AS MATERIALIZED (SELECT * FROM c{j - 1} UNION ALL (SELECT run, {j}, {zs} FROM d{j}
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY d2 <= 0, {wait(j)} / CASE WHEN d2 > 0 THEN d2 ELSE 1 END, iso_code) = 1))""")
    near = lambda c: f"""SELECT c.run, c.cluster, p.iso_code, {", ".join("p." + z for z in Z)}, {squares} AS d2 FROM points p, {c} c
  QUALIFY row_number() OVER (PARTITION BY c.run, p.iso_code ORDER BY {squares}, c.cluster) = 1"""  # noqa: E731
    for i in range(steps):
        before = f"c{k - 1}" if i == 0 else f"k{i - 1}"
        parts.append(f"""n{i} AS MATERIALIZED ({near(before)}),
k{i} AS MATERIALIZED (SELECT c.run, c.cluster, {", ".join(f"coalesce(avg(n.{z}), any_value(c.{z})) AS {z}" for z in Z)} FROM {before} c LEFT JOIN n{i} n ON n.run = c.run AND n.cluster = c.cluster GROUP BY c.run, c.cluster)""")
    parts.append(f"""final AS MATERIALIZED ({near(f"k{steps - 1}")}), costs AS (SELECT run, sum(d2) AS cost FROM final GROUP BY run),
kmeans AS (SELECT iso_code, CAST(cluster AS INTEGER) AS cluster_id, {zs}, d2 FROM final WHERE run = (SELECT run FROM costs ORDER BY cost::FLOAT, run LIMIT 1))""")
    return ",\n".join(parts)


@query("cluster_kmeans", with_fact(f"SELECT iso_code, cluster_id, {', '.join(f'round({z}, 4) AS {z}' for z in Z)}, round(sqrt(d2), 4) AS to_centroid FROM kmeans", "month", f"{PROFILES}, {_kmeans_sql()}"))
def cluster_kmeans(spark, sf):
    """Every point, its cluster, and how far its centroid is."""
    labelled = store(cluster.kmeans(points(spark, sf), Z), "kmeans")
    centre = labelled.groupBy("cluster_id").agg(*[F.avg(z).alias(f"c_{z}") for z in Z])
    rows = labelled.join(F.broadcast(centre), "cluster_id")  # a row for each of k clusters
    own = sum((F.col(z) - F.col(f"c_{z}")) * (F.col(z) - F.col(f"c_{z}")) for z in Z)
    return rounded(rows.select("iso_code", "cluster_id", *Z, F.sqrt(own).alias("to_centroid")))


@query("cluster_kmeans_runs", with_fact("SELECT CAST(run AS INTEGER) AS run, round(cost, 4) AS cost, 0.0::DOUBLE AS rise FROM costs", "month", f"{PROFILES}, {_kmeans_sql()}"))
def cluster_kmeans_runs(spark, sf):
    """Every restart's cost, and by how much a step ever raised it."""
    _, costs = cluster.kmeans_runs(points(spark, sf), Z)
    rise = lambda c: max([0.0, *[b - a for a, b in zip(c, c[1:])]])
    return rounded(spark.createDataFrame([(i, float(c[-1]), float(rise(c))) for i, c in enumerate(costs)], "run int, cost double, rise double"))


def _sweep_sql() -> str:
    """DBSCAN and its silhouette without noise for every eps of the sweep."""
    squares = " + ".join(f"(p.{z} - q.{z}) * (p.{z} - q.{z})" for z in Z)
    parts = [f"pair AS (SELECT p.iso_code AS a, q.iso_code AS b, {squares} AS d2 FROM points p, points q)"]
    for k, eps in enumerate(config.DBSCAN_EPS):
        parts.append(f"""near{k} AS (SELECT a, b FROM pair WHERE d2 <= {eps} * {eps}),
core{k} AS (SELECT a FROM near{k} GROUP BY a HAVING count(*) >= 5),
link{k} AS (SELECT a, b FROM near{k} WHERE a IN (SELECT a FROM core{k}) AND b IN (SELECT a FROM core{k})),
reach{k} AS (SELECT * FROM (WITH RECURSIVE r(a, b) AS (SELECT a, b FROM link{k} UNION SELECT r.a, l.b FROM r JOIN link{k} l ON r.b = l.a) SELECT a, min(b) AS root FROM r GROUP BY a)),
number{k} AS (SELECT a, dense_rank() OVER (ORDER BY root) - 1 AS c FROM reach{k}),
label{k} AS (SELECT a, c FROM number{k} UNION ALL SELECT n.a, min(m.c) FROM near{k} n JOIN number{k} m ON n.b = m.a WHERE n.a NOT IN (SELECT a FROM core{k}) GROUP BY n.a),
mean{k} AS (SELECT pair.a, x.c AS own, y.c AS other, sum(sqrt(d2)) AS total, count(*) AS n FROM pair JOIN label{k} x ON pair.a = x.a JOIN label{k} y ON pair.b = y.a GROUP BY ALL),
sil{k} AS (SELECT a, own, max(CASE WHEN own = other THEN CASE WHEN n > 1 THEN total / (n - 1) END END) AS inner_mean, min(total / n) FILTER (WHERE own <> other) AS outer_mean FROM mean{k} GROUP BY a, own),
score{k} AS (SELECT avg(CASE WHEN inner_mean IS NULL THEN 0 WHEN greatest(inner_mean, outer_mean) > 0 THEN (outer_mean - inner_mean) / greatest(inner_mean, outer_mean) ELSE 0 END) AS s, count(DISTINCT own) AS k, count(*) AS n FROM sil{k})""")
    rows = " UNION ALL ".join(f"SELECT {eps}::DOUBLE AS eps, '{eps}' AS name, s, k FROM score{k} WHERE k >= 2 AND n > 10" for k, eps in enumerate(config.DBSCAN_EPS))
    return ",\n".join(parts) + f", best AS (SELECT * FROM ({rows}) ORDER BY s DESC, eps LIMIT 1)"


KMEANS_SILHOUETTE = f"""gaps AS (SELECT p.iso_code, p.cluster_id AS own, q.cluster_id AS other,
  sum({_distance("p", "q")}) AS total, count(*) AS n FROM kmeans p, kmeans q GROUP BY ALL),
widths AS (SELECT iso_code, max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a, min(CASE WHEN own <> other THEN total / n END) AS b FROM gaps GROUP BY iso_code),
separation AS (SELECT avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END) AS km FROM widths)"""


@query("cluster_comparison", with_fact("""
SELECT 'DBSCAN (dbscan' || coalesce('_eps' || name, '') || ')' AS algorithm, round(coalesce(s, -1), 4) AS silhouette_score, CAST(coalesce(k, 0) AS INTEGER) AS n_clusters FROM (SELECT 1) LEFT JOIN best ON true
UNION ALL SELECT 'K-Means (k=3)', round(km, 4), 3 FROM separation""", "month", f"{PROFILES}, {_sweep_sql()}, {_kmeans_sql()}, {KMEANS_SILHOUETTE}"))
def cluster_comparison(spark, sf):
    """Both algorithms with their silhouettes; DBSCAN has none if no eps gives two clusters."""
    rows = cluster.cluster_entities(stored_fact(spark, sf, "month"))[1]
    return rows.select("algorithm", F.round("silhouette_score", 4).alias("silhouette_score"), "n_clusters")


FOREST = forests.isolation_forest()


@query("anomaly_isolation_forest", with_fact("SELECT iso_code, year, round(anomaly_score, 6) AS anomaly_score, is_anomaly FROM scored", "month", FOREST))
def anomaly_isolation_forest(spark, sf):
    """Every row's score and flag; the SQL grows the same 200 trees."""
    return rounded(forest.isolation_forest(stored_fact(spark, sf, "month")).select("iso_code", "year", "anomaly_score", "is_anomaly"), 6)


@query("mart_anomalies", with_fact("SELECT count(*) AS count FROM scored WHERE is_anomaly = 1", "month", FOREST))
def mart_anomalies(spark, sf):
    flagged = forest.isolation_forest(stored_fact(spark, sf, "month"))
    return marts.anomaly_count(flagged.filter("is_anomaly = 1"))


@query("mart_anomaly_rows", with_fact("""
SELECT iso_code, year, round(co2_per_capita, 4) AS co2_per_capita, round(anomaly_score, 6) AS anomaly_score, count(*) OVER () AS count FROM scored WHERE is_anomaly = 1""", "month", FOREST))
def mart_anomaly_rows(spark, sf):
    """The flagged rows, and their count next to each."""
    found = store(forest.isolation_forest(stored_fact(spark, sf, "month")).filter("is_anomaly = 1"), "anomalies")
    rows = found.select("iso_code", "year", F.round("co2_per_capita", 4).alias("co2_per_capita"), F.round("anomaly_score", 6).alias("anomaly_score"))
    return rows.withColumn("count", marts.anomaly_count(found).scalar())


@query("risk_model_scores", with_scores("SELECT iso_code, year, round(risk_score_heuristic, 4) AS risk_score_heuristic, 0.0::DOUBLE AS off_blend, 0.0::DOUBLE AS outside FROM scored", "month"))
def risk_model_scores(spark, sf):
    """Every row's heuristic score, and how far its score is from 0.6 model + 0.4 heuristic and from 0 to 100."""
    rows, _, _, _ = risk_model.score_all(stored_fact(spark, sf, "month"))
    blend = F.round(0.6 * F.col("risk_score_ml") + 0.4 * F.col("risk_score_heuristic"), 1)
    outside = F.greatest(-F.col("risk_score_ml"), F.col("risk_score_ml") - 100, F.lit(0.0))
    return rounded(rows.select("iso_code", "year", "risk_score_heuristic", F.abs(F.col("risk_score") - blend).alias("off_blend"), outside.alias("outside")))


KNOWN_ROWS = " AND ".join(f"{c} IS NOT NULL" for c in [*config.RISK_FEATURES, config.RISK_TARGET])


LEAST_R2 = 1e-9  # what the mean alone reaches is 0, but for the last bits


@query("risk_model_fit", with_fact(f"""
SELECT 200 AS trees, 5 AS depth, 0.1::DOUBLE AS rate, '{",".join(config.RISK_FEATURES)}' AS features, CAST(count(*) AS INTEGER) AS train_rows, count(*) > 0 AS better_than_mean
FROM fact WHERE {KNOWN_ROWS}""", "month"))
def risk_model_fit(spark, sf):
    fit = risk_model.train(stored_fact(spark, sf, "month"))[1]
    return fit.select("trees", "depth", F.col("rate").cast("double").alias("rate"), "features", F.col("train_rows").cast("int").alias("train_rows"), F.col("train_r2").between(LEAST_R2, 1.0).alias("better_than_mean"))


FEW, SHALLOW = 3, 3  # trees and depth where SQL grows the trees too
BOOSTED = forests.boosted_trees(FEW, SHALLOW)


def _small_model(spark, sf):
    f = stored_fact(spark, sf, "month")
    model, metrics, features = risk_model.train(f, trees=FEW, depth=SHALLOW)
    return f, model, metrics, features


@query("risk_model_trees", with_fact("SELECT CAST(tree AS INTEGER) AS tree, CAST(place AS INTEGER) AS place, CAST(f AS INTEGER) AS feature, round(cut, 4) AS cut, round(value, 6) AS value, rows FROM nodes", "month", BOOSTED))
def risk_model_trees(spark, sf):
    """Every node of the first trees: its cut, or its value (minus rate times gradients over rows + 1), and its rows."""
    _, model, _, _ = _small_model(spark, sf)
    rows = []
    for t, nodes in enumerate(model.trees):
        place = {0: 1}
        for i, n in enumerate(nodes):
            if n.feature >= 0:
                place[n.left], place[n.right] = 2 * place[i], 2 * place[i] + 1
            rows.append((t, place[i], n.feature if n.feature >= 0 else None, n.cut if n.feature >= 0 else None, None if n.feature >= 0 else n.value, n.rows))
    found = spark.createDataFrame(rows, "tree int, place int, feature int, cut double, value double, rows long")
    return found.withColumns({"cut": F.round("cut", 4), "value": F.round("value", 6)})


@query("risk_model_predictions", with_fact("SELECT iso_code, year, round(prediction, 4) AS prediction FROM predicted", "month", f"{BOOSTED}, {forests.walked('fact', 'iso_code, year', FEW, SHALLOW)}"))
def risk_model_predictions(spark, sf):
    """Every row's prediction by the first trees."""
    f, model, _, _ = _small_model(spark, sf)
    return rounded(model.predict(f).select("iso_code", "year", "prediction"))


@query("agg_in_sample_r2", with_fact("SELECT round(1 - sum((y - margin) * (y - margin)) / (var_pop(y) * count(*)), 6) AS train_r2, count(*) AS train_rows FROM fitted", "month", BOOSTED))
def agg_in_sample_r2(spark, sf):
    _, _, metrics, _ = _small_model(spark, sf)
    return metrics.select(F.round("train_r2", 6).alias("train_r2"), F.col("train_rows").cast("long").alias("train_rows"))


def _model(spark, sf):
    f = stored_fact(spark, sf, "month")
    model, _, features = risk_model.train(f)
    latest = store(f.filter(F.col("year") == f.agg(F.max("year")).first()[0]), "latest")
    return latest, model, features


LATEST = "now AS (SELECT * FROM fact WHERE year = (SELECT max(year) FROM fact))"


@query("explain_shapley", with_fact("SELECT iso_code, country, 0.0::DOUBLE AS off_prediction FROM now", "month", LATEST))
def explain_shapley(spark, sf):
    """Attributions and base value add up to the model's prediction."""
    latest, model, features = _model(spark, sf)
    shap = explain.shapley_values(latest, model, features)
    told = model.predict(latest).select("iso_code", "prediction")
    total = sum((F.col(f"shap_{f}") for f in features), F.col("base_value"))
    return rounded(shap.join(told, "iso_code").select("iso_code", "country", F.abs(total - F.col("prediction")).alias("off_prediction")), 3)


SHAP = f"{LATEST}, {BOOSTED}, {forests.coalitions('now', SHALLOW)}"
NAMES = "[" + ", ".join(f"'{f}'" for f in config.RISK_FEATURES) + "]"


def _small_shap(spark, sf):
    f, model, _, features = _small_model(spark, sf)
    latest = f.filter(F.col("year") == f.agg(F.max("year")).first()[0])
    return store(explain.shapley_values(latest, model, features), "shap"), features


@query("explain_shapley_values", with_fact(f"SELECT iso_code, {NAMES}[f + 1] AS feature, round(phi, 4) AS attribution FROM shap", "month", SHAP))
def explain_shapley_values(spark, sf):
    """Every attribution of a small model; the SQL sums over all coalitions."""
    shap, features = _small_shap(spark, sf)
    long = shap.select("iso_code", *[F.col(f"shap_{f}").alias(f) for f in features]).unpivot("iso_code", features, "feature", "attribution")
    return rounded(long)


@query("explain_importance", with_fact(f"SELECT {NAMES}[f + 1] AS feature, round(avg(abs(phi)), 4) AS importance FROM shap GROUP BY f", "month", SHAP))
def explain_importance(spark, sf):
    """Over the attributions of a small model."""
    shap, features = _small_shap(spark, sf)
    return rounded(explain.feature_importance(shap, features))


@query("mart_attributions", with_fact(f"SELECT iso_code, {NAMES}[f + 1] AS feature, round(phi, 4) AS value FROM shap WHERE iso_code = (SELECT min(iso_code) FROM now)", "month", SHAP))
def mart_attributions(spark, sf):
    """One entity's attributions."""
    shap, _ = _small_shap(spark, sf)
    code = shap.agg(F.min("iso_code")).first()[0]
    return marts.attributions_of(shap, code.lower()).select("iso_code", "feature", "value")


def _rules_sql() -> str:
    clean = ", ".join(f"coalesce(CASE WHEN isinf({f}) THEN NULL ELSE {f} END, 0) AS {f}" for f in config.RISK_FEATURES)
    cuts = ", ".join(f"quantile_cont({f}, 0.25) AS q1_{f}, quantile_cont({f}, 0.5) AS q2_{f}, quantile_cont({f}, 0.75) AS q3_{f}" for f in config.RISK_FEATURES)
    rules = " UNION ALL ".join(f"""SELECT iso_code, country, {i} AS f, CASE WHEN {f} <= q1_{f} THEN printf('{f} <= %.2f', q1_{f}) WHEN {f} <= q2_{f} THEN printf('%.2f < {f} <= %.2f', q1_{f}, q2_{f})
 WHEN {f} <= q3_{f} THEN printf('%.2f < {f} <= %.2f', q2_{f}, q3_{f}) ELSE printf('{f} > %.2f', q3_{f}) END AS feature_rule FROM top, cuts""" for i, f in enumerate(config.RISK_FEATURES))
    return f"""clean AS (SELECT iso_code, country, vulnerability_score, {clean} FROM now), cuts AS (SELECT {cuts} FROM clean),
top AS (SELECT * FROM clean ORDER BY vulnerability_score DESC NULLS LAST, iso_code LIMIT 15), rules AS ({rules})"""


SAMPLES = 300  # draws around each row; the SQL makes the same


@query("explain_local_rules", with_fact("SELECT iso_code, country, feature_rule, round(weight, 4) + 0 AS lime_weight FROM rules JOIN weights USING (iso_code, f)", "month",
                                        f"{LATEST}, {BOOSTED}, {_rules_sql()}, {forests.local_weights(FEW, SHALLOW, SAMPLES)}"))
def explain_local_rules(spark, sf):
    """Rules and their weights around the most vulnerable entities, by a small model."""
    f, model, _, features = _small_model(spark, sf)
    latest = store(f.filter(F.col("year") == f.agg(F.max("year")).first()[0]), "latest")
    rules = rounded(explain.local_rules_for_top(latest, model, features, samples=SAMPLES))
    return rules.withColumn("lime_weight", F.col("lime_weight") + 0.0)  # no negative zero


# Pooled models on lags: the rows, the state each series starts from, and both models in SQL.
LAGGED = f"""enough AS (SELECT iso_code, year, co2 AS y FROM wide WHERE co2 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY iso_code) >= 15),
scaled AS (SELECT *, avg(y) OVER (PARTITION BY iso_code) AS mean, stddev_pop(y) OVER (PARTITION BY iso_code) AS std FROM enough),
zs AS (SELECT iso_code, year, mean, std, (y - mean) / std AS z FROM scaled WHERE std > 0),
lagged AS MATERIALIZED (SELECT * FROM (SELECT *, {", ".join(f"lag(z, {i}) OVER w AS lag_{i}" for i in range(1, 6))} FROM zs WINDOW w AS (PARTITION BY iso_code ORDER BY year)) WHERE lag_5 IS NOT NULL),
starts AS (SELECT iso_code, max(year) AS last, any_value(mean) AS mean, any_value(std) AS std, max_by([z, lag_1, lag_2, lag_3, lag_4], year) AS path FROM lagged GROUP BY iso_code)"""
POOLED_TREES = forests.boosted_over("SELECT row_number() OVER () AS id, iso_code, std, lag_1 AS x0, lag_2 AS x1, lag_3 AS x2, lag_4 AS x3, lag_5 AS x4, z AS y FROM lagged", 5, FEW, SHALLOW) + ",\n" + \
    forests.fed_back("SELECT iso_code, path FROM starts", FEW, SHALLOW, config.HORIZON, 5) + f""",
spreads AS (SELECT iso_code, stddev_pop((t.y - margin) * std) AS resid FROM train t JOIN fitted USING (id) GROUP BY iso_code),
lstm AS (SELECT iso_code, CAST(last + h AS INTEGER) AS year, greatest(v, 0) AS lstm_co2, greatest(greatest(v, 0) - 1.645 * resid, 0) AS lstm_lower, greatest(v, 0) + 1.645 * resid AS lstm_upper FROM (
  SELECT iso_code, last, h, path[{config.HORIZON} - h + 1] * std + mean AS v FROM fed JOIN (SELECT iso_code, last, mean, std FROM starts) USING (iso_code), range(1, {config.HORIZON + 1}) t(h)) JOIN spreads USING (iso_code))"""
_ONES = "[1.0::DOUBLE, lag_1, lag_2, lag_3, lag_4, lag_5, z]"
POOLED_LINEAR = forests.solved(f"SELECT r, c, sum({_ONES}[r + 1] * {_ONES}[c + 1]) + CASE WHEN r = c AND r > 0 THEN 1e-3::DOUBLE ELSE 0 END AS v FROM lagged, range(6) a(r), range(7) b(c) GROUP BY r, c", 6, "beta") + f""",
betas AS (SELECT list(v ORDER BY r) AS beta FROM beta),
ahead0 AS (SELECT iso_code, last, mean, std, path, beta FROM starts, betas),
""" + ",\n".join(f"ahead{h + 1} AS (SELECT iso_code, last, mean, std, beta, list_concat([{' + '.join(f'path[{i}] * beta[{i + 1}]' for i in range(1, 6))} + beta[1]], path) AS path FROM ahead{h})" for h in range(config.HORIZON)) + f""",
np AS (SELECT iso_code, CAST(last + h AS INTEGER) AS year, greatest(v, 0) AS np_co2, greatest(v * 0.95::DOUBLE, 0) AS np_lower, greatest(v * 1.05::DOUBLE, 0) AS np_upper FROM (
  SELECT iso_code, last, h, path[{config.HORIZON} - h + 1] * std + mean AS v FROM ahead{config.HORIZON}, range(1, {config.HORIZON + 1}) t(h)))"""


@query("forecast_pooled_trees", with_sources(f"SELECT iso_code, year, {r4('lstm_co2', 'lstm_lower', 'lstm_upper')} FROM lstm", "month", f"{LAGGED}, {POOLED_TREES}"))
def forecast_pooled_trees(spark, sf):
    """Values and bands by a few trees; the SQL grows the same."""
    return rounded(forecast.pooled_tree_forecast(wide(spark, sf, "month"), trees=FEW, depth=SHALLOW))


@query("forecast_pooled_linear", with_sources(f"SELECT iso_code, year, {r4('np_co2', 'np_lower', 'np_upper')} FROM np", "month", f"{LAGGED}, {POOLED_LINEAR}"))
def forecast_pooled_linear(spark, sf):
    return rounded(forecast.pooled_linear_forecast(wide(spark, sf, "month")))


@query("forecast_changepoints", with_sources(f"""
SELECT iso_code, CAST(last + h AS INTEGER) AS year, round(greatest(a + b * (last + h), 0), 4) AS prophet_co2, round(greatest(a + b * (last + h) - half, 0), 4) AS prophet_lower,
  round(greatest(a + b * (last + h) + half, 0), 4) AS prophet_upper FROM (
  SELECT iso_code, max(year) AS last, regr_intercept(co2, year) AS a, regr_slope(co2, year) AS b, 1.645 * sqrt(greatest(regr_syy(co2, year) - regr_sxy(co2, year) * regr_slope(co2, year), 0) / count(*)) AS half
  FROM wide WHERE co2 IS NOT NULL GROUP BY iso_code HAVING count(*) >= 10 AND max(year) > min(year)), range(1, 11) t(h)""", "month"))
def forecast_changepoints(spark, sf):
    """The trend where no place for a change of slope is given, which is a straight line; tests compare changes of
    slope with all choices of them, for which there is no SQL."""
    return rounded(changepoint_forecast(wide(spark, sf, "month"), knots=0))


PARTS = ["prophet", "lstm", "arima", "np"]
_WEIGHED = lambda part: " + ".join(f"coalesce({m}_{part} * {config.ENSEMBLE_WEIGHTS[m]}, 0)" for m in PARTS)
_WEIGHT = " + ".join(f"CASE WHEN {m}_co2 IS NOT NULL THEN {config.ENSEMBLE_WEIGHTS[m]} ELSE 0 END" for m in PARTS)
_LABEL = ", ".join(f"CASE WHEN {m}_co2 IS NOT NULL THEN '{config.MODEL_LABELS[m]}' END" for m in PARTS)


@query("forecast_all_models", with_fact(f"""
SELECT iso_code, year, {r4(*[f"{m}_co2" for m in PARTS])}, round(greatest(({_WEIGHED("co2")}) / ({_WEIGHT}), 0), 4) AS forecast_co2,
  round(greatest(({_WEIGHED("lower")}) / ({_WEIGHT}), 0), 4) AS forecast_co2_lower, round(({_WEIGHED("upper")}) / ({_WEIGHT}), 4) AS forecast_co2_upper,
  round(tmp_co2, 4) AS forecast_temp_anomaly, last_historical_year, concat_ws('+', {_LABEL}) AS model_used
FROM prophet FULL JOIN arima USING (iso_code, year) FULL JOIN lstm USING (iso_code, year) FULL JOIN np USING (iso_code, year) LEFT JOIN tmp USING (year)
LEFT JOIN (SELECT iso_code, max(year) AS last_historical_year FROM wide GROUP BY iso_code) USING (iso_code)""", "month", f"{CLOSED}, {TEMP}, {LAGGED}, {POOLED_TREES}, {POOLED_LINEAR}"))
def forecast_all_models(spark, sf):
    """The four members with the trend's closed form, and what they give together."""
    out = forecast.forecasts(stored_fact(spark, sf, "month"), trees=FEW, depth=SHALLOW, one_knot=True)
    return rounded(out.select("iso_code", "year", *[f"{m}_co2" for m in PARTS], "forecast_co2", "forecast_co2_lower", "forecast_co2_upper", "forecast_temp_anomaly", "last_historical_year", "model_used"))
