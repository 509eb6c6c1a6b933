"""Queries of boosted trees: fits, folds, importances, contributions, and the same trees grown by SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from annualis.operators import boosting as B
from annualis.operators import modelling as M
from annualis.operators import scoring as P
from annualis.operators import tree_attribution as T
from annualis.operators.stats import regression_metrics
from annualis.plans import views as V
from annualis.plans.catalog import query, sql_round
from annualis.plans.q_cases import _hash_sql
from annualis.plans.q_joins import matrix
from annualis.schemas import FEATURES, TARGET
from annualis.session import scratch_path, stored
from annualis.sources import sinks


def _stored_matrix(spark, sf, folds: int | None = None):
    wide = matrix(spark, sf)
    return stored(M.with_fold(wide, ["reading_id"], folds) if folds else wide, "matrix")


@query()
def fit_yield(spark, sf):
    marked = M.split_random(_stored_matrix(spark, sf), ["reading_id"])
    model = M.fit_yield(marked.filter(~F.col("is_test")), keys=["reading_id"])
    return model.transform(marked).select("reading_id", "is_test", TARGET, "prediction")


@query()
def importances(spark, sf):
    return M.importances(spark, M.fit_yield(_stored_matrix(spark, sf), keys=["reading_id"]))


@query()
def cross_validate(spark, sf):
    return M.fold_metrics(M.cross_validate(_stored_matrix(spark, sf, 5), 5, keys=["reading_id"]))


@query()
def model_score(spark, sf):
    model = M.fit_yield(_stored_matrix(spark, sf), keys=["reading_id"])
    scored, _ = P.score(V.requests(spark, sf), V.features(spark, sf), model)
    return scored.select("event_id", "parcel_id", "predicted_yield", "irrigation_rec_mm")


@query()
def tree_attributions_top(spark, sf):
    """The five features with the largest mean contribution to the full model's predictions, by class."""
    from annualis.operators.attribution import top_features

    rows = stored(matrix(spark, sf, ("reading_id", "crop_type")), "matrix")
    model = M.fit_yield(rows, keys=["reading_id"])
    return top_features(T.mean_abs_contributions(rows, model, ["crop_type"]), 5, ["crop_type"])


@query(f"""WITH {V.MATRIX}, n AS (SELECT count(*) FILTER (WHERE {_hash_sql(42, 'reading_id')} % 1000000 >= 200000) AS a,
  count(*) FILTER (WHERE {_hash_sql(42, 'reading_id')} % 1000000 < 200000) AS b FROM matrix)
SELECT 'train_rows' AS name, CAST(a AS VARCHAR) AS value FROM n UNION ALL SELECT 'test_rows', CAST(b AS VARCHAR) FROM n
UNION ALL SELECT 'trees', '300'""")
def training_run(spark, sf):
    """Split, cross-validation on the training part, fit, test metrics and importances, logged as a run."""
    path = scratch_path(spark, "runs")
    params = B.Params.of().__dict__
    _, row = M.train_run(_stored_matrix(spark, sf), ["reading_id"], params=params)
    sinks.log_run(row, path, "trees-1", params)
    logged = spark.read.parquet(path)
    return logged.filter(F.col("name").isin("train_rows", "test_rows", "trees")).select("name", "value")


@query(f"""WITH {V.PARCELS}, {V.REQUESTS} SELECT 'batch' AS job, count(*) AS n, 0 AS different FROM requests WHERE crop_type <> 'banana'
UNION ALL SELECT 'stream', count(*), 0 FROM requests WHERE crop_type <> 'banana'""")
def saved_model_scores(spark, sf):
    """A model is fitted, saved, logged by its path and loaded by a batch and a stream job; both score every request as the fitted one does."""
    from annualis.operators import saved
    from annualis.plans.q_rates import _event_stream
    from annualis.streaming.jobs import stream_score

    runs, path, log = (scratch_path(spark, name) for name in ("runs", "model", "stream-log"))
    model, row = M.train_run(_stored_matrix(spark, sf), ["reading_id"])
    saved.log_trained(model, row, runs, "trees-1", path, B.Params.of().__dict__)
    loaded = saved.load_model(spark, spark.read.parquet(runs))
    features = stored(V.features(spark, sf), "features")
    direct = P.score(V.requests(spark, sf), features, model)[0].select("event_id", F.col("predicted_yield").alias("fitted"))
    stream_score(V.requests(spark, sf, _event_stream(spark, sf)), features, loaded, log, f"{log}-state", "trees", 0.9)
    jobs = {"batch": P.score(V.requests(spark, sf), features, loaded)[0], "stream": spark.read.parquet(log)}
    out = None
    for job, scored in jobs.items():
        both = scored.select("event_id", "predicted_yield").join(direct, "event_id", "full")
        one = both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("fitted").eqNullSafe(F.col("predicted_yield"))).cast("int").alias("different")).select(F.lit(job).alias("job"), "n", "different")
        out = one if out is None else out.unionAll(one)
    return out


# --- trees that SQL grows too ---------------------------------------------------------

_INPUTS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
_WHOLE = {"trees": 1, "row_sample": 1.0, "column_sample": 1.0}  # SQL knows no draws
_NAMES = " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(_INPUTS))


def _lines(spark, sf):
    lines = V.table(spark, sf, "lineitem")
    return stored(lines.select("l_orderkey", "l_returnflag", *_INPUTS, (F.col("l_extendedprice") / 1000).alias("y")), "lines")


_LINES = f"""lines AS (SELECT row_number() OVER () AS id, l_orderkey, l_returnflag, {', '.join(f'CAST({c} AS DOUBLE) AS x{k}' for k, c in enumerate(_INPUTS))},
  l_extendedprice / 1000 AS y FROM lineitem)"""


def _strength(g: str) -> str:
    return f"({g} - greatest(-0.1e0, least(0.1e0, {g})))"


def _score(g: str, n: str) -> str:
    return f"({_strength(g)} * {_strength(g)} / ({n} + 1e0))"


def _weight(g: str, n: str) -> str:
    return f"(-{_strength(g)} / ({n} + 1e0) * 0.05e0)"


def _pick(f: str) -> str:
    return f"(CASE {f} {' '.join(f'WHEN {k} THEN x{k}' for k in range(len(_INPUTS)))} END)"


def _tree_sql(source: str, depth: int) -> str:
    """CTEs of a tree for each model m of the rows of ``source``: a0, a1... are the rows at their nodes, s0, s1... the splits of a level."""
    out = [f"b AS (SELECT m, {sql_round('avg(y)', 6)} AS base FROM {source} GROUP BY m)",
           f"a0 AS (SELECT r.*, base - y AS g, 0 AS node FROM {source} r JOIN b USING (m))"]
    for d in range(depth):
        long = " UNION ALL ".join(f"SELECT m, node, {k} AS f, x{k} AS x, g FROM a{d}" for k in range(len(_INPUTS)))
        out.append(f"""c{d} AS (SELECT m, node, f, x, sum(sum(g)) OVER w AS gl, CAST(sum(count(*)) OVER w AS DOUBLE) AS nl, sum(sum(g)) OVER p AS ga,
  CAST(sum(count(*)) OVER p AS DOUBLE) AS na FROM ({long}) GROUP BY m, node, f, x WINDOW w AS (PARTITION BY m, node, f ORDER BY x), p AS (PARTITION BY m, node, f))""")
        out.append(f"""s{d} AS (SELECT * FROM (SELECT *, {_score('gl', 'nl')} + {_score('(ga - gl)', '(na - nl)')} - {_score('ga', 'na')} AS gain
  FROM c{d} WHERE nl >= 3 AND na - nl >= 3) WHERE gain > 1e-6 QUALIFY row_number() OVER (PARTITION BY m, node ORDER BY round(gain, 9) DESC, f, x) = 1)""")
        out.append(f"""a{d + 1} AS (SELECT a.* EXCLUDE (node), 2 * node + CASE WHEN {_pick('f')} <= s.x THEN 1 ELSE 2 END AS node
  FROM a{d} a JOIN s{d} s USING (m, node))""")
    return ", ".join(out)


def _nodes_sql(depth: int) -> str:
    level = lambda d: (f"SELECT node, f, x, coalesce(gain, 0e0) AS gain, n, w FROM (SELECT node, count(*) AS n, {_weight('sum(g)', 'count(*)')} AS w "  # noqa: E731
                       f"FROM a{d} GROUP BY node) " + (f"LEFT JOIN s{d} USING (node)" if d < depth else "CROSS JOIN (SELECT NULL AS f, NULL AS x, NULL AS gain)"))
    return " UNION ALL ".join(level(d) for d in range(depth + 1))


_WHOLE_LINES = f"{_LINES}, whole AS (SELECT *, 0 AS m FROM lines)"


@query(f"""WITH {_WHOLE_LINES}, {_tree_sql('whole', 3)}, nodes AS ({_nodes_sql(3)})
SELECT CAST(node AS INTEGER) AS node, CASE f {_NAMES} END AS feature, CAST(x AS DOUBLE) AS cut, {sql_round('gain', 3)} AS gain, n AS n_rows, {sql_round('w', 8)} AS weight
FROM nodes""")
def fitted_trees(spark, sf):
    """Splits, gains and leaf weights of a tree that is grown from one aggregation a level over the blocks of rows."""
    model = B.fit_together(_lines(spark, sf), _INPUTS, "y", ["l_orderkey"], {"all": F.lit(True)}, {**_WHOLE, "depth": 3}, one_task=0)["all"]
    return V.round_features(model.table(spark).drop("model", "tree"), {"gain": 3, "weight": 8})


@query(f"""WITH {_LINES}, folds AS (SELECT l.*, m FROM lines l JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS m) ON l_orderkey % 5 + 1 <> m), {_tree_sql('folds', 1)},
p AS (SELECT m AS fold, y, base + CASE WHEN {_pick('f')} <= s.x THEN {_weight('gl', 'nl')} ELSE {_weight('(ga - gl)', '(na - nl)')} END AS yhat
  FROM lines JOIN b ON m = l_orderkey % 5 + 1 JOIN s0 s USING (m))
SELECT CAST(fold AS BIGINT) AS fold, {sql_round('sqrt(avg((y - yhat) * (y - yhat)))', 6)} AS rmse, {sql_round('avg(abs(y - yhat))', 6)} AS mae,
  {sql_round('(1e0 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)))', 6)} AS r2, count(*) AS n FROM p GROUP BY fold""")
def cross_validated_rows(spark, sf):
    """Fold metrics of out-of-fold predictions, by models of the other folds that grow together."""
    rows = _lines(spark, sf).withColumn("fold", F.col("l_orderkey") % 5 + 1)
    parts = {str(k): F.col("fold") != k for k in range(1, 6)}
    models = B.fit_together(rows, _INPUTS, "y", ["l_orderkey"], parts, {**_WHOLE, "depth": 1}, one_task=0)
    out = B.predict_by(rows, {k: models[str(k)] for k in range(1, 6)}, "fold")
    metrics = regression_metrics(out, "y", "prediction", ["fold"]).select("fold", "rmse", "mae", "r2", "n")
    return V.round_features(metrics, {"rmse": 6, "mae": 6, "r2": 6})


@query(f"""WITH {_WHOLE_LINES}, {_tree_sql('whole', 3)}, gains AS (
  SELECT f, avg(gain) AS g, count(*) AS n FROM (SELECT f, gain FROM s0 UNION ALL SELECT f, gain FROM s1 UNION ALL SELECT f, gain FROM s2) GROUP BY f),
names AS (SELECT unnest([{', '.join(map(str, range(len(_INPUTS))))}]) AS f)
SELECT CASE names.f {_NAMES} END AS feature, {sql_round('coalesce(g / (SELECT sum(g) FROM gains), 0e0)', 6)} AS importance, coalesce(n, 0) AS splits
FROM names LEFT JOIN gains USING (f)""")
def split_gains(spark, sf):
    """Importances by gain, from the splits of a fitted model."""
    model = B.fit(_lines(spark, sf), _INPUTS, "y", ["l_orderkey"], {**_WHOLE, "depth": 3})
    return V.round_features(spark.createDataFrame(model.gains()), {"importance": 6})


@query(f"""WITH {_WHOLE_LINES}, {_tree_sql('whole', 2)},
leaves AS (SELECT r.f AS f0, r.x AS c0, k.node = 1 AS left0, k.na / r.na AS z0, k.f AS f1, k.x AS c1, l AS left1, CASE WHEN l THEN k.nl ELSE k.na - k.nl END / k.na AS z1,
  CASE WHEN l THEN {_weight('k.gl', 'k.nl')} ELSE {_weight('(k.ga - k.gl)', '(k.na - k.nl)')} END AS v
  FROM s0 r CROSS JOIN s1 k CROSS JOIN (SELECT unnest([true, false]) AS l)),
met AS (SELECT id, l_returnflag, f0, f1, v, z0, z1, CASE WHEN ({_pick('f0')} <= c0) = left0 THEN 1e0 ELSE 0e0 END AS o0,
  CASE WHEN ({_pick('f1')} <= c1) = left1 THEN 1e0 ELSE 0e0 END AS o1 FROM lines CROSS JOIN leaves),
each AS (SELECT id, f0 AS f, CASE WHEN f0 = f1 THEN v * (o0 * o1 - z0 * z1) ELSE v * 0.5e0 * (o0 - z0) * (z1 + o1) END AS c FROM met
  UNION ALL SELECT id, f1, v * 0.5e0 * (o1 - z1) * (z0 + o0) FROM met WHERE f0 <> f1),
total AS (SELECT id, f, sum(c) AS c FROM each GROUP BY id, f),
pairs AS (SELECT id, l_returnflag, f FROM lines CROSS JOIN (SELECT unnest([{', '.join(map(str, range(len(_INPUTS))))}]) AS f))
SELECT l_returnflag, CASE f {_NAMES} END AS feature, {sql_round('avg(abs(coalesce(c, 0e0)))', 8)} AS mean_abs, {sql_round('avg(coalesce(c, 0e0))', 8)} AS mean
FROM pairs LEFT JOIN total USING (id, f) GROUP BY 1, 2""")
def tree_contributions(spark, sf):
    """Mean contributions of the inputs to a tree's predictions, against the sums over all orders in which inputs may become known."""
    rows = _lines(spark, sf)
    model = B.fit(rows, _INPUTS, "y", ["l_orderkey"], {**_WHOLE, "depth": 2})
    long = T.tree_attributions(rows, ["l_returnflag"], model)
    means = long.groupBy("l_returnflag", "feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"), F.avg("contribution").alias("mean"))
    return V.round_features(means, {"mean_abs": 8, "mean": 8})


@query(f"WITH {_WHOLE_LINES}, {_tree_sql('whole', 3)} SELECT l_returnflag, count(*) AS n, {sql_round('sum(base + p)', 4)} AS predicted, {sql_round('sum(p)', 4)} AS contributed FROM ("
       f"SELECT a3.l_returnflag, base, {_weight('sum(g) OVER (PARTITION BY node)', 'count(*) OVER (PARTITION BY node)')} AS p FROM a3 JOIN b USING (m)) GROUP BY 1")
def contributions_add_up(spark, sf):
    """The sum of predictions, and of each row's contributions with the mean prediction's distance from the base."""
    rows = _lines(spark, sf)
    model = B.fit(rows, _INPUTS, "y", ["l_orderkey"], {**_WHOLE, "depth": 3})
    out = T.with_contributions(model.transform(rows), model)
    own = F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x) + F.lit(T.expected_value(model) - model.base)
    sums = out.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("prediction").alias("predicted"), F.sum(own).alias("contributed"))
    return V.round_features(sums, {"predicted": 4, "contributed": 4})
