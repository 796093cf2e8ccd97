"""Registered model and run-log queries (R2-R7, C1-C5, G1-G11, E4, M12, X1-X5,
J6, A24, A25).

R3-R5, A25, G5, G9, G11, E4, M11, M12 and M13 run at the published settings on
all training rows; the other model queries use small settings (rank 5, <= 5
iterations, <= 5 trees) and fit classifiers on a sample. The
results depend on fitted models, so they get the rows-only check, except those
with a closed form: linear regression on one feature (``regr_slope``), ridge (its normal
equation) and a tree of depth 1 (all splits tried out).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import materialize, scratch_path, session_conf
from ..operators import encode as en
from ..operators import evaluate as ev
from ..operators import features as fe
from ..operators import models as md
from ..operators import recsys as rs
from ..operators import runlog as rl
from ..sources.tables import load_or_fit
from ..sources.views import items_view, ratings_view, table
from .q_eval import TRAIN, TEST, split  # noqa: F401
from .queries import rd
from .registry import register

# The 27 points of the published 3 x 3 x 3 grid.
GRID = dict(ranks=(5, 10, 20), iters=(5, 10, 15), regs=(0.01, 0.1, 0.5), parallelism=4)
PAR = 4   # model fits submitted concurrently (local[8])


_SHARED: dict = {}


def shared(spark, name, sf, build):
    """A table that several queries of a session read: built and written by the first, read by the others."""
    key = (spark.sparkContext.applicationId, name, sf)
    if key not in _SHARED:
        _SHARED[key] = materialize(build(), name)
    return _SHARED[key]


def feature_rows(spark, sf):
    """Features and labels of every rating, written once per session."""
    with session_conf(spark, **fe.BY_USER):
        return shared(spark, "feature_rows", sf, lambda: md.supervised_rows(
            fe.all_features(ratings_view(spark, sf), items_view(spark, sf), encode=False, materialize_input=True, user_last=True),
            md.FEATURES_WITH_LEAKY)[0])


def supervised(spark, sf, fraction=0.1, cols=md.FEATURES):
    """(train, test, columns). ``fraction`` bounds the rows that classifiers are
    fitted on; regressors pass None. Every test row is scored."""
    rows = feature_rows(spark, sf)
    used = [c for c in cols if c in rows.columns]
    return *md.split_sides(rows, used, fraction), used


def als_points(spark, sf):
    """All points of the grid, fitted once per session: the ablation, the best point and the heat map read them."""
    def fit():
        tr, te = split(spark, sf)
        return rs.als_grid(tr, te, **GRID)
    return shared(spark, "als_grid", sf, fit)


# ------------------------------------------------------------------ ALS

@register("r2_r7_als_metrics", heavy=True)
def q_r2(spark, sf):
    tr, te = split(spark, sf)
    m = rs.fit_als(tr, rank=5, max_iter=5, reg=0.1)
    return rs.als_regression_metrics(m, te)


@register("r3_als_grid", heavy=True)
def q_r3(spark, sf):
    return als_points(spark, sf)


@register("r4_als_ablation", heavy=True)
def q_r4(spark, sf):
    return rs.als_ablation(als_points(spark, sf))


@register("a25_best_per_grid", heavy=True)
def q_a25(spark, sf):
    g = als_points(spark, sf)
    return rl.best_per(g, ["rank", "reg_param"], "rmse").join(
        rl.best_pivot(g, "rank", "max_iter", "rmse", list(GRID["iters"])), "rank")


@register("r5_als_cross_validate", heavy=True)
def q_r5(spark, sf):
    tr, te = split(spark, sf)
    best = als_points(spark, sf).orderBy("rmse", "rank", "max_iter", "reg_param").first()
    row, _ = rs.als_cross_validate(tr, te, rank=best["rank"], max_iter=best["max_iter"], reg=best["reg_param"], folds=3)
    return row


@register("r6_als_ranking_metrics", heavy=True)
def q_r6(spark, sf):
    tr, te = split(spark, sf)
    m = rs.fit_als(tr, rank=5, max_iter=5, reg=0.1)
    return rs.ranking_metrics(rs.recommend_top_k(m, 10), te, (5, 10), 3.5)


@register("r6_als_exclude_seen_ranking_metrics", heavy=True)
def q_r6_unseen(spark, sf):
    """Ranking metrics of ALS top-10 lists that exclude the user's training items."""
    tr, te = split(spark, sf)
    m = rs.fit_als(tr, rank=5, max_iter=3, reg=0.1)
    return rs.ranking_metrics(rs.recommend_top_k(m, 10, exclude_seen=tr), te, (5, 10), 3.5)


# ------------------------------------------------------------------ supervised

@register("c1_c5_compare_classifiers", heavy=True)
def q_c5(spark, sf):
    tr, te, _ = supervised(spark, sf)
    res, _ = md.compare_classifiers(tr, te, md.classifiers(fast=True), parallelism=PAR)
    return res.drop("seconds")


@register("g1_g5_compare_regressors", heavy=True)
def q_g5(spark, sf):
    tr, te, _ = supervised(spark, sf, fraction=None)
    res, _ = md.compare_regressors(tr, te, md.regressors(), parallelism=PAR)
    return res.drop("seconds")


@register("g1_linear_one_feature", f"""
select {rd('regr_slope(l_extendedprice, l_quantity)', 3)} as slope,
       {rd('regr_intercept(l_extendedprice, l_quantity)', 3)} as intercept from lineitem""")
def q_g1(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    x = en.assemble(li, ["l_quantity"])
    m = LinearRegression(featuresCol="features", labelCol="l_extendedprice", regParam=0.0, solver="normal",
                         standardization=False).fit(x)
    return spark.range(1).select(F.round(F.lit(float(m.coefficients[0])), 3).alias("slope"),
                                 F.round(F.lit(float(m.intercept)), 3).alias("intercept"))


@register("g7_overfit_threshold", """
select user_id, count(*) * 1000 as n_train,
       case when count(*) * 1000 < 5000 then 0.03 when count(*) * 1000 < 50000 then 0.05 else 0.10 end as threshold
from {R} r group by user_id""")
def q_g7(spark, sf):
    r = ratings_view(spark, sf).groupBy("user_id").agg((F.count(F.lit(1)) * 1000).alias("n_train"))
    return r.select("user_id", "n_train", md.overfit_threshold(F.col("n_train")).alias("threshold"))


@register("g6_diagnose_fit", """
select user_id, train_f1, test_f1,
       case when round(train_f1 - test_f1, 4) > 0.05 then 'OVERFIT' when test_f1 < 0.5 then 'UNDERFIT' else 'OK' end
         as diagnosis
from (select user_id, avg(case when rating >= 3.5 then 1.0 else 0.0 end) as train_f1,
             avg(case when rating >= 3.0 then 1.0 else 0.0 end) - 0.1 as test_f1
      from {R} r group by user_id) t""")
def q_g6(spark, sf):
    """G6 applied to a per-user results table derived from the ratings (shares
    of liked ratings at two thresholds stand in for train/test F1)."""
    r = ratings_view(spark, sf).groupBy("user_id").agg(
        F.avg(F.when(F.col("rating") >= 3.5, 1.0).otherwise(0.0)).alias("train_f1"),
        (F.avg(F.when(F.col("rating") >= 3.0, 1.0).otherwise(0.0)) - 0.1).alias("test_f1"))
    return r.select("user_id", "train_f1", "test_f1",
                    md.diagnose_classifier(F.col("train_f1"), F.col("test_f1")).alias("diagnosis"))


@register("g6_diagnose_regressor", f"""
select user_id, train_rmse, test_rmse, r2,
       case when round(test_rmse - train_rmse, 4) > 0.1 then 'OVERFIT' when r2 < 0.1 then 'UNDERFIT' else 'OK' end as diagnosis
from (select user_id, {rd('sqrt(avg((rating - 3) * (rating - 3)))', 6)} as train_rmse,
             {rd('sqrt(avg((rating - 2.5) * (rating - 2.5)))', 6)} as test_rmse,
             {rd('1 - avg((rating - 3) * (rating - 3)) / 4', 9)} as r2
      from {{R}} r group by user_id) t""")
def q_g6_reg(spark, sf):
    """G6, regression form, applied to a per-user results table derived from the ratings (the errors of two
    constant predictions stand in for train and test)."""
    e = lambda m: F.avg((F.col("rating") - m) * (F.col("rating") - m))
    r = ratings_view(spark, sf).groupBy("user_id").agg(F.round(F.sqrt(e(3.0)), 6).alias("train_rmse"), F.round(F.sqrt(e(2.5)), 6).alias("test_rmse"),
                                                       F.round(1 - e(3.0) / 4, 9).alias("r2"))
    return r.withColumn("diagnosis", md.diagnose_regressor(F.col("train_rmse"), F.col("test_rmse"), F.col("r2")))


_ONE = "cast(l_quantity as double) as x, cast(l_extendedprice as double) as y"


def _price_rows(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_quantity").cast("double").alias("x"), F.col("l_extendedprice").cast("double").alias("y"))
    return en.assemble(li, ["x"])


def _one_row(spark, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))


@register("g1_ridge_one_feature", f"""
select {rd('covar_pop(y, x) / (var_pop(x) + 1e6 / stddev_pop(y))', 4)} as slope,
       {rd('avg(y) - avg(x) * covar_pop(y, x) / (var_pop(x) + 1e6 / stddev_pop(y))', 2)} as intercept from (select {_ONE} from lineitem) t""")
def q_g1_ridge(spark, sf):
    """Ridge regression against its normal equation (MLlib's penalty counts in standard deviations of the label)."""
    m = LinearRegression(labelCol="y", regParam=1e6, elasticNetParam=0.0, solver="normal", standardization=False).fit(_price_rows(spark, sf))
    return _one_row(spark, slope=float(m.coefficients[0]), intercept=float(m.intercept)).select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"))


@register("g4_stump", f"""
with t as (select {_ONE} from lineitem), v as (select x, count(*) as n, sum(y) as s from t group by x),
c as (select x, lead(x) over (order by x) as nx, sum(n) over (order by x) as nl, sum(s) over (order by x) as sl,
             sum(n) over () as n, sum(s) over () as s from v),
best as (select * from c where nl < n order by sl * sl / nl + (s - sl) * (s - sl) / (n - nl) desc, x limit 1)
select {rd('(x + nx) / 2', 4)} as threshold, cast(nl as bigint) as n_left, {rd('sl / nl', 2)} as left_mean, {rd('(s - sl) / (n - nl)', 2)} as right_mean from best""")
def q_g4_stump(spark, sf):
    """A regression tree of depth 1 against all splits tried out."""
    x = _price_rows(spark, sf)
    m = DecisionTreeRegressor(labelCol="y", maxDepth=1, maxBins=64).fit(x)
    root = m._call_java("rootNode")
    at, left, right = root.split().threshold(), root.leftChild().prediction(), root.rightChild().prediction()
    n = x.where(F.col("x") <= at).count()
    return _one_row(spark, threshold=float(at), n_left=n, left_mean=float(left), right_mean=float(right)).select(
        F.round("threshold", 4).alias("threshold"), F.col("n_left").cast("bigint").alias("n_left"), F.round("left_mean", 2).alias("left_mean"),
        F.round("right_mean", 2).alias("right_mean"))


@register("s9_load_or_fit", f"""
select {rd('regr_slope(l_extendedprice, l_quantity)', 3)} as slope, cast(1 as bigint) as fits from lineitem""")
def q_s9(spark, sf):
    """A model fitted and saved by the first call, loaded by the second."""
    path, fits = scratch_path(spark, "model"), []

    def fit():
        fits.append(1)
        return LinearRegression(labelCol="y", regParam=0.0, solver="normal", standardization=False).fit(_price_rows(spark, sf))
    load_or_fit(LinearRegressionModel, path, fit)
    m = load_or_fit(LinearRegressionModel, path, fit)
    return _one_row(spark, slope=float(m.coefficients[0]), fits=len(fits)).select(F.round("slope", 3).alias("slope"), F.col("fits").cast("bigint").alias("fits"))


@register("p25_select_available", "select rating, ts from {R} r")
def q_p25(spark, sf):
    return en.select_available(ratings_view(spark, sf), ["rating", "no_such_column", "ts"], ["user_id", "item_id"])


@register("p25_select_fallback", "select user_id, item_id from {R} r")
def q_p25_fallback(spark, sf):
    return en.select_available(ratings_view(spark, sf), ["rating", "no_such_column"], ["user_id", "item_id"])


@register("e3_e4_feature_importance", heavy=True)
def q_e4(spark, sf):
    tr, _, used = supervised(spark, sf, fraction=None, cols=md.FEATURES_WITH_LEAKY)
    return md.feature_importance(tr, used)


@register("g8_cross_validate", heavy=True)
def q_g8(spark, sf):
    """Three-fold CV of all eight models: f1 of the classifiers, rmse of the regressors (on all training rows)."""
    # one cached table for all models of a kind, released when all are done
    tr, whole = md._cached(*(md.with_folds(supervised(spark, sf, fraction=f)[0], 3) for f in (0.1, None)))
    f1 = MulticlassClassificationEvaluator(labelCol="label_cls", metricName="f1")
    rmse = RegressionEvaluator(labelCol="rating", metricName="rmse")
    jobs = [("f1", k, m.copy().setLabelCol("label_cls"), f1, tr) for k, m in md.classifiers(fast=True).items()]
    jobs += [("rmse", k, m.copy().setLabelCol("rating"), rmse, whole) for k, m in md.regressors(fast=True).items()]
    try:
        n = {"f1": tr.count(), "rmse": whole.count()}
        with ThreadPoolExecutor(max_workers=PAR) as ex:
            rows = list(ex.map(lambda j: (j[1], j[0], n[j[0]], md.cross_validate(j[2], j[4], j[3], 3)), jobs))
    finally:
        tr.unpersist()
        whole.unpersist()
    return spark.createDataFrame(rows, "model string, metric string, n_train long, cv_value double")


@register("m9_m10_fitted_classifier_roc", heavy=True)
def q_roc_fitted(spark, sf):
    """ROC points and AUC of a fitted classifier's probability on the whole test side."""
    tr, te, _ = supervised(spark, sf)
    m = LogisticRegression(maxIter=5, regParam=0.01, labelCol="label_cls").fit(tr)
    scored = md.probability_of_positive(m.transform(te)).select("label_cls", "score")
    return ev.roc_points(scored, "label_cls", "score").crossJoin(ev.auc_roc(scored, "label_cls", "score"))


@register("m11_fitted_regressor_residuals", heavy=True)
def q_residuals_fitted(spark, sf):
    """Error of the fitted regressors (the published plot has all but the single tree) per rating value on the whole test side."""
    tr, te, _ = supervised(spark, sf, fraction=None)
    fit = {k: m.copy().setLabelCol("rating").fit(tr) for k, m in md.regressors().items()}
    e = F.col("rating") - F.col("prediction")
    parts = [m.transform(te).groupBy("rating").agg(F.count("*").alias("n"), F.avg(e).alias("mean_residual"), F.stddev_samp(e).alias("sd_residual"))
             .select(F.lit(k).alias("model"), "*") for k, m in fit.items()]
    return reduce(DataFrame.unionByName, parts)


@register("m13_metrics_summary_fitted", heavy=True)
def q_m13_fitted(spark, sf):
    """The summary of one fitted recommender and classifier: ALS_, Rec_ (the top ten of ALS) and Cls_."""
    tr, te = split(spark, sf)
    model = rs.fit_als(tr)
    at_k = rs.ranking_metrics(rs.recommend_top_k(model, 10), te, (5, 10), 3.5)
    rec = at_k.agg(*(F.first(F.when(F.col("k") == k, F.col(m)), ignorenulls=True).alias(m.replace("_k", f"_{k}"))
                     for k in (5, 10) for m in ("precision_at_k", "recall_at_k", "ndcg_at_k")))
    train, test, _ = supervised(spark, sf, fraction=None)
    scored = md.classifiers()["Logistic_Regression"].setLabelCol("label_cls").fit(train).transform(test)
    cls = ev.averaged_metrics(ev.confusion_counts(scored, "label_cls", "prediction"))
    return ev.metrics_summary([("ALS_", rs.als_regression_metrics(model, te)), ("Rec_", rec), ("Cls_", cls)])


@register("g9_learning_curve", heavy=True)
def q_g9(spark, sf):
    tr, te, _ = supervised(spark, sf, fraction=None)
    return md.learning_curve(tr, te)


@register("g10_p23_scale_study", heavy=True)
def q_g10(spark, sf):
    tr, te, _ = supervised(spark, sf, fraction=None)
    models = {"linear": LinearRegression(maxIter=5, regParam=0.1, elasticNetParam=0.3),
              "random_forest": RandomForestRegressor(numTrees=3, maxDepth=4, minInstancesPerNode=10, seed=42)}
    return md.scale_study(tr.unionByName(te), (2_000, 10_000, None), models, parallelism=PAR).drop("fit_seconds")


@register("g11_x5_unified_and_final_summary", heavy=True)
def q_g11(spark, sf):
    tr, te, _ = supervised(spark, sf, fraction=None)
    cls, _ = md.compare_classifiers(tr, te, md.classifiers(), parallelism=PAR)
    reg, _ = md.compare_regressors(tr, te, md.regressors(), parallelism=PAR)
    u = md.unified_comparison(cls, reg).drop("seconds")
    return u.crossJoin(rl.final_summary(cls, reg))


@register("m12_all_confusion_matrices", heavy=True)
def q_m12(spark, sf):
    tr, te, _ = supervised(spark, sf, fraction=None)
    return md.all_confusion_matrices(tr, te, md.classifiers(), parallelism=PAR)


# ------------------------------------------------------------------ run log

_RUNS_SQL = """
li as (select l_orderkey, max(l_shipdate) as e from lineitem group by l_orderkey),
runs as (select o_orderkey as run_uuid, o_orderpriority as experiment_id, o_orderpriority as name,
                case when o_orderstatus = 'F' then 'FINISHED' when o_orderstatus = 'O' then 'RUNNING' else 'FAILED' end
                  as status,
                cast(epoch_ms(o_orderdate) as bigint) as start_time, cast(epoch_ms(li.e) as bigint) as end_time
         from orders left join li on o_orderkey = li.l_orderkey),
experiments as (select o_orderpriority as experiment_id, o_orderpriority as name,
                       cast(epoch_ms(min(o_orderdate)) as bigint) as creation_time from orders group by 1),
metrics as (select l_orderkey as run_uuid, 'qty_' || l_returnflag as key, l_quantity as value,
                   cast(l_linenumber as bigint) as step from lineitem)"""


@register("j6_runs_with_metrics", "with " + _RUNS_SQL + """
select run_uuid, name, start_time, key, value, step from runs join metrics using (run_uuid)
where status = 'FINISHED'""")
def q_j6(spark, sf):
    _, runs, metrics = rl.runlog_from_orders(spark, sf)
    return rl.runs_with_metrics(runs, metrics)


@register("x2_metrics_wide", "with " + _RUNS_SQL + """,
j as (select run_uuid, name, start_time, key, value, step from runs join metrics using (run_uuid)
      where status = 'FINISHED')
select name, arg_min(value, (start_time, run_uuid, step, value)) filter (where key = 'qty_A') as qty_A,
             arg_min(value, (start_time, run_uuid, step, value)) filter (where key = 'qty_N') as qty_N,
             arg_min(value, (start_time, run_uuid, step, value)) filter (where key = 'qty_R') as qty_R
from j group by name""")
def q_x2(spark, sf):
    _, runs, metrics = rl.runlog_from_orders(spark, sf)
    return rl.metrics_wide(runs, metrics, ["qty_A", "qty_N", "qty_R"])


@register("x3_longest_runs", "with " + _RUNS_SQL + """
select run_uuid, runs.name, experiments.name as experiment_name, start_time, end_time,
       end_time - start_time as duration_ms
from runs join experiments using (experiment_id)
order by duration_ms desc nulls last, run_uuid limit 10""")
def q_x3(spark, sf):
    experiments, runs, _ = rl.runlog_from_orders(spark, sf)
    return rl.longest_runs(runs.where(F.col("end_time").isNotNull()), experiments, 10)


@register("x4_experiment_spans", "with " + _RUNS_SQL + """
select experiment_id, count(*) as runs, min(start_time) as first_start, max(end_time) as last_end
from runs group by experiment_id""")
def q_x4(spark, sf):
    _, runs, _ = rl.runlog_from_orders(spark, sf)
    return rl.experiment_spans(runs)


@register("a24_leaderboard", f"""
with tr as {TRAIN}, te as {TEST},
u as (select user_id, avg(rating) as m from tr group by user_id),
res as (select user_id, {rd('sqrt(avg((te.rating - u.m) * (te.rating - u.m)))', 9)} as rmse, count(*) as n
        from te join u using (user_id) group by user_id)
select user_id, rmse, n, cast(row_number() over (order by rmse, user_id) as int) as position
from (select * from res order by rmse, user_id limit 10) t""")
def q_a24(spark, sf):
    """Leaderboard of per-user mean-predictor RMSE (10 best users)."""
    tr, te = split(spark, sf)
    p = rs.predict_from_means(te, ev.group_means(tr, "user_id"), "user_id", "user_id_mean")
    e = F.col("rating") - F.col("user_id_mean")
    res = p.groupBy("user_id").agg(F.round(F.sqrt(F.avg(e * e)), 9).alias("rmse"), F.count(F.lit(1)).alias("n"))
    return rl.leaderboard(res, "rmse", 10, True, ["user_id"]).withColumn("position", F.col("position").cast("int"))


@register("x1_log_run", heavy=True)
def q_x1(spark, sf):
    """Logs a run whose metrics are the (Spark-computed) baseline RMSEs, then
    reads the run log back through J6."""
    tr, te = split(spark, sf)
    log = rl.RunLog(spark, scratch_path(spark, "runlog"))
    b = rs.baseline_rmse(tr, te).select(F.col("baseline").alias("metric"), F.col("rmse").alias("value"))
    log.log_metrics_frame("baselines", "mean_baselines", b, {"split": "md5<cd"})
    return rl.runs_with_metrics(log.table(rl.RUNS), log.table(rl.METRICS)).select("name", "key", "value")
