import itertools
import math

import pytest
from pyspark.sql import functions as F

from ratings_engine.functions.formatting import format_magnitude, scale_label
from ratings_engine.operators import evaluate as ev
from ratings_engine.operators import features as fe
from ratings_engine.operators import models as md


@pytest.mark.parametrize("rating,label", [(5.0, 1.0), (4.0, 1.0), (3.9, 0.0), (3.5, 0.0), (1.0, 0.0), (0.5, 0.0)])
def test_label_at_four(spark, rating, label):
    df = spark.createDataFrame([(rating,)], "rating double")
    assert df.select(fe.binary_label_col("rating", 4.0)).first()[0] == label


def test_label_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "rating double")
    assert [r[0] for r in df.select(fe.binary_label_col("rating", 3.5)).collect()] == [0.0, 1.0]


@pytest.mark.parametrize("n,t", [(1000, .03), (4999, .03), (5000, .05), (25000, .05), (49999, .05),
                                 (50000, .10), (200000, .10)])
def test_overfit_threshold(spark, n, t):
    df = spark.createDataFrame([(n,)], "n long")
    assert df.select(md.overfit_threshold(F.col("n"))).first()[0] == t


def _cm(spark, actual, pred):
    df = spark.createDataFrame(list(zip(actual, pred)), "label int, prediction int")
    return ev.confusion_counts(df)


def test_confusion_counts_and_prf(spark):
    cm = _cm(spark, [0, 1, 0, 1, 1], [0, 1, 1, 0, 1])
    r = ev.binary_prf(cm).first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (1, 1, 1, 2)
    assert r["precision"] == 0.6667 and r["recall"] == 0.6667 and r["f1"] == 0.6667


def test_zero_tp_gives_zero(spark):
    cm = spark.createDataFrame([(2, 2, 2, 0)], "tn long, fp long, fn long, tp long")
    r = ev.binary_prf(cm).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)


def test_averaged_metrics_invariants(spark):
    cm = _cm(spark, [0, 1, 0, 1, 1, 1, 0], [0, 1, 1, 0, 1, 1, 0])
    r = ev.averaged_metrics(cm).first()
    assert r["micro_f1"] == r["accuracy"] == r["micro_precision"]
    mp, mr = r["macro_precision"], r["macro_recall"]
    assert math.isclose(r["macro_f1"], 2 * mp * mr / (mp + mr))
    assert math.isclose(r["weighted_recall"], r["accuracy"])


def test_auc_matches_pairwise_bruteforce(spark):
    labels = [1, 0, 1, 1, 0, 0, 1, 0, 1, 0]
    scores = [0.9, 0.1, 0.4, 0.4, 0.4, 0.2, 0.8, 0.7, 0.3, 0.3]
    df = spark.createDataFrame(list(zip(labels, scores)), "label int, score double")
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l == 0]
    brute = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert math.isclose(ev.auc_roc(df).first()["auc"], brute)


def test_roc_points_ends(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.6), (0, 0.5)], "label int, score double")
    pts = {r["step"]: (r["fpr"], r["tpr"]) for r in ev.roc_points(df).collect()}
    assert pts[0] == (1.0, 1.0) and len(pts) == 21
    assert pts[20] == (0.0, 0.0)


def test_regression_metrics_perfect_and_mean(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)], "label double, prediction double")
    r = ev.regression_metrics(df).first()
    assert r["rmse"] == 0 and r["r2"] == 1.0
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "label double, prediction double")
    assert abs(ev.regression_metrics(df2).first()["r2"]) < 1e-12


def test_majority_baseline(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (0,)], "label int")
    r = ev.majority_baseline(df).first()
    p = 0.75
    assert r["majority_label"] == 1 and math.isclose(r["weighted_f1"], p * 2 * p / (1 + p))


@pytest.mark.parametrize("n,text", [(0, "0"), (999, "999"), (1000, "1.0K"), (1500, "1.5K"), (999999, "1000.0K"),
                                    (1_000_000, "1.00M"), (2_500_000, "2.50M"), (25_000_000, "25.00M")])
def test_format_magnitude(spark, n, text):
    df = spark.createDataFrame([(n,)], "n long")
    assert df.select(format_magnitude("n")).first()[0] == text


@pytest.mark.parametrize("size,total,text", [(100_000, 25_000_000, "100K"), (1_000_000, 25_000_000, "1M"),
                                             (None, 25_000_095, "25.0M (all)"), (None, 54_321, "54,321")])
def test_scale_label(spark, size, total, text):
    df = spark.createDataFrame([(size, total)], "size long, total long")
    assert df.select(scale_label("size", "total")).first()[0] == text


def test_diagnosis(spark):
    df = spark.createDataFrame([(0.9, 0.8), (0.45, 0.44), (0.7, 0.68)], "tr double, te double")
    got = [r[0] for r in df.select(md.diagnose_classifier(F.col("tr"), F.col("te"))).collect()]
    assert got == ["OVERFIT", "UNDERFIT", "OK"]


def test_compare_models_parallel_and_summary(spark):
    import random
    from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
    from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
    from ratings_engine.operators import runlog as rl
    rnd = random.Random(1)
    data = []
    for i in range(400):
        x1, x2 = rnd.random(), rnd.random()
        rating = round(min(5.0, max(0.5, 0.5 + 4 * x1 + rnd.gauss(0, 0.3))) * 2) / 2
        data.append((f"k{i}", rating, x1, x2))
    df = spark.createDataFrame(data, "row_key string, rating double, f1 double, f2 double")
    tr, te, used = md.prepare_supervised(df, ["f1", "f2", "absent"], 3.5, None)
    assert used == ["f1", "f2"]
    cls, _ = md.compare_classifiers(tr, te, {"lr": LogisticRegression(maxIter=5),
                                             "dt": DecisionTreeClassifier(maxDepth=3)}, parallelism=2)
    reg, _ = md.compare_regressors(tr, te, {"lin": LinearRegression(maxIter=5),
                                            "dt": DecisionTreeRegressor(maxDepth=3)}, parallelism=2)
    assert [r["model"] for r in cls.collect()] == ["lr", "dt"]
    assert all(r["accuracy"] > 0.8 for r in cls.collect())
    assert all(r["r2"] > 0.5 for r in reg.collect())
    s = rl.final_summary(cls, reg).first()
    assert s["best_classifier"] in ("lr", "dt") and s["best_regressor"] in ("lin", "dt")
    imp = md.feature_importance(tr, used, trees=3, depth=3)
    assert abs(sum(r["importance"] for r in imp.collect()) - 1.0) < 1e-9


def test_auc_distributed_prefix_matches_bruteforce(spark):
    import random
    rnd = random.Random(5)
    data = [(1 if rnd.random() < 0.4 else 0, round(rnd.random(), 2)) for _ in range(600)]
    df = spark.createDataFrame(data, "label int, score double")
    pos = [s for l, s in data if l == 1]
    neg = [s for l, s in data if l == 0]
    brute = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    for parts in (1, 7):
        assert math.isclose(ev.auc_roc(df, partitions=parts).first()["auc"], brute)
