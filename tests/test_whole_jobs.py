"""Model queries run at the published settings and fit on all training rows."""

import pytest

from ratings_engine.operators import models as md
from ratings_engine.operators import recsys as rs
from ratings_engine.operators.split import split_flag
from ratings_engine.plans import q_models as qm


# ------------------------------------------------------------------ grid of ALS

@pytest.mark.parametrize("query", [qm.q_r3, qm.q_r4, qm.q_a25, qm.q_r5])
def test_grid_is_the_published_one(spark, monkeypatch, query):
    """The queries fit ranks 5, 10, 20, and the cross-validation takes the best of these points."""
    asked, best = [], {}

    def grid(tr, te, ranks, iters, regs, **kw):
        asked.append((ranks, iters, regs))
        points = [(r, i, g, abs(r - 20) + abs(i - 15) + g, 1.0) for r in ranks for i in iters for g in regs]
        return spark.createDataFrame(points, "rank int, max_iter int, reg_param double, rmse double, seconds double")

    def folds(tr, te, **kw):
        best.update(kw)
        return spark.range(1), None

    monkeypatch.setattr(qm, "split", lambda spark, sf: (spark.range(1), spark.range(1)))
    monkeypatch.setattr(rs, "als_grid", grid)
    monkeypatch.setattr(rs, "als_cross_validate", folds)
    rows = query(spark, f"no-folder-{query.__name__}").collect()
    assert asked == [((5, 10, 20), (5, 10, 15), (0.01, 0.1, 0.5))]
    assert len(rows) == {qm.q_r3: 27, qm.q_r4: 9, qm.q_a25: 9, qm.q_r5: 1}[query]
    if query is qm.q_r5:
        assert best == {"rank": 20, "max_iter": 15, "reg": 0.01, "folds": 3}


# ------------------------------------------------------------------ supervised models

@pytest.fixture()
def few_rows(spark, monkeypatch):
    """60 feature rows in place of the feature table; returns the number of training rows."""
    data = [(f"r{i}", float(i % 10) / 2, float(i % 2), *(float(i * j % 7) for j in range(len(md.FEATURES_WITH_LEAKY)))) for i in range(60)]
    df = spark.createDataFrame(data, ["row_key", "rating", "label_cls", *md.FEATURES_WITH_LEAKY])
    monkeypatch.setattr(qm, "feature_rows", lambda spark, sf: df)
    return df.where(split_flag()).count()


def _settings(models):
    keep = ("maxIter", "regParam", "numTrees", "maxDepth")
    return {k: {p.name: v for p, v in m.extractParamMap().items() if p.name in keep} for k, m in models.items()}


def _asked(monkeypatch, name, result):
    """What the query hands to the operator: rows of its training side and the settings of its models."""
    asked = []

    def operator(tr, te, models=None, *a, **kw):
        asked.append((tr.count(), _settings(models)))
        return result

    monkeypatch.setattr(md, name, operator)
    return asked


def test_importances_come_from_all_training_rows(spark, monkeypatch, few_rows):
    from pyspark.ml.classification import RandomForestClassifier
    asked, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, tr: asked.append((tr.count(), self.getNumTrees(), self.getMaxDepth())) or fit(self, tr))
    got = qm.q_e4(spark, "x").collect()
    assert asked == [(few_rows, 50, 8)]
    assert [r["feature"] for r in got] == md.FEATURES_WITH_LEAKY and abs(sum(r["importance"] for r in got) - 1) < 1e-9


def test_summary_compares_models_of_all_training_rows(spark, monkeypatch, few_rows):
    cls = spark.createDataFrame([("c", 0.5, 0.5, 1.0)], "model string, accuracy double, f1 double, seconds double")
    reg = spark.createDataFrame([("r", 0.5, 0.5, 1.0)], "model string, rmse double, r2 double, seconds double")
    classifiers, regressors = _asked(monkeypatch, "compare_classifiers", (cls, {})), _asked(monkeypatch, "compare_regressors", (reg, {}))
    assert qm.q_g11(spark, "x").count() == 2
    assert classifiers == [(few_rows, _settings(md.classifiers()))] and regressors == [(few_rows, _settings(md.regressors()))]


def test_regressors_are_compared_at_published_settings(spark, monkeypatch, few_rows):
    asked = _asked(monkeypatch, "compare_regressors", (spark.range(1), {}))
    qm.q_g5(spark, "x")
    assert asked == [(few_rows, _settings(md.regressors()))]


def test_learning_curve_fits_both_models_on_all_rows_of_a_fraction(spark, monkeypatch, few_rows):
    asked, forest = [], md.RandomForestClassifier
    monkeypatch.setattr(md, "RandomForestClassifier", lambda **kw: asked.append((kw["numTrees"], kw["maxDepth"])) or forest(**kw | {"numTrees": 2}))
    got = qm.q_g9(spark, "x").collect()
    assert [r["fraction"] for r in got] == [0.1, 0.2, 0.3, 0.5, 0.7, 1.0] and got[-1]["n_train"] == few_rows
    assert all(r["n_train_classifier"] == r["n_train"] for r in got) and asked == [(30, 6)] * 6


def test_residuals_of_the_boosted_trees_too(spark, monkeypatch, few_rows):
    models = md.regressors(fast=True)
    asked = []
    monkeypatch.setattr(md, "regressors", lambda fast=False: asked.append(fast) or models)
    assert {r["model"] for r in qm.q_residuals_fitted(spark, "x").select("model").distinct().collect()} == set(models)
    assert asked == [False]


def test_confusion_matrices_of_models_of_all_training_rows(spark, monkeypatch, few_rows):
    asked = _asked(monkeypatch, "all_confusion_matrices", spark.range(1))
    qm.q_m12(spark, "x")
    assert asked == [(few_rows, _settings(md.classifiers()))]


def test_summary_of_fitted_models_uses_all_training_rows(spark, monkeypatch, few_rows):
    from pyspark.ml.classification import LogisticRegression
    asked, fit, als = [], LogisticRegression.fit, rs.fit_als
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, tr: asked.append((tr.count(), self.getMaxIter())) or fit(self, tr))
    monkeypatch.setattr(rs, "fit_als", lambda tr, rank=10, max_iter=10, reg=0.1: asked.append((rank, max_iter, reg)) or als(tr, 2, 1))
    ratings = spark.createDataFrame([(u, i, float((u + i) % 5), f"{u}-{i}") for u in range(8) for i in range(8)], "user_id int, item_id int, rating double, row_key string")
    monkeypatch.setattr(qm, "split", lambda spark, sf: (ratings.where(split_flag()), ratings.where(~split_flag())))
    assert qm.q_m13_fitted(spark, "x").count() > 0
    assert asked == [(10, 10, 0.1), (few_rows, 20)]
