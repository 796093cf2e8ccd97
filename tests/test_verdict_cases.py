import math

import pytest

from ratings_engine.functions.quantiles import exact_quantiles
from ratings_engine.operators import evaluate as ev
from ratings_engine.operators import features as fe
from ratings_engine.operators import models as md
from ratings_engine.operators import quality as qa
from ratings_engine.operators import recsys as rs
from ratings_engine.operators import split as sp
from ratings_engine.streaming.ingest import ingest_until
from tests.conftest import SF_SMALL

RATINGS = "user_id int, item_id int, rating double, ts long, row_key string"


def _ratings(spark, rows):
    return spark.createDataFrame([(u, i, r, t, f"{u}-{i}-{t}") for u, i, r, t in rows], RATINGS)


@pytest.mark.parametrize("ratio", [0.0, 0.1, 0.998, 0.999, 1.0])
def test_split_follows_its_ratio(spark, ratio):
    df = spark.range(20000).selectExpr("string(id) as row_key")
    train, test = sp.train_test_split(df, ratio)
    n = train.count()
    assert n + test.count() == 20000 and abs(n / 20000 - ratio) < 0.01
    assert ratio not in (0.0, 1.0) or n == 20000 * ratio


@pytest.mark.parametrize("n", [0, 1, 50, 100, 19999, 20000, 30000])
def test_sample_rows_is_exact_and_stays_partitioned(spark, n):
    df = spark.range(0, 20000, 1, 8).selectExpr("string(id) as row_key")
    s = sp.sample_rows(df, n)
    assert s.count() == min(n, 20000)
    if n >= 50:
        assert s.rdd.getNumPartitions() > 1


def test_sample_rows_with_equal_keys(spark):
    df = spark.range(100).selectExpr("string(id % 2) as row_key")
    assert sp.sample_rows(df, 70).count() == 70


def test_constant_raters_are_suspicious(spark):
    df = _ratings(spark, [(1, i, 1.1, i) for i in range(61)] + [(2, i, 0.5 + i % 9 * 0.5, i) for i in range(61)])
    got = {r["user_id"]: r["stddev_rating"] for r in qa.suspicious_users(df).collect()}
    assert got == {1: 0.0}
    assert {r["user_rating_variance"] for r in fe.user_features(df).where("user_id = 1").collect()} == {0.0}


def test_null_users_share_their_statistics(spark):
    df = _ratings(spark, [(None, 1, 2.0, 1), (None, 2, 4.0, 2), (1, 1, 3.0, 3)])
    for hot in (1, 100):
        got = {(r["user_id"], r["user_avg_rating"], r["user_rating_count"]) for r in fe.user_features(df, hot_rows=hot).collect()}
        assert got == {(None, 3.0, 2), (1, 3.0, 1)}


def test_infinities_stand_at_the_ends(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in (-inf, 1.0, 2.0, 3.0, inf, None, float("nan"))], "v double")
    r = exact_quantiles(df, "v", {"lo": 0.0, "q1": 0.25, "mid": 0.5, "hi": 1.0}).first()
    assert (r["lo"], r["q1"], r["mid"], r["hi"], r["n"]) == (-inf, 1.0, 2.0, inf, 5)


def test_metrics_without_variance_or_class(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "label double, prediction double")
    m = ev.regression_metrics(df).first()
    assert m["r2"] is None and m["mse"] == 0.5
    one = spark.createDataFrame([(1, 0.3), (1, 0.4)], "label int, score double")
    assert ev.auc_roc(one).first()["auc"] == 0.0
    some = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (0, float("nan"))], "label int, score double")
    r = ev.auc_roc(some).first()
    assert (r["auc"], r["n_pos"], r["n_neg"]) == (1.0, 1, 1)


def test_ideal_gain_without_liked_items(spark):
    df = spark.createDataFrame([(0,), (1,), (3,)], "n int")
    got = [r[0] for r in df.select(rs.ideal_dcg(df["n"], 2)).collect()]
    assert got[0] == 0.0 and got[1] == 1.0 and math.isclose(got[2], 1 + 1 / math.log2(3))


def test_report_on_no_rows(spark):
    r = qa.quality_report(_ratings(spark, [])).collect()
    assert len(r) == 1 and r[0]["rows_after"] == 0 and r[0]["outlier_count"] == 0


def test_scale_study_has_metrics_inside_a_split(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df = spark.range(3000).selectExpr("string(id) as row_key", "double(id % 7) as x", "double(id % 7) * 2 + 1 as rating")
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    train, _ = sp.train_test_split(data)
    rows = md.scale_study(train, (500, None), {"linear": LinearRegression()}).collect()
    assert len(rows) == 2 and all(r["n_test"] > 0 and r["rmse"] < 1e-6 and r["r2"] > 0.99 for r in rows)


class _DeadQuery:
    isActive = False  # noqa: N815
    recentProgress = ()  # noqa: N815

    def exception(self):
        return RuntimeError("sink is gone")

    def stop(self):
        pass


def test_a_failed_stream_is_raised():
    with pytest.raises(RuntimeError, match="sink is gone"):
        ingest_until(_DeadQuery(), n_rows=1)


def test_fitted_summary_has_every_family(spark):
    import __spark_entry__ as entry
    got = {r["metric"]: r["value"] for r in entry.queries()["m13_metrics_summary_fitted"](spark, SF_SMALL).collect()}
    assert {k.split("_")[0] for k in got} == {"ALS", "Rec", "Cls"}
    assert all(v is not None and v == v for v in got.values())
    assert got["ALS_n"] > 0 and got["ALS_rmse"] > 0 and 0 < got["Cls_accuracy"] <= 1
