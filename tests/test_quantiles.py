import numpy as np
import pytest

from ratings_engine.functions import quantiles as qq

PROBS = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}


def _cases():
    rnd = np.random.default_rng(3)
    return {
        "lognormal": rnd.lognormal(0, 2, 5000),
        "one_outlier": np.concatenate([rnd.random(5000), [1e12]]),
        "ties": rnd.integers(0, 5, 5000).astype(float),
        "single": np.array([3.0]),
        "two": np.array([1.0, 2.0]),
    }


@pytest.mark.parametrize("name", list(_cases()))
@pytest.mark.parametrize("final_rows", [2_000_000, 300])
def test_exact_quantiles_match_numpy(spark, name, final_rows):
    arr = _cases()[name]
    df = spark.createDataFrame([(float(x),) for x in arr], "x double")
    # final_rows=300 forces narrowing by sketches of the brackets' own rows
    r = qq.exact_quantiles(df, "x", PROBS, k=64, final_rows=final_rows).first()
    for k, q in PROBS.items():
        e = float(np.quantile(arr, q))
        assert abs(r[k] - e) <= 1e-9 * max(1.0, abs(e)), (k, r[k], e)
    assert r["n"] == len(arr)


def test_exact_quantiles_ignores_null_nan_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    r = qq.exact_quantiles(df, "x", {"median": 0.5}).first()
    assert r["median"] == 2.0 and r["n"] == 2
    e = qq.exact_quantiles(spark.createDataFrame([], "x double"), "x", {"median": 0.5}).first()
    assert e["median"] is None and e["n"] == 0


@pytest.mark.parametrize("name", list(_cases()))
def test_bracket_without_its_rank_is_widened(spark, name, monkeypatch):
    monkeypatch.setattr(qq, "_error", lambda k: 1e-6)       # a sketch far worse than its bound
    arr = _cases()[name]
    df = spark.createDataFrame([(float(x),) for x in arr], "x double")
    for rank in {0, len(arr) // 3, len(arr) - 1}:
        assert qq.value_at_rank(df, "x", rank, k=8) == np.sort(arr)[rank]


@pytest.mark.parametrize("name", list(_cases()))
def test_box_plot_matches_numpy(spark, name):
    arr = _cases()[name]
    df = spark.createDataFrame([(float(x),) for x in arr] + [(None,), (float("nan"),)], "x double").repartition(3)
    q1, med, q3 = np.quantile(arr, [0.25, 0.5, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    want = (q1, med, q3, q3 - q1, arr[arr >= lo].min(), arr[arr <= hi].max(), ((arr < lo) | (arr > hi)).sum() + 1, len(arr) + 2)
    assert np.allclose([float(x) for x in qq.box_plot(df, "x").first()], want, rtol=1e-12)


def test_infinite_values_stand_at_the_ends(spark):
    inf = float("inf")
    arr = [-inf] * 3 + [float(x) for x in range(10)] + [inf] * 4
    df = spark.createDataFrame([(x,) for x in arr], "x double")
    for rank in (0, 2, 3, 12, 13, 16):
        assert qq.value_at_rank(df, "x", rank) == arr[rank]
    assert tuple(qq.exact_quantiles(df, "x", {"lo": 0.0, "mid": 0.5, "hi": 1.0}).first()) == (-inf, 5.0, inf, 17)
