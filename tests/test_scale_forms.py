"""Forms for large and skewed inputs: blocks, two-phase winners, composite salting, distributed label index, nested samples, safe run log."""

import math
import os
import re
import threading
import time

import numpy as np
import pytest
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from ratings_engine.config import session_conf
from ratings_engine.operators import encode as en
from ratings_engine.operators import evaluate as ev
from ratings_engine.operators import features as fe
from ratings_engine.operators import models as md
from ratings_engine.operators import quality as qa
from ratings_engine.operators import recsys as rs
from ratings_engine.operators import runlog as rl
from ratings_engine.operators import split as sp
from ratings_engine.plans.registry import all_queries
from ratings_engine.streaming import ingest as ig
from tests.conftest import SF_SMALL, rows

RSCHEMA = "user_id int, item_id int, rating double, ts long, row_key string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ top-K of unseen items

@pytest.mark.parametrize("block", [3, 7, 2048])
def test_unseen_blocks_match_brute_force(spark, block):
    rng = np.random.default_rng(5)
    uf = {u: rng.integers(-2, 3, 3).astype(float) for u in range(23)}        # small integers: many equal scores
    itf = {i: rng.integers(-2, 3, 3).astype(float) for i in range(100, 141)}
    seen = {(u, i) for u in uf for i in itf if rng.random() < (0.97 if u == 0 else 0.3)}
    frame = lambda f: spark.createDataFrame([(k, [float(x) for x in v]) for k, v in f.items()], "id int, features array<float>")
    pairs = spark.createDataFrame([*seen, *list(seen)[:50], (0, 9999), (9999, 100), (None, 100), (1, None)], "user_id int, item_id int")
    k = 5
    got = {}
    for r in rs.recommend_unseen(frame(uf), frame(itf), pairs, k, block=block).collect():
        got.setdefault(r["user_id"], []).append((r["rank"], r["item_id"], r["score"]))
    for u in uf:
        want = sorted((-float(uf[u] @ itf[i]), i) for i in itf if (u, i) not in seen)[:k]
        assert sorted(got.get(u, [])) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)], u


def test_unseen_of_empty_factors(spark):
    none = spark.createDataFrame([], "id int, features array<float>")
    some = spark.createDataFrame([(1, [1.0])], "id int, features array<float>")
    seen = spark.createDataFrame([], "user_id int, item_id int")
    assert rs.recommend_unseen(none, some, seen).collect() == rs.recommend_unseen(some, none, seen).collect() == []


# ------------------------------------------------------------------ baselines in one pass

def test_baselines_match_joins_and_read_each_side_once(spark):
    rng = np.random.default_rng(9)
    data = [(int(rng.integers(0, 40)) or None, int(rng.integers(0, 60)), float(rng.integers(1, 11)) / 2, i, f"r{i}") for i in range(900)]
    df = spark.createDataFrame(data, RSCHEMA)
    tr, te = df.where("ts < 500 and item_id > 5"), df.where("ts >= 500")          # some items unseen in training
    got = {r["baseline"]: (r["rmse"], r["n"]) for r in rs.baseline_rmse(tr, te).collect()}
    for key in ("user_id", "item_id"):
        p = rs.predict_from_means(te, ev.group_means(tr, key), key, f"{key}_mean")
        w = ev.regression_metrics(p, "rating", f"{key}_mean").first()
        assert math.isclose(got[f"{key}_mean"][0], w["rmse"], rel_tol=1e-12) and got[f"{key}_mean"][1] == w["n"]
    w = ev.mean_baseline(tr, te).first()
    assert math.isclose(got["global_mean"][0], w["rmse"], rel_tol=1e-12) and got["global_mean"][1] == w["n"]
    empty = {r["baseline"]: (r["rmse"], r["n"]) for r in rs.baseline_rmse(tr.limit(0), te).collect()}
    assert empty == {k: (None, 0) for k in got}


@pytest.mark.parametrize("query", ["r1_baseline_rmse", "a26_improvement_pct"])
def test_baseline_plans_scan_four_times(spark, query):
    assert _plan(all_queries()[query].build(spark, SF_SMALL)).count("Scan parquet") <= 4


# ------------------------------------------------------------------ winners of duplicate keys

def _first(data, keys, order):
    best = {}
    none_first = lambda x: (x is not None, x if x is not None else 0)
    for r in data:
        k = tuple(r[i] for i in keys)
        o = [none_first(r[i]) for i in order]
        if k not in best or o < best[k][0]:
            best[k] = (o, r)
    return sorted((r for _, r in best.values()), key=str)


@pytest.mark.parametrize("hot_rows", [3, 2_000_000])
def test_two_phase_winner(spark, hot_rows):
    rng = np.random.default_rng(2)
    texts = ["same8byte-b", "same8byte-a", "same8byte", "b", "a", "", None, "é", "zz"]
    data = [(int(rng.integers(0, 6)), int(rng.integers(0, 4)) or None, float(rng.integers(1, 4)), int(rng.integers(0, 3)) or None,
             texts[rng.integers(0, len(texts))]) for _ in range(300)]
    data += [(7, 7, 1.0, 7, "copy")] * 40 + [(8, 8, 1.0, 8, "once"), (None, None, 2.0, None, "x"), (None, None, 1.0, None, "x")]
    df = spark.createDataFrame(data, RSCHEMA).repartition(3)
    for keys, order in ((["user_id", "item_id"], ["ts", "row_key"]), (["user_id", "item_id", "ts"], ["ts", "row_key"]), (["user_id"], ["row_key", "ts"])):
        pos = {c: i for i, c in enumerate(df.columns)}
        full = [c for c in order if c not in keys] + [c for c in df.columns if c not in keys and c not in order]
        got = sorted((tuple(r) for r in qa.remove_duplicates(df, keys, order, hot_rows).collect()), key=str)
        assert got == _first(data, [pos[k] for k in keys], [pos[c] for c in full])
        assert "SortAggregate" not in _plan(qa.remove_duplicates(df, keys, order, hot_rows))


# ------------------------------------------------------------------ (user, category) means

def test_many_categories_without_maps(spark):
    r = spark.range(6000).select((F.col("id") % 3).cast("int").alias("user_id"), F.col("id").cast("int").alias("item_id"), (F.col("id") % 7).cast("double").alias("rating"),
                                 F.col("id").alias("ts"), F.col("id").cast("string").alias("row_key"), F.when(F.col("id") % 11 > 0, F.concat(F.lit("c"), F.col("id") % 2500)).alias("cat"))
    want = {}
    for x in r.collect():
        if x["cat"]:
            want.setdefault((x["user_id"], x["cat"]), []).append(x["rating"])
    for hot in (1, 2_000_000):
        out = fe.user_category_mean(r, "cat", hot_rows=hot)
        assert "map_from_entries" not in out._jdf.queryExecution().toString()
        for x in out.collect():
            m = want.get((x["user_id"], x["cat"]))
            assert x["user_genre_avg_rating"] == (None if m is None else pytest.approx(round(sum(m) / len(m), 3), abs=6e-4))


# ------------------------------------------------------------------ label index

def _indexed(df, col):
    m = StringIndexer(inputCol=col, outputCol="i", handleInvalid="keep", stringOrderType="frequencyDesc").fit(df)
    return m.transform(df)


@pytest.mark.parametrize("limit", [0, 50_000])
def test_label_index_equals_string_indexer(spark, monkeypatch, limit):
    monkeypatch.setattr(en, "BROADCAST_LABELS", limit)
    labels = ["Drama", "Comedy", "Drama", "Ärger", None, "a", "b", "Comedy", "Drama", "z"] * 7 + ["b", "once"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "row_key int, g string")
    a = en.encode_category(df, "g", "i", "v", hot_rows=5)
    b = OneHotEncoder(inputCol="i", outputCol="v", dropLast=True).fit(_indexed(df, "g")).transform(_indexed(df, "g"))
    assert rows(en.vector_to_text(a, "v"), "row_key", "i", "v_str") == rows(en.vector_to_text(b, "v"), "row_key", "i", "v_str")


def test_label_index_of_100_000_labels(spark):
    df = spark.range(150_000).select(F.concat(F.lit("label"), F.when(F.col("id") < 100_000, F.col("id")).otherwise(F.col("id") % 777)).alias("g"))
    index, one_task = (en.label_index(df.groupBy("g").agg(F.count("*").alias("n")), "g", small=small) for small in (1000, 200_000))
    assert rows(index) == rows(one_task)
    got = [(r["label"], r["n"]) for r in index.orderBy("label_index").collect()]
    counts = {}
    for r in df.collect():
        counts[r[0]] = counts.get(r[0], 0) + 1
    assert got == sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    out = en.encode_category(df, "g", "i", one_hot=False)
    assert out.count() == 150_000 and out.agg(F.max("i")).first()[0] == 99_999.0


# ------------------------------------------------------------------ ROC points

def test_roc_points_match_conditional_counts(spark):
    rng = np.random.default_rng(4)
    scores = [i / 20 for i in range(21)] + [np.nextafter(i / 20, d) for i in range(21) for d in (0, 1)] + list(rng.random(300)) + [-0.5, 1.5, float("nan"), None]
    data = [(float(s) if s is not None else None, int(rng.integers(0, 2))) for s in scores]
    df = spark.createDataFrame(data, "score double, label int")
    for steps in (20, 3, 1):
        got = {r["step"]: (r["threshold"], r["fpr"], r["tpr"]) for r in ev.roc_points(df, steps=steps).collect()}
        at = lambda y, t: sum(s is not None and (s >= t or s != s) for s, z in data if z == y) / sum(z == y for _, z in data)
        assert got == {i: (i / steps, pytest.approx(at(0, i / steps)), pytest.approx(at(1, i / steps))) for i in range(steps + 1)}
    assert {(r["fpr"], r["tpr"]) for r in ev.roc_points(df.limit(0)).collect()} == {(0.0, 0.0)}
    assert _plan(ev.roc_points(df)).count("count_if") <= 8


# ------------------------------------------------------------------ nested samples

def test_numbered_rows_are_the_samples(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 1000 > 2, F.col("id").cast("string")).alias("row_key"), "id").repartition(7)
    x = sp.numbered_by_hash(df)
    assert sorted(r["_pos"] for r in x.collect()) == list(range(3000))
    for n in (1, 50, 2999):
        assert rows(x.where(F.col("_pos") < n), "row_key") == rows(sp.sample_rows(df, n), "row_key") if n < 2900 else x.where(F.col("_pos") < n).count() == n


def test_regressors_of_the_learning_curve_see_all_rows(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(f"r{i}", float(i % 10), float(rng.random()), float(i % 2)) for i in range(1200)], "row_key string, rating double, x double, label_cls double")
    tr, te = md.split_sides(df, ["x"])
    got = {r["fraction"]: r for r in md.learning_curve(tr, te, (0.2, 0.6, 1.0), trees=2, depth=2, classifier_fraction=0.5).collect()}
    assert got[1.0]["n_train"] == tr.count() and 0.4 < got[1.0]["n_train_classifier"] / got[1.0]["n_train"] < 0.6
    assert got[0.2]["n_train"] < got[0.6]["n_train"] < got[1.0]["n_train"]
    assert all(v is not None for r in got.values() for v in r)


def test_scale_study_has_metrics_for_every_size(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(f"r{i}", float(i % 10), float(rng.random())) for i in range(900)], "row_key string, rating double, x double")
    data = en.assemble(df, ["x"]).select("row_key", "features", "rating")
    got = md.scale_study(data, (200, 400, 5000, None)).collect()
    assert {(r["model"], r["size"]) for r in got} == {(m, s) for m in ("linear", "random_forest") for s in (200, 400, None)}
    assert all(v is not None for r in got for k, v in r.asDict().items() if k != "size")


# ------------------------------------------------------------------ run log, intake

def test_two_writers_make_one_experiment(spark, tmpdir_path):
    logs = [rl.RunLog(spark, f"{tmpdir_path}/log") for _ in range(2)]
    start, failed = threading.Barrier(2), []

    def write(log, k):
        try:
            start.wait()
            for i in range(3):
                log.log_run("shared", f"run{k}{i}", {"p": k}, {"rmse": 1.0 + i}, run_id=f"id-{k}-{i}")
        except Exception as e:  # noqa: BLE001
            failed.append(e)
    threads = [threading.Thread(target=write, args=(log, k)) for k, log in enumerate(logs)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    logs[0].log_run("shared", "run00", {"p": 0}, {"rmse": 1.0}, run_id="id-0-0")         # a retry after a lost answer
    table = logs[1].table
    assert [r["name"] for r in table(rl.EXPERIMENTS).collect()] == ["shared"]
    assert table(rl.RUNS).count() == table(rl.PARAMS).count() == table(rl.METRICS).count() == 6
    assert {r["experiment_id"] for r in table(rl.RUNS).collect()} == {rl.experiment_id("shared")}
    assert rl.experiment_spans(table(rl.RUNS)).first()["runs"] == 6
    assert all(r["value"] is not None for r in rl.runs_with_metrics(table(rl.RUNS), table(rl.METRICS)).collect())


def test_file_intake_is_bounded_in_bytes(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    sizes = [400, 30_000, 500, 600, 9_000, 700, 9_500, 300]        # one file larger than the bound
    for i, size in enumerate(sizes):
        line = '{"userId": 1, "movieId": 2, "rating": 4.0, "timestamp": 3}\n'
        with open(os.path.join(src, f"f{i}.json"), "w") as f:
            f.write(line * (size // len(line) + 1))
        os.utime(os.path.join(src, f"f{i}.json"), (1_000_000 + i, 1_000_000 + i))
    q = ig.ingest(spark, os.path.join(tmpdir_path, "sink"), os.path.join(tmpdir_path, "ck"), source="files", path=src, max_bytes_per_trigger=10_000, available_now=True)
    q.awaitTermination()
    batches = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    biggest = 30_000 // 59 + 1
    assert len(batches) >= 4 and sorted(batches)[-1] <= biggest + 10_000 // 59 and sorted(batches)[-2] <= 10_000 // 59 + 20
    assert spark.read.parquet(os.path.join(tmpdir_path, "sink")).count() == sum(s // 59 + 1 for s in sizes)
    with pytest.raises(ValueError):
        ig.read_rating_stream(spark, "files", path=src, max_per_trigger=1, max_bytes_per_trigger=1)


def test_unseen_tiles_match_brute_force_and_skip(spark, monkeypatch):
    rng = np.random.default_rng(6)
    uid, iid = np.arange(50), np.arange(1000, 1400)
    uf, itf = rng.normal(size=(50, 3)), rng.normal(size=(400, 3)) * rng.exponential(size=(400, 1))
    itf[7] = itf[300]                                                              # equal scores
    seen = [(u, i) for u in uid for i in iid if rng.random() < (0.99 if u == 3 else 0.2)]
    monkeypatch.setattr(rs, "TILE_USERS", 16)
    monkeypatch.setattr(rs, "TILE_ITEMS", 32)
    for pairs in ([], seen):
        su, si = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ([], [])))
        got = {}
        for u, i, s in zip(*rs._cell_search(10)(uid, uf, iid, itf, su, si)):
            got.setdefault(u, []).append((-s, i))
        out = set(pairs)
        score = (uf @ itf.T).astype(np.float32)
        for u in uid:
            want = sorted((-score[u, i - 1000], i) for i in iid if (u, i) not in out)[:10]
            assert got.get(u, []) == want, u


def test_cells_of_the_factor_product_ship_few_copies(spark):
    """Each item once went to all 49 user blocks of 2,048, each user to all 25 item blocks."""
    frame = lambda n: spark.range(n).select(F.col("id").cast("int").alias("id"), F.array(F.lit(1.0).cast("float")).alias("features"))
    shipped = rs.recommend_unseen(frame(100_000), frame(50_000), None, 1)._jdf.queryExecution().analyzed().toString()
    top = [int(x) for x in re.findall(r"explode\(sequence\(0, (\d+)", shipped)]
    assert top and max(top) + 1 <= 2 * spark.sparkContext.defaultParallelism


def test_top_k_of_all_items_as_spark_gives_them(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 9 + 1) / 2) for u in range(30) for i in range(40) if (u + i) % 3]
    m = rs.fit_als(spark.createDataFrame(rows, "user_id int, item_id int, rating double"), rank=3, max_iter=2)
    own, theirs = rs.recommend_top_k(m, 5), m.recommendForAllUsers(5)
    assert own.dtypes == theirs.dtypes
    a, b = ({r["user_id"]: [x["rating"] for x in r["recommendations"]] for r in d.collect()} for d in (own, theirs))
    assert a.keys() == b.keys() and all(np.allclose(a[u], b[u], atol=1e-5) for u in a)


def test_cross_validation_of_als_is_that_of_crossvalidator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.recommendation import ALS
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    from ratings_engine.operators.split import fold_col
    rows = [(u, i, float((u * 7 + i * 3) % 9 + 1) / 2, f"{u}-{i}") for u in range(30) for i in range(40) if (u + i) % 3]
    tr = spark.createDataFrame(rows, "user_id int, item_id int, rating double, row_key string")
    got = rs.als_cross_validate(tr, tr, rank=2, max_iter=2, reg=0.1)[0].first()
    cv = CrossValidator(estimator=ALS(userCol="user_id", itemCol="item_id", ratingCol="rating", rank=2, maxIter=2, regParam=0.1, seed=42,
                                      coldStartStrategy="drop"), estimatorParamMaps=ParamGridBuilder().build(),
                        evaluator=RegressionEvaluator(metricName="rmse", labelCol="rating"), numFolds=3, foldCol="fold")
    assert math.isclose(got["cv_mean_rmse"], cv.fit(tr.withColumn("fold", fold_col("row_key", 3))).avgMetrics[0], rel_tol=1e-6)


def test_als_grid_leaves_no_shuffle_files(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 9 + 1) / 2, f"{u}-{i}") for u in range(30) for i in range(40) if (u + i) % 3]
    tr = spark.createDataFrame(rows, "user_id int, item_id int, rating double, row_key string")
    files = lambda: sum(str(x).endswith(".data") for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()))
    rs.release_shuffles(spark)
    time.sleep(2)
    before = files()
    grid = rs.als_grid(tr, tr, ranks=(2, 3), iters=(1, 2), regs=(0.1,), parallelism=2)
    grid.unpersist()
    time.sleep(2)
    assert grid.count() == 4 and files() - before <= 20                            # about 50 a fit


def test_cross_validate_fits_once_per_fold(spark, monkeypatch):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    df = en.assemble(spark.createDataFrame([(float(i % 7), float(i % 5), f"r{i}") for i in range(200)], "x double, rating double, row_key string"), ["x"])
    est, ev_ = LinearRegression(labelCol="rating"), RegressionEvaluator(labelCol="rating")
    folded = md.with_folds(df, 3).cache()
    want = CrossValidator(estimator=est, estimatorParamMaps=ParamGridBuilder().build(), evaluator=ev_, numFolds=3, foldCol="fold").fit(folded).avgMetrics[0]
    fits, fit = [], LinearRegression.fit
    monkeypatch.setattr(LinearRegression, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    folded.cache()
    assert math.isclose(md.cross_validate(est, folded, ev_, 3), want, rel_tol=1e-9) and len(fits) == 3
    assert folded.storageLevel.useMemory                                           # the caller's table stays cached
    assert math.isclose(md.cross_validate(est, df, ev_, 3), want, rel_tol=1e-9)
    folded.unpersist()
    with pytest.raises(ValueError, match="empty"):
        md.cross_validate(est, df.limit(1), ev_, 3)


def test_feature_shuffles_leave_out_what_follows_from_ts(spark):
    r = spark.createDataFrame([(1, 1, 3.0, 100, "a"), (1, 2, 4.0, 200, "b"), (2, 1, 5.0, 300, "c")], RSCHEMA)
    items = spark.createDataFrame([(1, "A (1990)", "X|Y"), (2, "B (1991)", "Y")], "item_id int, title string, genres string")
    plan = fe.all_features(r, items, encode=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("rating_datetime") < plan.index("Join") and "rating_datetime" not in plan[plan.index("Join"):]


# ------------------------------------------------------------------ feature rows and their cached sides

def test_user_columns_follow_on_rows_dealt_by_user(spark):
    """Same values in either order of the joins, also with NULL and hot users; the wide rows are dealt once by user."""
    keys = [(i, i % 7 if i % 13 else None, i % 11, (i * 7 % 10 + 1) / 2, 86400 * (i * 31 % 400), f"k{i}") for i in range(300)]
    schema = "n int, user_id int, item_id int, rating double, ts long, row_key string"
    items = spark.createDataFrame([(i, f"t{i} (19{60 + i})", f"g{i % 3}|h") for i in range(10)], "item_id int, title string, genres string")
    cols = ["row_key", *md.FEATURES_WITH_LEAKY]
    with session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", **fe.BY_USER):
        twice = items.unionByName(items.where("item_id < 3").withColumn("title", F.lit("again (1990)")))
        known = [k for k in keys if k[1] is not None]
        for r, dim, hot in ((keys, twice, 2_000_000), (keys, items, 20), (known, items, 2_000_000)):
            df = spark.createDataFrame(r, schema).drop("n")
            one, two = (md.supervised_rows(fe.all_features(df, dim, encode=False, hot_rows=hot, user_last=last), md.FEATURES_WITH_LEAKY)[0] for last in (True, False))
            one.collect()
            assert sorted(map(str, one.select(cols).collect())) == sorted(map(str, two.select(cols).collect()))
        two.collect()
    deals = lambda x: _plan(x).split("Initial Plan")[0].count("Exchange hashpartitioning")
    assert deals(one) == 4 and deals(two) > 4          # rows by item and by user, two tables to meet them
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_cached_sides_have_small_partitions(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(md, "SMALL_SCANS", {"spark__sql__files__maxPartitionBytes": "64k"})
    spark.range(100_000).select(F.rand(1).alias("x")).coalesce(1).write.option("parquet.block.size", 65536).parquet(tmpdir_path + "/t")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    table = spark.read.parquet(tmpdir_path + "/t")
    small, = md._cached(table)
    try:
        assert small.rdd.getNumPartitions() >= 8 and small.count() == 100_000
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    finally:
        small.unpersist()


# ------------------------------------------------------------------ blocks of ALS

def test_blocks_of_als_keep_their_size(spark, monkeypatch):
    rows = [(u, i, float((u * 7 + i * 3) % 9 + 1) / 2, f"{u}-{i}") for u in range(30) for i in range(40) if (u + i) % 3]
    tr = spark.createDataFrame(rows, "user_id int, item_id int, rating double, row_key string")
    assert rs.als_blocks(20_000_000) == {} and rs.als_blocks(173_000_000)["numUserBlocks"] == 87
    asked, fit = [], rs.ALS.fit
    monkeypatch.setattr(rs.ALS, "fit", lambda self, df: asked.append((self.getNumUserBlocks(), self.getNumItemBlocks())) or fit(self, df))
    few, _ = rs.als_grid(tr, tr, (2,), (3,), (0.1,)), rs.als_cross_validate(tr, tr, rank=2, max_iter=2)
    assert set(asked) == {(10, 10)}
    monkeypatch.setattr(rs, "BLOCK_RATINGS", 50)
    asked.clear()
    many, _ = rs.als_grid(tr, tr, (2,), (3,), (0.1,)), rs.als_cross_validate(tr, tr, rank=2, max_iter=2)
    assert set(asked) == {(16, 16)} and len(asked) == 5
    assert abs(many.first()["rmse"] - few.first()["rmse"]) < 0.2


# ------------------------------------------------------------------ many hot keys

def test_many_hot_keys_are_not_broadcast(spark):
    """With a threshold of two rows nearly every pair is hot; their table meets the rows by a shuffle."""
    r = spark.range(900).select((F.col("id") % 30).cast("int").alias("user_id"), (F.col("id") % 7).cast("double").alias("rating"), F.col("id").alias("ts"),
                                F.col("id").cast("string").alias("row_key"), F.when(F.col("id") % 13 > 0, F.concat(F.lit("c"), F.floor(F.col("id") % 60 / 30))).alias("cat"))
    r = r.unionByName(r.where("ts < 9"))
    few, many = (fe.user_category_mean(r, "cat", hot_rows=n) for n in (2, 2_000_000))
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect())) and few.columns == many.columns
    hinted = lambda x: re.findall(r"ResolvedHint|strategy=broadcast", x._jdf.queryExecution().analyzed().toString())
    bounds = re.findall(r"_n#\w+ > (?:cast\()?(\d+)", few._jdf.queryExecution().analyzed().toString())
    assert hinted(few) and bounds and "2000000" in bounds        # what is still broadcast is bounded by total/2,000,000 rows
    with session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = fe.user_category_mean(r, "cat", hot_rows=2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2 and plan.count("Join LeftOuter") > 3


def test_learning_curve_and_folds_fill_small_partitions(spark, monkeypatch):
    asked, cached = [], md._cached
    monkeypatch.setattr(md, "_cached", lambda *frames: asked.append(len(frames)) or cached(*frames))
    df = spark.createDataFrame([(f"r{i}", float(i % 10), float(i % 7), float(i % 2)) for i in range(200)], "row_key string, rating double, x double, label_cls double")
    tr, te = md.split_sides(df, ["x"])
    md.learning_curve(tr, te, (0.5, 1.0), trees=2, depth=2)
    assert asked == [1, 1, 1]                                    # the test side and each fraction
    asked.clear()
    from ratings_engine.plans import q_models as qm
    monkeypatch.setattr(qm, "supervised", lambda spark, sf, fraction: (tr, te, ["x"]))
    monkeypatch.setattr(md, "cross_validate", lambda est, frame, *a: float(frame.storageLevel.useMemory))
    assert {r["cv_value"] for r in qm.q_g8(spark, "x").collect()} == {1.0} and asked == [2]
