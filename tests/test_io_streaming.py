import json
import os

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from ratings_engine.operators import recsys as rs
from ratings_engine.operators import runlog as rl
from ratings_engine.sources import tables as tb
from ratings_engine.streaming import ingest as ig
from tests.conftest import SF_SMALL, rows


def _write_lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _msg(u, i, r, t):
    return json.dumps({"userId": u, "movieId": i, "rating": r, "timestamp": t})


def test_stream_restart_exactly_once_and_bad_messages(spark, tmpdir_path):
    src, sink, ckpt = (os.path.join(tmpdir_path, x) for x in ("src", "sink", "ckpt"))
    for f in range(4):
        _write_lines(src, f"part{f}.json", [_msg(f * 10 + k, k, 3.5, 1000 + k) for k in range(5)])
    q = ig.ingest(spark, sink, ckpt, source="files", path=src, max_per_trigger=2, available_now=True)
    q.awaitTermination()
    assert tb.read_table(spark, sink).count() == 20
    # wire_bad: valid, garbage, wrong-typed userId, missing userId, bad rating but valid user
    _write_lines(src, "part4.json", [_msg(100, 1, 4.0, 1), "bad", json.dumps({"userId": "x", "movieId": 1}),
                                     json.dumps({"movieId": 2, "rating": 3.0, "timestamp": 5}),
                                     json.dumps({"userId": 101, "movieId": 3, "rating": "oops", "timestamp": 6})])
    _write_lines(src, "part5.json", [_msg(200, 2, 2.0, 2)])
    q = ig.ingest(spark, sink, ckpt, source="files", path=src, max_per_trigger=2, available_now=True)
    q.awaitTermination()
    out = tb.read_table(spark, sink)
    assert out.count() == 23                       # 20 + valid + bad-rating-valid-user + part5, each once
    assert out.groupBy("user_id", "item_id", "ts").count().where("count > 1").count() == 0
    assert out.where("user_id = 101").first()["rating"] is None


def test_publish_events_skips_bad_rows(spark):
    df = spark.createDataFrame([("1", "10", "4.5", "100"), ("x", "10", "4.5", "100"), ("2", "11", None, "5")],
                               "userId string, movieId string, rating string, timestamp string")
    msgs, counts = ig.publish_events(df)
    c = counts.first()
    assert (c["sent"], c["skipped"]) == (1, 2)
    m = msgs.first()
    assert m["key"] == "1" and json.loads(m["value"]) == {"userId": 1, "movieId": 10, "rating": 4.5, "timestamp": 100}


def test_publish_events_missing_column_skips_all(spark):
    df = spark.createDataFrame([("1", "10", "4.5")], "userId string, movieId string, rating string")
    _, counts = ig.publish_events(df)
    assert counts.first()["skipped"] == 1


def test_ingest_rate_and_progress(spark):
    df = spark.createDataFrame([(f"2024-01-01 00:00:0{s}",) for s in (0, 1, 1, 4, 7, 7, 8)], "t string") \
        .select(F.col("t").cast("timestamp").alias("processed_at"))
    r = rows(ig.ingest_rate(df, keep=2), "rows_added", "total_rows", "rows_per_sec")
    assert r == [(1, 4, 0), (3, 7, 1)]
    p = spark.range(1).select(*[v.alias(k) for k, v in ig.ingest_progress(F.lit(50), 200, F.lit(10)).items()]).first()
    assert (p["progress"], p["remaining"], p["eta_seconds"], p["state"]) == (0.25, 150, 15, "active")
    p = spark.range(1).select(*[v.alias(k) for k, v in ig.ingest_progress(F.lit(0), 200, F.lit(0)).items()]).first()
    assert p["state"] == "empty" and p["eta_seconds"] is None


def test_read_first_available_and_row_count(spark, tmpdir_path):
    df = tb.read_first_available(spark, [f"{tmpdir_path}/nope", f"{SF_SMALL}/region.parquet"])
    assert df.count() == 5
    assert tb.table_row_count(spark, f"{tmpdir_path}/nope").first()[0] == 0


def test_items_csv_quoted_commas(spark, tmpdir_path):
    _write_lines(tmpdir_path, "movies.csv", ["movieId,title,genres", '1,"Heat, The (1995)",Action|Crime',
                                             "2,Toy Story (1995),Animation"])
    got = rows(tb.read_items_csv(spark, f"{tmpdir_path}/movies.csv"))
    assert got[0] == (1, "Heat, The (1995)", "Action|Crime")


def test_commit_history_skips_broken_lines(spark, tmpdir_path):
    log = os.path.join(tmpdir_path, "ratings", "_delta_log")
    _write_lines(log, "00000.json", [json.dumps({"commitInfo": {"timestamp": 1000, "operation": "WRITE"}}),
                                     json.dumps({"add": {"path": "x"}}), "", "{broken"])
    _write_lines(log, "00001.json", [json.dumps({"commitInfo": {"timestamp": 5000, "operation": "MERGE"}})])
    h = tb.commit_history(spark, f"{tmpdir_path}/*/_delta_log/*.json").first()
    assert (h["commits"], h["first_commit_ms"], h["last_commit_ms"]) == (2, 1000, 5000)
    assert list(h["operations"]) == ["MERGE", "WRITE"]


def test_file_inventory(spark, tmpdir_path):
    for n in ("a.json", "b.JSON", "c.crc", "README"):
        _write_lines(tmpdir_path, n, ["x"])
    inv = {r["extension"]: r["files"] for r in tb.file_inventory(spark, tmpdir_path).collect()}
    assert inv == {"json": 2, "crc": 1, "(no ext)": 1}


def test_model_save_load_and_load_or_fit(spark, tmpdir_path):
    tr = spark.createDataFrame([(u, i, float((u + i) % 5 + 1)) for u in range(10) for i in range(8)],
                               "user_id int, item_id int, rating double")
    m = rs.fit_als(tr, rank=2, max_iter=2)
    tb.save_model(m, f"{tmpdir_path}/als")
    assert tb.load_model(ALSModel, f"{tmpdir_path}/als").rank == 2
    calls = []
    m2 = tb.load_or_fit(ALSModel, f"{tmpdir_path}/als2", lambda: calls.append(1) or rs.fit_als(tr, 2, 2))
    m3 = tb.load_or_fit(ALSModel, f"{tmpdir_path}/als2", lambda: calls.append(1) or rs.fit_als(tr, 2, 2))
    assert len(calls) == 1 and m2.rank == m3.rank == 2


def test_run_log_fixture(spark, tmpdir_path):
    log = rl.RunLog(spark, f"{tmpdir_path}/runlog")
    log.log_run("exp_a", "als", {"rank": 10}, {"rmse": 0.9, "mae": 0.7}, start_ms=1000, end_ms=5000)
    log.log_run("exp_a", "als", {"rank": 20}, {"rmse": 0.8}, start_ms=2000, end_ms=9000)
    log.log_run("exp_a", "lr", None, {"rmse": 1.0}, start_ms=3000, end_ms=3500)
    log.log_run("exp_b", "rf", None, {"f1": 0.7}, start_ms=4000, end_ms=4100)
    log.log_run("exp_b", "gbt", None, {"f1": 0.6}, status="FAILED", start_ms=4500, end_ms=4600)
    runs, metrics, exps = log.table(rl.RUNS), log.table(rl.METRICS), log.table(rl.EXPERIMENTS)
    assert exps.count() == 2
    assert rl.runs_with_metrics(runs, metrics).select("run_uuid").distinct().count() == 4
    wide = {r["name"]: r for r in rl.metrics_wide(runs, metrics).collect()}
    assert wide["als"]["rmse"] == 0.9 and "gbt" not in wide
    top = rl.longest_runs(runs, exps, 2).collect()
    assert [r["duration_ms"] for r in top] == [7000, 4000]
    spans = {r["runs"] for r in rl.experiment_spans(runs).collect()}
    assert spans == {3, 2}


def test_bounded_intake_and_ingest_until(spark, tmpdir_path):
    src, sink, ckpt = (os.path.join(tmpdir_path, x) for x in ("src", "sink", "ckpt"))
    for f in range(6):
        _write_lines(src, f"p{f}.json", [_msg(f, k, 4.0, k) for k in range(3)])
    raw = ig.read_rating_stream(spark, "files", path=src, max_per_trigger=2)
    q = ig.append_stream(ig.parse_ratings(raw), sink, ckpt, processing_time="1 second")
    n = ig.ingest_until(q, n_rows=6, seconds=120, poll=0.5)
    assert n >= 6 and not q.isActive
    # No micro-batch read more than 2 files (6 rows)
    assert all(p["numInputRows"] <= 6 for p in q.recentProgress)


def test_ingest_rate_streaming_form(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    _write_lines(src, "a.json", [_msg(1, k, 4.0, k) for k in range(5)])
    raw = ig.read_rating_stream(spark, "files", path=src, max_per_trigger=1)
    rate = ig.ingest_rate_stream(ig.parse_ratings(raw), "processed_at", seconds=3)
    q = (rate.writeStream.format("memory").queryName("rate_test").outputMode("update")
         .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("rate_test").agg(F.max("rows_added")).first()[0]
    assert got == 5


def test_select_available_falls_back(spark):
    from ratings_engine.operators.encode import select_available
    df = spark.createDataFrame([(1, 2, 3.0)], "user_id int, item_id int, a double")
    assert select_available(df, ["a", "b", "c"], ["user_id", "item_id"]).columns == ["user_id", "item_id"]
    df2 = df.withColumn("b", F.lit(1))
    assert select_available(df2, ["a", "b", "c"], ["user_id", "item_id"]).columns == ["a", "b"]


def test_best_row_and_leaderboard(spark):
    res = spark.createDataFrame([("lr", 0.9), ("rf", 0.8), ("gbt", 0.8), ("dt", 1.1)], "model string, rmse double")
    b = rl.best_row(res, "rmse", "model").first()
    assert (b["model"], b["rmse"]) == ("gbt", 0.8)
    top = rl.leaderboard(res, "rmse", 2, True, ["model"]).collect()
    assert [(r["model"], r["position"]) for r in top] == [("gbt", 1), ("rf", 2)]


def test_load_or_fit_als_fallback_parameters(spark, tmpdir_path):
    tr = spark.createDataFrame([(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(9)],
                               "user_id int, item_id int, rating double")
    m = rs.load_or_fit_als(f"{tmpdir_path}/als_fallback", tr, max_iter=2)
    assert m.rank == 10
    assert rs.load_or_fit_als(f"{tmpdir_path}/als_fallback", tr, rank=3).rank == 10   # loaded, not refit
