import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratings_engine.functions import items as fi
from ratings_engine.operators import features as fe
from ratings_engine.operators.windows import ordered_sequence
from tests.conftest import SF_SMALL, rows

RSCHEMA = "user_id int, item_id int, rating double, ts long, row_key string"


def test_titles_odd(spark):
    df = spark.createDataFrame([
        (1, "No Year Here", "A|B"), (2, "Spaced (1995) ", "(no genres listed)"),
        (3, "Middle (1990) Title", None), (4, "Good (2001)", "X")], "item_id int, title string, genres string")
    got = {r[0]: tuple(r[1:]) for r in fi.item_features(df).collect()}
    assert got[1] == (None, 2, "A")
    assert got[2] == (1995, 0, "(no genres listed)")
    assert got[3] == (None, None, None)
    assert got[4] == (2001, 1, "X")
    filled = df.select(fi.fill_unknown_col(fi.primary_genre_col("genres"))).collect()
    assert filled[2][0] == "Unknown"


def test_item_age_zero_without_year(spark):
    df = spark.createDataFrame([(2000, None), (2000, 2005)], "ry int, ty int")
    assert [r[0] for r in df.select(fi.item_age_col(F.col("ry"), F.col("ty"))).collect()] == [0, -5]


def test_single_rating_user(spark):
    df = spark.createDataFrame([(7, 1, 4.0, 1_000_000, "k")], RSCHEMA)
    u = fe.user_features(df).first()
    assert u["user_rating_variance"] is None and u["user_activity_days"] == 0
    o = fe.rating_order(df).first()
    assert o["rating_order"] == 1 and o["time_since_last_rating"] == 0


def _random_ratings(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        u = 1 if rnd.random() < 0.4 else rnd.randint(2, 40)       # user 1 holds ~40% of rows
        data.append((u, rnd.randint(1, 50), rnd.choice([1.0, 2.5, 4.0]), rnd.randint(0, 500) * 3600, f"k{i}"))
    return spark.createDataFrame(data, RSCHEMA)


def test_ordered_sequence_matches_plain_window_on_hot_user(spark):
    df = _random_ratings(spark)
    w = Window.partitionBy("user_id").orderBy("ts", "item_id", "row_key")
    plain = df.select("row_key", F.row_number().over(w).alias("rn"), F.lag("ts").over(w).alias("prev"))
    for hot, per_task in ((50, 100), (200, 300), (10_000, None)):
        seg = ordered_sequence(df, "user_id", ["ts", "item_id", "row_key"], "ts", rn_col="rn", prev_col="prev",
                               hot_rows=hot, rows_per_task=per_task)
        assert rows(seg, "row_key", "rn", "prev") == rows(plain)


def test_rating_order_is_one_to_n_per_user(spark):
    df = _random_ratings(spark, 800, 3)
    o = fe.rating_order(df, hot_rows=40, rows_per_task=50)
    chk = o.groupBy("user_id").agg(F.count("*").alias("n"), F.min("rating_order").alias("lo"),
                                   F.max("rating_order").alias("hi"), F.countDistinct("rating_order").alias("d"))
    assert chk.where("lo != 1 or hi != n or d != n").count() == 0


def test_all_features_keeps_row_count(spark):
    from ratings_engine.sources.views import items_view, ratings_view
    r = ratings_view(spark, SF_SMALL)
    f = fe.all_features(r, items_view(spark, SF_SMALL))
    assert f.count() == r.count()
    assert {"genre_encoded", "genre_index", "rating_order", "user_genre_avg_rating"} <= set(f.columns)


def test_zero_fill_only_present_columns(spark):
    df = spark.createDataFrame([(None, float("nan"))], "a int, b double")
    r = fe.zero_fill(df, ["a", "b", "missing"]).first()
    assert r["a"] == 0.0 and r["b"] != r["b"]   # NaN kept


def test_ordered_sequence_null_order_values_on_hot_key(spark):
    # one hot user, a burst of equal timestamps and NULL timestamps
    data = [(1, i, 1.0, None if i % 7 == 0 else (500 if i % 3 == 0 else i * 10), f"k{i:03d}") for i in range(60)]
    df = spark.createDataFrame(data, RSCHEMA)
    w = Window.partitionBy("user_id").orderBy("ts", "item_id", "row_key")
    plain = df.select("row_key", F.row_number().over(w).alias("rn"), F.lag("ts").over(w).alias("prev"))
    seg = ordered_sequence(df, "user_id", ["ts", "item_id", "row_key"], "ts", rn_col="rn", prev_col="prev",
                           hot_rows=10, rows_per_task=8)
    assert rows(seg, "row_key", "rn", "prev") == rows(plain)


def test_ordered_sequence_hot_null_key(spark):
    data = [(None if i < 40 else 2, i % 5, 1.0, i, f"k{i:03d}") for i in range(50)]
    df = spark.createDataFrame(data, RSCHEMA)
    w = Window.partitionBy("user_id").orderBy("ts", "item_id", "row_key")
    plain = df.select("row_key", F.row_number().over(w).alias("rn"), F.lag("ts").over(w).alias("prev"))
    seg = ordered_sequence(df, "user_id", ["ts", "item_id", "row_key"], "ts", rn_col="rn", prev_col="prev",
                           hot_rows=5, rows_per_task=7)
    assert rows(seg, "row_key", "rn", "prev") == rows(plain)


def test_salted_join_equals_plain_join(spark):
    from ratings_engine.operators.windows import salted_join
    df = _random_ratings(spark, 1500, 11)
    stats = df.groupBy("user_id").agg(F.count("*").alias("n"), F.avg("rating").alias("m"))
    plain = df.join(stats, "user_id", "left")
    for hot in (30, 100_000):
        got = salted_join(df, stats, "user_id", "n", ["row_key"], hot_rows=hot)
        assert rows(got, "row_key", "n", "m") == rows(plain, "row_key", "n", "m")


def test_user_category_mean_null_category_and_hot_user(spark):
    data = [(1, i, float(i % 5), i, f"k{i}", None if i % 4 == 0 else f"g{i % 3}") for i in range(80)] + \
           [(2, 1, 3.0, 1, "z1", "g0")]
    df = spark.createDataFrame(data, RSCHEMA + ", primary_genre string")
    plain = df.join(df.groupBy("user_id", "primary_genre").agg(F.round(F.avg("rating"), 3).alias("m")),
                    ["user_id", "primary_genre"], "left")
    for hot in (10, 10_000):
        got = fe.user_category_mean(df, hot_rows=hot)
        assert rows(got, "row_key", "user_genre_avg_rating") == rows(plain, "row_key", "m")


def test_item_attributes_salted(spark):
    """A hot item, an unknown one and a NULL one (which matches nothing) keep all rows once."""
    data = [(u, 1, 4.0, u, f"h{u}") for u in range(50)] + [(1, 2, 3.0, 5, "x"), (2, 7, 2.0, 6, "y"), (3, None, 1.0, 7, "z")]
    df = spark.createDataFrame(data, RSCHEMA)
    dim = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (None, "D")], "item_id int, primary_genre string")
    want = sorted([(f"h{u}", "A") for u in range(50)] + [("x", "B"), ("y", "-"), ("z", "-")])
    for hot in (4, 1000):
        got = fi.with_item_attributes(df, dim, hot_rows=hot)
        assert got.columns == [*df.columns, "primary_genre"]
        assert rows(got.fillna("-", ["primary_genre"]), "row_key", "primary_genre") == want


def test_item_features_salted(spark):
    data = [(u, 1, float(u % 5), 86400 * u, f"h{u}") for u in range(50)] + [(1, None, 3.0, 5, "x"), (2, 7, 2.0, 6, "y")]
    df = spark.createDataFrame(data, RSCHEMA)
    dim = spark.createDataFrame([(1, "T (1960)", "A|B")], "item_id int, title string, genres string")
    a, b = (fe.item_features(df, dim, hot_rows=h) for h in (4, 1000))
    assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert {r["row_key"]: r["item_rating_count"] for r in a.collect()}["x"] == 1
