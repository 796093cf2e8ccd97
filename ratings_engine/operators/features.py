"""Wide feature table.

Whole-group statistics (user, item, user x category) are computed with
``groupBy`` -- partial aggregation before the shuffle -- and joined back,
instead of unordered windows that would buffer a hot user's or item's rows in
one task. The stats tables are also reusable: fit on train, apply to test
(``user_features(test, stats=user_stats_table(train))``), which avoids the
leakage of computing them on all rows. Only rating order / time since the
previous rating need an ordered window; that one goes through the skew-safe
``ordered_sequence``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COLS, DEFAULTS, Cols
from ..functions import items as fi
from ..functions import temporal as ft
from ..functions.quantiles import rounded_variance
from .windows import DEFAULT_HOT_ROWS, _null_safe, hot_keys, ordered_sequence, salted_join


def user_stats_table(r: DataFrame, c: Cols = COLS) -> DataFrame:
    """W1 + W2 per user: round(avg,3), count, round(var_samp,4), activity days."""
    t = F.timestamp_seconds(F.col(c.ts))
    return r.groupBy(c.user).agg(
        F.round(F.avg(c.rating), 3).alias("user_avg_rating"),
        F.count(F.lit(1)).alias("user_rating_count"),
        rounded_variance(F.col(c.rating), 4).alias("user_rating_variance"),
        F.datediff(F.max(t), F.min(t)).alias("user_activity_days"))


def _salt_cols(df: DataFrame, c: Cols) -> list[str]:
    return [c.key] if c.key in df.columns else [x for x in (c.ts, c.item) if x in df.columns]


def user_features(r: DataFrame, stats: DataFrame | None = None, c: Cols = COLS,
                  hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Join the user stats back (salted for hot users);
    deviation = round(rating - rounded mean, 3)."""
    s = user_stats_table(r, c) if stats is None else stats
    j = salted_join(r, s, c.user, "user_rating_count", _salt_cols(r, c), hot_rows=hot_rows)
    return j.withColumn("user_rating_deviation", F.round(F.col(c.rating) - F.col("user_avg_rating"), 3))


def item_stats_table(r: DataFrame, c: Cols = COLS, recent_years: int = 1) -> DataFrame:
    """W3 + W4 per item: round(avg,3), count and the share of ratings from the
    last ``recent_years`` + 1 calendar years of the whole table (4 dp).

    The global max year is a one-row aggregate joined in, not a driver action.
    """
    yr = ft.rating_year_col(c.ts)
    max_year = r.agg(F.max(yr).alias("_max_year"))
    x = r.select(c.item, c.rating, yr.alias("_y")).crossJoin(F.broadcast(max_year))  # one-row side
    return x.groupBy(c.item).agg(
        F.round(F.avg(c.rating), 3).alias("item_avg_rating"),
        F.count(F.lit(1)).alias("item_rating_count"),
        F.round(F.count_if(F.col("_y") >= F.col("_max_year") - recent_years) / F.count(F.lit(1)), 4)
        .alias("item_popularity_trend"))


def with_item_stats(r: DataFrame, stats: DataFrame | None = None, c: Cols = COLS,
                    hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Item stats joined back (salted for hot items)."""
    s = item_stats_table(r, c) if stats is None else stats
    return salted_join(r, s, c.item, "item_rating_count", _salt_cols(r, c), hot_rows=hot_rows)


def item_features(r: DataFrame, items: DataFrame, stats: DataFrame | None = None,
                  c: Cols = COLS, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Item stats and dimension attributes joined back
    (together, salted for hot items)."""
    s = item_stats_table(r, c) if stats is None else stats
    dim = items.select(c.item, fi.title_year_col(c.title).alias("movie_year"),
                       fi.genre_count_col(c.genres).alias("genre_count"),
                       fi.primary_genre_col(c.genres).alias("primary_genre"), c.genres)
    j = with_item_stats(r, s.join(dim, c.item, "left"), c, hot_rows)
    ry = ft.rating_year_col(c.ts)
    return j.withColumns({
        "rating_year": ry,
        "item_age": fi.item_age_col(ry, F.col("movie_year")),
    })


def user_category_mean(r: DataFrame, category: str = "primary_genre", c: Cols = COLS,
                       hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """round(avg,3) per (user, category), joined back on both keys.

    One statistics row per pair, however many categories a user or the table has; the
    join is salted by the pair's row count, so neither a hot user nor a hot pair
    meets in one task. A NULL category has no mean.
    """
    per = (r.where(F.col(category).isNotNull()).groupBy(c.user, category)
           .agg(F.round(F.avg(c.rating), 3).alias("user_genre_avg_rating"), F.count(F.lit(1)).alias("_n")))
    return salted_join(r, per, [c.user, category], "_n", _salt_cols(r, c), hot_rows=hot_rows).drop("_n")


def rating_order(r: DataFrame, c: Cols = COLS, hot_rows: int = DEFAULT_HOT_ROWS,
                 rows_per_task: int | None = None, hot: tuple | None = None) -> DataFrame:
    """W6 + W7: rating_order = row_number by (ts, item, row_key) within user;
    time_since_last_rating = ts - previous ts, 0 for the first rating."""
    order = [c.ts, c.item] + ([c.key] if c.key in r.columns else [])
    s = ordered_sequence(r, c.user, order, c.ts, rn_col="rating_order", prev_col="_prev_ts",
                         hot_rows=hot_rows, rows_per_task=rows_per_task, hot=hot)
    return s.withColumn("time_since_last_rating",
                        F.when(F.col("_prev_ts").isNotNull(), F.col(c.ts) - F.col("_prev_ts"))
                        .otherwise(F.lit(0)).cast("bigint")).drop("_prev_ts")


def zero_fill(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULL -> 0 and cast to double, for the listed columns that exist (NaN kept)."""
    present = set(cols) & set(df.columns)
    return df.select(*[F.coalesce(F.col(n), F.lit(0)).cast("double").alias(n) if n in present else F.col(n)
                       for n in df.columns])


def binary_label_col(col: str | Column = COLS.rating, threshold: float = DEFAULTS.like_threshold) -> Column:
    """>= threshold -> 1.0 else 0.0 (NULL -> 0.0; NaN -> 1.0, so clean first)."""
    x = F.col(col) if isinstance(col, str) else col
    return F.when(x >= threshold, F.lit(1.0)).otherwise(F.lit(0.0))


#: Rows dealt by user may meet a table by user and category without being dealt again.
BY_USER = {"spark__sql__requireAllClusterKeysForCoPartition": "false"}


def all_features(r: DataFrame, items: DataFrame, c: Cols = COLS, encode: bool = True,
                 hot_rows: int = DEFAULT_HOT_ROWS, materialize_input: bool = False, user_last: bool = False) -> DataFrame:
    """Temporal, user, item, category-encoding and interaction columns,
    with the reference's values. The row count is unchanged (all joins are
    left joins on keys that are unique on the statistics side).

    Every statistics table (user, item, user x category, label counts, hot
    users) is aggregated from the lean input ``r`` -- not from the widening
    frame -- so no branch re-runs the other joins. The ordered columns are
    computed first on the lean rows (their values do not depend on the
    other features). When ``r`` is itself expensive (a join or a view rather
    than a table scan) pass ``materialize_input=True`` to write it once.

    With ``user_last`` the item columns are joined first, on the lean rows. The ordered columns and the user columns then
    follow on rows dealt by user, one shuffle for both if it runs under ``BY_USER`` and no key is hot or NULL. Where ``items`` repeats an item the order stays.
    """
    from ..config import materialize
    from .encode import encode_category

    if materialize_input:
        r = materialize(r)
    dim = items.select(c.item, fi.title_year_col(c.title).alias("movie_year"),
                       fi.genre_count_col(c.genres).alias("genre_count"),
                       fi.fill_unknown_col(fi.primary_genre_col(c.genres)).alias("primary_genre"), c.genres)
    # Key-sized tables, each aggregated and written once: the joins below, the hot-key
    # tables and the label counts all read them.
    items_all = materialize(item_stats_table(r, c).join(dim, c.item, "left")
                            .withColumn("primary_genre", fi.fill_unknown_col("primary_genre")), "items")
    hot_items = hot_keys(items_all, c.item, "item_rating_count", hot_rows)
    salt = _salt_cols(r, c)
    r_cat = salted_join(r.select(*dict.fromkeys([c.user, c.item, c.rating, *salt])),
                        items_all.select(c.item, "item_rating_count", "primary_genre"), c.item, "item_rating_count",
                        salt, hot_rows=hot_rows, hot=hot_items).select(c.user, c.rating, "primary_genre")
    per = r_cat.groupBy(c.user, "primary_genre").agg(F.round(F.avg(c.rating), 3).alias("user_genre_avg_rating"),
                                                     F.count(F.lit(1)).alias("_pair_n"))
    # user columns ride on the (user, category) rows: one join of the wide frame brings both
    pairs = materialize(_null_safe(per, user_stats_table(r, c), [c.user], "left"), "pairs")
    hot_pairs = hot_keys(pairs, [c.user, "primary_genre"], "_pair_n", hot_rows)
    hot_users = hot_keys(pairs.groupBy(c.user).agg(F.max("user_rating_count").alias("_n")), c.user, "_n", hot_rows)

    with_items = lambda x: salted_join(x, items_all, c.item, "item_rating_count", salt, hot_rows=hot_rows, hot=hot_items)
    in_order = lambda x: rating_order(x, c, hot_rows, hot=hot_users)
    # a repeated item repeats its ratings, which are numbered before that
    user_last = user_last and items_all.groupBy(c.item).count().where("count > 1").isEmpty()
    df = in_order(with_items(r)) if user_last else with_items(in_order(r))
    if user_last and not hot_pairs[1] and pairs.where(F.col(c.user).isNull() | F.col("primary_genre").isNull()).isEmpty():
        df = df.join(pairs, [c.user, "primary_genre"], "left").drop("_pair_n")     # plain keys: rows dealt by user stay where they are
    else:
        df = salted_join(df, pairs, [c.user, "primary_genre"], "_pair_n", salt, hot_rows=hot_rows, hot=hot_pairs).drop("_pair_n")
    ry = ft.rating_year_col(c.ts)
    df = df.withColumns({"user_rating_deviation": F.round(F.col(c.rating) - F.col("user_avg_rating"), 3),
                         "rating_year": ry, "item_age": fi.item_age_col(ry, F.col("movie_year"))})
    # a function of ts alone: computed behind the shuffles, which need not carry it
    first = ft.temporal_features(r, c).columns
    df = ft.temporal_features(df, c).select(*first, *(n for n in df.columns if n not in first))
    if encode:
        counts = pairs.groupBy("primary_genre").agg(F.sum("_pair_n").alias("n"))
        df = encode_category(df, "primary_genre", "genre_index", "genre_encoded", counts=counts)
    return df
