"""Descriptive statistics over a ratings table.

All aggregates are plain ``groupBy().agg`` so Spark runs a partial
aggregate before the shuffle: a hot user or item costs one row per map task,
not one giant group. Global values (min/max, totals) are one-row aggregates
joined back with a one-row cross product, never collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import COLS, Cols
from ..functions.quantiles import approx_quantiles, box_plot
from ..functions.formatting import short_title
from ..functions.temporal import rating_year_col, month_col


def group_stats(r: DataFrame, key: str, digits: int = 2, c: Cols = COLS) -> DataFrame:
    """round(avg(rating), digits) and count(rating) per key."""
    return r.groupBy(key).agg(
        F.round(F.avg(c.rating), digits).alias("avg_rating"),
        F.count(c.rating).alias("num_ratings"))


def item_stats(r: DataFrame, c: Cols = COLS) -> DataFrame:
    """A1 movie_stats: per item round(avg,2), count. Order only at presentation."""
    return group_stats(r, c.item, 2, c)


def user_stats(r: DataFrame, c: Cols = COLS) -> DataFrame:
    """A2 user_stats."""
    return group_stats(r, c.user, 2, c)


def rating_distribution(r: DataFrame, c: Cols = COLS) -> DataFrame:
    """A3: rows per rating value."""
    return r.groupBy(c.rating).agg(F.count(F.lit(1)).alias("n"))


def ratings_per_year(r: DataFrame, c: Cols = COLS) -> DataFrame:
    """A4: rows per calendar year of the epoch-seconds ``ts``."""
    return r.groupBy(rating_year_col(c.ts).alias("year")).agg(F.count(F.lit(1)).alias("n"))


def attach_titles(top: DataFrame, items: DataFrame, title_len: int = 35, c: Cols = COLS) -> DataFrame:
    """Left-join a k-row top list to the item dimension without shuffling the dimension.

    The dimension is first semi-joined against the k keys (broadcast of k
    keys), leaving at most k dimension rows, which are then broadcast into
    the left join that keeps every top row.
    """
    keys = top.select(c.item)
    dim_k = items.join(F.broadcast(keys), c.item, "left_semi") \
        .select(c.item, short_title(c.title, title_len).alias("short_title"))
    return top.join(F.broadcast(dim_k), c.item, "left")


def top_items_by_count(r: DataFrame, items: DataFrame, k: int = 20, title_len: int = 35,
                       c: Cols = COLS) -> DataFrame:
    """A5: top-k items by count (tie: item id), limited before the dim join."""
    top = (r.groupBy(c.item)
           .agg(F.count(F.lit(1)).alias("num_ratings"), F.round(F.avg(c.rating), 2).alias("avg_rating"))
           .orderBy(F.desc("num_ratings"), F.asc(c.item)).limit(k))
    return attach_titles(top, items, title_len, c)


def top_items_by_mean(r: DataFrame, items: DataFrame, k: int = 20, min_n: int = 500,
                      title_len: int = 35, c: Cols = COLS) -> DataFrame:
    """HAVING count >= min_n, top-k by round(avg,3) (tie: count desc, item id)."""
    top = (r.groupBy(c.item)
           .agg(F.count(F.lit(1)).alias("num_ratings"), F.round(F.avg(c.rating), 3).alias("avg_rating"))
           .where(F.col("num_ratings") >= min_n)
           .orderBy(F.desc("avg_rating"), F.desc("num_ratings"), F.asc(c.item)).limit(k))
    return attach_titles(top, items, title_len, c)


def user_activity(r: DataFrame, c: Cols = COLS) -> DataFrame:
    """Ratings per user."""
    return r.groupBy(c.user).agg(F.count(F.lit(1)).alias("n"))


def activity_histogram(r: DataFrame, bins: int = 60, c: Cols = COLS) -> DataFrame:
    """Equal-width histogram of ratings-per-user; last bin closed."""
    act = user_activity(r, c)
    rng = act.agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    b = F.least(F.width_bucket(F.col("n").cast("double"), F.col("lo").cast("double"),
                               F.col("hi").cast("double"), F.lit(bins)), F.lit(bins))
    return (act.crossJoin(F.broadcast(rng))  # one-row side
            .groupBy(b.alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("n_users"))
            .select("bin",
                    F.round(F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / F.lit(bins), 6)
                    .alias("bin_start"),
                    F.round(F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.lit(bins), 6)
                    .alias("bin_end"),
                    "n_users"))


def five_number_summary(values: DataFrame, col: str, exact: bool = True, rel_err: float = 0.01) -> DataFrame:
    """q1, median, q3, whisker ends at 1.5 IQR and the outlier count (box plot)."""
    if exact:
        return box_plot(values, col)
    q = approx_quantiles(values, col, {"q1": 0.25, "median": 0.5, "q3": 0.75}, rel_err)
    q = q.select("q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    v = F.col(col).cast("double")
    j = values.select(v.alias("_v")).crossJoin(F.broadcast(q))
    return j.groupBy("q1", "median", "q3", "iqr").agg(
        F.min(F.when(F.col("_v") >= lo_f, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(F.col("_v") <= hi_f, F.col("_v"))).alias("whisker_high"),
        F.count_if((F.col("_v") < lo_f) | (F.col("_v") > hi_f)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))


def genre_stats(r: DataFrame, items: DataFrame, digits: int = 3, none_label: str = "(no genres listed)",
                c: Cols = COLS) -> DataFrame:
    """A10: explode genres, drop the 'none' label and NULLs, round(avg,3), count.

    Ratings are pre-aggregated per item before the join, so the join moves one
    row per item instead of one per rating; a hot item cannot skew it.
    """
    per_item = r.groupBy(c.item).agg(F.sum(c.rating).alias("_s"), F.count(c.rating).alias("_n"))
    g = items.select(c.item, F.explode(F.split(c.genres, r"\|")).alias("genre")) \
        .where(F.col("genre").isNotNull() & (F.col("genre") != none_label))
    return (per_item.join(g, c.item, "inner").groupBy("genre")
            .agg(F.round(F.sum("_s") / F.sum("_n"), digits).alias("avg_rating"),
                 F.sum("_n").alias("num_ratings")))


def monthly_heatmap(r: DataFrame, year_lo: int = 2000, year_hi: int = 2019, c: Cols = COLS) -> DataFrame:
    """Month x year counts within [year_lo, year_hi]; missing cells are 0."""
    years = list(range(year_lo, year_hi + 1))
    t = r.select(rating_year_col(c.ts).alias("year"), month_col(c.ts).alias("month")) \
        .where(F.col("year").between(year_lo, year_hi))
    return t.groupBy("month").agg(
        *[F.count_if(F.col("year") == y).alias(str(y)) for y in years])


def mean_rating_per_year(r: DataFrame, year_lo: int = 1995, year_hi: int = 2019, digits: int = 3,
                         c: Cols = COLS) -> DataFrame:
    """round(avg,3) per year in range, and the unweighted mean of those yearly means."""
    y = (r.select(rating_year_col(c.ts).alias("year"), c.rating)
         .where(F.col("year").between(year_lo, year_hi))
         .groupBy("year").agg(F.round(F.avg(c.rating), digits).alias("avg_rating"),
                              F.count(F.lit(1)).alias("n")))
    overall = y.agg(F.round(F.avg("avg_rating"), digits).alias("mean_of_means"))
    return y.crossJoin(F.broadcast(overall))  # one row per year x one row
