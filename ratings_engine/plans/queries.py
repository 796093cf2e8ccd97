"""Registered queries over the driver tables (see registry.py).

Each builder re-expresses one operator of the survey on the R / I / E views;
the SQL next to it is an independent DuckDB formulation used as the oracle.
Oracles round in decimal (``rd``) because Spark rounds doubles half-up on
their shortest decimal form.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import COLS as C
from ..functions import items as fi
from ..functions import temporal as ft
from ..operators import stats
from ..sources.views import events_view, items_view, ratings_view
from .registry import register

# Small-scale thresholds: at sf0.01 the busiest user has 93 ratings and the
# busiest item 49, so the reference defaults (10 000 / 500 / 50) would select
# nothing. The defaults stay on the operator functions.
MIN_N_TOP_MEAN = 30
HYPERACTIVE_MIN = 60
SUSPICIOUS_MIN_N = 20
SUSPICIOUS_MAX_SD = 1.3


def rd(expr: str, d: int) -> str:
    return f"cast(round(cast({expr} as decimal(38,12)), {d}) as double)"


def R(spark, sf):
    return ratings_view(spark, sf)


def I(spark, sf):  # noqa: E743
    return items_view(spark, sf)


def E(spark, sf):
    return events_view(spark, sf)


TS = "epoch_ms(ts*1000)"

# ---------------------------------------------------------------- A1-A12


@register("a1_item_stats", f"""
select item_id, {rd('avg(rating)', 2)} as avg_rating, count(rating) as num_ratings
from {{R}} r group by item_id""")
def q_a1(spark, sf):
    return stats.item_stats(R(spark, sf))


@register("a2_user_stats", f"""
select user_id, {rd('avg(rating)', 2)} as avg_rating, count(rating) as num_ratings
from {{R}} r group by user_id""")
def q_a2(spark, sf):
    return stats.user_stats(R(spark, sf))


@register("a3_rating_distribution", """
select rating, count(*) as n from {R} r group by rating""")
def q_a3(spark, sf):
    return stats.rating_distribution(R(spark, sf))


@register("a4_ratings_per_year", f"""
select cast(year({TS}) as int) as year, count(*) as n from {{R}} r group by 1""")
def q_a4(spark, sf):
    return stats.ratings_per_year(R(spark, sf))


@register("a5_top_items_by_count", f"""
with t as (select item_id, count(*) as num_ratings, {rd('avg(rating)', 2)} as avg_rating
           from {{R}} r group by item_id order by num_ratings desc, item_id limit 20)
select t.item_id, t.num_ratings, t.avg_rating, substr(i.title, 1, 35) as short_title
from t left join {{I}} i on t.item_id = i.item_id""")
def q_a5(spark, sf):
    return stats.top_items_by_count(R(spark, sf), I(spark, sf), k=20)


@register("a6_top_items_by_mean", f"""
with t as (select item_id, count(*) as num_ratings, {rd('avg(rating)', 3)} as avg_rating
           from {{R}} r group by item_id having count(*) >= {MIN_N_TOP_MEAN}
           order by avg_rating desc, num_ratings desc, item_id limit 20)
select t.item_id, t.num_ratings, t.avg_rating, substr(i.title, 1, 35) as short_title
from t left join {{I}} i on t.item_id = i.item_id""")
def q_a6(spark, sf):
    return stats.top_items_by_mean(R(spark, sf), I(spark, sf), k=20, min_n=MIN_N_TOP_MEAN)


@register("a7_user_activity", """
select user_id, count(*) as n from {R} r group by user_id""")
def q_a7(spark, sf):
    return stats.user_activity(R(spark, sf))


@register("a8_activity_histogram", """
with a as (select user_id, count(*) as n from {R} r group by user_id),
     m as (select min(n) as lo, max(n) as hi from a),
     b as (select least(cast(floor(60 * cast(n - lo as double) / cast(hi - lo as double)) as bigint) + 1, 60) as bin,
                  lo, hi from a, m)
select cast(bin as bigint) as bin, round(lo + (bin - 1) * (hi - lo) / 60.0, 6) as bin_start,
       round(lo + bin * (hi - lo) / 60.0, 6) as bin_end, count(*) as n_users
from b group by bin, lo, hi""")
def q_a8(spark, sf):
    return stats.activity_histogram(R(spark, sf), bins=60)


@register("a9_five_number_summary", """
with a as (select user_id, cast(count(*) as double) as n from {R} r group by user_id),
     q as (select quantile_cont(n, 0.25) as q1, quantile_cont(n, 0.5) as median,
                  quantile_cont(n, 0.75) as q3 from a),
     f as (select q1, median, q3, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from q)
select q1, median, q3, iqr, min(case when n >= lo then n end) as whisker_low,
       max(case when n <= hi then n end) as whisker_high,
       count(*) filter (where n < lo or n > hi) as n_outliers, count(*) as n
from a, f group by q1, median, q3, iqr""")
def q_a9(spark, sf):
    return stats.five_number_summary(stats.user_activity(R(spark, sf)), "n")


@register("a10_genre_stats", f"""
with g as (select item_id, unnest(string_split(genres, '|')) as genre from {{I}} i)
select genre, {rd('avg(rating)', 3)} as avg_rating, count(*) as num_ratings
from {{R}} r join g using (item_id)
where genre is not null and genre <> '(no genres listed)' group by genre""")
def q_a10(spark, sf):
    return stats.genre_stats(R(spark, sf), I(spark, sf))


_HEAT_COLS = ", ".join(f"count(*) filter (where y = {y}) as \"{y}\"" for y in range(2000, 2020))


@register("a11_monthly_heatmap", f"""
select m as month, {_HEAT_COLS}
from (select cast(year({TS}) as int) as y, cast(month({TS}) as int) as m from {{R}} r) t
where y between 2000 and 2019 group by m""")
def q_a11(spark, sf):
    return stats.monthly_heatmap(R(spark, sf), 2000, 2019)


@register("a12_mean_rating_per_year", f"""
with y as (select cast(year({TS}) as int) as year, {rd('avg(rating)', 3)} as avg_rating, count(*) as n
           from {{R}} r where year({TS}) between 1995 and 2019 group by 1)
select year, avg_rating, n, (select {rd('avg(avg_rating)', 3)} from y) as mean_of_means from y""")
def q_a12(spark, sf):
    return stats.mean_rating_per_year(R(spark, sf), 1995, 2019)


# ---------------------------------------------------------------- P2-P15


@register("p2_epoch_to_timestamp", f"""
select row_key, strftime({TS}, '%Y-%m-%d %H:%M:%S') as rating_date from {{R}} r""")
def q_p2(spark, sf):
    r = ft.epoch_to_timestamp(R(spark, sf))
    return r.select(C.key, F.date_format("rating_date", "yyyy-MM-dd HH:mm:ss").alias("rating_date"))


@register("p3_p5_p6_p7_p9_calendar", f"""
select row_key, cast(isodow({TS}) - 1 as int) as day_of_week, cast(month({TS}) as int) as month,
       case when month({TS}) in (3,4,5) then 1 when month({TS}) in (6,7,8) then 2
            when month({TS}) in (9,10,11) then 3 else 4 end as season,
       case when isodow({TS}) - 1 in (5, 6) then 1 else 0 end as is_weekend,
       cast(year({TS}) as int) as rating_year
from {{R}} r""")
def q_p3(spark, sf):
    r = R(spark, sf)
    dow, mon = ft.day_of_week_col(C.ts), ft.month_col(C.ts)
    return r.select(C.key, dow.alias("day_of_week"), mon.alias("month"),
                    ft.season_col(mon).alias("season"), ft.is_weekend_col(dow).alias("is_weekend"),
                    ft.rating_year_col(C.ts).alias("rating_year"))


@register("p4_p8_hour_and_period", """
select event_id, cast(hour(ts) as int) as hour_of_day,
       case when hour(ts) >= 6 and hour(ts) < 12 then 1 when hour(ts) >= 12 and hour(ts) < 18 then 2
            when hour(ts) >= 18 and hour(ts) < 24 then 3 else 0 end as day_period,
       cast(isodow(ts) - 1 as int) as day_of_week
from events""")
def q_p4(spark, sf):
    e = E(spark, sf)
    hr = ft.hour_col("ts", epoch=False)
    return e.select("event_id", hr.alias("hour_of_day"), ft.day_period_col(hr).alias("day_period"),
                    ft.day_of_week_col("ts", epoch=False).alias("day_of_week"))


@register("p10_between_years", f"""
select row_key, rating from {{R}} r where year({TS}) between 1996 and 1998""")
def q_p10(spark, sf):
    return ft.between_years(R(spark, sf), 1996, 1998).select(C.key, C.rating)


@register("p11_p12_p13_item_columns", r"""
select item_id, try_cast(nullif(regexp_extract(title, '\((\d{4})\)\s*$', 1), '') as int) as movie_year,
       cast(case when genres = '(no genres listed)' then 0 else len(string_split(genres, '|')) end as int)
         as genre_count,
       string_split(genres, '|')[1] as primary_genre
from {I} i""")
def q_p11(spark, sf):
    return fi.item_features(I(spark, sf))


_ITEM_AGE_SQL = r"""
select r.row_key,
       case when try_cast(nullif(regexp_extract(i.title, '\((\d{4})\)\s*$', 1), '') as int) is null then 0
            else cast(year(epoch_ms(r.ts*1000)) as int)
                 - try_cast(nullif(regexp_extract(i.title, '\((\d{4})\)\s*$', 1), '') as int) end as item_age,
       coalesce(string_split(i.genres, '|')[1], 'Unknown') as primary_genre
from {R} r left join {I} i on r.item_id = i.item_id"""


def _item_age(spark, sf, **hot):
    j = fi.with_item_attributes(R(spark, sf), fi.item_features(I(spark, sf)), **hot)
    return j.select(C.key,
                    fi.item_age_col(ft.rating_year_col(C.ts), F.col("movie_year")).alias("item_age"),
                    fi.fill_unknown_col("primary_genre").alias("primary_genre"))


@register("p14_p15_item_age", _ITEM_AGE_SQL)
def q_p14(spark, sf):
    return _item_age(spark, sf)


@register("j1_item_age_hot_split", _ITEM_AGE_SQL)
def q_j1_hot(spark, sf):
    """Same as p14_p15 with a hot-item threshold of 20 rows (salted join)."""
    return _item_age(spark, sf, hot_rows=20)


# ---------------------------------------------------------------- P22-P24


@register("p22_p24_format_columns", """
with a as (select item_id, count(*) * 1000 as n from {R} r group by item_id)
select a.item_id, a.n,
       case when n >= 1e6 then printf('%.2fM', n / 1e6) when n >= 1e3 then printf('%.1fK', n / 1e3)
            else cast(cast(n as bigint) as varchar) end as n_text,
       substr(i.title, 1, 35) as short_title
from a join {I} i using (item_id)""")
def q_p22(spark, sf):
    from ..functions.formatting import format_magnitude, short_title
    a = R(spark, sf).groupBy(C.item).agg((F.count(F.lit(1)) * 1000).alias("n"))
    return a.join(I(spark, sf), C.item).select(C.item, "n", format_magnitude("n").alias("n_text"),
                                              short_title(C.title).alias("short_title"))


# Further query groups register themselves on import.
from . import q_quality, q_features, q_eval, q_io, q_models  # noqa: E402,F401
