"""Registered feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import items as fi
from ..operators import encode as en
from ..operators import features as fe
from ..sources.views import items_view, ratings_view
from .queries import TS, rd
from .registry import register

VAR = "(var_samp(rating) + 1e-9)"   # halves round up in both engines

_TITLE_YEAR = r"try_cast(nullif(regexp_extract(title, '\((\d{4})\)\s*$', 1), '') as int)"


_USER_SQL = f"""
with r as (select * from {{R}} r0),
us as (select user_id, {rd('avg(rating)', 3)} as user_avg_rating, count(*) as user_rating_count,
              {rd(VAR, 4)} as user_rating_variance,
              cast(datediff('day', cast(min({TS}) as date), cast(max({TS}) as date)) as int) as user_activity_days
       from r group by user_id)
select row_key, user_avg_rating, user_rating_count, user_rating_variance, user_activity_days,
       {rd('rating - user_avg_rating', 3)} as user_rating_deviation
from r left join us using (user_id)"""


@register("w1_w2_p20_user_features", _USER_SQL)
def q_w1(spark, sf):
    f = fe.user_features(ratings_view(spark, sf))
    return f.select("row_key", "user_avg_rating", "user_rating_count", "user_rating_variance",
                    "user_activity_days", "user_rating_deviation")


@register("w1_w2_p20_user_features_hot_split", _USER_SQL)
def q_w1_hot(spark, sf):
    """Same as w1 with a hot-user threshold of 20 rows: busy users' rows are
    salted over several join tasks (checks the salted join against the oracle)."""
    f = fe.user_features(ratings_view(spark, sf), hot_rows=20)
    return f.select("row_key", "user_avg_rating", "user_rating_count", "user_rating_variance",
                    "user_activity_days", "user_rating_deviation")


_ITEM_SQL = f"""
with r as (select * from {{R}} r0),
m as (select max(year({TS})) as max_year from r),
s as (select item_id, {rd('avg(rating)', 3)} as item_avg_rating, count(*) as item_rating_count,
             {rd('1.0 * count(*) filter (where year(' + TS + ') >= (select max_year from m) - 1) / count(*)', 4)}
               as item_popularity_trend
      from r group by item_id)
select row_key, item_avg_rating, item_rating_count, item_popularity_trend from r left join s using (item_id)"""


@register("w3_w4_item_features", _ITEM_SQL)
def q_w3(spark, sf):
    return fe.with_item_stats(ratings_view(spark, sf)).select(
        "row_key", "item_avg_rating", "item_rating_count", "item_popularity_trend")


@register("w3_w4_item_features_hot_split", _ITEM_SQL)
def q_w3_hot(spark, sf):
    """Same as w3 with a hot-item threshold of 20 rows (salted join)."""
    return fe.with_item_stats(ratings_view(spark, sf), hot_rows=20).select(
        "row_key", "item_avg_rating", "item_rating_count", "item_popularity_trend")


@register("w5_user_genre_mean", f"""
with r as (select r0.*, coalesce(string_split(i.genres, '|')[1], 'Unknown') as primary_genre
           from {{R}} r0 left join {{I}} i using (item_id))
select row_key, primary_genre,
       {rd('avg(rating) over (partition by user_id, primary_genre)', 3)} as user_genre_avg_rating
from r""")
def q_w5(spark, sf):
    r = ratings_view(spark, sf)
    i = items_view(spark, sf).select("item_id", fi.primary_genre_col("genres").alias("primary_genre"))
    r = fi.with_item_attributes(r, i).withColumn("primary_genre", fi.fill_unknown_col("primary_genre"))
    return fe.user_category_mean(r).select("row_key", "primary_genre", "user_genre_avg_rating")


_USER_ORDER_SQL = f"""
with r as (select r0.*, string_split(row_key, '-')[1] as order_id from {{R}} r0)
select row_key, order_id, {rd('avg(rating) over (partition by user_id, order_id)', 3)} as user_genre_avg_rating from r"""


def _by_order(spark, sf, **kw):
    r = ratings_view(spark, sf).withColumn("order_id", F.split("row_key", "-")[0])
    return fe.user_category_mean(r, "order_id", **kw).select("row_key", "order_id", "user_genre_avg_rating")


@register("w5_user_order_mean", _USER_ORDER_SQL)
def q_w5_order(spark, sf):
    """W5 with a category of many values (one per order, 15 000 at sf0.01)."""
    return _by_order(spark, sf)


@register("w5_user_order_mean_hot_split", _USER_ORDER_SQL)
def q_w5_order_hot(spark, sf):
    """Same, pairs of over two rows salted."""
    return _by_order(spark, sf, hot_rows=2)


_ORDER_SQL = """
select row_key,
       cast(row_number() over (partition by user_id order by ts, item_id, row_key) as int) as rating_order,
       cast(coalesce(ts - lag(ts) over (partition by user_id order by ts, item_id, row_key), 0) as bigint)
         as time_since_last_rating
from {R} r"""


@register("w6_w7_rating_order", _ORDER_SQL)
def q_w6(spark, sf):
    return fe.rating_order(ratings_view(spark, sf)).select("row_key", "rating_order", "time_since_last_rating")


@register("w6_w7_rating_order_hot_split", _ORDER_SQL)
def q_w6_hot(spark, sf):
    """Same result with a hot-group threshold of 20 rows and 5 000 rows per
    slice, so that busy users go through the range-sliced path and a user's
    rows span several slices: checks the skew path against the oracle."""
    return fe.rating_order(ratings_view(spark, sf), hot_rows=20, rows_per_task=5000).select(
        "row_key", "rating_order", "time_since_last_rating")


@register("p16_p17_zero_fill_and_label", """
select row_key, cast(coalesce(rating, 0) as double) as rating,
       case when rating >= 3.5 then 1.0 else 0.0 end as label_35,
       case when rating >= 4.0 then 1.0 else 0.0 end as label_40
from {R} r""")
def q_p16(spark, sf):
    r = fe.zero_fill(ratings_view(spark, sf), ["rating", "not_there"])
    return r.select("row_key", "rating", fe.binary_label_col("rating", 3.5).alias("label_35"),
                    fe.binary_label_col("rating", 4.0).alias("label_40"))


_LABELS_SQL = """lab as (select primary_genre, count(*) as n,
                row_number() over (order by count(*) desc, primary_genre) - 1 as idx
            from {src} group by primary_genre),
nl as (select count(*) as n_labels from lab)"""

_ONEHOT_SQL = ("'[' || array_to_string(list_transform(range((select n_labels from nl)), "
               "lambda x: case when x = lab.idx then '1.0' else '0.0' end), ', ') || ']'")


@register("e1_e2_p21_category_encoding", f"""
with g as (select coalesce(string_split(i.genres, '|')[1], 'Unknown') as primary_genre, r0.row_key
           from {{R}} r0 left join {{I}} i using (item_id)),
{_LABELS_SQL.format(src='g')}
select g.row_key, g.primary_genre, cast(lab.idx as double) as genre_index, {_ONEHOT_SQL} as genre_encoded_str
from g join lab using (primary_genre)""")
def q_e1(spark, sf):
    r = ratings_view(spark, sf)
    i = items_view(spark, sf).select("item_id", fi.primary_genre_col("genres").alias("primary_genre"))
    r = fi.with_item_attributes(r, i).withColumn("primary_genre", fi.fill_unknown_col("primary_genre"))
    enc = en.encode_category(r, "primary_genre")
    return en.vector_to_text(enc, "genre_encoded").select("row_key", "primary_genre", "genre_index",
                                                          "genre_encoded_str")


W10_COLUMNS = [
    "user_id", "item_id", "rating", "ts", "row_key", "rating_datetime", "day_of_week", "hour_of_day", "month",
    "season", "is_weekend", "day_period", "user_avg_rating", "user_rating_count", "user_rating_variance",
    "user_activity_days", "user_rating_deviation", "item_avg_rating", "item_rating_count",
    "item_popularity_trend", "movie_year", "genre_count", "primary_genre", "genres", "rating_year", "item_age",
    "genre_index", "genre_encoded_str", "user_genre_avg_rating", "rating_order", "time_since_last_rating"]


@register("w10_all_features", f"""
with r as (select * from {{R}} r0),
m as (select max(year({TS})) as max_year from r),
us as (select user_id, {rd('avg(rating)', 3)} as user_avg_rating, count(*) as user_rating_count,
              {rd(VAR, 4)} as user_rating_variance,
              cast(datediff('day', cast(min({TS}) as date), cast(max({TS}) as date)) as int) as user_activity_days
       from r group by user_id),
its as (select item_id, {rd('avg(rating)', 3)} as item_avg_rating, count(*) as item_rating_count,
               {rd('1.0 * count(*) filter (where year(' + TS + ') >= (select max_year from m) - 1) / count(*)', 4)}
                 as item_popularity_trend
        from r group by item_id),
dim as (select item_id, {_TITLE_YEAR} as movie_year,
               cast(case when genres = '(no genres listed)' then 0 else len(string_split(genres, '|')) end as int)
                 as genre_count,
               string_split(genres, '|')[1] as primary_genre, genres from {{I}} i),
j as (select r.*, strftime({TS}, '%Y-%m-%d %H:%M:%S') as rating_datetime,
             cast(isodow({TS}) - 1 as int) as day_of_week, cast(hour({TS}) as int) as hour_of_day,
             cast(month({TS}) as int) as month,
             case when month({TS}) in (3,4,5) then 1 when month({TS}) in (6,7,8) then 2
                  when month({TS}) in (9,10,11) then 3 else 4 end as season,
             case when isodow({TS}) - 1 in (5, 6) then 1 else 0 end as is_weekend,
             case when hour({TS}) >= 6 and hour({TS}) < 12 then 1 when hour({TS}) >= 12 and hour({TS}) < 18 then 2
                  when hour({TS}) >= 18 then 3 else 0 end as day_period,
             us.user_avg_rating, us.user_rating_count, us.user_rating_variance, us.user_activity_days,
             {rd('rating - us.user_avg_rating', 3)} as user_rating_deviation,
             its.item_avg_rating, its.item_rating_count, its.item_popularity_trend,
             dim.movie_year, dim.genre_count, coalesce(dim.primary_genre, 'Unknown') as primary_genre, dim.genres,
             cast(year({TS}) as int) as rating_year,
             case when dim.movie_year is null then 0 else cast(year({TS}) as int) - dim.movie_year end as item_age
      from r left join us using (user_id) left join its using (item_id) left join dim using (item_id)),
{_LABELS_SQL.format(src='j')}
select j.*, cast(lab.idx as double) as genre_index, {_ONEHOT_SQL} as genre_encoded_str,
       {rd('avg(rating) over (partition by user_id, j.primary_genre)', 3)} as user_genre_avg_rating,
       cast(row_number() over (partition by user_id order by ts, item_id, row_key) as int) as rating_order,
       cast(coalesce(ts - lag(ts) over (partition by user_id order by ts, item_id, row_key), 0) as bigint)
         as time_since_last_rating
from j join lab using (primary_genre)""")
def q_w10(spark, sf):
    # R is a join view here (a table in production): write it once so the
    # statistics branches scan it instead of re-running the join each time.
    f = fe.all_features(ratings_view(spark, sf), items_view(spark, sf), materialize_input=True)
    f = en.vector_to_text(f, "genre_encoded").withColumn(
        "rating_datetime", F.date_format("rating_datetime", "yyyy-MM-dd HH:mm:ss"))
    return f.select(*W10_COLUMNS)
