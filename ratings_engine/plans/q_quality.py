"""Registered data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as qa
from ..sources.views import events_view, ratings_view
from .queries import HYPERACTIVE_MIN, SUSPICIOUS_MAX_SD, SUSPICIOUS_MIN_N, rd
from .registry import register

SD = "(stddev_samp(rating) + 1e-9)"   # halves round up in both engines

PAIR = ("user_id", "item_id")
# Range used on the driver data so that the repair step removes rows
# (the view's ratings span the whole 0.5-5.0 default range).
LO, HI = 1.0, 4.5
# Valid range for the skewed event values (0.01-490.02).
EV_LO, EV_HI = 0.5, 400.0

_EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _missing_sql(cols, table, float_cols=()):
    parts = []
    for c in cols:
        cond = f"{c} is null or isnan({c})" if c in float_cols else f"{c} is null"
        parts.append(f"""select '{c}' as column_name, count(*) filter (where {cond}) as null_count,
  case when count(*) > 0 then {rd(f"100.0 * count(*) filter (where {cond}) / count(*)", 4)} else 0.0 end as null_pct,
  count(*) as total_rows, count(*) * {len(cols)} as total_cells from {table}""")
    return "\nunion all\n".join(parts)


@register("p18_remove_out_of_range", f"""
select row_key, rating from {{R}} r where rating between {LO} and {HI}""")
def q_p18(spark, sf):
    return qa.remove_out_of_range(ratings_view(spark, sf), LO, HI).select("row_key", "rating")


@register("p19_drop_missing", """
select user_id, item_id, rating, ts, row_key from {R} r
where user_id is not null and item_id is not null and rating is not null and not isnan(rating)
  and ts is not null""")
def q_p19(spark, sf):
    return qa.drop_missing(ratings_view(spark, sf))


@register("p18_p19_a16_clean", f"""
select user_id, item_id, rating, ts, row_key from (
  select *, row_number() over (partition by user_id, item_id, ts order by ts, row_key) as rn from {{R}} r
  where user_id is not null and item_id is not null and rating is not null and not isnan(rating) and ts is not null) t
where rn = 1 and rating between {LO} and {HI}""")
def q_clean(spark, sf):
    """The whole repair: drop missing, first of each duplicate, valid range."""
    return qa.clean(ratings_view(spark, sf), lo=LO, hi=HI).select("user_id", "item_id", "rating", "ts", "row_key")


@register("a13_missing_report", _missing_sql(_EV_COLS, "events", ("value",)))
def q_a13(spark, sf):
    return qa.missing_report(events_view(spark, sf))


@register("a14_duplicate_report", """
select user_id, item_id, count(*) as dup_count from {R} r group by user_id, item_id having count(*) > 1""")
def q_a14(spark, sf):
    return qa.duplicate_report(ratings_view(spark, sf), PAIR)


@register("a15_duplicate_extra", """
select count(*) as dup_groups, cast(coalesce(sum(dup_count - 1), 0) as bigint) as dup_extra
from (select count(*) as dup_count from {R} r group by user_id, item_id having count(*) > 1) d""")
def q_a15(spark, sf):
    return qa.duplicate_extra(ratings_view(spark, sf), PAIR)


@register("a16_remove_duplicates", """
select user_id, item_id, rating, ts, row_key from (
  select *, row_number() over (partition by user_id, item_id order by ts, row_key) as rn from {R} r) t
where rn = 1""")
def q_a16(spark, sf):
    return qa.remove_duplicates(ratings_view(spark, sf), PAIR, ("ts", "row_key"))


_IQR_SQL = """(select q1, median, q3, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_bound,
        q3 + 1.5 * (q3 - q1) as upper_bound
 from (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
              quantile_cont(value, 0.75) as q3 from events) q)"""


_BOUNDS = ["q1", "median", "q3", "iqr", "lower_bound", "upper_bound"]
_BOUNDS_SQL = ", ".join(f"{rd(c, 9)} as {c}" for c in _BOUNDS)


def _round_bounds(df):
    """Presentation only: bounds rounded to 9 dp (the counts use the exact bounds)."""
    return df.select(*[F.round(c, 9).alias(c) if c in _BOUNDS else F.col(c) for c in df.columns])


@register("a17_iqr_bounds", f"select {_BOUNDS_SQL} from {_IQR_SQL} b")
def q_a17(spark, sf):
    return _round_bounds(qa.iqr_bounds(events_view(spark, sf), "value"))


@register("a18_outlier_counts", f"""
select {_BOUNDS_SQL}, outlier_count, invalid_count from (
  select b.*, count(*) filter (where value < lower_bound or value > upper_bound) as outlier_count,
         count(*) filter (where value < {EV_LO} or value > {EV_HI}) as invalid_count
  from events, {_IQR_SQL} b
  group by all) t""")
def q_a18(spark, sf):
    e = events_view(spark, sf)
    return _round_bounds(qa.outlier_counts(e, qa.iqr_bounds(e, "value"), "value", EV_LO, EV_HI))


@register("a19_hyperactive_users", f"""
select user_id, count(*) as rating_count, {rd('avg(rating)', 2)} as avg_rating,
       {rd(SD, 2)} as stddev_rating
from {{R}} r group by user_id having count(*) > {HYPERACTIVE_MIN}""")
def q_a19(spark, sf):
    return qa.hyperactive_users(ratings_view(spark, sf), HYPERACTIVE_MIN)


@register("a20_suspicious_users", f"""
select * from (
  select user_id, count(*) as rating_count, {rd('avg(rating)', 3)} as avg_rating,
         {rd(SD, 4)} as stddev_rating
  from {{R}} r group by user_id having count(*) >= {SUSPICIOUS_MIN_N}) s
where stddev_rating < {SUSPICIOUS_MAX_SD} or stddev_rating is null""")
def q_a20(spark, sf):
    return qa.suspicious_users(ratings_view(spark, sf), SUSPICIOUS_MIN_N, SUSPICIOUS_MAX_SD)


_J7_SQL = f"""
select * from {{R}} r where user_id not in (
  select user_id from {{R}} r2 group by user_id having count(*) > {HYPERACTIVE_MIN})"""


@register("j7_exclude_users_hot_split", _J7_SQL)
def q_j7_hot(spark, sf):
    """Same as j7 with a hot-user threshold of 20 rows (salted join)."""
    r = ratings_view(spark, sf)
    return qa.exclude_users(r, qa.hyperactive_users(r, HYPERACTIVE_MIN), hot_rows=20)


@register("j7_exclude_users", _J7_SQL)
def q_j7(spark, sf):
    r = ratings_view(spark, sf)
    return qa.exclude_users(r, qa.hyperactive_users(r, HYPERACTIVE_MIN))


_R_COLS = ["user_id", "item_id", "rating", "ts", "row_key"]
_MISS_COUNTS = ", ".join(f"count(*) filter (where {c} is null{' or isnan(rating)' if c == 'rating' else ''})"
                         f" as missing_{c}_count" for c in _R_COLS)
_MISS_PCTS = ", ".join(
    f"case when count(*) > 0 then {rd(f'100.0 * count(*) filter (where {c} is null) / count(*)', 4)} else 0.0 end"
    f" as missing_{c}_pct" for c in _R_COLS)


@register("a21_quality_report", f"""
with r as (select * from {{R}} r0),
miss as (select count(*) as rows_before, {_MISS_COUNTS}, {_MISS_PCTS} from r),
nm as (select * from r where user_id is not null and item_id is not null and rating is not null
       and not isnan(rating) and ts is not null),
dups as (select cast(coalesce(sum(c - 1), 0) as bigint) as duplicate_rows
         from (select count(*) as c from nm group by user_id, item_id having count(*) > 1) d),
dd as (select * from (select *, row_number() over (partition by user_id, item_id order by ts, row_key) as rn
       from nm) t where rn = 1),
b as (select q1, median, q3, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_bound, q3 + 1.5 * (q3 - q1) as upper_bound
      from (select quantile_cont(rating, 0.25) as q1, quantile_cont(rating, 0.5) as median,
                   quantile_cont(rating, 0.75) as q3 from dd) q),
oc as (select b.*, count(*) filter (where rating < lower_bound or rating > upper_bound) as outlier_count,
              count(*) filter (where rating < {LO} or rating > {HI}) as invalid_count
       from dd, b group by all),
v as (select * from dd where rating between {LO} and {HI}),
u as (select user_id, count(*) as n, sqrt(case when count(rating) > 1 then (sum(rating * rating) - sum(rating) * sum(rating) / count(rating)) / (count(rating) - 1) end) as sd from v group by user_id),
us as (select cast(coalesce(sum(n), 0) as bigint) as rows_after,
              count(*) filter (where n > {HYPERACTIVE_MIN}) as hyperactive_users,
              count(*) filter (where n >= {SUSPICIOUS_MIN_N} and ({rd('sd', 4)} < {SUSPICIOUS_MAX_SD} or sd is null))
                as suspicious_users from u)
select miss.*, {' + '.join(f'missing_{c}_count' for c in _R_COLS)} as missing_total, dups.*, oc.*, us.*,
       rows_before - rows_after as rows_removed,
       case when rows_before > 0 then {rd('100.0 * (rows_before - rows_after) / rows_before', 4)} else 0.0 end
         as rows_removed_pct
from miss, dups, oc, us""")
def q_a21(spark, sf):
    from ..config import materialize
    r = materialize(ratings_view(spark, sf), "ratings")   # a join view here; a table scan in production
    return qa.quality_report(r, keys=PAIR, lo=LO, hi=HI, hyper_min=HYPERACTIVE_MIN,
                             susp_min_n=SUSPICIOUS_MIN_N, susp_sd=SUSPICIOUS_MAX_SD)


@register("a17_iqr_bounds_approx")
def q_a17_approx(spark, sf):
    """Approximate form (rows-only check; rank error is tested in tests/)."""
    return qa.iqr_bounds(events_view(spark, sf), "value", exact=False).withColumn("exact", F.lit(False))
