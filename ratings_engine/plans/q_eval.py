"""Registered split, baseline, metric and ranking queries
(L1-L5, R1, R8, A22, A23, A26, M1-M13, J2-J5, W8, W9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import recsys as rs
from ..operators import split as sp
from ..sources.views import ratings_view, table
from .queries import rd
from .registry import register

def _hex_unit(expr: str, digits: int) -> str:
    return f"(cast(('0x' || substr(md5({expr}), 1, {digits})) as bigint) / {float(16 ** digits)})"


TRAIN = f"(select * from {{R}} r0 where {_hex_unit('row_key', 12)} < 0.8)"
TEST = f"(select * from {{R}} r0 where {_hex_unit('row_key', 12)} >= 0.8)"


def split(spark, sf):
    return sp.train_test_split(ratings_view(spark, sf), 0.8)


def labels(spark, sf):
    return table(spark, sf, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


def item_mean_scored(spark, sf):
    """Test rows scored by the training item mean (cold items dropped)."""
    tr, te = split(spark, sf)
    return rs.predict_from_means(te, ev.group_means(tr, "item_id"), "item_id", "item_id_mean")


@register("l1_top_k", """
select * from {R} r order by rating desc, ts desc, row_key limit 10""")
def q_l1(spark, sf):
    return sp.top_k(ratings_view(spark, sf), [F.desc("rating"), F.desc("ts"), F.asc("row_key")], 10)


@register("l2_train_test_split", f"""
select row_key, {_hex_unit('row_key', 12)} < 0.8 as is_train, {_hex_unit('row_key', 12)} < 0.999 as is_train_999, true as is_train_all
from {{R}} r""")
def q_l2(spark, sf):
    r = ratings_view(spark, sf)
    return r.select("row_key", sp.split_flag("row_key", 0.8).alias("is_train"), sp.split_flag("row_key", 0.999).alias("is_train_999"),
                    sp.split_flag("row_key", 1.0).alias("is_train_all"))


@register("l3_sample_fraction", f"""
select row_key, rating from {{R}} r where {_hex_unit("'42:' || row_key", 12)} < 0.1""")
def q_l3(spark, sf):
    return sp.sample_fraction(ratings_view(spark, sf), 0.1, "row_key", 42).select("row_key", "rating")


@register("l4_sample_rows", f"""
select row_key, rating from {{R}} r order by {_hex_unit("'42:' || row_key", 12)}, row_key limit 1000""")
def q_l4(spark, sf):
    return sp.sample_rows(ratings_view(spark, sf), 1000, key="row_key", seed=42).select("row_key", "rating")


@register("l5_nested_fraction_sizes", f"""
select f as fraction, (select count(*) from {TRAIN} t
                       where f >= 1.0 or {_hex_unit("'curve:' || row_key", 12)} < f) as n_rows
from (select unnest([0.1, 0.2, 0.3, 0.5, 0.7, 1.0]) as f) fs""")
def q_l5(spark, sf):
    tr, _ = split(spark, sf)
    return sp.nested_fraction_sizes(tr)


@register("a22_group_means", f"""
select item_id, {rd('avg(rating)', 9)} as item_id_mean from {TRAIN} t group by item_id""")
def q_a22(spark, sf):
    tr, _ = split(spark, sf)
    return ev.group_means(tr, "item_id").select("item_id", F.round("item_id_mean", 9).alias("item_id_mean"))


@register("a23_mean_baseline", f"""
select {rd('sqrt(avg((rating - m) * (rating - m)))', 9)} as rmse, {rd('avg(abs(rating - m))', 9)} as mae,
       count(*) as n
from {TEST} t, (select avg(rating) as m from {TRAIN} t2) g""")
def q_a23(spark, sf):
    tr, te = split(spark, sf)
    m = ev.mean_baseline(tr, te)
    return m.select(F.round("rmse", 9).alias("rmse"), F.round("mae", 9).alias("mae"), "n")


@register("a23_majority_baseline", f"""
with c as (select quality as label, count(*) as n from labels group by quality),
s as (select max(n) as m, sum(n) as t, arg_max(label, (n, label)) as majority_label from c)
select majority_label, {rd('1.0 * m / t', 9)} as accuracy, {rd('(1.0 * m / t) * 2 * (1.0 * m / t) / (1 + 1.0 * m / t)', 9)}
       as weighted_f1 from s""")
def q_a23b(spark, sf):
    m = ev.majority_baseline(labels(spark, sf), "label")
    return m.select("majority_label", F.round("accuracy", 9).alias("accuracy"),
                    F.round("weighted_f1", 9).alias("weighted_f1"))


_BASE_SQL = f"""
with tr as {TRAIN}, te as {TEST},
g as (select 'global_mean' as baseline, sqrt(avg((rating - m) * (rating - m))) as rmse, count(*) as n
      from te, (select avg(rating) as m from tr) x),
u as (select 'user_id_mean' as baseline, sqrt(avg((te.rating - um.m) * (te.rating - um.m))) as rmse, count(*) as n
      from te join (select user_id, avg(rating) as m from tr group by user_id) um using (user_id)),
i as (select 'item_id_mean' as baseline, sqrt(avg((te.rating - im.m) * (te.rating - im.m))) as rmse, count(*) as n
      from te join (select item_id, avg(rating) as m from tr group by item_id) im using (item_id)),
b as (select * from g union all select * from u union all select * from i)"""


@register("r1_baseline_rmse", _BASE_SQL + f"""
select baseline, {rd('rmse', 9)} as rmse, n from b""")
def q_r1(spark, sf):
    tr, te = split(spark, sf)
    return rs.baseline_rmse(tr, te).select("baseline", F.round("rmse", 9).alias("rmse"), "n")


@register("a26_improvement_pct", _BASE_SQL + f"""
select {rd('(g.rmse - u.rmse) * 100 / g.rmse', 6)} as user_vs_global_pct,
       {rd('(g.rmse - i.rmse) * 100 / g.rmse', 6)} as item_vs_global_pct
from g, u, i""")
def q_a26(spark, sf):
    tr, te = split(spark, sf)
    b = rs.baseline_rmse(tr, te)
    w = b.groupBy().pivot("baseline", ["global_mean", "user_id_mean", "item_id_mean"]).agg(F.first("rmse"))
    return w.select(
        F.round(ev.improvement_pct(F.col("global_mean"), F.col("user_id_mean")), 6).alias("user_vs_global_pct"),
        F.round(ev.improvement_pct(F.col("global_mean"), F.col("item_id_mean")), 6).alias("item_vs_global_pct"))


@register("m1_regression_metrics", f"""
with te as {TEST}, im as (select item_id, avg(rating) as p from {TRAIN} t group by item_id),
x as (select te.rating as y, im.p from te join im using (item_id))
select {rd('sqrt(avg((y - p) * (y - p)))', 9)} as rmse, {rd('avg(abs(y - p))', 9)} as mae,
       {rd('avg((y - p) * (y - p))', 9)} as mse,
       {rd('1 - sum((y - p) * (y - p)) / (sum(y * y) - sum(y) * sum(y) / count(*))', 9)} as r2, count(*) as n
from x""")
def q_m1(spark, sf):
    m = ev.regression_metrics(item_mean_scored(spark, sf), "rating", "item_id_mean")
    return m.select(*[F.round(c, 9).alias(c) for c in ("rmse", "mae", "mse", "r2")], "n")


_CM = """(select count(*) filter (where quality = 0 and toxic = 0) as tn,
        count(*) filter (where quality = 0 and toxic = 1) as fp,
        count(*) filter (where quality = 1 and toxic = 0) as fn,
        count(*) filter (where quality = 1 and toxic = 1) as tp from labels)"""


@register("m6_m7_confusion_prf", f"""
select tn, fp, fn, tp,
  {rd('case when tp + fp > 0 then 1.0 * tp / (tp + fp) else 0.0 end', 4)} as precision,
  {rd('case when tp + fn > 0 then 1.0 * tp / (tp + fn) else 0.0 end', 4)} as recall,
  {rd('''case when tp > 0 then 2.0 * (1.0 * tp / (tp + fp)) * (1.0 * tp / (tp + fn))
          / ((1.0 * tp / (tp + fp)) + (1.0 * tp / (tp + fn))) else 0.0 end''', 4)} as f1
from {_CM} c""")
def q_m6(spark, sf):
    return ev.binary_prf(ev.confusion_counts(labels(spark, sf)))


_AVG_SQL = f"""
with c as {_CM},
p as (select tn, fp, fn, tp, tn + fp + fn + tp as n,
        case when tp + fp > 0 then 1.0 * tp / (tp + fp) else 0.0 end as p1,
        case when tp + fn > 0 then 1.0 * tp / (tp + fn) else 0.0 end as r1,
        case when tn + fn > 0 then 1.0 * tn / (tn + fn) else 0.0 end as p0,
        case when tn + fp > 0 then 1.0 * tn / (tn + fp) else 0.0 end as r0 from c),
q as (select *, case when p1 + r1 > 0 then 2 * p1 * r1 / (p1 + r1) else 0.0 end as f1,
             case when p0 + r0 > 0 then 2 * p0 * r0 / (p0 + r0) else 0.0 end as f0,
             1.0 * (tp + fn) / n as w1, 1.0 * (tn + fp) / n as w0, 1.0 * (tp + tn) / n as acc,
             (p0 + p1) / 2 as mp, (r0 + r1) / 2 as mr from p),
m as (select acc as accuracy, w0 * p0 + w1 * p1 as weighted_precision, w0 * r0 + w1 * r1 as weighted_recall,
             w0 * f0 + w1 * f1 as weighted_f1, mp as macro_precision, mr as macro_recall,
             case when mp + mr > 0 then 2 * mp * mr / (mp + mr) else 0.0 end as macro_f1,
             acc as micro_precision, acc as micro_recall, acc as micro_f1 from q)"""

_AVG_COLS = ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "macro_precision", "macro_recall",
             "macro_f1", "micro_precision", "micro_recall", "micro_f1"]


@register("m8_averaged_metrics", _AVG_SQL + "\nselect " + ", ".join(f"{rd(c, 9)} as {c}" for c in _AVG_COLS)
          + " from m")
def q_m8(spark, sf):
    m = ev.averaged_metrics(ev.confusion_counts(labels(spark, sf)))
    return m.select(*[F.round(c, 9).alias(c) for c in _AVG_COLS])


_SCORED = f"""(select case when te.rating >= 3.5 then 1 else 0 end as label, im.p / 5.0 as score
 from {TEST} te join (select item_id, avg(rating) as p from {TRAIN} t group by item_id) im using (item_id))"""


def scored_labels(spark, sf):
    s = item_mean_scored(spark, sf)
    return s.select(F.when(F.col("rating") >= 3.5, 1).otherwise(0).alias("label"),
                    (F.col("item_id_mean") / 5.0).alias("score"))


@register("m9_auc_roc", f"""
with s as {_SCORED},
h as (select score, count(*) filter (where label = 1) as p, count(*) filter (where label = 0) as n from s group by score),
t as (select sum(p) as tp, sum(n) as tn from h)
select {rd('''sum(a.p * b.n * case when a.score > b.score then 1.0 when a.score = b.score then 0.5 else 0.0 end)
          / (max(t.tp) * max(t.tn))''', 9)} as auc, cast(max(t.tp) as bigint) as n_pos,
       cast(max(t.tn) as bigint) as n_neg
from h a, h b, t""")
def q_m9(spark, sf):
    a = ev.auc_roc(scored_labels(spark, sf))
    return a.select(F.round("auc", 9).alias("auc"), "n_pos", "n_neg")


@register("m10_roc_points", f"""
with s as {_SCORED}, th as (select i as step, i / 20.0 as t from range(0, 21) r(i))
select cast(step as int) as step, t as threshold,
  {rd("case when count(*) filter (where label = 0) > 0 then 1.0 * count(*) filter (where label = 0 and score >= t) / count(*) filter (where label = 0) else 0.0 end", 9)} as fpr,
  {rd("case when count(*) filter (where label = 1) > 0 then 1.0 * count(*) filter (where label = 1 and score >= t) / count(*) filter (where label = 1) else 0.0 end", 9)} as tpr
from s, th group by step, t""")
def q_m10(spark, sf):
    p = ev.roc_points(scored_labels(spark, sf))
    return p.select("step", "threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


@register("m11_residual_summary", f"""
with te as {TEST}, im as (select item_id, avg(rating) as p from {TRAIN} t group by item_id),
x as (select te.rating - im.p as res from te join im using (item_id)),
st as (select min(res) as lo, max(res) as hi, avg(res) as mr from x),
b as (select least(cast(floor(40 * (res - lo) / (hi - lo)) as bigint) + 1, 40) as bin, lo, hi, mr from x, st)
select bin, {rd('lo + (bin - 1) * (hi - lo) / 40', 9)} as bin_start, count(*) as n, {rd('mr', 9)} as mean_residual
from b group by bin, lo, hi, mr""")
def q_m11(spark, sf):
    r = ev.residual_summary(item_mean_scored(spark, sf), "rating", "item_id_mean")
    return r.select("bin", F.round("bin_start", 9).alias("bin_start"), "n",
                    F.round("mean_residual", 9).alias("mean_residual"))


_POP_SQL = f"""
tr as {TRAIN}, te as {TEST},
pop as (select item_id, count(*) as n from tr group by item_id order by n desc, item_id limit 10),
pr as (select item_id, n, row_number() over (order by n desc, item_id) as rk from pop),
users as (select distinct user_id from tr),
recs as (select u.user_id, pr.item_id, pr.rk, pr.n from users u cross join pr)"""


@register("r8_w8_recommend_popular", f"""
with {_POP_SQL}
select user_id, item_id, cast(n as float) as score, cast(rk as int) as rank from recs""")
def q_r8(spark, sf):
    tr, _ = split(spark, sf)
    return rs.recs_long(rs.recommend_popular(tr, 10))


@register("m2_relevant_counts", f"""
select user_id, count(*) as n_relevant from (select distinct user_id, item_id from {TEST} t where rating >= 3.5) d
group by user_id""")
def q_m2(spark, sf):
    _, te = split(spark, sf)
    return rs.relevant_counts(rs.relevant_items(te, 3.5))


@register("m3_m4_m5_ranking_metrics", f"""
with {_POP_SQL},
rel as (select distinct user_id, item_id from te where rating >= 3.5),
nrel as (select user_id, count(*) as n_relevant from rel group by user_id),
h as (select recs.user_id, recs.rk, case when rel.item_id is not null then 1 else 0 end as hit
      from recs left join rel on recs.user_id = rel.user_id and recs.item_id = rel.item_id),
pu as (select user_id, {{cols}} from h group by user_id),
b as (select * from pu join nrel using (user_id))
{{sel}}""".replace("{cols}", ", ".join(
    f"sum(case when rk <= {k} then hit else 0 end) as h{k}, "
    f"sum(case when rk <= {k} and hit = 1 then 1.0 / log2(rk + 1) else 0.0 end) as d{k}" for k in (5, 10)))
    .replace("{sel}", "\nunion all\n".join(
        f"select {k} as k, {rd(f'avg(h{k} / {k}.0)', 4)} as precision_at_k, {rd(f'avg(1.0 * h{k} / n_relevant)', 4)}"
        f" as recall_at_k, {rd(f'avg(d{k} / list_sum(list_transform(range(1, least(n_relevant, {k}) + 1), lambda i: 1.0 / log2(i + 1))))', 4)}"
        f" as ndcg_at_k, count(*) as n_users from b" for k in (5, 10))))
def q_m3(spark, sf):
    tr, te = split(spark, sf)
    return rs.ranking_metrics(rs.recommend_popular(tr, 10), te, (5, 10), 3.5)


@register("m13_metrics_summary", _AVG_SQL + ",\n" + _BASE_SQL.replace("with ", "", 1) + "\n"
          + "\nunion all\n".join(f"select 'Cls_{c}' as metric, {rd(c, 9)} as value from m" for c in _AVG_COLS)
          + "\nunion all\n" + f"select 'Base_' || baseline as metric, {rd('rmse', 9)} as value from b")
def q_m13(spark, sf):
    tr, te = split(spark, sf)
    cls = ev.averaged_metrics(ev.confusion_counts(labels(spark, sf)))
    base = rs.baseline_rmse(tr, te).groupBy().pivot("baseline", ["global_mean", "user_id_mean", "item_id_mean"]) \
        .agg(F.first("rmse"))
    s = ev.metrics_summary([("Cls_", cls), ("Base_", base)])
    return s.select("metric", F.round("value", 9).alias("value"))
