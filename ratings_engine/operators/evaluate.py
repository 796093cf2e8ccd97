"""Evaluation metrics as single-pass aggregates.

The reference runs one Spark job per metric or per confusion cell; here each
family is one ``agg`` whose partial aggregation runs map-side. Results are
small DataFrames (one row, or one row per metric), never driver values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import COLS, Cols


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


# ------------------------------------------------------------------ regression

def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M1: rmse, mae, mse, r2 and n in one pass.

    r2 (NULL for a constant label) = 1 - SSE / SST with SST = sum(y^2) - (sum y)^2 / n (as RegressionEvaluator).
    """
    e = F.col(label) - F.col(prediction)
    a = df.agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("_sse"), F.sum(F.abs(e)).alias("_sae"),
               F.sum(F.col(label)).alias("_sy"), F.sum(F.col(label) * F.col(label)).alias("_syy"))
    mse = F.try_divide("_sse", "n")
    sst = F.col("_syy") - F.try_divide(F.col("_sy") * F.col("_sy"), F.col("n"))
    return a.select(F.sqrt(mse).alias("rmse"), F.try_divide("_sae", "n").alias("mae"), mse.alias("mse"),
                    (F.lit(1.0) - F.try_divide("_sse", sst)).alias("r2"), "n")


def global_mean(train: DataFrame, c: Cols = COLS) -> DataFrame:
    """One-row mean of the training ratings."""
    return train.agg(F.avg(c.rating).alias("global_mean"))


def group_means(train: DataFrame, key: str, c: Cols = COLS) -> DataFrame:
    """Per-key mean (and row count, used to salt hot keys) of the training ratings."""
    return train.groupBy(key).agg(F.avg(c.rating).alias(f"{key}_mean"), F.count(F.lit(1)).alias(f"{key}_n"))


def mean_baseline(train: DataFrame, test: DataFrame, c: Cols = COLS) -> DataFrame:
    """RMSE/MAE of always predicting the training mean on test."""
    p = test.crossJoin(F.broadcast(global_mean(train, c)))  # one-row side
    m = regression_metrics(p, c.rating, "global_mean")
    return m.select("rmse", "mae", "n")


def majority_baseline(df: DataFrame, label: str = "label") -> DataFrame:
    """Weighted F1 (and accuracy) of always predicting the majority class.

    With majority share p: class F1 is 2p/(1+p) for the majority, 0 for the
    rest; weighted by true shares the F1 is p * 2p / (1 + p).
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    s = counts.agg(F.max("_c").alias("_m"), F.sum("_c").alias("_n"),
                   F.max_by(label, F.struct("_c", label)).alias("majority_label"))
    p = F.col("_m") / F.col("_n")
    return s.select("majority_label", p.alias("accuracy"), (p * 2 * p / (1 + p)).alias("weighted_f1"))


def improvement_pct(base: Column, new: Column) -> Column:
    """(base - new) / base * 100; NULL when base is 0."""
    return F.try_divide((base - new) * 100, base)


# ------------------------------------------------------------------ classification

def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     by: list[str] | None = None) -> DataFrame:
    """M6: tn, fp, fn, tp in one aggregate (one row, or one per ``by`` group)."""
    y, p = F.col(label), F.col(prediction)
    g = df.groupBy(*by) if by else df
    return g.agg(F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def binary_prf(cm: DataFrame, digits: int = 4) -> DataFrame:
    """M7: precision, recall, F1 of the positive class; 0 on empty denominators."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    f1 = _safe_div(2 * prec * rec, prec + rec)
    return cm.select("*", F.round(prec, digits).alias("precision"), F.round(rec, digits).alias("recall"),
                     F.round(f1, digits).alias("f1"))


def averaged_metrics(cm: DataFrame, digits: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """M8 from the confusion counts: accuracy; weighted P/R/F1 (weights = true
    class shares, as MulticlassClassificationEvaluator); macro P and R = mean of
    the two classes; macro F1 = harmonic mean of macro P and macro R (the
    reference's definition, not the mean of class F1); micro P = R = F1 = accuracy.
    """
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1_1, f1_0 = _safe_div(2 * p1 * r1, p1 + r1), _safe_div(2 * p0 * r0, p0 + r0)
    w1, w0 = _safe_div(tp + fn, n), _safe_div(tn + fp, n)
    acc = _safe_div(tp + tn, n)
    mp, mr = (p0 + p1) / 2, (r0 + r1) / 2
    cols = {
        "accuracy": acc,
        "weighted_precision": w0 * p0 + w1 * p1,
        "weighted_recall": w0 * r0 + w1 * r1,
        "weighted_f1": w0 * f1_0 + w1 * f1_1,
        "macro_precision": mp,
        "macro_recall": mr,
        "macro_f1": _safe_div(2 * mp * mr, mp + mr),
        "micro_precision": acc,
        "micro_recall": acc,
        "micro_f1": acc,
    }
    r = (lambda x: F.round(x, digits)) if digits is not None else (lambda x: x)
    return cm.select(*(keep or []), *[r(v).alias(k) for k, v in cols.items()])


def auc_roc(df: DataFrame, label: str = "label", score: str = "score", bins: int | None = None,
            partitions: int | None = None) -> DataFrame:
    """M9: exact area under ROC by the rank (Mann-Whitney) form with mid-ranks
    for ties: AUC = P(score_pos > score_neg) + 0.5 P(equal).

    Rows are reduced to a histogram (score -> positives, negatives) by a
    partial aggregate. The running count of negatives below each score is a
    distributed prefix sum: the histogram is range-partitioned by score and
    written once with its partition id (so every later read agrees on the
    split); negatives per partition (one row per partition) give each
    partition its offset, and the running sum inside a partition is a window
    over that partition only. No task orders more than its range of distinct
    scores. ``bins`` optionally buckets the scores first (like
    BinaryClassificationEvaluator's numBins).
    """
    from ..config import materialize

    spark = df.sparkSession
    s = F.col(score).cast("double")
    if bins:
        s = F.floor(s * bins) / bins
    # a row without a score or label cannot be ranked
    h = df.where(s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull()).groupBy(s.alias("_s")).agg(F.count_if(F.col(label) == 1).alias("_p"),
                                      F.count_if(F.col(label) != 1).alias("_n"))
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    h = materialize(h.repartitionByRange(n_parts, "_s").withColumn("_pid", F.spark_partition_id()), "auc_hist")
    per_part = h.groupBy("_pid").agg(F.sum("_n").alias("_pn"))
    offs = per_part.select("_pid", F.coalesce(F.sum("_pn").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = F.coalesce(F.sum("_n").over(Window.partitionBy("_pid").orderBy("_s")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    x = h.select("_pid", "_p", "_n", local.alias("_local")).join(F.broadcast(offs), "_pid")  # one row per partition
    a = x.agg(F.sum(F.col("_p") * (F.col("_off") + F.col("_local") + 0.5 * F.col("_n"))).alias("_w"),
              F.sum("_p").alias("n_pos"), F.sum("_n").alias("n_neg"))
    return a.select(F.coalesce(F.try_divide("_w", F.col("n_pos") * F.col("n_neg")), F.lit(0.0)).alias("auc"), "n_pos", "n_neg")


def roc_points(df: DataFrame, label: str = "label", score: str = "score", steps: int = 20) -> DataFrame:
    """Thresholds 0, 1/steps, ..., 1 with prediction = score >= t; FPR, TPR
    (0 on an empty class), as a cumulative histogram.

    Each row falls into the bucket of the highest threshold it reaches, found
    by comparing with the thresholds themselves (a multiplication could round a
    score across one); one hash aggregate counts the classes by bucket. The running
    sum from the top goes over at most steps + 2 rows. A NULL score reaches no
    threshold; NaN reaches all.
    """
    y, s = F.col(label), F.col(score)
    grid = [i / steps for i in range(steps + 1)]
    near = F.greatest(F.lit(0), F.least(F.lit(steps), F.floor(F.try_divide(s, F.lit(1.0 / steps))).cast("int")))
    at = lambda i: F.element_at(F.array(*map(F.lit, grid)), i + 1)
    bucket = (F.when(s.isNull() | (s < 0.0), -1).when(F.isnan(s.cast("double")) | (s >= 1.0), steps)
              .when((near < steps) & (s >= at(F.least(near + 1, F.lit(steps)))), near + 1).when(s < at(near), near - 1).otherwise(near))
    hist = df.groupBy(bucket.alias("step")).agg(F.count_if(y == 1).alias("p"), F.count_if(y != 1).alias("n"))
    steps_ = df.sparkSession.range(-1, steps + 1).select(F.col("id").cast("int").alias("step"))
    rows = steps_.join(F.broadcast(hist), "step", "left").groupBy().agg(      # at most steps + 2 rows
        F.sort_array(F.collect_list(F.struct("step", F.coalesce("p", F.lit(0)).alias("p"), F.coalesce("n", F.lit(0)).alias("n")))).alias("h"))
    total = lambda name, lo: F.aggregate(F.filter("h", lambda x: x["step"] >= lo), F.lit(0).cast("bigint"), lambda a, x: a + x[name])
    pts = F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda i: F.struct(
        i.alias("step"), (i / F.lit(steps)).alias("threshold"),
        _safe_div(total("n", i), total("n", F.lit(-1))).alias("fpr"), _safe_div(total("p", i), total("p", F.lit(-1))).alias("tpr")))
    return rows.select(F.inline(pts))


def residual_summary(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     bins: int = 40) -> DataFrame:
    """residual = label - prediction; equal-width histogram (last bin closed)
    with the mean residual on every row."""
    r = df.select((F.col(label) - F.col(prediction)).alias("residual"))
    st = r.agg(F.min("residual").alias("_lo"), F.max("residual").alias("_hi"), F.avg("residual").alias("mean_residual"))
    b = F.least(F.width_bucket(F.col("residual"), F.col("_lo"), F.col("_hi"), F.lit(bins)), F.lit(bins))
    return (r.crossJoin(F.broadcast(st))  # one-row side
            .groupBy(b.alias("bin"), "_lo", "_hi", "mean_residual").agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (F.col("_lo") + (F.col("bin") - 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_start"),
                    "n", "mean_residual"))


def to_long(one_row: DataFrame, prefix: str = "", cols: list[str] | None = None) -> DataFrame:
    """Unpivot a one-row metrics frame to (metric, value)."""
    cols = cols or one_row.columns
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(prefix + c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols])))


def metrics_summary(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """All metric families in one long table, names prefixed (e.g. ``ALS_``, ``Rec_``, ``Cls_``)."""
    out = None
    for prefix, one in parts:
        x = to_long(one, prefix)
        out = x if out is None else out.unionByName(x)
    return out
