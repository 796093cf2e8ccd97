"""Category encoding and feature assembly."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import materialize
from .windows import DEFAULT_HOT_ROWS, numbered, salted_join


#: An index of at most this many labels (some MB) is broadcast, a larger one meets the rows in a salted join.
BROADCAST_LABELS = 50_000


def label_index(counts: DataFrame, col: str, n: str = "n", small: int = BROADCAST_LABELS) -> DataFrame:
    """(label, label_index, n) from label counts: 0 for the most frequent label, ties by label. NULL has no
    index. Up to ``small`` labels, which a first pass counts, are numbered in one task; beyond, the
    order is a distributed prefix count, so the label list never sits in one place."""
    c = counts.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("label")).agg(F.sum(n).alias("n"))
    c = materialize(c, "label_counts")
    order = [F.desc("n"), F.asc("label")]
    x = c.withColumn("label_index", F.row_number().over(Window.orderBy(*order)) - 1) if c.count() <= small else numbered(c, order, "label_index")
    return x.select("label", F.col("label_index").cast("double").alias("label_index"), "n")


def encode_category(df: DataFrame, col: str, index_col: str = "genre_index",
                    vec_col: str = "genre_encoded", one_hot: bool = True,
                    fit_on: DataFrame | None = None, counts: DataFrame | None = None, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """E1 + E2: frequency-ordered index (ties by label), unseen and NULL labels kept as one more;
    one-hot with that last slot dropped, so every known label keeps its slot.

    The index is a table joined to the rows (``label_index``); the driver only learns how
    many labels there are. ``fit_on`` may be a leaner frame with the same label
    column and row multiset (e.g. before wide joins), ``counts`` a table (label
    column, n) that is known already.
    """
    if counts is None:
        counts = (df if fit_on is None else fit_on).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    index = label_index(counts, col, small=BROADCAST_LABELS)
    labels = index.count()
    x = df.withColumn("_label", F.col(col).cast("string"))
    index = index.withColumnsRenamed({"label": "_label", "label_index": "_index", "n": "_label_n"})
    if labels <= BROADCAST_LABELS:
        x = x.join(F.broadcast(index), "_label", "left")
    else:
        x = salted_join(x, index, "_label", "_label_n", df.columns, hot_rows=hot_rows)
    x = x.withColumn(index_col, F.coalesce("_index", F.lit(float(labels)))).drop("_label", "_index", "_label_n")
    if not one_hot:
        return x
    widest = df.sparkSession.range(1).select(F.lit(float(labels)).alias(index_col))
    return OneHotEncoder(inputCol=index_col, outputCol=vec_col, dropLast=True).fit(widest).transform(x)


def assemble(df: DataFrame, cols: list[str], out: str = "features", handle_invalid: str = "skip") -> DataFrame:
    """VectorAssembler; with ``skip`` rows holding NULL/NaN features vanish."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def vector_to_text_col(col: str) -> Column:
    """Vector -> '[0.0, 1.0]' text (built-ins, no Python UDF); NULL -> ''."""
    arr = vector_to_array(F.col(col))
    txt = F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: x.cast("string")), ", "), F.lit("]"))
    return F.when(F.col(col).isNull(), F.lit("")).otherwise(txt)


def vector_to_text(df: DataFrame, col: str, out: str | None = None, drop: list[str] = ()) -> DataFrame:
    out = out or f"{col}_str"
    return df.withColumn(out, vector_to_text_col(col)).drop(col, *drop)


def select_available(df: DataFrame, wanted: list[str], fallback: list[str], min_cols: int = 2) -> DataFrame:
    """P25: keep the listed columns that exist; fewer than ``min_cols`` -> the fallback ids."""
    present = [c for c in wanted if c in df.columns]
    return df.select(*(present if len(present) >= min_cols else [c for c in fallback if c in df.columns]))
