"""Sorting, sampling and splitting.

Splits and samples are **hash based**: a row's side is a function of its key
(``md5(key)`` read as a number against a threshold), so the split is the same after a
repartition, on a re-run after a lost executor, and in any engine that has
md5. ``randomSplit`` depends on partition layout and is offered only as an
option.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COLS, DEFAULTS


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    """L1: sort + limit (planned as TakeOrderedAndProject: k rows per task)."""
    return df.orderBy(*order).limit(k)


def hash_unit(key: str | Column, salt: str = "", digits: int = 12) -> Column:
    """Deterministic value in [0, 1) from the first ``digits`` hex digits of md5(salt:key)
    (12 digits are exact in a double)."""
    k = F.col(key) if isinstance(key, str) else key
    src = F.concat(F.lit(f"{salt}:"), k.cast("string")) if salt else k.cast("string")
    return F.conv(F.substring(F.md5(src), 1, digits), 16, 10).cast("double") / float(16 ** digits)


def split_flag(key: str = COLS.key, ratio: float = DEFAULTS.split_ratio, salt: str = "") -> Column:
    """True for the training side: the row's hash lies below ``ratio`` (0 and 1 are exact).
    A split inside one side of another split needs a salt of its own."""
    return hash_unit(key, salt) < F.lit(float(ratio))


def train_test_split(df: DataFrame, ratio: float = DEFAULTS.split_ratio, key: str = COLS.key,
                     method: str = "hash", seed: int = DEFAULTS.seed):
    """L2: (train, test). ``method='random'`` uses ``randomSplit`` like the reference."""
    if method == "random":
        return tuple(df.randomSplit([ratio, 1 - ratio], seed=seed))
    flag = split_flag(key, ratio)
    return df.where(flag), df.where(~flag)


def fold_col(key: str = COLS.key, folds: int = 3, salt: str = "fold") -> Column:
    """Hash fold id in [0, folds) for cross-validation (``foldCol``)."""
    return F.floor(hash_unit(key, salt) * folds).cast("int")


def check_folds(df: DataFrame, folds: int, col: str = "fold") -> None:
    """An error unless every fold has rows and every row a fold (as CrossValidator demands)."""
    found = {r[0] for r in df.select(col).distinct().collect()}   # one row per fold
    if found != set(range(folds)):
        raise ValueError(f"folds {sorted(set(range(folds)) - found)} are empty or a row has no fold")


def sample_fraction(df: DataFrame, fraction: float, key: str | None = COLS.key, seed: int = DEFAULTS.seed) -> DataFrame:
    """L3: Bernoulli sample. With a key it is hash based (repeatable); without,
    ``DataFrame.sample``. Apply before assembling features."""
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.where(hash_unit(key, str(seed)) < fraction)


def sample_rows(df: DataFrame, n: int, total: int | None = None, key: str = COLS.key,
                seed: int = DEFAULTS.seed) -> DataFrame:
    """L4: exactly min(n, rows) rows, those of the smallest (hash, key).

    The n-th smallest hash comes from the two-pass selection of
    ``functions.quantiles``; the sample is then a filter, so it keeps the
    input's partitioning and no task holds it whole. Only rows whose hash
    equals the n-th (equal keys, or a collision in 48 bits) are ordered by key.
    ``total`` may tell the number of rows; a sample of all rows then needs no pass.
    """
    from ..functions.quantiles import counts_around

    if total is not None and n >= total:
        return df
    if n <= 0:
        return df.limit(0)
    u = F.coalesce(hash_unit(key, str(seed)), F.lit(1.0))
    counted, _ = counts_around(df.select(u.alias("_u")), "_u", lambda rows: [min(n, rows) - 1])
    if n >= counted.n:
        return df
    bound = counted.value_at(n - 1)
    below = counted.split(bound)[0]
    if counted.split(math.nextafter(bound, 2.0))[0] == n:
        return df.where(u <= bound)
    return df.where(u < bound).unionByName(df.where(u == bound).orderBy(key).limit(n - below))


def by_hash(df: DataFrame, key: str = COLS.key, salt: str = str(DEFAULTS.seed)) -> DataFrame:
    """``df`` range-partitioned and sorted by the hash of its key, kept as ``_u`` (a NULL key is 1.0). Once written,
    ``_u < f`` reads the first files only: every nested fraction is a prefix of one ordered table."""
    return df.withColumn("_u", F.coalesce(hash_unit(key, salt), F.lit(1.0))).repartitionByRange("_u").sortWithinPartitions("_u")


def numbered_by_hash(df: DataFrame, key: str = COLS.key, seed: int = DEFAULTS.seed) -> DataFrame:
    """``df`` with ``_pos``, a row's place in the order of (hash, key): ``_pos < n`` are the rows of ``sample_rows(df, n)``."""
    from .windows import numbered

    return numbered(df.withColumn("_u", F.coalesce(hash_unit(key, str(seed)), F.lit(1.0))), ["_u", key], "_pos").drop("_u")


def nested_fractions(train: DataFrame, fractions=(0.1, 0.2, 0.3, 0.5, 0.7, 1.0), key: str = COLS.key,
                     salt: str = "curve") -> list[tuple[float, DataFrame]]:
    """Growing training subsets; each is a superset of the previous (one hash column)."""
    u = hash_unit(key, salt)
    return [(f, train.where(u < f) if f < 1.0 else train) for f in fractions]


def nested_fraction_sizes(train: DataFrame, fractions=(0.1, 0.2, 0.3, 0.5, 0.7, 1.0), key: str = COLS.key,
                          salt: str = "curve") -> DataFrame:
    """Sizes of the L5 subsets in one pass."""
    u = hash_unit(key, salt)
    one = train.agg(*[F.count_if(u < f if f < 1.0 else F.lit(True)).alias(f"f{i}") for i, f in enumerate(fractions)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(float(f)).alias("fraction"), F.col(f"f{i}").alias("n_rows"))
                                         for i, f in enumerate(fractions)])))
