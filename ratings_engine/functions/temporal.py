"""Calendar columns (P2-P10). All are JVM built-ins, inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COLS, Cols


def _ts(col) -> Column:
    """Accept epoch seconds (numeric) or a timestamp column by name/Column."""
    return F.col(col) if isinstance(col, str) else col


def epoch_to_timestamp_col(col) -> Column:
    """Unix seconds -> timestamp (session zone)."""
    return F.timestamp_seconds(_ts(col))


def epoch_to_timestamp(df: DataFrame, col: str = COLS.ts, out: str = "rating_date") -> DataFrame:
    return df.withColumn(out, epoch_to_timestamp_col(col))


def as_timestamp(col, epoch: bool) -> Column:
    return F.timestamp_seconds(_ts(col)) if epoch else _ts(col).cast("timestamp")


def day_of_week_col(col, epoch: bool = True) -> Column:
    """Monday=0 ... Sunday=6."""
    return F.weekday(as_timestamp(col, epoch))


def hour_col(col, epoch: bool = True) -> Column:
    """0-23."""
    return F.hour(as_timestamp(col, epoch))


def month_col(col, epoch: bool = True) -> Column:
    """P5: 1-12."""
    return F.month(as_timestamp(col, epoch))


def season_col(month: Column) -> Column:
    """3-5 -> 1, 6-8 -> 2, 9-11 -> 3, else 4."""
    return (F.when(month.isin(3, 4, 5), 1).when(month.isin(6, 7, 8), 2)
            .when(month.isin(9, 10, 11), 3).otherwise(4))


def is_weekend_col(dow: Column) -> Column:
    """1 when day_of_week in (5, 6)."""
    return F.when(dow.isin(5, 6), 1).otherwise(0)


def day_period_col(hour: Column) -> Column:
    """[6,12) -> 1, [12,18) -> 2, [18,24) -> 3, else 0."""
    return (F.when((hour >= 6) & (hour < 12), 1).when((hour >= 12) & (hour < 18), 2)
            .when((hour >= 18) & (hour < 24), 3).otherwise(0))


def rating_year_col(col, epoch: bool = True) -> Column:
    """Calendar year."""
    return F.year(as_timestamp(col, epoch))


def between_years(df: DataFrame, lo: int, hi: int, col: str = COLS.ts, epoch: bool = True) -> DataFrame:
    """P10: inclusive year range filter."""
    return df.where(rating_year_col(col, epoch).between(lo, hi))


def temporal_features(df: DataFrame, c: Cols = COLS, epoch: bool = True) -> DataFrame:
    """P2-P8 in one projection (the reference chains ~7 withColumn calls)."""
    t = as_timestamp(c.ts, epoch)
    dow, hr, mon = F.weekday(t), F.hour(t), F.month(t)
    return df.withColumns({
        "rating_datetime": t,
        "day_of_week": dow,
        "hour_of_day": hr,
        "month": mon,
        "season": season_col(mon),
        "is_weekend": is_weekend_col(dow),
        "day_period": day_period_col(hr),
    })
