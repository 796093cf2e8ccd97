"""Presentation columns (P22-P24), as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def format_magnitude(col) -> Column:
    """>= 1e6 -> '%.2fM', >= 1e3 -> '%.1fK', else the integer text
    (999999 -> '1000.0K')."""
    x = _c(col).cast("double")
    return (F.when(x >= 1e6, F.format_string("%.2fM", x / 1e6))
            .when(x >= 1e3, F.format_string("%.1fK", x / 1e3))
            .otherwise(x.cast("long").cast("string")))


def scale_label(size, total) -> Column:
    """Sizes below a million as '<n div 1000>K', others '<n div 10^6>M';
    no size (the whole table) as '<total/10^6 with one decimal>M (all)' from a
    million rows up, else the total with digit grouping."""
    size, total = _c(size), _c(total)
    full = F.when(total >= 1_000_000, F.format_string("%.1fM (all)", total / 1e6)) \
        .otherwise(F.format_number(total, 0))
    part = F.when(size < 1_000_000, F.concat(F.floor(size / 1000).cast("string"), F.lit("K"))) \
        .otherwise(F.concat(F.floor(size / 1_000_000).cast("string"), F.lit("M")))
    return F.when(size.isNull(), full).otherwise(part)


def short_title(col, n: int = 35) -> Column:
    """First n characters."""
    return F.substring(_c(col), 1, n)
