"""Item-dimension columns (P11-P15) and the fact-to-dimension join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COLS, Cols
from ..operators.windows import DEFAULT_HOT_ROWS, salted_join

# Fixed values of the reference's item format.
TITLE_YEAR_PATTERN = r"\((\d{4})\)\s*$"
NO_GENRES = "(no genres listed)"
UNKNOWN = "Unknown"


def title_year_col(title: str | Column = COLS.title) -> Column:
    """Trailing '(YYYY)' -> int; no match -> NULL (try_cast, ANSI-safe)."""
    t = F.col(title) if isinstance(title, str) else title
    return F.regexp_extract(t, TITLE_YEAR_PATTERN, 1).try_cast("int")


def genre_count_col(genres: str | Column = COLS.genres, none_label: str = NO_GENRES) -> Column:
    """0 for the 'no genres' label, else number of '|' parts (NULL stays NULL)."""
    g = F.col(genres) if isinstance(genres, str) else genres
    return F.when(g == none_label, F.lit(0)).otherwise(F.size(F.split(g, r"\|")))


def primary_genre_col(genres: str | Column = COLS.genres) -> Column:
    """First '|' part; keeps the 'no genres' label as is."""
    g = F.col(genres) if isinstance(genres, str) else genres
    return F.split(g, r"\|").getItem(0)


def item_age_col(rating_year: Column, title_year: Column) -> Column:
    """Rating year - title year; 0 when the title has no year (may be negative)."""
    return F.when(title_year.isNull(), F.lit(0)).otherwise(rating_year - title_year)


def fill_unknown_col(col: str | Column, label: str = UNKNOWN) -> Column:
    """NULL category -> 'Unknown'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(label))


def item_features(items: DataFrame, c: Cols = COLS) -> DataFrame:
    """P11-P13 on the dimension (computed once per item, not per rating)."""
    return items.select(
        c.item,
        title_year_col(c.title).alias("movie_year"),
        genre_count_col(c.genres).alias("genre_count"),
        primary_genre_col(c.genres).alias("primary_genre"),
    )


def with_item_attributes(r: DataFrame, items: DataFrame, cols: list[str] | None = None,
                         c: Cols = COLS, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Fact LEFT JOIN dimension on item; unmatched facts kept with NULLs.

    The rows of an item with more than ``hot_rows`` ratings are salted over
    several join tasks. Only the item column is read for the counts. A NULL
    item matches nothing.
    """
    d = (items if cols is None else items.select(c.item, *cols)).where(F.col(c.item).isNotNull())
    counts = r.groupBy(c.item).agg(F.count(F.lit(1)).alias("_item_n"))
    salt = [c.key] if c.key in r.columns else [x for x in (c.ts, c.user) if x in r.columns] or r.columns
    return salted_join(r, d.join(counts, c.item, "left"), c.item, "_item_n", salt, hot_rows=hot_rows).drop("_item_n")
