"""Registry of named queries: a Spark builder and, where SQL can express it,
an independent DuckDB oracle over the same Parquet tables.

Query builders take ``(spark, sf_dir)`` and return a DataFrame; they read the
driver tables through the views in ``sources.views`` so their work grows with
the data. Oracle SQL may use the placeholders ``{R}``, ``{I}`` and ``{E}``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.views import E_SQL, I_SQL, R_SQL


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    heavy: bool = False   # model fitting: skipped by the quick bench subset


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, heavy: bool = False):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, heavy)
        return fn
    return deco


def render_sql(sql: str) -> str:
    return sql.replace("{R}", R_SQL).replace("{I}", I_SQL).replace("{E}", E_SQL)


def all_queries() -> dict[str, Query]:
    from . import queries  # noqa: F401  (registers on import)
    return REGISTRY
