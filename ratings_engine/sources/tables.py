"""Batch tables, item CSV, models and audit reads."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import WIRE_COLUMNS, commit_schema, items_schema


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """Batch scan. Column pruning and filter push-down happen when the
    caller's select/where sit next to this scan."""
    r = spark.read.format(fmt)
    if merge_schema and fmt == "parquet":
        r = r.option("mergeSchema", "true")
    return r.load(path)


def missing_path(e: AnalysisException) -> bool:
    cls = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    cond = cls() if cls else None
    return cond == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def read_first_available(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """The first table that exists (e.g. cleaned, else raw). Only a missing
    path falls through; any other error is raised (the reference catches all)."""
    last = None
    for p in paths:
        try:
            df = read_table(spark, p, fmt)
            df.schema  # noqa: B018  (resolves the relation: fails now if absent)
            return df
        except AnalysisException as e:
            if not missing_path(e):
                raise
            last = e
    raise FileNotFoundError(f"none of {paths} exists") from last


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    """Items CSV with header and quoted titles (commas inside quotes).
    Explicit schema: no inference pass over the file."""
    return (spark.read.schema(items_schema()).option("header", True).option("quote", '"')
            .option("escape", '"').option("mode", "PERMISSIVE").csv(path)
            .withColumnRenamed("movieId", "item_id"))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                merge_schema: bool = False, partition_cols: list[str] | None = None) -> None:
    """Write a table. ``merge_schema`` applies to Delta on write (for
    Parquet, schemas are merged on read with ``read_table(merge_schema=True)``)."""
    w = df.write.format(fmt).mode(mode)
    if merge_schema and fmt == "delta":
        w = w.option("mergeSchema", "true")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)


def save_model(model, path: str) -> None:
    """Persist an MLlib model (overwrite)."""
    model.write().overwrite().save(path)


def load_model(cls, path: str):
    """``cls`` is the model class, e.g. ``ALSModel``."""
    return cls.load(path)


def load_or_fit(cls, path: str, fit):
    """Load a saved model, else call ``fit()`` and save the result."""
    try:
        return cls.load(path)
    except Exception as e:  # noqa: BLE001  (absent or unreadable model dir)
        if "PATH_NOT_FOUND" not in str(e) and "Input path does not exist" not in str(e):
            raise
    m = fit()
    save_model(m, path)
    return m


def table_row_count(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row ``row_count``; an absent table counts 0. For Parquet the
    count reads only row-group metadata (no column is scanned)."""
    try:
        df = read_table(spark, path, fmt)
        df.schema  # noqa: B018
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"))
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def sample_records(df: DataFrame, n: int = 8, order: list[str] | None = None, ts_col: str | None = None,
                   wire: list[str] = WIRE_COLUMNS) -> DataFrame:
    """N most recent rows (deterministic order), only the wire columns
    that exist, epoch seconds -> timestamp with bad values -> NULL."""
    cols = [c for c in wire if c in df.columns]
    x = df.select(*(cols or df.columns))
    if order:
        x = x.orderBy(*[F.desc(o) if i == 0 else F.asc(o) for i, o in enumerate(order)])
    x = x.limit(n)
    if ts_col and ts_col in x.columns:
        x = x.withColumn("datetime", F.timestamp_seconds(F.col(ts_col).try_cast("bigint")))
    return x


def commit_history(spark: SparkSession, log_glob: str) -> DataFrame:
    """Per table directory -- commits, first and last commit time (ms),
    operations seen; malformed lines skipped. Reads JSON lines with an explicit
    schema, PERMISSIVE; the table is the folder above ``_delta_log``."""
    raw = (spark.read.schema(commit_schema()).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record").json(log_glob))
    x = raw.where(F.col("_corrupt_record").isNull() & F.col("commitInfo.timestamp").isNotNull()).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/_delta_log/[^/]*$", 1).alias("table_path"),
        F.col("commitInfo.timestamp").alias("commit_ms"), F.col("commitInfo.operation").alias("operation"))
    x = x.withColumn("table_path", F.when(F.col("table_path") == "", F.lit(None)).otherwise(F.col("table_path")))
    return x.groupBy("table_path").agg(
        F.count(F.lit(1)).alias("commits"), F.min("commit_ms").alias("first_commit_ms"),
        F.max("commit_ms").alias("last_commit_ms"), F.array_sort(F.collect_set("operation")).alias("operations"))


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files by extension under ``root`` (recursive), '(no ext)' bucket.
    Uses the binaryFile listing but selects only path/length: content is not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select("path", "length"))
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    ext = F.regexp_extract(name, r"(?<=.)\.([^./]+)$", 1)
    return files.groupBy(F.when(ext == "", F.lit("(no ext)")).otherwise(F.lower(ext)).alias("extension")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
