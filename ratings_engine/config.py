"""Session defaults, column names and domain thresholds.

Every operator takes its thresholds as arguments; the values here are only
the defaults, kept in one place.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Cols:
    """Generic column names used by every operator."""

    user: str = "user_id"
    item: str = "item_id"
    rating: str = "rating"
    ts: str = "ts"
    key: str = "row_key"
    title: str = "title"
    genres: str = "genres"


COLS = Cols()


@dataclass(frozen=True)
class Thresholds:
    # Fixed values of the reference's domain (defaults only; every operator
    # takes them as arguments).
    rating_min: float = 0.5
    rating_max: float = 5.0
    hyperactive_min: int = 10_000
    suspicious_min_n: int = 50
    suspicious_max_sd: float = 0.1
    quantile_rel_err: float = 0.01
    like_threshold: float = 3.5
    top_mean_min_n: int = 500
    split_ratio: float = 0.8
    seed: int = 42
    max_offsets_per_trigger: int = 10_000
    max_bytes_per_trigger: str = "128m"
    trigger_seconds: int = 10


DEFAULTS = Thresholds()


def build_session(master: str | None = None, app: str = "ratings_engine",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the settings this library expects.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the
    cluster manager and AQE decide. Locally pass e.g. ``local[8]`` / 8.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Without one, a ``local`` master (tests, notebooks) gets a scratch folder of
    its own; any other master is refused, because executors would each write to
    their own disk and readers would find only part of a table.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="ratings-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables:
    the application id and a random part keep two drivers apart."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


#: Spark 4.1: drop the shuffle files of a query when it ends. They would otherwise stay
#: on the executors' disks until the driver happens to collect its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def session_conf(spark: SparkSession, **settings):
    """Session settings (dots written as ``__``) for what is planned and run inside; the earlier ones come back after it."""
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df, name: str = "materialized"):
    """Cut lineage: write ``df`` once as a Parquet table under the shared
    checkpoint folder and read it back, so that several branches of a plan
    scan the written rows (with column pruning and filter push-down) instead
    of recomputing an expensive input such as a join. A lost executor then
    re-reads files instead of replaying the lineage. (An RDD ``checkpoint()``
    would compute the input twice and lose the columnar scan.)

    The application owns the folder: it goes when the application ends, or
    earlier by ``discard``. The shuffle files of the write go with its end."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        df.select("*").write.mode("errorifexists").parquet(path)   # select: the setting is read when a frame is made
    finally:
        spark.conf.set(RELEASE, before)
    p, fs = _folder(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables) -> None:
    """Delete tables of ``materialize`` that nothing reads any more."""
    for t in tables:
        path = getattr(t, "_scratch_path", None)
        if path:
            p, fs = _folder(t.sparkSession, path)
            fs.delete(p, True)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle and checkpoint files deleted that no live frame or model refers to.

    Spark deletes the files of an RDD shuffle (MLlib fits make many) once the driver has collected the
    objects behind it. A loop of fits leaves little garbage on the driver, so no collection comes by itself
    before the executors' disks hold the shuffles of every fit."""
    gc.collect()                              # py4j drops its references first
    spark.sparkContext._jvm.System.gc()
