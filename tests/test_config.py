import os

import pytest
from pyspark.sql import functions as F

from ratings_engine import config


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):  # noqa: N802  (Spark's name)
        return None


class _Session:
    sparkContext = _Context()  # noqa: N815

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        config.checkpoint_dir(_Session())


def test_scratch_paths_never_collide(spark):
    paths = {config.scratch_path(spark, "x") for _ in range(50)}
    assert len(paths) == 50
    assert all(spark.sparkContext.applicationId in p for p in paths)


def test_materialize_keeps_rows_and_discard_removes_them(spark):
    t = config.materialize(spark.range(10), "ten")
    assert t.count() == 10
    path = t._scratch_path.replace("file://", "").replace("file:", "")
    assert os.path.isdir(path)
    config.discard(t)
    assert not os.path.exists(path)


def test_materialize_releases_its_shuffle(spark):
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = spark.conf.get(config.RELEASE)
    table = config.materialize(counts, "counts")
    assert spark.conf.get(config.RELEASE) == before
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, counts.collect()))
    config.discard(table)
