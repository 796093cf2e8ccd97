from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ratings_engine.functions import temporal as ft
from ratings_engine.operators import encode as en
from ratings_engine.sources import tables as tb
from tests.conftest import rows


def test_sample_records_bad_epoch_is_null(spark):
    df = spark.createDataFrame([("1", "2", "4.0", "86400"), ("3", "4", "2.0", "oops")],
                               "userId string, movieId string, rating string, timestamp string") \
        .withColumn("extra", F.lit(1))
    s = tb.sample_records(df, 5, ["timestamp"], "timestamp")
    assert "extra" not in s.columns
    got = {r["userId"]: r["datetime"] for r in s.collect()}
    assert got["3"] is None and str(got["1"]).startswith("1970-01-02")


def test_write_read_partitioned_and_merge_schema(spark, tmpdir_path):
    a = spark.createDataFrame([(1, 4.0)], "user_id int, rating double")
    b = spark.createDataFrame([(2, 3.0, "x")], "user_id int, rating double, note string")
    tb.write_table(a, f"{tmpdir_path}/t", partition_cols=["rating"])
    tb.write_table(b, f"{tmpdir_path}/t", mode="append", partition_cols=["rating"])
    r = tb.read_table(spark, f"{tmpdir_path}/t", merge_schema=True)
    assert set(r.columns) == {"user_id", "rating", "note"} and r.count() == 2


def test_vector_to_text(spark):
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StructField, StructType
    schema = StructType([StructField("v", VectorUDT())])
    df = spark.createDataFrame([(Vectors.sparse(3, [1], [1.0]),), (None,)], schema)
    got = [r[0] for r in df.select(en.vector_to_text_col("v")).collect()]
    assert got == ["[0.0, 1.0, 0.0]", ""]


def test_calendar_columns(spark):
    # 2021-03-07 is a Sunday; 19:30 UTC is in the evening period
    df = spark.createDataFrame([(1615145400,)], "ts long")
    r = ft.temporal_features(df).first()
    assert (r["day_of_week"], r["hour_of_day"], r["month"], r["season"], r["is_weekend"], r["day_period"]) == \
        (6, 19, 3, 1, 1, 3)
    assert rows(ft.between_years(df, 2021, 2021)) == [(1615145400,)]
    assert ft.between_years(df, 2000, 2020).count() == 0
