"""Fixed schemas (S2) and the wire <-> generic column mapping."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the wire format: JSON keys of a rating message.
WIRE_USER, WIRE_ITEM, WIRE_RATING, WIRE_TS = "userId", "movieId", "rating", "timestamp"
WIRE_COLUMNS = [WIRE_USER, WIRE_ITEM, WIRE_RATING, WIRE_TS]


def rating_schema() -> T.StructType:
    """Payload schema of a rating message. ``from_json`` ignores the
    non-null flags and yields NULL for missing or wrong-typed fields."""
    return T.StructType([
        T.StructField(WIRE_USER, T.IntegerType(), nullable=False),
        T.StructField(WIRE_ITEM, T.IntegerType(), nullable=False),
        T.StructField(WIRE_RATING, T.FloatType(), nullable=False),
        T.StructField(WIRE_TS, T.LongType(), nullable=False),
    ])


def items_schema() -> T.StructType:
    """Item dimension CSV: id, title '(YYYY)', '|'-separated genres."""
    return T.StructType([
        T.StructField("movieId", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ])


def commit_schema() -> T.StructType:
    """Table commit-log line: ``{"commitInfo": {"timestamp": ms, "operation": ...}}``."""
    return T.StructType([
        T.StructField("commitInfo", T.StructType([
            T.StructField("timestamp", T.LongType()),
            T.StructField("operation", T.StringType()),
        ])),
        T.StructField("_corrupt_record", T.StringType()),
    ])
