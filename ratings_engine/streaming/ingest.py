"""Streaming ingest of rating messages.

Kafka is the production source (``format("kafka")``, bounded offsets per
trigger); a directory of JSON-lines files with ``maxFilesPerTrigger`` is the
same contract for tests. The job is stateless and append-only; exactly-once
comes from the checkpoint plus the file/Delta sink's commit log, so a
restart with the same checkpoint resumes where it stopped.
"""

from __future__ import annotations

import contextlib
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import COLS, DEFAULTS, Cols
from ..sources.schema import WIRE_COLUMNS, WIRE_ITEM, WIRE_RATING, WIRE_TS, WIRE_USER, rating_schema


def read_rating_stream(spark: SparkSession, source: str = "kafka", *, servers: str | None = None,
                       topic: str = "ratings", path: str | None = None,
                       max_per_trigger: int | None = None, max_bytes_per_trigger: int | str | None = None,
                       starting: str = "earliest", min_partitions: int | None = None) -> DataFrame:
    """S1 + T2: raw stream with a string-castable ``value`` and a ``kafka_timestamp``.

    ``source='kafka'``: subscription from ``starting``, at most
    ``max_per_trigger`` offsets per micro-batch, ``failOnDataLoss=false``.
    Messages are keyed by user, so one hot user fills one topic partition;
    ``min_partitions`` makes Spark split large offset ranges of a partition
    over several tasks instead of one.
    ``source='files'``: JSON lines under ``path``; the file's modification time stands in
    for the broker time. A micro-batch is bounded in bytes (``max_bytes_per_trigger``, a number or
    ``128m``), whatever the sizes of the files; a file larger than that is a batch of its own.
    ``max_per_trigger`` bounds the number of files instead.

    A source takes its own kind of bound only: rows for Kafka, bytes or files for files.
    """
    if max_bytes_per_trigger is not None and (source == "kafka" or max_per_trigger is not None):
        raise ValueError("bytes bound a file source, and not together with a number of files")
    if source == "kafka":
        raw = (spark.readStream.format("kafka")
               .option("kafka.bootstrap.servers", servers)
               .option("subscribe", topic)
               .option("startingOffsets", starting)
               .option("maxOffsetsPerTrigger", max_per_trigger or DEFAULTS.max_offsets_per_trigger)
               .option("failOnDataLoss", "false"))
        if min_partitions:
            raw = raw.option("minPartitions", min_partitions)
        raw = raw.load()
        return raw.select("key", "value", F.col("timestamp").alias("kafka_timestamp"))
    bound = ("maxFilesPerTrigger", max_per_trigger) if max_per_trigger is not None else ("maxBytesPerTrigger", max_bytes_per_trigger or DEFAULTS.max_bytes_per_trigger)
    raw = spark.readStream.format("text").option(*bound).load(path)
    return raw.select(F.lit(None).cast("binary").alias("key"), F.col("value"),
                      F.col("_metadata.file_modification_time").alias("kafka_timestamp"))


def parse_ratings(raw: DataFrame, c: Cols = COLS) -> DataFrame:
    """Value -> string -> ``from_json`` -> flat columns + broker time +
    ``processed_at``; rows whose **user id** is NULL are dropped (only that
    field is checked, as in the reference: a bad rating with a valid user passes).
    Narrow projection + filter: no shuffle.

    The parsed struct is flattened with ``inline`` so that the JSON is parsed
    once per message: a filter on a plain struct field would be pushed below
    the projection and parse the message a second time.
    """
    data = F.from_json(F.col("value").cast("string"), rating_schema())
    flat = raw.select(F.inline(F.array(data)), "kafka_timestamp")
    return (flat.where(F.col(WIRE_USER).isNotNull())
            .select(F.col(WIRE_USER).alias(c.user), F.col(WIRE_ITEM).alias(c.item),
                    F.col(WIRE_RATING).alias(c.rating), F.col(WIRE_TS).alias(c.ts),
                    "kafka_timestamp", F.current_timestamp().alias("processed_at")))


def append_stream(df: DataFrame, path: str, checkpoint: str, *, fmt: str = "parquet",
                  processing_time: str | None = f"{DEFAULTS.trigger_seconds} seconds",
                  available_now: bool = False, query_name: str | None = None) -> StreamingQuery:
    """S3: append micro-batches to a table, checkpointed. ``available_now``
    drains what is there and stops (batch-like runs and tests)."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start(path)


def run_until_stopped(q: StreamingQuery) -> None:
    """Block until the query ends; its failure is raised, an interrupt ends it quietly."""
    try:
        with contextlib.suppress(KeyboardInterrupt):
            q.awaitTermination()
    finally:
        q.stop()


def ingest_until(q: StreamingQuery, n_rows: int | None = None, seconds: float | None = None,
                 poll: float = 1.0) -> int:
    """Stop the query once ``n_rows`` input rows were processed or after
    ``seconds``; returns the rows processed. Reads only the progress reports."""
    start = time.time()
    seen_batches: set[int] = set()
    total = 0
    while q.isActive:
        for p in q.recentProgress:
            b = p["batchId"]
            if b not in seen_batches:
                seen_batches.add(b)
                total += int(p["numInputRows"])
        if (n_rows is not None and total >= n_rows) or (seconds is not None and time.time() - start >= seconds):
            break
        time.sleep(poll)
    failure = q.exception()
    q.stop()
    if failure is not None:
        raise failure
    return total


def ingest(spark: SparkSession, sink: str, checkpoint: str, *, source: str = "kafka",
           available_now: bool = False, fmt: str = "parquet", **source_opts) -> StreamingQuery:
    """S1 -> P1 -> S3 as one stateless append job."""
    raw = read_rating_stream(spark, source, **source_opts)
    return append_stream(parse_ratings(raw), sink, checkpoint, fmt=fmt, available_now=available_now)


# ------------------------------------------------------------------ producer side

def publish_events(rows: DataFrame, c: Cols = COLS, wire=(WIRE_USER, WIRE_ITEM, WIRE_RATING, WIRE_TS)):
    """(key, value) messages from a text table (e.g. CSV with header, all
    strings) plus one-row counts (sent, skipped).

    Each of the four fields is ``try_cast`` to its type; a row is skipped when a
    field is absent or any cast fails. ``value`` is the JSON object, ``key`` the
    user id text. Write with ``.write.format("kafka")`` (or text for files).
    """
    types = {wire[0]: "int", wire[1]: "int", wire[2]: "float", wire[3]: "bigint"}
    missing = [k for k in wire if k not in rows.columns]
    if missing:
        casted = rows.select(*[F.lit(None).cast(t).alias(k) for k, t in types.items()])
    else:
        casted = rows.select(*[F.col(k).cast("string").try_cast(t).alias(k) for k, t in types.items()])
    ok = F.lit(True)
    for k in wire:
        ok = ok & F.col(k).isNotNull()
    flagged = casted.withColumn("_ok", ok)
    msgs = flagged.where("_ok").select(
        F.col(wire[0]).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(k) for k in wire])).alias("value"))
    counts = flagged.agg(F.count_if("_ok").alias("sent"), F.count_if(~F.col("_ok")).alias("skipped"))
    return msgs, counts


def wire_messages(r: DataFrame, c: Cols = COLS) -> DataFrame:
    """Rating rows -> (key, value) JSON messages (the producer's wire format)."""
    msgs, _ = publish_events(r.select(F.col(c.user).alias(WIRE_USER), F.col(c.item).alias(WIRE_ITEM),
                                      F.col(c.rating).alias(WIRE_RATING), F.col(c.ts).alias(WIRE_TS)))
    return msgs


# ------------------------------------------------------------------ monitoring

def ingest_rate(df: DataFrame, time_col: str = "processed_at", seconds: int = 3, keep: int = 60) -> DataFrame:
    """T3 (batch form): rows per ``seconds``-wide window of ``time_col``;
    ``rows_added``, cumulative ``total_rows`` and integer ``rows_per_sec``; only
    the last ``keep`` non-empty windows are returned.

    The window counts are a partial aggregate; only ``keep`` rows are ordered,
    and the total before them comes from a one-row aggregate.
    """
    t = F.col(time_col)
    w = df.groupBy(F.window(t, f"{seconds} seconds").alias("_w")).agg(F.count(F.lit(1)).alias("rows_added"))
    last = w.orderBy(F.desc("_w.start")).limit(keep)
    total = df.agg(F.count(F.lit(1)).alias("_all"))
    from pyspark.sql import Window
    run = Window.orderBy("_w.start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tail = Window.partitionBy(F.lit(0))
    x = last.crossJoin(F.broadcast(total))  # keep rows x one row
    return x.select(
        F.unix_timestamp(F.col("_w.start")).alias("window_start"),
        "rows_added",
        (F.col("_all") - F.sum("rows_added").over(tail) + F.sum("rows_added").over(run)).alias("total_rows"),
        F.floor(F.col("rows_added") / F.lit(seconds)).cast("bigint").alias("rows_per_sec"))


def ingest_rate_stream(stream: DataFrame, time_col: str = "processed_at", seconds: int = 3,
                       watermark: str = "30 seconds") -> DataFrame:
    """T3 (streaming form): windowed counts with a watermark (append or update mode)."""
    return (stream.withWatermark(time_col, watermark)
            .groupBy(F.window(time_col, f"{seconds} seconds").alias("_w"))
            .agg(F.count(F.lit(1)).alias("rows_added"))
            .select(F.col("_w.start").alias("window_start"), "rows_added",
                    F.floor(F.col("rows_added") / F.lit(seconds)).cast("bigint").alias("rows_per_sec")))


def ingest_progress(count: Column, target: Column | int, speed: Column) -> dict[str, Column]:
    """T4: progress min(count/target, 1), remaining, ETA seconds (NULL when idle)
    and state active / idle / empty."""
    tgt = target if isinstance(target, Column) else F.lit(target)
    return {
        "progress": F.least(F.try_divide(count.cast("double"), tgt.cast("double")), F.lit(1.0)),
        "remaining": F.greatest(tgt - count, F.lit(0)),
        "eta_seconds": F.when(speed > 0, F.floor((tgt - count) / speed)).cast("double"),
        "state": F.when(speed > 0, F.lit("active")).when(count > 0, F.lit("idle")).otherwise(F.lit("empty")),
    }


__all__ = ["read_rating_stream", "parse_ratings", "append_stream", "run_until_stopped", "ingest_until", "ingest",
           "publish_events", "wire_messages", "ingest_rate", "ingest_rate_stream", "ingest_progress",
           "WIRE_COLUMNS"]
