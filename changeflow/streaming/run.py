"""Append sinks, grouped runs and progress."""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.sources import files
from changeflow.sources.tables import PARTITION_COL
from changeflow.streaming import history


def _last_batch(spark: SparkSession, folder: str) -> int:
    found = (re.fullmatch(r"(\d+)(\.compact)?", n) for n in files.names(spark, folder))
    return max((int(m[1]) for m in found if m), default=-1)


def check_sink_log(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Refuse a folder whose sink log is ahead of the checkpoint. A file sink
    skips every batch id its log already holds, so a fresh (or foreign)
    checkpoint on such a folder would lose its first batches without a word."""
    written = _last_batch(spark, "%s/_spark_metadata" % path.rstrip("/"))
    known = _last_batch(spark, "%s/offsets" % checkpoint.rstrip("/"))
    if written > known:
        raise RuntimeError(
            "%s holds batches up to %d, but the checkpoint %s knows only batches up to %d: its next batches would "
            "be skipped. Use the checkpoint that wrote this folder, or another folder." % (path, written, checkpoint, known))


def append_stream(df: DataFrame, path: str, checkpoint: str, *, day_from: str | None = None,
                  trigger: str | None = "10 seconds", available_now: bool = False,
                  name: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """B2: append a stream to a layer folder, partitioned by the day of
    ``day_from``, zstd Parquet, checkpoint in the shared store. Rows are
    written as they come (no sort before the write): one day is alive at a
    time, so each task writes few files. With ``fmt="iceberg"`` ``path`` is
    a catalog table name. Every batch is recorded (``history``)."""
    spark = df.sparkSession
    if fmt == "parquet":
        check_sink_log(spark, path, checkpoint)
    history.listen(spark)
    if day_from and fmt == "parquet":
        df = df.withColumn(PARTITION_COL, F.to_date(F.col(day_from)))
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint))
    if fmt == "parquet":
        w = w.option("compression", "zstd")
        if day_from:
            w = w.partitionBy(PARTITION_COL)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    if fmt == "iceberg":
        # a catalog table, partitioned by its own days(); no sort by partition first
        query = w.option("fanout-enabled", "true").toTable(path)
    else:
        query = w.start(path)
    history.follow(spark, query, checkpoint)
    return query


def say_progress(query: StreamingQuery, seen: dict) -> None:
    """Print the rate and rows of a query's last micro-batch, once a batch."""
    p = query.lastProgress
    if p and seen.get(query.id) != p["batchId"] and p["numInputRows"]:
        seen[query.id] = p["batchId"]
        print("%s batch %d: %d rows, %.1f rows/s in, %.1f rows/s processed" % (
            query.name or query.id, p["batchId"], p["numInputRows"], p["inputRowsPerSecond"] or 0.0,
            p["processedRowsPerSecond"] or 0.0), flush=True)


def run_group(spark: SparkSession, queries: list[StreamingQuery], seconds: float = 0,
              poll_s: float = 0.5, tell: Callable[[StreamingQuery, dict], None] | None = None) -> None:
    """The queries of one group live and die together. Watches only the
    queries given (the session may run other groups) until ``seconds`` have
    passed (0: no limit) or one of them ends, stops the others, and raises the
    error of one that failed: gold tables of which some went on and some did
    not would disagree. ``tell`` is called with each query while the group runs
    (``say_progress`` prints rates and rows)."""
    seen: dict = {}
    deadline = time.monotonic() + seconds if seconds else None
    try:
        while all(q.isActive for q in queries):
            if deadline is not None and time.monotonic() >= deadline:
                break
            time.sleep(poll_s)
            for q in queries if tell else ():
                tell(q, seen)
    except KeyboardInterrupt:
        pass
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
            history.settle(spark, q)
    errors = [q.exception() for q in queries if q.exception() is not None]
    if errors:
        raise RuntimeError("a query of the group failed: %s" % errors[0])


def run_available(queries: list[StreamingQuery]) -> None:
    """Wait for ``availableNow`` queries to drain their input and stop."""
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        history.settle(SparkSession.active(), q)


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """All micro-batches of this run of the query, with late-row drops,
    duplicate drops and state size summed over its stateful operators. A query
    that ``append_stream`` did not start has no record: that is an error."""
    checkpoint = history.of_query(query)
    if checkpoint is None:
        raise ValueError("no batches are recorded for this query; start it with append_stream")
    history.settle(spark, query)
    rows = history.read(spark, checkpoint)
    if rows is None:
        rows = spark.createDataFrame([], history.RECORD)
    return rows.where(F.col("run_id") == str(query.runId)).select(
        F.col("batch_id").alias("batchId"), F.col("started").alias("timestamp"),
        F.col("input_rows").alias("numInputRows"), F.col("input_rate").alias("inputRowsPerSecond"),
        F.col("process_rate").alias("processedRowsPerSecond"), F.col("late_drops").alias("rowsDroppedByWatermark"),
        F.col("duplicate_drops").alias("duplicatesDropped"), F.col("state_rows").alias("stateRows"), "watermark",
        F.col("duration_ms").alias("durationMs"), F.col("read_rows").alias("readRows"), "unreadable",
        F.col("without_id").alias("withoutId"), F.col("without_time").alias("withoutTime"))
