"""Commit history of a streaming query (G4), from its lasting batch record.

Parquet folders have no table snapshots; ``history`` keeps a record per
finished micro-batch, beyond the retention of the checkpoint's own logs. Two
separate runs show up as two bursts. A compacted folder keeps a record per
rewritten day, and a catalog table that has snapshots lists its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.sources.tables import compactions, is_folder
from changeflow.streaming import history


def has_history(spark: SparkSession, checkpoint: str) -> bool:
    return history.read(spark, checkpoint) is not None


def commit_history(spark: SparkSession, checkpoint: str, newest: int | None = None) -> DataFrame:
    """batch_id, committed_at, operation, rows, next_watermark; oldest first,
    or the ``newest`` n newest first. Empty without a record.
    A batch was committed when its commit file was written; where that was
    gone before it was recorded, the end of the batch stands in."""
    rows = history.read(spark, checkpoint)
    if rows is None:
        rows = spark.createDataFrame([], history.RECORD)
    started_ms = F.unix_millis(F.to_timestamp("started"))
    committed_ms = F.coalesce("committed_ms", started_ms + F.col("duration_ms"))
    out = rows.select("batch_id", F.timestamp_millis(committed_ms).alias("committed_at"),
                      F.lit("append").alias("operation"), F.col("input_rows").alias("rows"),
                      F.when(F.col("next_watermark_ms") > 0, F.timestamp_millis("next_watermark_ms")).alias("next_watermark"))
    if newest:
        return out.orderBy(F.col("batch_id").desc()).limit(newest)
    return out.orderBy("batch_id")


def table_commits(spark: SparkSession, name_or_path: str, checkpoint: str | None = None) -> DataFrame:
    """commit, committed_at, operation, rows, files of all that changed a
    table, oldest first. A catalog table: its snapshots. A folder: the
    micro-batches of ``checkpoint`` (append) and its compacted days
    (replace)."""
    if not is_folder(name_or_path):
        summary = F.col("summary")
        return spark.table(name_or_path + ".snapshots").select(
            F.col("snapshot_id").cast("string").alias("commit"), "committed_at", "operation",
            summary["added-records"].cast("long").alias("rows"),
            summary["added-data-files"].cast("long").alias("files")).orderBy("committed_at", "commit")
    out = compactions(spark, name_or_path).select(
        F.concat(F.lit("day "), "day").alias("commit"), F.timestamp_millis("committed_ms").alias("committed_at"),
        F.lit("replace").alias("operation"), "rows", F.col("files_after").alias("files"))
    if checkpoint:
        out = commit_history(spark, checkpoint).select(
            F.concat(F.lit("batch "), "batch_id").alias("commit"), "committed_at", "operation", "rows",
            F.lit(None).cast("long").alias("files")).unionByName(out)
    return out.orderBy("committed_at", "commit")
