"""Late data: find a tagged test batch in the raw layer, bucket it by delay
and measure how much of each bucket reached silver (H1-H5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.columns import delay_bucket, event_time, ingest_delay
from changeflow.operators.refine import parse_event
from changeflow.schemas import TAGGED_EVENT

DEFAULT_TAG_PREFIX = "evento sintetico"


def tagged(raw: DataFrame, prefix: str = DEFAULT_TAG_PREFIX) -> DataFrame:
    """H1: raw rows of one test batch (``comment`` starts with ``prefix``),
    with their event time and queue delay."""
    return (parse_event(raw, TAGGED_EVENT)
            .filter(F.col("e.comment").startswith(prefix))
            .select(F.col("e.meta.id").alias("meta_id"),
                    event_time(F.col("e.meta.dt")).alias("ts_evento"),
                    F.col("ts_cola"))
            .withColumn("retraso_s", ingest_delay("ts_cola", "ts_evento")))


def injected_duplicates(batch: DataFrame) -> DataFrame:
    """H2: rows, distinct ids and the difference (duplicates injected)."""
    return (batch.agg(F.count(F.lit(1)).alias("filas"),
                      F.count_distinct("meta_id").alias("distintos"))
            .withColumn("duplicados", F.col("filas") - F.col("distintos")))


def survival(batch: DataFrame, silver: DataFrame, one_bucket_per_id: bool = False,
             null_bucket: str | None = None) -> DataFrame:
    """H4: per delay bucket, distinct ids in the raw batch, how many reached
    silver and the share (%, 1 decimal), ordered by bucket.

    By default an id is counted once per bucket its copies fall in (as the
    reference does); ``one_bucket_per_id`` keeps only its smallest delay.
    A NULL delay falls in the last bucket unless ``null_bucket`` names its
    own. The silver side is reduced to distinct ids before the join, and the
    joins carry no hint: AQE picks broadcast or sort-merge from true sizes."""
    if one_bucket_per_id:
        ids = batch.groupBy("meta_id").agg(F.min("retraso_s").alias("retraso_s"))
    else:
        ids = batch.select("meta_id", "retraso_s")
    b = ids.select("meta_id", delay_bucket("retraso_s", null_bucket).alias("tramo")).distinct()
    if "dia" in silver.columns and "ts_evento" in batch.columns:
        # A stored, day-partitioned silver: only the days of the batch matter.
        # An id lands in silver on the day of its own event time, so the
        # semi join on the partition column loses nothing.
        days = batch.select(F.to_date("ts_evento").alias("dia")).filter(F.col("dia").isNotNull()).distinct()
        silver = silver.join(days, "dia", "left_semi")
    s = silver.select("meta_id").distinct().withColumn("_hit", F.lit(1))
    hit = F.sum(F.when(F.col("_hit").isNotNull(), 1).otherwise(0)).cast("long")
    return (b.join(s, "meta_id", "left")
            .groupBy("tramo")
            .agg(F.count(F.lit(1)).alias("en_bronce"), hit.alias("en_plata"))
            .withColumn("pct_superviviente",
                        F.round(F.lit(100.0) * F.col("en_plata").cast("double") / F.col("en_bronce").cast("double"), 1))
            .orderBy("tramo"))


def dedup_proof(silver: DataFrame) -> DataFrame:
    """H5: silver rows, distinct ids and duplicates left (must be 0)."""
    return injected_duplicates(silver.select("meta_id"))
