"""Watermark and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LATENESS = "30 seconds"


def with_lateness(df: DataFrame, lateness: str = DEFAULT_LATENESS,
                  time_col: str = "ts_evento") -> DataFrame:
    """Event-time watermark: bounds streaming state and cuts late rows."""
    return df.withWatermark(time_col, lateness)


def dedup_stream(df: DataFrame, keys=("meta_id",)) -> DataFrame:
    """Bounded-state streaming dedup: state for a key expires once the
    watermark passes its event time (call ``with_lateness`` first)."""
    return df.dropDuplicatesWithinWatermark(list(keys))


def dedup_first(df: DataFrame, keys=("meta_id",),
                order=("ts_cola",)) -> DataFrame:
    """Batch twin of the streaming dedup: keep, per key, the row that came
    first by ``order`` (ties broken by the whole row).

    A grouped ``min`` over a struct instead of a ranking window: partial
    aggregation collapses a hot key to one row per map task before the
    shuffle, so a key holding a third of all rows never lands whole in one
    task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order_cols = [c for c in order if c in rest]
    others = [c for c in rest if c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + others]).alias("_first")
    return (
        df.groupBy(*keys)
        .agg(F.min(packed).alias("_first"))
        .select(*keys, *[F.col("_first." + c).alias(c) for c in rest])
        .select(*df.columns)
    )
