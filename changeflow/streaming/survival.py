"""Survival of the raw rows as a running job (H4): a left outer join of two
streams, raw ids and silver ids, under both watermarks.

An id that reaches silver comes out with its match; one that does not comes
out as lost once both watermarks have passed the time by which its match had
to arrive. The state holds the ids of that span only. ``delay`` bounds how
long after its event a raw message may still be read (its own watermark):
it must exceed the delays under study, or the late rows themselves would be
dropped before they are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.columns import delay_bucket

DELAY = "10 minutes"
#: a raw event and its silver row have the same event time
SLACK = "1 second"


def outcomes(raw: DataFrame, silver: DataFrame, delay: str = DELAY, slack: str = SLACK,
             null_bucket: str | None = None) -> DataFrame:
    """meta_id, tramo, ts_evento, llego: one row per id and delay bucket of
    ``raw`` (meta_id, ts_evento, retraso_s) and whether silver has the id.
    Streams give a stream (append); batch frames give the same at once."""
    ids = (raw.where(F.col("meta_id").isNotNull() & F.col("ts_evento").isNotNull())
           .select("meta_id", "ts_evento", delay_bucket("retraso_s", null_bucket).alias("tramo")))
    there = silver.select(F.col("meta_id").alias("_id"), F.col("ts_evento").alias("_ts"))
    if raw.isStreaming:
        ids = ids.withWatermark("ts_evento", delay).dropDuplicatesWithinWatermark(["meta_id", "tramo"])
        there = there.withWatermark("_ts", delay)
    else:
        ids, there = ids.dropDuplicates(["meta_id", "tramo"]), there.dropDuplicates(["_id"])
    near = F.expr("_ts >= ts_evento - INTERVAL %s AND _ts <= ts_evento + INTERVAL %s" % (slack, slack))
    return (ids.join(there, (F.col("meta_id") == F.col("_id")) & near, "left")
            .select("meta_id", "tramo", "ts_evento", F.col("_id").isNotNull().alias("llego")))


def survival_of(found: DataFrame) -> DataFrame:
    """The report of ``lateness.survival`` from outcomes."""
    hit = F.sum(F.col("llego").cast("long"))
    return (found.groupBy("tramo").agg(F.count(F.lit(1)).alias("en_bronce"), hit.alias("en_plata"))
            .withColumn("pct_superviviente", F.round(F.lit(100.0) * F.col("en_plata").cast("double")
                                                     / F.col("en_bronce").cast("double"), 1))
            .orderBy("tramo"))
