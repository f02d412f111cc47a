"""Capture files (A7): JSON lines ``{"_recibido": <epoch s>, "_evento": {...}}``
written by a live listener; an event that could not be read is stored as
``{"_evento": {"_error_parseo": "<first 500 chars>"}}``.

A capture frame has: recibido (double, epoch s), seq (tie-breaker for equal
arrival times, in file order), evento (JSON text of the event), error (true
for an error record and for a line that is no record at all).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType([
    T.StructField("_recibido", T.DoubleType()),
    # An object read into a string field keeps its JSON text.
    T.StructField("_evento", T.StringType()),
])


def read_capture(spark: SparkSession, path: str) -> DataFrame:
    """Scan capture files; blank lines are skipped. ``seq`` follows the
    file order (monotonic id assigned right at the scan)."""
    lines = (spark.read.text(path)
             .withColumn("seq", F.monotonically_increasing_id())
             .filter(F.trim(F.col("value")) != ""))
    rec = lines.select(F.from_json(F.col("value"), RECORD).alias("r"), "seq")
    event = F.col("r._evento")
    return rec.select(
        F.col("r._recibido").alias("recibido"),
        F.col("seq"),
        event.alias("evento"),
        (event.isNull() | F.get_json_object(event, "$._error_parseo").isNotNull()).alias("error"),
    )


def capture_from_raw(raw: DataFrame) -> DataFrame:
    """A capture frame from raw envelope rows: arrival = queue time, ties
    broken by (offset, partition). Both are 64-bit integers in a 38-digit
    decimal (offset x 2^63 + partition would not fit one long); offsets or
    partitions beyond that (Kinesis sequence numbers) fall back to a hash of
    the message."""
    offset = F.expr("try_cast(desplazamiento AS BIGINT)").cast("decimal(38,0)")
    part = F.when(F.col("particion").isNull(), F.lit(0)).otherwise(F.expr("try_cast(particion AS BIGINT)")).cast("decimal(38,0)")
    seq = F.coalesce((offset * F.expr("9223372036854775808BD")).cast("decimal(38,0)") + part,
                     F.xxhash64(F.col("valor")).cast("decimal(38,0)"))
    return raw.select(
        (F.unix_micros(F.col("ts_cola")) / F.lit(1e6)).alias("recibido"),
        seq.cast("decimal(38,0)").alias("seq"),
        F.col("valor").alias("evento"),
        F.lit(False).alias("error"),
    )


def write_capture(cap: DataFrame, path: str) -> None:
    """Write a capture frame back as JSON lines (one file per task)."""
    (cap.select(F.to_json(F.struct(
        F.col("recibido").alias("_recibido"),
        F.parse_json(F.col("evento")).alias("_evento"))).alias("value"))
     .write.mode("overwrite").text(path))
