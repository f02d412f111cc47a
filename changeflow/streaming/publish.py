"""Keyed publish of change events to a queue.

The key is ``wiki|title``: every change of one page goes to one queue
partition and keeps its order, and no single value concentrates traffic.
The producer waits for all replicas, is idempotent and compresses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.columns import partition_key

PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.compression.type": "snappy",
    "kafka.linger.ms": "10",
}


def with_key(changes: DataFrame, wiki: str = "wiki", title: str = "titulo", value: Column | None = None) -> DataFrame:
    """Key/value frame of any frame of changes: key ``wiki|title`` (a missing
    part becomes ``?``), value the change as UTF-8 JSON text: ``value`` if
    given, else all columns of the row."""
    value = F.to_json(F.struct(*[F.col(c) for c in changes.columns])) if value is None else value
    return changes.select(partition_key(wiki, title).alias("key"), value.alias("value"))


def publish(keyed: DataFrame, brokers: str, topic: str, checkpoint: str | None = None):
    """Write a key/value frame to a Kafka topic; a streaming frame needs a
    ``checkpoint`` and returns the running query."""
    opts = dict(PRODUCER_OPTIONS, **{"kafka.bootstrap.servers": brokers, "topic": topic})
    kv = keyed.select(F.col("key").cast("string"), F.col("value").cast("string"))
    if kv.isStreaming:
        return (kv.writeStream.format("kafka").options(**opts)
                .option("checkpointLocation", checkpoint).start())
    kv.write.format("kafka").options(**opts).save()
    return None
