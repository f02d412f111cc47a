"""Queue scans and their envelopes.

A queue is described by one ``Queue`` object: the connector it is read with,
the options of a scan, how the connector's columns become envelope columns
(clave, valor, origen, particion, desplazamiento, ts_cola), and whether its
offsets are consecutive. Nothing downstream asks which queue it was. The
connector jars (Kafka, Kinesis) are supplied by the cluster.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.schemas import ENVELOPE

SOURCE_ENV = "CHANGEFLOW_SOURCE"


@dataclass(frozen=True)
class Queue:
    """``columns``: envelope column -> expression over the connector's
    columns, cast to the envelope's type. ``options``: scan settings ->
    connector options."""
    connector: str
    consecutive: bool
    options: Callable[..., dict[str, str]]
    columns: dict[str, str]

    def scan(self, spark: SparkSession, **settings) -> DataFrame:
        return spark.readStream.format(self.connector).options(**self.options(**settings)).load()

    def envelope(self, df: DataFrame) -> DataFrame:
        def column(field) -> Column:
            return F.expr(self.columns[field.name]).cast(field.dataType).alias(field.name)
        return df.select(*[column(f) for f in ENVELOPE.fields])


def kafka_options(brokers: str, topic: str, max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None, **_) -> dict[str, str]:
    """The first run reads the topic from its oldest message (later runs
    follow their checkpoint), and messages that retention has removed do not
    stop the query. ``max_offsets_per_trigger`` keeps a micro-batch of a large
    backlog bounded; ``min_partitions`` reads a large partition in several
    tasks."""
    limits = {"maxOffsetsPerTrigger": max_offsets_per_trigger, "minPartitions": min_partitions}
    return {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": "earliest",
            "failOnDataLoss": "false", **{k: str(v) for k, v in limits.items() if v}}


def kinesis_options(stream: str, region: str, **_) -> dict[str, str]:
    """The whole retained stream on the first run."""
    return {"kinesis.streamName": stream, "kinesis.region": region,
            "kinesis.startingposition": "TRIM_HORIZON"}


QUEUES = {
    "kafka": Queue("kafka", True, kafka_options, {
        "clave": "key", "valor": "value", "origen": "topic", "particion": "partition",
        "desplazamiento": "offset", "ts_cola": "timestamp"}),
    # its rows name no shard, and its sequence numbers grow with holes
    "kinesis": Queue("aws-kinesis", False, kinesis_options, {
        "clave": "partitionKey", "valor": "data", "origen": "streamName", "particion": "NULL",
        "desplazamiento": "sequenceNumber", "ts_cola": "approximateArrivalTimestamp"}),
}


def pick(name: str | None = None) -> Queue:
    """The queue called ``name``, or the one that the environment names, or
    the first known; case and outer blanks do not matter."""
    wanted = name if name else os.environ.get(SOURCE_ENV) or next(iter(QUEUES))
    try:
        return QUEUES[wanted.strip().lower()]
    except KeyError:
        raise ValueError("unknown queue %r (%s or $%s): one of %s"
                         % (wanted, "argument", SOURCE_ENV, ", ".join(QUEUES))) from None


def offsets_consecutive(name: str | None = None) -> bool:
    """Whether a missing offset means a missing message."""
    return pick(name).consecutive


def read_kafka(spark: SparkSession, brokers: str, topic: str, **limits) -> DataFrame:
    """A1: streaming scan of a topic, with the connector's own columns."""
    return QUEUES["kafka"].scan(spark, brokers=brokers, topic=topic, **limits)


def read_kinesis(spark: SparkSession, stream: str, region: str) -> DataFrame:
    """A2: streaming scan of a stream, with the connector's own columns."""
    return QUEUES["kinesis"].scan(spark, stream=stream, region=region)


def normalize_kafka(df: DataFrame) -> DataFrame:
    """A3: the envelope of a Kafka scan."""
    return QUEUES["kafka"].envelope(df)


def normalize_kinesis(df: DataFrame) -> DataFrame:
    """A4: the envelope of a Kinesis scan; its partition is a typed NULL."""
    return QUEUES["kinesis"].envelope(df)


def read_queue(spark: SparkSession, name: str | None = None, **settings) -> DataFrame:
    """Envelope stream of a queue (``brokers`` and ``topic``, or ``stream``
    and ``region``; others are ignored)."""
    queue = pick(name)
    return queue.envelope(queue.scan(spark, **settings))


def read_envelope_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Offline stand-in for a queue: a folder of Parquet files holding
    envelope rows, read as a stream (one or more files per micro-batch)."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def stamp_ingest(df: DataFrame) -> DataFrame:
    """Ingest stamp = start of the micro-batch that wrote the row."""
    return df.withColumn("ingerido_en", F.current_timestamp())
