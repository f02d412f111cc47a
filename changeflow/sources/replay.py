"""Replay of a tabular event log as raw change events.

The driver's ``events`` table (event_id, ts, user_id, event_type, value,
props) stands in for the live change stream. Each row becomes one change
event with the shape of a recent-change message and is serialised to JSON,
so the refine step parses real text exactly as it would from a queue.

Mapping (every value is computed row by row, no shuffle):

* k = props.k (0..99)
* meta.id = event_id as text; id = event_id; meta.dt = ts as ISO text (ms)
* type = event_type; namespace = k % 4; title = 'P' || k
* wiki = 'w' || k % 5; server_name = domain = 's' || k % 5
* user = user_id as text; bot = user_id % 5 = 0
* timestamp = epoch seconds of ts
* queue partition = event_id % 3, offset = event_id div 3 (ids are dense,
  so offsets are consecutive per partition without any ordering job)
* queue time = ts + (event_id * 7919 mod 90000) ms: 0 to 90 s of delay
* ingest time = queue time + 2 s + (event_id * 104729 mod 10000) ms
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.columns import partition_key
from changeflow.operators.common import fence

SCHEMA_URI = "/mediawiki/recentchange/1.0.0"
QUEUE_PARTITIONS = 3
QUEUE_LAG_MULT, QUEUE_LAG_MOD_MS = 7919, 90000
INGEST_LAG_BASE_MS, INGEST_LAG_MULT, INGEST_LAG_MOD_MS = 2000, 104729, 10000

# Event types of the test log that count as page edits for P3 (the live
# stream uses edit and new).
EVENTS_EDIT_TYPES = ("click", "view", "purchase")

ISO_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def table_path(sf_dir: str, name: str) -> str:
    return "%s/%s.parquet" % (sf_dir.rstrip("/"), name)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "events"))


def _plus_ms(ts: Column, ms: Column) -> Column:
    return F.timestamp_millis(F.unix_millis(ts) + ms)


def change_events(events: DataFrame) -> DataFrame:
    """Test log -> typed change events (before serialisation).

    Columns: event_id, ts (event time), meta_id, tipo, wiki, servidor,
    espacio, titulo, usuario, es_bot, comment, ts_cola, ingerido_en, copia.
    Queue and ingest times are fixed here, from the original event time, so
    that a later shift of the event time (late injection) keeps the arrival.
    """
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    ts = F.col("ts").cast("timestamp")
    eid = F.col("event_id")
    queue_ts = _plus_ms(ts, F.pmod(eid * QUEUE_LAG_MULT, F.lit(QUEUE_LAG_MOD_MS)))
    ingest_ms = F.lit(INGEST_LAG_BASE_MS) + F.pmod(eid * INGEST_LAG_MULT, F.lit(INGEST_LAG_MOD_MS))
    return (
        events.select(eid, ts.alias("ts"), k.alias("_k"), "user_id", "event_type")
        .select(
            eid,
            F.col("ts"),
            eid.cast("string").alias("meta_id"),
            F.col("event_type").alias("tipo"),
            F.concat(F.lit("w"), (F.col("_k") % 5).cast("string")).alias("wiki"),
            F.concat(F.lit("s"), (F.col("_k") % 5).cast("string")).alias("servidor"),
            (F.col("_k") % 4).alias("espacio"),
            F.concat(F.lit("P"), F.col("_k").cast("string")).alias("titulo"),
            F.col("user_id").cast("string").alias("usuario"),
            (F.col("user_id") % 5 == 0).alias("es_bot"),
            F.lit(None).cast("string").alias("comment"),
            queue_ts.alias("ts_cola"),
            F.lit(0).alias("copia"),
        )
        .withColumn("ingerido_en", _plus_ms(F.col("ts_cola"), ingest_ms))
    )


def payload(df: DataFrame) -> Column:
    """JSON text of a change event, field order as the live stream sends it.
    NULL fields (e.g. no comment) are left out, as ``to_json`` does."""
    return F.to_json(F.struct(
        F.lit(SCHEMA_URI).alias("$schema"),
        F.struct(
            F.col("meta_id").alias("id"),
            F.date_format(F.col("ts"), ISO_MS).alias("dt"),
            F.col("servidor").alias("domain"),
        ).alias("meta"),
        F.col("event_id").alias("id"),
        F.col("tipo").alias("type"),
        F.col("espacio").alias("namespace"),
        F.col("titulo").alias("title"),
        F.col("comment").alias("comment"),
        F.unix_seconds(F.col("ts")).alias("timestamp"),
        F.col("usuario").alias("user"),
        F.col("es_bot").alias("bot"),
        F.col("servidor").alias("server_name"),
        F.col("wiki").alias("wiki"),
    ))


def to_envelope(changes: DataFrame, origin: str = "events",
                partitions: int = QUEUE_PARTITIONS) -> DataFrame:
    """Change events -> bronze rows (the common queue envelope + ingest
    stamp). A duplicate copy (copia > 0) is a redelivery of the same message:
    same partition, offset, bytes and queue time."""
    eid = F.col("event_id")
    # fenced: the payload is computed once per row, as if read from storage
    return fence(changes.select(
        partition_key("wiki", "titulo").alias("clave"),
        payload(changes).alias("valor"),
        F.lit(origin).alias("origen"),
        F.pmod(eid, F.lit(partitions)).cast("string").alias("particion"),
        F.expr("event_id div %d" % partitions).cast("string").alias("desplazamiento"),
        F.col("ts_cola"),
        F.col("ingerido_en"),
    ))


def replay_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze layer as the queue would have delivered the test log."""
    return to_envelope(change_events(read_events(spark, sf_dir)))
