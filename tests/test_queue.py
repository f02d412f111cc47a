"""Queue envelopes (A1-A4), source choice and keyed publish."""

import datetime as dt

import pytest

from changeflow.sources import queue
from changeflow.streaming.publish import with_key


def test_source_choice(monkeypatch):
    assert queue.pick(" Kafka ").connector == "kafka"
    monkeypatch.setenv(queue.SOURCE_ENV, "KINESIS")
    assert queue.pick().connector == "aws-kinesis"
    assert not queue.offsets_consecutive()
    with pytest.raises(ValueError):
        queue.pick("pulsar")


def test_normalize_kafka(spark):
    df = spark.createDataFrame(
        [(b"w|t", b'{"a":1}', "topic", 2, 41, dt.datetime(2026, 1, 1)), (None, b"x", "topic", 0, 0, None)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    rows = queue.normalize_kafka(df).collect()
    assert rows[0].asDict() == {"clave": "w|t", "valor": '{"a":1}', "origen": "topic", "particion": "2",
                                "desplazamiento": "41", "ts_cola": dt.datetime(2026, 1, 1)}
    assert rows[1].clave is None


def test_normalize_kinesis(spark):
    seq = "49590338271490256608559692538361571095921575989136588898"
    df = spark.createDataFrame(
        [(b'{"a":1}', "s", "w|t", seq, dt.datetime(2026, 1, 1))],
        "data binary, streamName string, partitionKey string, sequenceNumber string, "
        "approximateArrivalTimestamp timestamp")
    out = queue.normalize_kinesis(df)
    r = out.first()
    assert r.particion is None and r.desplazamiento == seq and r.clave == "w|t"
    assert dict(out.dtypes)["particion"] == "string"


def test_publish_key_and_value(spark):
    from changeflow.sources import replay
    ch = replay.change_events(replay.read_events(spark, "/root/testdata/sf0.001"))
    kv = with_key(ch.limit(3)).collect()
    assert all("|" in r.key and '"meta_id"' in r.value for r in kv)
    raw = with_key(ch.limit(3), value=replay.payload(ch)).collect()
    assert all(r.value.startswith('{"$schema"') for r in raw)
    other = spark.createDataFrame([("u-1", "w", None)], "uuid string, site string, page string")
    assert with_key(other, "site", "page").first().asDict() == {"key": "w|?", "value": '{"uuid":"u-1","site":"w"}'}
    nulls = ch.limit(1).withColumn("wiki", ch.wiki.substr(0, 0).cast("string")).selectExpr(
        "*").withColumn("titulo", ch.titulo.isNull().cast("string")).withColumn("titulo", ch.comment)
    assert with_key(nulls).first().key.endswith("|?")


def test_kafka_options_bound_batches():
    o = queue.kafka_options("b:9092", "changes", max_offsets_per_trigger=500000, min_partitions=64)
    assert o["startingOffsets"] == "earliest" and o["failOnDataLoss"] == "false"
    assert o["maxOffsetsPerTrigger"] == "500000" and o["minPartitions"] == "64"
    assert "maxOffsetsPerTrigger" not in queue.kafka_options("b:9092", "changes")
    k = queue.kinesis_options("s", "eu-west-1")
    assert k["kinesis.startingposition"] == "TRIM_HORIZON"
