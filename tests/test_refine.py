"""Refine (C1-C8) on the must-have raw event cases."""

import datetime as dt
import json

from changeflow.operators.refine import refine
from changeflow.schemas import SILVER_COLUMNS


def _raw(spark, payloads):
    rows = [(p, dt.datetime(2026, 8, 17, 15, 3, 0)) for p in payloads]
    return spark.createDataFrame(rows, "valor string, ts_cola timestamp")


def _event(**over):
    e = {"$schema": "/mediawiki/recentchange/1.0.0",
         "meta": {"id": "id-1", "dt": "2026-08-17T15:02:17.471Z", "domain": "en.wikipedia.org"},
         "id": 7, "type": "edit", "namespace": 0, "title": "Page", "user": "Ann", "bot": False,
         "wiki": "enwiki", "server_name": "en.wikipedia.org", "timestamp": 1787065337}
    e.update(over)
    return json.dumps(e, ensure_ascii=False)


def test_valid_row_is_typed(spark):
    out = refine(_raw(spark, [_event()])).collect()
    assert len(out) == 1
    r = out[0]
    assert tuple(r.asDict().keys()) == SILVER_COLUMNS
    assert r.meta_id == "id-1"
    assert r.ts_evento == dt.datetime(2026, 8, 17, 15, 2, 17, 471000)
    assert r.es_bot is False and r.espacio == 0
    assert abs(r.retraso_s - 42.529) < 1e-6


def test_bad_payloads_are_dropped(spark):
    bad = ["not json", "[]", _event(meta={"dt": "2026-08-17T15:02:17.471Z"}),
           _event(meta={"id": "x"}), _event(meta={"id": "x", "dt": "2026-08-17T15:02:17Z"}),
           _event(meta={"id": "x", "dt": "17/08/2026"})]
    assert refine(_raw(spark, bad)).count() == 0


def test_permissive_fields(spark):
    rows = refine(_raw(spark, [
        _event(meta={"id": "a", "dt": "2026-08-17T15:02:17.471Z"}, namespace="cero"),
        _event(meta={"id": "b", "dt": "2026-08-17T15:02:17.471Z"}, bot=None),
        _event(meta={"id": "c", "dt": "2026-08-17T15:02:17.471Z"}, user=None, title="Страница 東京"),
        _event(meta={"id": "d", "dt": "2026-08-17T15:02:17.471Z"}, timestamp=1187065337,
               log_params={"a": 1}),
        _event(meta={"id": "e", "dt": "2026-08-17T15:02:17.471Z"}, log_params=[]),
    ])).orderBy("meta_id").collect()
    by = {r.meta_id: r for r in rows}
    assert set(by) == {"a", "b", "c", "d", "e"}
    assert by["a"].espacio is None
    assert by["b"].es_bot is False
    assert by["c"].usuario is None and by["c"].titulo == "Страница 東京"
    assert by["d"].ts_mediawiki.year == 2007


def test_event_time_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        from pyspark.sql import functions as F
        from changeflow.functions.columns import event_time
        v = (spark.range(1).select(F.unix_micros(event_time(F.lit("2026-08-17T15:02:17.471Z"))).alias("u"))
             .first().u)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert v == 1786978937471000


def test_poison_timestamp_becomes_null(spark):
    from changeflow.operators import refine as R
    rows = [('{"meta":{"id":"%d","dt":"2026-01-01T00:00:00.000Z"},"timestamp":%d}' % (i, t),) for i, t in enumerate(
        (-9223372036854775808, 9223372036854775807, 253402300800, 0, -1))]
    raw = spark.createDataFrame(rows, "valor string").selectExpr("valor", "timestamp'2026-01-01 00:00:01' AS ts_cola")
    got = {r.meta_id: r.s for r in R.refine(raw).selectExpr("meta_id", "unix_seconds(ts_mediawiki) AS s").collect()}
    assert got == {"0": None, "1": None, "2": None, "3": 0, "4": -1}
