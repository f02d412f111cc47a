"""Capture files (A7) and the source profile (I1-I10) on F-6 cases."""

import json
import math

from changeflow.operators import profile as P
from changeflow.sources.capture import read_capture


def _write(path, records):
    with open(path, "w", encoding="utf-8") as f:
        for r in records:
            f.write(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False))
            f.write("\n")


def _ev(i, t, kind="edit", dt="2026-08-17T15:02:%02d.000Z", **extra):
    e = {"meta": {"id": "m%d" % i, "dt": dt % (i % 60) if "%" in dt else dt}, "type": kind,
         "server_name": "en.wikipedia.org", "bot": i % 2 == 0, "namespace": 0, "wiki": "enwiki", "id": i}
    e.update(extra)
    return {"_recibido": t, "_evento": e}


def test_capture_reading_and_counts(spark, scratch):
    path = scratch + "/cap.jsonl"
    _write(path, [_ev(1, 100.2), "", "   ", {"_recibido": 100.5, "_evento": {"_error_parseo": "{bad"}},
                  _ev(2, 101.1), _ev(3, 101.9, kind="log", log_params=[]),
                  _ev(4, 102.3, kind="log", log_params={"a": 1}), _ev(5, 103.0, kind="new")])
    cap = read_capture(spark, path)
    t = P.throughput(cap).first()
    assert (t.eventos, t.errores_parseo) == (5, 1)
    assert math.isclose(t.duracion_s, 2.8) and math.isclose(t.eps_medio, 5 / 2.8)
    # seconds 100 (1), 101 (2), 102 (1), 103 (1): first and last dropped
    r = P.rate_percentiles(cap).first()
    assert (r.eps_p50, r.eps_p95, r.eps_pico) == (1.5, 1.95, 2)
    schema = {x.ruta: x for x in P.schema_profile(cap).collect()}
    assert schema["log_params"].mixto and set(schema["log_params"].tipos.split(", ")) == {"array", "struct"}
    assert "log_params.a" in schema                                  # objects are descended
    assert schema["meta.id"].presencia_pct == 100.0
    fields = {x.tipo: x.campos for x in P.type_fields(cap).collect()}
    assert fields["log"] == "log_params" and fields["edit"] == "-"
    ex = {x.tipo: json.loads(x.ejemplo)["meta"]["id"] for x in P.examples(cap).collect()}
    assert ex == {"edit": "m1", "log": "m3", "new": "m5"}


def test_few_seconds_give_nan(spark, scratch):
    path = scratch + "/cap2.jsonl"
    _write(path, [_ev(1, 10.0), _ev(2, 11.0)])
    r = P.rate_percentiles(read_capture(spark, path)).first()
    assert math.isnan(r.eps_p50) and math.isnan(r.eps_p95) and r.eps_pico == 0


def test_disorder_duplicates_and_missing_time(spark, scratch):
    path = scratch + "/cap3.jsonl"
    recs = [_ev(1, 1.0, dt="2026-08-17T15:02:10.000Z"), _ev(2, 2.0, dt="2026-08-17T15:02:08.500Z"),
            _ev(3, 3.0, dt="2026-08-17T15:02:11.000Z"), _ev(3, 3.0, dt="2026-08-17T15:02:11.000Z"),
            _ev(4, 4.0, dt="no time"), {"_recibido": 5.0, "_evento": {"type": "edit"}}]
    _write(path, recs)
    cap = read_capture(spark, path)
    d = P.disorder(cap).first()
    assert (d.con_tiempo, d.sin_tiempo, d.desordenados) == (4, 2, 1)
    assert math.isclose(d.pct, 100.0 / 6) and math.isclose(d.maximo, 1.5)
    dup = {x.clave: x for x in P.duplicate_report(cap).collect()}
    assert (dup["meta.id"].repetidos, dup["meta.id"].entregas_de_mas) == (1, 1)
    top = {x.valor: x.eventos for x in P.top_values(cap, "server_name").collect()}
    assert top["(sin server_name)"] == 1


def test_schema_walk_goes_as_deep_as_the_events(spark, scratch):
    path = scratch + "/deep.jsonl"
    deep = {"x": 1}
    for i in range(40):
        deep = {"n%d" % i: deep}
    _write(path, [_ev(1, 1.0, deep=deep)])
    paths = {r.ruta for r in P.field_paths(read_capture(spark, path)).collect()}
    assert "deep." + ".".join("n%d" % i for i in range(39, -1, -1)) + ".x" in paths


def test_cli_profile(spark, scratch, capsys):
    from changeflow import cli
    path = scratch + "/cap_cli.jsonl"
    _write(path, [_ev(i, 100.0 + i * 0.3) for i in range(20)])
    assert cli.main(["profile", "--capture", path]) == 0
    out = capsys.readouterr().out
    assert "== disorder" in out and "== examples" in out


def test_capture_roundtrip(spark, scratch):
    from pyspark.sql import functions as F
    from changeflow.sources import replay
    from changeflow.sources.capture import capture_from_raw, write_capture
    cap = capture_from_raw(replay.replay_bronze(spark, "/root/testdata/sf0.001"))
    write_capture(cap, scratch + "/cap_out")
    back = read_capture(spark, scratch + "/cap_out")
    a = cap.select("recibido", F.get_json_object("evento", "$.meta.id").alias("id"))
    b = back.select("recibido", F.get_json_object("evento", "$.meta.id").alias("id"))
    assert back.filter("error").count() == 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    t1, t2 = P.throughput(cap).first(), P.throughput(back).first()
    assert t1.eventos == t2.eventos == 1000 and t1.duracion_s == t2.duracion_s


def test_broken_lines_microseconds_and_repeated_keys(spark, scratch):
    from changeflow.operators import profile
    from changeflow.sources.capture import read_capture
    lines = ['{"_recibido":2.0,"_evento":{"meta":{"dt":"1970-01-01T00:00:01.250001Z"},"a":1}}',
             '{"_recibido":3.0,"_evento":{"meta":{"dt":"1970-01-01T00:00:01.5Z"},"a":"x","a":2}}',
             '{"_recibido":2.5,"_ev', '{"_evento":{"_error_parseo":"?"}}', "", "  "]
    with open(scratch + "/c.jsonl", "w") as f:
        f.write("\n".join(lines))
    cap = read_capture(spark, scratch + "/c.jsonl")
    t = profile.throughput(cap).first()
    assert (t.eventos, t.errores_parseo) == (2, 2)
    lat = profile.arrival_latency(cap).first()
    assert (lat.con_tiempo, lat.sin_tiempo) == (2, 0) and abs(lat.minimo - 0.749999) < 1e-9
    rows = {r.ruta: r for r in profile.schema_profile(cap).collect()}
    assert rows["a"].presencia_pct == 50.0 and rows["a"].ilegibles == 1


def test_paths_of_a_shape(spark):
    """Quoted names, nested arrays and empty objects in the schema text."""
    from pyspark.sql import functions as F
    from changeflow.operators.profile import shape_paths
    event = ('{"": 1, "$schema": "x", "b c": {"d`e": 1.5, "f, g": [1, {"z: >": [[{"`": 2}]]}], "h>": null}, "m": {}, "n": [], '
             '"o": true, "p": 1e30, "1x": {"a.b": {"<": 1}}, "z": 12345678901234567890}')
    text = spark.createDataFrame([(event,)], "e string").select(F.schema_of_variant(F.try_parse_json("e")).alias("s")).first().s
    expected = {"": "BIGINT", "$schema": "STRING", "b c": "OBJECT", "b c.d`e": "DECIMAL(2,1)", "b c.f, g": "ARRAY",
                "b c.h>": "VOID", "m": "OBJECT", "n": "ARRAY", "o": "BOOLEAN", "p": "DOUBLE", "1x": "OBJECT",
                "1x.a.b": "OBJECT", "1x.a.b.<": "BIGINT", "z": "DECIMAL(20,0)"}
    found = shape_paths(text)
    assert dict(found) == expected and len(found) == len(expected)
    for other in ("ARRAY<OBJECT<a: BIGINT>>", "STRING", "VOID", "OBJECT<>"):
        assert shape_paths(other) == []


def test_schema_reports_read_the_capture_once(spark, scratch):
    path = scratch + "/once.jsonl"
    _write(path, [_ev(i, 1.0 + i) for i in range(5)])
    shapes = P.shape_counts(read_capture(spark, path))
    for df in (P.schema_profile(None, shapes), P.type_fields(None, shapes=shapes)):
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() > 0
