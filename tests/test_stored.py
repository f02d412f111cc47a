"""Footers, newest day, bucketed tables, one pass for all fields."""

import datetime as dt

from pyspark.sql import functions as F

from changeflow.operators import dedup, lateness, profile, serving
from changeflow.schemas import P1
from changeflow.sources.tables import footer_scan, layer_path, newest_day, read_table, write_bucketed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _layer(spark, scratch):
    rows = [(dt.datetime(2026, 1, d, 10, m), dt.datetime(2026, 1, d, 10, m + 1), "s%d" % (m % 2), 0, 5 + m)
            for d in (1, 2, 3) for m in range(6)]
    path = layer_path(scratch, "gold_activity")
    spark.createDataFrame(rows, P1).withColumn("dia", F.to_date("ventana_inicio")).write.partitionBy("dia").parquet(path)
    return path


def test_counts_from_footers_read_no_column(spark, scratch):
    path = _layer(spark, scratch)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    scan = footer_scan(spark, path, "gold_activity")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    volumes = serving.layer_volumes(spark, {"gold_activity": scan, "gold_bots": None})
    assert "PushedAggregation: [COUNT(*)]" in _plan(volumes)
    assert {(r.tabla, r.filas, r.existe) for r in volumes.collect()} == {("gold_activity", 18, True), ("gold_bots", None, False)}
    days = footer_scan(spark, path, "gold_activity").groupBy("dia").agg(F.count(F.lit(1)).alias("n"), F.max("eventos").alias("m"))
    assert "PushedAggregation: [COUNT(*), MAX(eventos)]" in _plan(days)
    assert {(r.dia.day, r.n, r.m) for r in days.collect()} == {(d, 6, 10) for d in (1, 2, 3)}


def test_newest_day(spark, scratch):
    path = _layer(spark, scratch)
    rows = newest_day(spark, path, "gold_activity")
    assert {r.ventana_inicio.day for r in rows.collect()} == {3}
    latest = [tuple(r) for r in serving.activity_latest(rows).collect()]
    assert latest == [tuple(r) for r in serving.activity_latest(read_table(spark, path, layer="gold_activity")).collect()] == [("s1", 0, 10)]


def test_bucketed_tables_need_no_exchange_by_key(spark, scratch):
    t0 = dt.datetime(2026, 1, 1)
    raw = [("id%d" % (i % 40), t0, t0 + dt.timedelta(seconds=i), float(i % 90)) for i in range(120)]
    raw = spark.createDataFrame(raw, "meta_id string, ts_evento timestamp, ts_cola timestamp, retraso_s double")
    silver = spark.createDataFrame([("id%d" % i, t0) for i in range(0, 40, 2)], "meta_id string, ts_evento timestamp")
    a = write_bucketed(raw, "test_raw_ids", scratch + "/a", ["meta_id"], 4)
    b = write_bucketed(silver, "test_silver_ids", scratch + "/b", ["meta_id"], 4)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        first = dedup.dedup_first(a)
        assert "Exchange" not in _plan(first)
        assert first.exceptAll(dedup.dedup_first(raw)).count() == 0 and first.count() == 40
        plan = _plan(lateness.survival(a, b))
        assert "SortMergeJoin" in plan and plan.count("hashpartitioning(meta_id") == 0
        got, want = (sorted(map(tuple, lateness.survival(x, y).collect())) for x, y in ((a, b), (raw, silver)))
        assert got == want
    finally:
        spark.conf.set(key, before)


def test_all_fields_in_one_pass(spark):
    events = ['{"type":"edit","bot":true,"namespace":%d,"server_name":"s%d"}' % (i % 3, i % 20) for i in range(60)]
    events += ['{"type":null,"bot":"x"}', "{}", '{"type":{"a":1},"$schema":"/x"}']
    cap = spark.createDataFrame([(float(i), i, e, False) for i, e in enumerate(events)] + [(0.0, 0, None, True)],
                                "recibido double, seq long, evento string, error boolean")
    every = profile.top_values_of(cap, profile.REPORTED)
    assert _plan(every).count("from_json") == 1
    got = {(r.campo, r.valor): (r.eventos, round(r.pct, 9)) for r in every.collect()}
    want = {}
    for field, n in profile.REPORTED.items():
        want |= {(r.campo, r.valor): (r.eventos, round(r.pct, 9)) for r in profile.top_values(cap, field, n).collect()}
    assert got == want


def test_closed_days_are_compacted_once(spark, scratch):
    from changeflow.sources.tables import compact_closed_days, compactions
    from changeflow.streaming.commits import table_commits
    path = _layer(spark, scratch)
    spark.read.parquet(path).repartition(5).write.mode("append").partitionBy("dia").parquet(path)
    made = compact_closed_days(spark, path, scratch + "/compact", "gold_activity")
    assert [d for d, _ in made] == ["2026-01-01", "2026-01-02"] and all(n == 1 for _, n in made)
    assert compact_closed_days(spark, path, scratch + "/compact", "gold_activity") == []
    assert spark.read.parquet(scratch + "/compact").count() == 24
    done = {r.day: r for r in compactions(spark, scratch + "/compact").collect()}
    assert sorted(done) == ["2026-01-01", "2026-01-02"] and sum(r.rows for r in done.values()) == 24
    assert all(r.files_before > r.files_after == 1 and r.bytes_before > 0 for r in done.values())
    commits = table_commits(spark, scratch + "/compact").collect()
    assert [(c.commit, c.operation, c.rows) for c in commits] == [
        ("day " + d, "replace", done[d].rows) for d in sorted(done, key=lambda d: done[d].committed_ms)]
    assert table_commits(spark, path).count() == 0
    assert compact_closed_days(spark, scratch + "/none", scratch + "/x", "gold_activity") == []


def test_progress_is_told_while_a_group_runs(spark, scratch, capsys):
    from changeflow.streaming.run import append_stream, run_group, say_progress
    rate = spark.readStream.format("rate").option("rowsPerSecond", 50).load()
    query = append_stream(rate, scratch + "/rate", scratch + "/ck", trigger="1 second", name="told")
    run_group(spark, [query], seconds=9, tell=say_progress)
    assert "told batch" in capsys.readouterr().out


def test_capture_order_of_large_partitions(spark):
    from changeflow.sources.capture import capture_from_raw
    rows = [("0", "5"), ("9000000000000000000", "4"), (None, "9000000000000000000"), ("x", "1")]
    raw = spark.createDataFrame([(p, o, "{}", dt.datetime(2026, 1, 1)) for p, o in rows],
                                "particion string, desplazamiento string, valor string, ts_cola timestamp")
    seq = [int(r.seq) for r in capture_from_raw(raw).collect()]
    assert seq[:3] == [5 * 2**63, 4 * 2**63 + 9 * 10**18, 9 * 10**18 * 2**63] and seq[1] < seq[0]
