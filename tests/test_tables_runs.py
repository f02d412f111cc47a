"""Layer tables (A6, B1), grouped runs (B3), commit history (G4), entry."""

import pytest
from pyspark.sql import functions as F

from changeflow.sources import replay
from changeflow.sources.queue import read_envelope_files, stamp_ingest
from changeflow.sources.tables import ensure_tables, read_table, table_exists
from changeflow.streaming.commits import commit_history
from changeflow.streaming.run import append_stream, run_group


def test_ensure_tables_is_idempotent_and_readable(spark, scratch):
    names = ensure_tables(spark, scratch + "/wh", database="cf_test")
    assert ensure_tables(spark, scratch + "/wh", database="cf_test") == names
    assert all(spark.catalog.tableExists(n) for n in names)
    assert read_table(spark, "cf_test.silver").count() == 0
    assert "dia" in read_table(spark, "cf_test.gold_activity").columns
    assert not table_exists(spark, scratch + "/nowhere")


def test_run_group_stops_all_and_history(spark, scratch):
    env = replay.replay_bronze(spark, "/root/testdata/sf0.001").drop("ingerido_en")
    env.repartition(4).write.parquet(scratch + "/queue")
    src = read_envelope_files(spark, scratch + "/queue", 1)
    qs = [append_stream(stamp_ingest(src), scratch + "/out%d" % i, scratch + "/ck%d" % i,
                        day_from="ts_cola", trigger="1 second") for i in range(2)]
    run_group(spark, qs, seconds=20)
    assert not any(q.isActive for q in qs)
    hist = commit_history(spark, scratch + "/ck0").collect()
    assert len(hist) >= 1 and hist[0].batch_id == 0 and hist[0].operation == "append"
    newest = commit_history(spark, scratch + "/ck0", newest=1).collect()
    assert newest[0].batch_id == hist[-1].batch_id
    out = read_table(spark, scratch + "/out0", layer="bronze")
    assert out.select("dia").distinct().count() >= 1
    assert out.filter(F.col("ingerido_en").isNull()).count() == 0


def test_run_group_raises_when_one_fails(spark, scratch):
    bad = (spark.readStream.format("rate").option("rowsPerSecond", 5).load()
           .select(F.expr("assert_true(value < 3)").alias("x")))
    good = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    qs = [bad.writeStream.format("noop").option("checkpointLocation", scratch + "/a").start(),
          good.writeStream.format("noop").option("checkpointLocation", scratch + "/b").start()]
    with pytest.raises(RuntimeError):
        run_group(spark, qs, seconds=60)
    assert not any(q.isActive for q in qs)


def test_entry_runs_in_any_session_zone(spark):
    from __spark_entry__ import entry
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    rows = entry(spark).collect()
    assert len(rows) >= 1 and set(rows[0].asDict()) == {"servidor", "espacio", "eventos"}
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_compact_day(spark, scratch):
    from changeflow.sources.tables import compact_day
    env = replay.replay_bronze(spark, "/root/testdata/sf0.001")
    src = scratch + "/bronze"
    env.withColumn("dia", F.to_date("ts_cola")).repartition(16).write.partitionBy("dia").parquet(src)
    n = compact_day(spark, src, scratch + "/bronze_c", "bronze", "2024-01-02", target_bytes=1 << 30)
    assert n == 1
    out = read_table(spark, scratch + "/bronze_c", layer="bronze")
    want = read_table(spark, src, layer="bronze").filter("dia = DATE'2024-01-02'")
    assert out.count() == want.count() > 0
    assert len(out.inputFiles()) == 1


def test_report_on_folded_warehouse(spark, scratch):
    from changeflow.operators import serving
    from changeflow.streaming.chain import ChainConfig, run_chain_available
    env = replay.replay_bronze(spark, "/root/testdata/sf0.001").drop("ingerido_en")
    env.repartition(2).write.parquet(scratch + "/queue")
    cfg = ChainConfig(warehouse=scratch + "/wh", checkpoints=scratch + "/ck", fold_counts=True,
                      edit_types=replay.EVENTS_EDIT_TYPES)
    run_chain_available(spark, read_envelope_files(spark, scratch + "/queue"), cfg)
    rep = serving.report(spark, cfg.warehouse)
    vol = {r.tabla: r.existe for r in rep["volumes"].collect()}
    assert vol["gold_counts"] and not vol["gold_activity"]
    assert rep["activity_latest"].count() >= 1 and rep["bot_share"].count() == 12


def test_report_by_catalog_names(spark, scratch):
    """Named tables, with and without a stored day, give the folders' report."""
    from changeflow.operators import serving
    from changeflow.sources.tables import layer_path
    from changeflow.streaming.chain import ChainConfig, run_chain_available
    env = replay.replay_bronze(spark, "/root/testdata/sf0.001").drop("ingerido_en")
    env.repartition(2).write.parquet(scratch + "/queue")
    cfg = ChainConfig(warehouse=scratch + "/wh", checkpoints=scratch + "/ck", edit_types=replay.EVENTS_EDIT_TYPES)
    run_chain_available(spark, read_envelope_files(spark, scratch + "/queue"), cfg)
    spark.sql("CREATE DATABASE IF NOT EXISTS cf_named LOCATION '%s/named'" % scratch)
    layers = ["bronze", "silver", "gold_activity", "gold_bots"]
    for layer in layers:
        df = read_table(spark, layer_path(cfg.warehouse, layer))
        df = df.drop("dia") if layer in ("silver", "gold_activity") else df
        df.write.option("path", "%s/named/%s" % (scratch, layer)).saveAsTable("cf_named." + layer)
    try:
        since = "2024-01-20 00:00:00"
        want = serving.report(spark, cfg.warehouse, since=since)
        got = serving.report(spark, "", since=since, table=lambda layer: "cf_named." + layer)
        assert set(want) - set(got) == {"concurrent_top"}  # that table is not there
        vol = {r.tabla: (r.filas, r.existe) for r in got["volumes"].collect()}
        for r in want["volumes"].collect():
            assert vol[r.tabla] == ((r.filas, True) if r.tabla in layers else (None, False))
        for name in ("latency", "activity_latest", "bot_share", "bot_share_swing"):
            assert got[name].collect() == want[name].collect() != []
        assert table_exists(spark, "cf_named.silver") and not table_exists(spark, "cf_named.gold_panes")
    finally:
        spark.sql("DROP DATABASE cf_named CASCADE")


def test_since_prunes_day_partitions(spark, scratch, capsys):
    env = replay.replay_bronze(spark, "/root/testdata/sf0.001")
    src = scratch + "/bronze_p"
    env.withColumn("dia", F.to_date("ts_cola")).write.partitionBy("dia").parquet(src)
    df = read_table(spark, src, layer="bronze", since="2024-01-29 00:00:00").select("ts_cola")
    df.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(dia" in plan and "2024-01-29" in plan
    assert "ReadSchema: struct<ts_cola:timestamp>" in plan
    assert df.count() == env.filter("ts_cola >= TIMESTAMP'2024-01-29 00:00:00'").count() > 0


def test_iceberg_statement_and_chain_tables():
    from changeflow.sources.tables import table_ddl
    from changeflow.streaming.chain import ChainConfig
    ddl = table_ddl("silver", "/wh", "lake", "iceberg")
    assert "lake.silver" in ddl and "USING iceberg PARTITIONED BY (days(ts_evento))" in ddl and "134217728" in ddl
    assert "`dia`" not in ddl
    assert ChainConfig(warehouse="/wh", fmt="iceberg", database="lake").table("bronze") == "lake.bronze"
    assert ChainConfig(warehouse="/wh").table("bronze") == "/wh/bronze"


def test_only_a_missing_table_counts_as_missing(spark, scratch):
    import pytest
    from changeflow.sources.tables import table_exists
    assert not table_exists(spark, scratch + "/silver")
    with pytest.raises(Exception):
        table_exists(spark, "nosuchstore://x/silver")
