"""Streaming = batch, restart without loss or duplicates, late-data cut."""

import datetime as dt
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from changeflow.operators import dedup, integrity, lateness, refine
from changeflow.plans import registry
from changeflow.sources import replay
from changeflow.sources.queue import read_envelope_files
from changeflow.sources.tables import layer_path, read_table
from changeflow.streaming import history
from changeflow.streaming.chain import ChainConfig, run_chain_available, start_bronze
from changeflow.streaming.commits import commit_history, table_commits
from changeflow.streaming.run import append_stream, progress_frame, run_available

SF = "/root/testdata/sf0.001"


def _write_batches(rows_by_batch, folder):
    """One Parquet file per micro-batch, modification times in batch order."""
    os.makedirs(folder, exist_ok=True)
    schema = pa.schema([("clave", pa.string()), ("valor", pa.string()), ("origen", pa.string()),
                        ("particion", pa.string()), ("desplazamiento", pa.string()),
                        ("ts_cola", pa.timestamp("us", tz="UTC"))])
    for i, rows in enumerate(rows_by_batch):
        cols = list(zip(*rows)) if rows else [[] for _ in schema]
        path = os.path.join(folder, "b%04d.parquet" % i)
        pq.write_table(pa.table([list(c) for c in cols], schema=schema), path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def test_chain_equals_batch(spark, scratch):
    env = replay.replay_bronze(spark, SF).drop("ingerido_en")
    env.repartition(3).write.parquet(scratch + "/queue")
    cfg = ChainConfig(warehouse=scratch + "/wh", checkpoints=scratch + "/ckpt", exact_editors=True,
                      edit_types=replay.EVENTS_EDIT_TYPES)
    run_chain_available(spark, read_envelope_files(spark, scratch + "/queue"), cfg)
    for layer, fn in [("gold_activity", registry.gold_p1), ("gold_bots", registry.gold_p2),
                      ("gold_concurrent", registry.gold_p3)]:
        s = read_table(spark, layer_path(cfg.warehouse, layer)).drop("dia")
        b = fn(spark, SF)
        assert s.count() == b.count() > 0 or layer == "gold_concurrent"
        assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0
    silver = read_table(spark, layer_path(cfg.warehouse, "silver"))
    assert silver.count() == 1000
    assert lateness.dedup_proof(silver).first().duplicados == 0


def test_restart_is_exactly_once(spark, scratch):
    env = replay.replay_bronze(spark, SF).drop("ingerido_en").collect()
    rows = [tuple(r) for r in sorted(env, key=lambda r: r.ts_cola)]
    half = len(rows) // 2
    chunks = [rows[i:i + 100] for i in range(0, len(rows), 100)]
    queue = scratch + "/queue"
    first = [c for c in chunks if c[0] in rows[:half]]
    _write_batches(first, queue)
    cfg = ChainConfig(warehouse=scratch + "/wh", checkpoints=scratch + "/ckpt", available_now=True)
    run_available([start_bronze(spark, read_envelope_files(spark, queue, 1), cfg)])
    # the queue grows while the job is down; the restart resumes from its checkpoint
    rest = chunks[len(first):]
    os.makedirs(queue, exist_ok=True)
    for j, c in enumerate(rest):
        path = os.path.join(queue, "b%04d.parquet" % (len(first) + j))
        tmp = scratch + "/tmp.parquet"
        _write_batches([c], scratch + "/one%d" % j)
        os.rename(os.path.join(scratch + "/one%d" % j, "b0000.parquet"), path)
        del tmp
    q = start_bronze(spark, read_envelope_files(spark, queue, 1), cfg)
    run_available([q])
    assert progress_frame(spark, q).agg(F.sum("numInputRows")).first()[0] == len(rows) - sum(len(c) for c in first)
    bronze = read_table(spark, layer_path(cfg.warehouse, "bronze"))
    v = integrity.verdict(bronze).first()
    assert (v.filas, v.duplicados, v.huecos, v.ok) == (1000, 0, 0, True)
    hist = commit_history(spark, cfg.ckpt("bronze")).collect()
    assert [h.batch_id for h in hist] == list(range(len(chunks)))


def _delayed(spark, delays_s, base, batch):
    """Envelope rows whose event time is ``base - d`` and that arrive in
    trigger interval ``batch`` (10 s intervals)."""
    out = []
    for i, d in enumerate(delays_s):
        ev = base - dt.timedelta(milliseconds=round(d * 1000))
        payload = ('{"meta":{"id":"%s","dt":"%s"},"type":"edit","comment":"evento sintetico t"}'
                   % ("b%d-%d" % (batch, i), ev.strftime("%Y-%m-%dT%H:%M:%S.") + "%03dZ" % (ev.microsecond // 1000)))
        arrival = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=10 * batch + 1)
        out.append(("k", payload, "t", "0", str(batch * 100 + i), arrival))
    return out


def test_late_rows_are_cut_two_batches_behind(spark, scratch):
    t0 = dt.datetime(2026, 1, 1, 0, 10, tzinfo=dt.timezone.utc)
    delays = [0, 4.999, 5, 14.999, 15, 29.999, 30, 30.001, 44.999, 45, 59.999, 60, 120]
    b0 = _delayed(spark, [0], t0, 0)                       # sets max event time t0
    b1 = _delayed(spark, [-1], t0, 1)                      # late rows judged on batch 0's watermark
    b2 = _delayed(spark, delays, t0, 2)                    # cut: t0 - 30 s
    dup = b2[2]
    b3 = [dup, dup] + _delayed(spark, [-5], t0, 3)         # identical copies later
    _write_batches([b0, b1, b2, b3], scratch + "/queue")
    raw = read_envelope_files(spark, scratch + "/queue", 1)
    silver = dedup.dedup_stream(dedup.with_lateness(refine.refine(raw), "30 seconds"))
    q = append_stream(silver, scratch + "/silver", scratch + "/ck", available_now=True)
    run_available([q])
    got = {r.meta_id for r in spark.read.parquet(scratch + "/silver").collect()}
    prog = progress_frame(spark, q).agg(F.sum("rowsDroppedByWatermark").alias("late"),
                                        F.sum("duplicatesDropped").alias("dups")).first()
    assert prog.late == 7 and prog.dups == 2
    # strictly behind the 30 s watermark survives; at or past it is dropped
    assert got == {"b0-0", "b1-0", "b2-0", "b2-1", "b2-2", "b2-3", "b2-4", "b2-5", "b3-0"}
    surv = lateness.survival(lateness.tagged(spark.read.parquet(scratch + "/queue")),
                             spark.read.parquet(scratch + "/silver")).collect()
    assert sum(r.en_plata for r in surv) == len(got)
    assert sum(r.en_bronce for r in surv) == 16


def test_cli_jobs_and_report(spark, scratch):
    from changeflow import cli
    from changeflow.operators import serving
    env = replay.replay_bronze(spark, SF).drop("ingerido_en")
    env.repartition(2).write.parquet(scratch + "/queue")
    common = ["--warehouse", scratch + "/wh", "--checkpoints", scratch + "/ck", "--available-now"]
    assert cli.main(["bronze", "--queue-path", scratch + "/queue"] + common) == 0
    assert cli.main(["verify", "--warehouse", scratch + "/wh"]) == 0
    rep = serving.report(spark, scratch + "/wh")
    vol = {r.tabla: (r.filas, r.existe) for r in rep["volumes"].collect()}
    assert vol["bronze"] == (1000, True) and vol["silver"] == (None, False)
    assert set(rep) == {"volumes"}
    assert cli.main(["silver"] + common) == 0
    assert cli.main(["gold"] + common) == 0
    rep = serving.report(spark, scratch + "/wh", since="2024-01-30 00:00:00",
                         silver_checkpoint=scratch + "/ck/silver")
    assert {"latency", "commit_latency", "activity_latest", "bot_share", "bot_share_swing",
            "concurrent_top"} <= set(rep)
    assert rep["commit_latency"].first().filas == rep["latency"].first().filas
    assert rep["activity_latest"].count() >= 1
    assert rep["latency"].first().filas > 0


def test_survival_with_day_pruning_equals_plain(spark, scratch):
    env = registry.injected_raw(spark, SF).drop("ingerido_en")
    env.repartition(2).write.parquet(scratch + "/queue")
    cfg = ChainConfig(warehouse=scratch + "/wh", checkpoints=scratch + "/ck",
                      edit_types=replay.EVENTS_EDIT_TYPES)
    run_chain_available(spark, read_envelope_files(spark, scratch + "/queue"), cfg)
    bronze = read_table(spark, layer_path(cfg.warehouse, "bronze"))
    silver = read_table(spark, layer_path(cfg.warehouse, "silver"))
    batch = lateness.tagged(bronze.filter("dia <= DATE'2024-01-05'"))
    pruned = lateness.survival(batch, silver).collect()
    plain = lateness.survival(batch, silver.drop("dia")).collect()
    assert pruned == plain and sum(r.en_plata for r in pruned) > 0


def test_delay_bucket_edges(spark):
    from changeflow.functions.columns import delay_bucket
    vals = [0.0, 4.999, 5.0, 14.999, 15.0, 29.999, 30.0, 44.999, 45.0, 59.999, 60.0, 120.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    got = [r.b for r in df.select(delay_bucket("d").alias("b")).collect()]
    assert got == ["a) <5s", "a) <5s", "b) 5-15s", "b) 5-15s", "c) 15-30s", "c) 15-30s", "d) 30-45s",
                   "d) 30-45s", "e) 45-60s", "e) 45-60s", "f) >60s", "f) >60s", "f) >60s"]
    own = df.select(delay_bucket("d", "g) sin retraso").alias("b")).collect()[-1].b
    assert own == "g) sin retraso"


def test_hll_stream_equals_hll_batch(spark, scratch):
    sf = "/root/testdata/sf0.01"
    env = replay.replay_bronze(spark, sf).drop("ingerido_en")
    env.repartition(4).write.parquet(scratch + "/queue")
    cfg = ChainConfig(warehouse=scratch + "/wh", checkpoints=scratch + "/ck", exact_editors=False,
                      edit_types=replay.EVENTS_EDIT_TYPES)
    run_chain_available(spark, read_envelope_files(spark, scratch + "/queue"), cfg)
    s = read_table(spark, layer_path(cfg.warehouse, "gold_concurrent")).drop("dia")
    b = registry.gold_p3(spark, sf, exact=False)
    assert s.count() == b.count() > 0
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_commit_latency_after_batch_start(spark, scratch):
    from changeflow.operators import serving
    env = replay.replay_bronze(spark, SF).drop("ingerido_en").collect()
    rows = [tuple(r) for r in sorted(env, key=lambda r: r.ts_cola)]
    _write_batches([rows[i:i + 250] for i in range(0, len(rows), 250)], scratch + "/queue")
    cfg = ChainConfig(warehouse=scratch + "/wh", checkpoints=scratch + "/ck", available_now=True)
    run_available([start_bronze(spark, read_envelope_files(spark, scratch + "/queue"), cfg)])
    cfg.max_files_per_trigger = 1
    from changeflow.streaming.chain import start_silver
    run_available([start_silver(spark, cfg)])
    silver = read_table(spark, layer_path(cfg.warehouse, "silver"))
    commits = commit_history(spark, cfg.ckpt("silver"))
    to_commit = serving.commit_latency(silver, commits, lookback=None, exact=True).first()
    to_start = serving.latency(silver, lookback="100000 days", exact=True).first()
    # one bronze file per batch in file order: later days first push the
    # watermark ahead and earlier rows are dropped as late; every row that
    # did reach silver must map to the commit of its batch
    assert to_commit.filas == silver.count() > 0
    assert to_commit.minimo >= to_start.minimo and to_commit.maximo >= to_start.maximo


def test_default_checkpoints_of_two_warehouses_do_not_meet(spark, scratch):
    replay.replay_bronze(spark, SF).drop("ingerido_en").write.parquet(scratch + "/queue")
    for wh in ("/a", "/b"):
        cfg = ChainConfig(warehouse=scratch + wh, available_now=True)
        run_available([start_bronze(spark, read_envelope_files(spark, scratch + "/queue"), cfg)])
        assert read_table(spark, layer_path(cfg.warehouse, "bronze")).count() == 1000
        assert cfg.ckpt("bronze") == scratch + wh + "/_checkpoints/bronze"


def test_rerun_reads_what_is_new_and_a_foreign_checkpoint_is_refused(spark, scratch):
    import pytest
    env = replay.replay_bronze(spark, SF).drop("ingerido_en")
    env.write.parquet(scratch + "/queue")
    cfg = ChainConfig(warehouse=scratch + "/wh", available_now=True)
    run_available([start_bronze(spark, read_envelope_files(spark, scratch + "/queue"), cfg)])
    env.limit(150).write.mode("append").parquet(scratch + "/queue")
    run_available([start_bronze(spark, read_envelope_files(spark, scratch + "/queue"), cfg)])
    assert read_table(spark, layer_path(cfg.warehouse, "bronze")).count() == 1150
    other = ChainConfig(warehouse=scratch + "/wh", checkpoints=scratch + "/fresh", available_now=True)
    with pytest.raises(RuntimeError, match="would be skipped"):
        start_bronze(spark, read_envelope_files(spark, scratch + "/queue"), other)


def test_history_outlives_the_checkpoint_logs(spark, scratch, monkeypatch):
    rows = [tuple(r) for r in replay.replay_bronze(spark, SF).drop("ingerido_en").limit(50).collect()]
    _write_batches([rows[i:i + 2] for i in range(0, 50, 2)], scratch + "/queue")
    cfg = ChainConfig(warehouse=scratch + "/wh", available_now=True)
    before = spark.conf.get("spark.sql.streaming.minBatchesToRetain")
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    try:
        q = start_bronze(spark, read_envelope_files(spark, scratch + "/queue", 1), cfg)
        run_available([q])
    finally:
        spark.conf.set("spark.sql.streaming.minBatchesToRetain", before)
    assert len([f for f in os.listdir(cfg.ckpt("bronze") + "/commits") if f.isdigit()]) < 25
    hist = commit_history(spark, cfg.ckpt("bronze")).collect()
    assert [(h.batch_id, h.rows) for h in hist] == [(i, 2) for i in range(25)]
    assert all(a.committed_at < b.committed_at for a, b in zip(hist, hist[1:]))
    # records of finished batches share files; a record that is there twice counts once
    monkeypatch.setattr(history, "ROLL", 10)
    folder = history.folder(cfg.ckpt("bronze"))
    twice = folder + "/%020d.json" % 3
    text = open(twice).read()
    history.roll(spark, cfg.ckpt("bronze"), 20)
    names = sorted(n for n in os.listdir(folder) if n.endswith(".json"))
    assert [n for n in names if n.startswith("to-")] == ["to-%020d.json" % i for i in (9, 19)] and len(names) == 7
    assert commit_history(spark, cfg.ckpt("bronze")).collect() == hist
    again = json.loads(text)
    again.update(started="2099-01-01T00:00:00.000Z", input_rows=7)
    open(twice, "w").write(json.dumps(again))
    assert [h.rows for h in commit_history(spark, cfg.ckpt("bronze")).collect()][2:5] == [2, 7, 2]
    open(twice, "w").write(text)
    commits = table_commits(spark, cfg.table("bronze"), cfg.ckpt("bronze")).collect()
    assert [c.commit for c in commits] == ["batch %d" % i for i in range(25)] and commits[0].operation == "append"
    assert progress_frame(spark, q).count() == 25
    assert commit_history(spark, scratch + "/nothing").count() == 0


def test_chain_leaves_session_and_config_as_they_were(spark, scratch):
    replay.replay_bronze(spark, SF).drop("ingerido_en").limit(20).write.parquet(scratch + "/queue")
    cfg = ChainConfig(warehouse=scratch + "/wh", state_partitions=3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run_chain_available(spark, read_envelope_files(spark, scratch + "/queue"), cfg)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before and not cfg.available_now
