"""Panes of mergeable sketches (E3, F2, I7) against row-wise forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators import gold, panes, serving
from changeflow.schemas import SILVER


def _silver(spark, rows):
    full = [("id%d" % i, ts, "edit", "enwiki", "en", 0, title, user, bot, None, ts, 0.0, ts + dt.timedelta(seconds=lat))
            for i, (ts, user, bot, title, lat) in enumerate(rows)]
    return spark.createDataFrame(full, SILVER)


def _rows(seed, n):
    rnd = random.Random(seed)
    start = dt.datetime(2026, 1, 1, 10, 0)
    return [(start + dt.timedelta(seconds=rnd.uniform(0, 1800)), rnd.choice([None, *("u%d" % i for i in range(9))]),
             rnd.random() < 0.2, "P%d" % rnd.randrange(6), rnd.choice([-3.0, 0.0, rnd.uniform(0.1, 90)])) for _ in range(n)]


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_windows_of_panes_equal_windows_of_rows(spark):
    s = _silver(spark, _rows(1, 900))
    stored = panes.page_panes(s)
    for width, slide in (("5 minutes", "1 minute"), ("10 minutes", "5 minutes"), ("1 minute", "1 minute")):
        assert _set(panes.pages_from_panes(stored, width, slide)) == _set(gold.concurrent_pages(s, width, slide, exact=True))


def test_many_editors_stay_within_the_sketch_error(spark):
    start = dt.datetime(2026, 1, 1, 10, 0)
    rows = [(start + dt.timedelta(seconds=i % 240), "u%d" % (i % 5000), False, "P", 1.0) for i in range(20_000)]
    s = _silver(spark, rows)
    near = {r.ventana_inicio: r.editores for r in panes.pages_from_panes(panes.page_panes(s)).collect()}
    for r in gold.concurrent_pages(s, exact=True).collect():
        assert abs(near[r.ventana_inicio] - r.editores) <= 3 * 0.0163 * r.editores


def test_a_row_is_read_into_one_pane(spark):
    s = _silver(spark, _rows(2, 50))
    plan = panes.page_panes(s)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_stream_of_chained_windows(spark, scratch):
    """Panes and their windows as one streaming query (append)."""
    s = _silver(spark, _rows(3, 600))
    s.write.parquet(scratch + "/in")
    stream = spark.readStream.schema(SILVER).parquet(scratch + "/in").withWatermark("ts_evento", "30 seconds")
    found = panes.pages_from_panes(panes.page_panes(stream))
    query = (found.writeStream.format("parquet").option("checkpointLocation", scratch + "/ck").option("path", scratch + "/out")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    expected = _set(gold.closed_windows(gold.concurrent_pages(s, exact=True), s))
    assert _set(spark.read.parquet(scratch + "/out")) == expected and expected


@pytest.mark.parametrize("lookback", ["15 minutes", "40 minutes", None])
def test_latency_states(spark, lookback):
    rows = _rows(4, 800)
    s = _silver(spark, rows)
    got = panes.latency_from_panes(panes.latency_panes(s), lookback).first()
    newest = max(r[0] for r in rows)
    span = dt.timedelta(minutes=int(lookback.split()[0])) if lookback else dt.timedelta(days=1)
    lat = sorted(r[4] for r in rows if r[4] > 0 and r[0].replace(second=0, microsecond=0) >= newest - span)
    assert got.filas == len(lat)
    assert (got.minimo, got.maximo) == (round(lat[0], 2), round(lat[-1], 2))
    for p, value in ((0.5, got.p50), (0.95, got.p95), (0.99, got.p99)):
        assert value == pytest.approx(lat[-int(-p * len(lat) // 1) - 1], abs=0.011)


def test_no_rows(spark):
    s = _silver(spark, _rows(5, 3)).limit(0)
    assert panes.latency_from_panes(panes.latency_panes(s)).first().filas == 0
    assert panes.latency_from_panes(panes.latency_panes(s)).first().p50 is None
    assert panes.pages_from_panes(panes.page_panes(s)).count() == 0


def test_rank_errors(spark):
    values = spark.range(1, 101).select(F.col("id").cast("double").alias("x"))
    est = spark.range(1).select(F.lit(50.0).alias("p50"), F.lit(90.0).alias("p95"))
    got = {r.cuantil: r for r in panes.rank_errors(values, "x", est, {"p50": 0.5, "p95": 0.95}).collect()}
    assert got["p50"].error == 0 and got["p95"].error == pytest.approx(0.05) and got["p50"].filas == 100


def test_report_reads_states_instead_of_silver(spark, scratch):
    from changeflow.sources.tables import layer_path
    s = _silver(spark, _rows(6, 400))
    for layer, df in (("silver", s), ("gold_activity", gold.activity(s)), ("gold_bots", gold.bot_counts(s)),
                      ("gold_panes", panes.page_panes(s)), ("silver_latency", panes.latency_panes(s))):
        day = "ts_evento" if layer == "silver" else "ventana_inicio"
        df.withColumn("dia", F.to_date(day)).write.partitionBy("dia").parquet(layer_path(scratch, layer))
    out = serving.report(spark, scratch)
    plan = out["latency"]._jdf.queryExecution().executedPlan().toString()
    assert "estado" in plan and "ts_evento" not in plan and "ingerido_en" not in plan
    assert out["latency"].first().filas == panes.latency_from_panes(panes.latency_panes(s)).first().filas
    assert _set(out["concurrent_top"]) == _set(serving.concurrent_top(gold.concurrent_pages(s, exact=True)))
