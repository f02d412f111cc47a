"""Sliding windows from panes of mergeable sketches (E3), and latency and rate
percentiles from stored sketches (F2, I2, I7).

A pane is a tumbling window as long as the slide. Each row is read once, into
one pane; its page's editors go into a HyperLogLog sketch. A sliding window is
the union of its panes' sketches, so what is copied ``width / slide`` times is
a pane's state, not its rows. Stored panes answer any window whose width and
slide are multiples of the pane.

In the same way a minute's latencies are kept as a KLL sketch with their
count, minimum and maximum: a question about the last 15 minutes merges at
most 15 small rows and reads no silver.

All functions serve a batch frame and, after ``with_lateness``, a stream (the
chained aggregates run in append mode).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.operators.gold import LIVE_EDIT_TYPES, MIN_EDITORS

#: log2 of the HyperLogLog registers: a standard error of 1.6 % (2^12)
LG_K = 12
#: KLL size, states of some 20 KB; twice its published rank error of 0.24 %
#: (99 % confidence)
KLL_K = 2_000
KLL_RANK_ERROR = 0.0048


def page_panes(silver: DataFrame, pane: str = "1 minute", edit_types=LIVE_EDIT_TYPES, lg_k: int = LG_K) -> DataFrame:
    """ventana_inicio, ventana_fin, ts_panel, wiki, titulo, editores_hll,
    ediciones: per pane and page the sketch of its human editors and the
    number of their edits. ``ts_panel`` is an instant of the pane that a
    further window can take as event time."""
    humans = (silver.filter(~F.col("es_bot")).filter(F.col("tipo").isin(*edit_types))
              .select("ts_evento", "wiki", "titulo", "usuario"))
    g = (humans.groupBy(F.window("ts_evento", pane), "wiki", "titulo")
         .agg(F.hll_sketch_agg("usuario", F.lit(lg_k)).alias("editores_hll"), F.count(F.lit(1)).alias("ediciones")))
    return g.select(F.col("window.start").alias("ventana_inicio"), F.col("window.end").alias("ventana_fin"),
                    F.window_time("window").alias("ts_panel"), "wiki", "titulo", "editores_hll", "ediciones")


def pages_from_panes(panes: DataFrame, width: str = "5 minutes", slide: str = "1 minute",
                     min_editors: int = MIN_EDITORS) -> DataFrame:
    """P3 from panes: pages with ``min_editors`` or more distinct editors in a
    sliding window. Width and slide must be multiples of the pane's length."""
    g = (panes.groupBy(F.window("ts_panel", width, slide), "wiki", "titulo")
         .agg(F.hll_sketch_estimate(F.hll_union_agg("editores_hll")).alias("editores"),
              F.sum("ediciones").cast("long").alias("ediciones"))
         .filter(F.col("editores") >= min_editors))
    return g.select(F.col("window.start").alias("ventana_inicio"), F.col("window.end").alias("ventana_fin"),
                    "wiki", "titulo", F.col("editores").cast("long").alias("editores"), "ediciones")


def _sketched(col: str, k: int) -> list[Column]:
    return [F.count(col).alias("filas"), F.min(col).alias("minimo"), F.max(col).alias("maximo"),
            F.kll_sketch_agg_double(col, F.lit(k)).alias("estado")]


def latency_panes(silver: DataFrame, pane: str = "1 minute", k: int = KLL_K) -> DataFrame:
    """ventana_inicio, ventana_fin, ultimo (newest event time), filas, minimo,
    maximo, estado: per pane of event time the ingest latencies (s) of rows
    that were ingested after their event."""
    lat = F.col("ingerido_en").cast("double") - F.col("ts_evento").cast("double")
    rows = silver.select("ts_evento", F.when(lat > 0, lat).alias("lat"))
    g = rows.groupBy(F.window("ts_evento", pane)).agg(F.max("ts_evento").alias("ultimo"), *_sketched("lat", k))
    return g.select(F.col("window.start").alias("ventana_inicio"), F.col("window.end").alias("ventana_fin"),
                    "ultimo", "filas", "minimo", "maximo", "estado")


def merge_states(panes: DataFrame, *more: Column) -> DataFrame:
    """One row from the states: filas, minimo, maximo, estado."""
    return panes.agg(F.coalesce(F.sum("filas"), F.lit(0)).cast("long").alias("filas"), F.min("minimo").alias("minimo"),
                     F.max("maximo").alias("maximo"), F.kll_merge_agg_double("estado").alias("estado"), *more)


def quantiles(merged: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Adds columns for ``probs`` from the merged state; NULL without rows."""
    return merged.select("*", *[
        F.when(F.col("filas") > 0, F.kll_sketch_get_quantile_double("estado", F.lit(float(p)))).alias(name)
        for name, p in probs.items()])


def latency_from_panes(panes: DataFrame, lookback: str | None = "15 minutes") -> DataFrame:
    """F2 from ``latency_panes``: filas, minimo, p50, p95, p99, maximo over the
    panes that begin after the newest event time less ``lookback`` (whole
    panes, so the first, partial one is left out)."""
    if lookback:
        bound = panes.agg((F.max("ultimo") - F.expr("INTERVAL " + lookback)).alias("_lo"))
        panes = panes.crossJoin(F.broadcast(bound)).filter(F.col("ventana_inicio") >= F.col("_lo"))
    out = quantiles(merge_states(panes), {"p50": 0.50, "p95": 0.95, "p99": 0.99})
    return out.select("filas", *[F.round(c, 2).alias(c) for c in ("minimo", "p50", "p95", "p99", "maximo")])


def arrival_panes(times: DataFrame, pane_s: int = 60, k: int = KLL_K) -> DataFrame:
    """I7 as states: per minute of arrival the arrival latencies of ``times``
    (recibido, lat; lat NULL without a valid event time)."""
    return (times.groupBy(F.floor(F.col("recibido") / pane_s).alias("minuto"))
            .agg(F.count(F.when(F.col("lat").isNull(), 1)).alias("sin_tiempo"), *_sketched("lat", k)))


def arrival_from_panes(panes: DataFrame) -> DataFrame:
    """con_tiempo, sin_tiempo, minimo, p50, p95, p99, maximo."""
    merged = merge_states(panes, F.coalesce(F.sum("sin_tiempo"), F.lit(0)).cast("long").alias("sin_tiempo"))
    out = quantiles(merged, {"p50": 0.50, "p95": 0.95, "p99": 0.99})
    return out.select(F.col("filas").alias("con_tiempo"), "sin_tiempo", "minimo", "p50", "p95", "p99", "maximo")


def rank_errors(values: DataFrame, col: str, estimates: DataFrame, probs: dict[str, float]) -> DataFrame:
    """cuantil, filas, error: for each estimated quantile how far its true rank
    (share of values at or below it) is from the wanted one; 0 if the wanted
    rank lies within the ranks of equal values."""
    est = estimates.select(F.explode(F.array(*[F.struct(F.lit(n).alias("cuantil"), F.lit(float(p)).alias("p"),
                                                        F.col(n).alias("v")) for n, p in probs.items()])).alias("q"))
    est = est.select("q.*")
    # a few estimates against all values: one pass, aggregated per estimate
    both = values.select(F.col(col).alias("_x")).where(F.col("_x").isNotNull()).crossJoin(F.broadcast(est))
    ranks = both.groupBy("cuantil", "p").agg(
        F.count(F.lit(1)).alias("filas"), F.avg((F.col("_x") <= F.col("v")).cast("double")).alias("_hi"),
        F.avg((F.col("_x") < F.col("v")).cast("double")).alias("_lo"))
    error = F.greatest(F.col("p") - F.col("_hi"), F.col("_lo") - F.col("p"), F.lit(0.0))
    return ranks.select("cuantil", "filas", error.alias("error"))
