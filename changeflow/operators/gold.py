"""Silver -> gold: windowed aggregates P1-P3.

The same functions serve a streaming frame (after ``with_lateness``; append
mode emits a window once the watermark passes its end) and a batch frame.
``closed_windows`` is the batch twin of append emission.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.operators.dedup import DEFAULT_LATENESS

LIVE_EDIT_TYPES = ("edit", "new")
MIN_EDITORS = 2


def _flatten(grouped: DataFrame, *cols: str) -> DataFrame:
    return grouped.select(
        F.col("window.start").alias("ventana_inicio"),
        F.col("window.end").alias("ventana_fin"),
        *cols,
    )


def activity(silver: DataFrame, width: str = "1 minute") -> DataFrame:
    """Events per (tumbling window, server, namespace)."""
    g = (silver.groupBy(F.window("ts_evento", width), F.col("servidor"), F.col("espacio"))
         .agg(F.count(F.lit(1)).alias("eventos")))
    return _flatten(g, "servidor", "espacio", "eventos")


def bot_counts(silver: DataFrame, width: str = "1 minute") -> DataFrame:
    """Events per (tumbling window, is-bot)."""
    g = (silver.groupBy(F.window("ts_evento", width), F.col("es_bot"))
         .agg(F.count(F.lit(1)).alias("eventos")))
    return _flatten(g, "es_bot", "eventos")


def activity_bot_counts(silver: DataFrame, width: str = "1 minute") -> DataFrame:
    """P1 and P2 folded: events per (tumbling window, server, namespace,
    is-bot). One aggregation (one scan, one state store in a stream) from
    which both are derived exactly by summing."""
    g = (silver.groupBy(F.window("ts_evento", width), F.col("servidor"), F.col("espacio"), F.col("es_bot"))
         .agg(F.count(F.lit(1)).alias("eventos")))
    return _flatten(g, "servidor", "espacio", "es_bot", "eventos")


def activity_from_counts(counts: DataFrame) -> DataFrame:
    """P1 from the folded counts."""
    return (counts.groupBy("ventana_inicio", "ventana_fin", "servidor", "espacio")
            .agg(F.sum("eventos").cast("long").alias("eventos")))


def bots_from_counts(counts: DataFrame) -> DataFrame:
    """P2 from the folded counts."""
    return (counts.groupBy("ventana_inicio", "ventana_fin", "es_bot")
            .agg(F.sum("eventos").cast("long").alias("eventos")))


def concurrent_pages(silver: DataFrame, width: str = "5 minutes", slide: str = "1 minute",
                     min_editors: int = MIN_EDITORS, exact: bool = False,
                     edit_types=LIVE_EDIT_TYPES, rsd: float = 0.05) -> DataFrame:
    """Pages edited by at least ``min_editors`` distinct humans inside a
    sliding window. Bots and non-edit types are filtered before the window
    (each row is copied into width/slide windows, so filter first).

    ``exact=False`` counts editors with HyperLogLog++ (mergeable state,
    what a stream should keep); ``exact=True`` counts them exactly (batch:
    two-level distinct aggregation; stream: the set of users per window and
    page is kept in state).
    """
    humans = (silver.filter(~F.col("es_bot"))
              .filter(F.col("tipo").isin(*edit_types))
              .select("ts_evento", "wiki", "titulo", "usuario"))
    if exact:
        editors = (F.size(F.collect_set("usuario")) if silver.isStreaming
                   else F.count_distinct("usuario"))
    else:
        editors = F.approx_count_distinct("usuario", rsd)
    g = (humans.groupBy(F.window("ts_evento", width, slide), F.col("wiki"), F.col("titulo"))
         .agg(editors.cast("long").alias("editores"), F.count(F.lit(1)).alias("ediciones"))
         .filter(F.col("editores") >= min_editors))
    return _flatten(g, "wiki", "titulo", "editores", "ediciones")


def closed_windows(gold: DataFrame, silver: DataFrame,
                   lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """Keep the windows an append stream would have emitted by now: those
    whose end is at or before max(event time) - lateness. The bound is a
    one-row global aggregate (partial max per task), joined as a constant."""
    bound = silver.agg(
        (F.max("ts_evento") - F.expr("INTERVAL " + lateness)).alias("_wm"))
    return (gold.crossJoin(F.broadcast(bound))
            .filter(F.col("ventana_fin") <= F.col("_wm"))
            .drop("_wm"))
