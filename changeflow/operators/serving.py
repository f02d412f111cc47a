"""Batch serving queries over silver and gold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.ordering import summary


def layer_volumes(spark: SparkSession, layers: dict) -> DataFrame:
    """rows per layer. ``layers`` maps name -> DataFrame, or None for a
    table that does not exist yet (legal: its job has not run)."""
    parts = []
    for name, df in layers.items():
        if df is None:
            parts.append(spark.createDataFrame(
                [(name, None, False)], "tabla string, filas bigint, existe boolean"))
        else:
            parts.append(df.agg(F.count(F.lit(1)).alias("filas"))
                         .select(F.lit(name).alias("tabla"), "filas", F.lit(True).alias("existe")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def latency(silver: DataFrame, lookback: str = "15 minutes", exact: bool = False,
            accuracy: int = 10000) -> DataFrame:
    """ingest latency (ingest stamp - event time, s) over the last
    ``lookback`` of event time, rows with ingest after event only.

    ``exact=True`` gives linear-interpolation percentiles (the second
    engine's numbers) by distributed rank selection; the default is the
    mergeable approximate form (one sketch per task, merged).
    """
    bound = silver.agg((F.max("ts_evento") - F.expr("INTERVAL " + lookback)).alias("_lo"))
    recent = (silver.select("ts_evento", "ingerido_en")
              .crossJoin(F.broadcast(bound))
              .filter((F.col("ts_evento") > F.col("_lo")) & (F.col("ingerido_en") > F.col("ts_evento")))
              .select((F.col("ingerido_en").cast("double") - F.col("ts_evento").cast("double")).alias("lat")))
    if exact:
        both = summary(recent, "lat", {"_p50": 0.50, "_p95": 0.95, "_p99": 0.99}).withColumnsRenamed(
            {"valores": "filas", "minimo": "_min", "maximo": "_max"})
    else:
        def pct(p):
            return F.percentile_approx(F.col("lat"), F.lit(p), F.lit(accuracy))
        both = recent.agg(F.count(F.lit(1)).alias("filas"), F.min("lat").alias("_min"),
                          F.max("lat").alias("_max"), pct(0.50).alias("_p50"),
                          pct(0.95).alias("_p95"), pct(0.99).alias("_p99"))
    return both.select(
        "filas",
        F.round(F.col("_min"), 2).alias("minimo"),
        F.round(F.col("_p50"), 2).alias("p50"),
        F.round(F.col("_p95"), 2).alias("p95"),
        F.round(F.col("_p99"), 2).alias("p99"),
        F.round(F.col("_max"), 2).alias("maximo"),
    )


def activity_latest(p1: DataFrame, n: int = 12) -> DataFrame:
    """P1 rows of the newest window, top ``n`` by events (ties by key)."""
    newest = p1.agg(F.max("ventana_inicio").alias("_v"))
    return (p1.crossJoin(F.broadcast(newest))
            .filter(F.col("ventana_inicio") == F.col("_v"))
            .select("servidor", "espacio", "eventos")
            .orderBy(F.col("eventos").desc(), F.col("servidor"), F.col("espacio"))
            .limit(n))


def _bot_sums(p2: DataFrame) -> DataFrame:
    return (p2.groupBy("ventana_inicio")
            .agg(F.sum(F.when(F.col("es_bot"), F.col("eventos")).otherwise(0)).cast("long").alias("bots"),
                 F.sum(F.when(F.col("es_bot"), 0).otherwise(F.col("eventos"))).cast("long").alias("humanos")))


def _pct_bot(bots: str = "bots", humans: str = "humanos"):
    return (F.lit(100.0) * F.col(bots).cast("double")
            / (F.col(bots) + F.col(humans)).cast("double"))


def bot_share(p2: DataFrame, n: int = 12) -> DataFrame:
    """bots, humans and bot share per window, newest ``n`` windows."""
    return (_bot_sums(p2)
            .select(F.date_format("ventana_inicio", "yyyy-MM-dd HH:mm").alias("ventana"),
                    "ventana_inicio", "bots", "humanos",
                    F.round(_pct_bot(), 1).alias("pct_bot"))
            .orderBy(F.col("ventana_inicio").desc())
            .limit(n))


def bot_share_swing(p2: DataFrame) -> DataFrame:
    """how much the bot share moves between windows."""
    per_window = _bot_sums(p2).select(_pct_bot().alias("pct_bot"))
    return per_window.agg(
        F.count(F.lit(1)).alias("ventanas"),
        F.round(F.min("pct_bot"), 1).alias("min_pct_bot"),
        F.round(F.avg("pct_bot"), 1).alias("media_pct_bot"),
        F.round(F.max("pct_bot"), 1).alias("max_pct_bot"),
        F.round(F.stddev_samp("pct_bot"), 1).alias("desviacion"),
    )


def concurrent_top(p3: DataFrame, n: int = 15) -> DataFrame:
    """most concurrent pages, by editors then edits (ties by key)."""
    return (p3.select("ventana_inicio", "wiki", "titulo", "editores", "ediciones")
            .orderBy(F.col("editores").desc(), F.col("ediciones").desc(),
                     F.col("ventana_inicio"), F.col("wiki"), F.col("titulo"))
            .limit(n))


def report(spark: SparkSession, warehouse: str, exact: bool = False,
           since: str | None = None, silver_checkpoint: str | None = None,
           table: Callable[[str], str] | None = None) -> dict[str, DataFrame]:
    """F1-F6 over the stored layers of a warehouse, or over those that
    ``table`` names (layer -> folder or catalog name). A missing layer is
    reported, not an error; without the P1 and P2 tables only the volumes
    are returned. ``since`` limits silver to recent day partitions for the
    latency query (partition pruning), which reads no silver at all where
    latency states are stored; with the silver query's checkpoint the latency
    to commit is added."""
    from changeflow.schemas import LAYERS
    from changeflow.sources.tables import is_folder, footer_scan, layer_path, newest_day, read_table, table_exists
    names = {k: table(k) if table else layer_path(warehouse, k) for k in LAYERS}
    present = {k: table_exists(spark, name) for k, name in names.items()}
    frames = {k: (read_table(spark, names[k], layer=k).drop("dia") if ok else None) for k, ok in present.items()}
    # counts of folders come from the files' footers
    out = {"volumes": layer_volumes(spark, {
        k: (footer_scan(spark, names[k], k) if is_folder(names[k]) else frames[k]) if ok else None
        for k, ok in present.items()})}
    stored = present["gold_activity"]
    if present["gold_counts"] and not (present["gold_activity"] and present["gold_bots"]):
        from changeflow.operators.gold import activity_from_counts, bots_from_counts
        frames["gold_activity"] = activity_from_counts(frames["gold_counts"])
        frames["gold_bots"] = bots_from_counts(frames["gold_counts"])
        present["gold_activity"] = present["gold_bots"] = True
    if present["gold_panes"] and not present["gold_concurrent"]:
        from changeflow.operators.panes import pages_from_panes
        frames["gold_concurrent"] = pages_from_panes(frames["gold_panes"])
        present["gold_concurrent"] = True
    if not (present["gold_activity"] and present["gold_bots"]):
        return out
    if present["silver"]:
        silver = read_table(spark, names["silver"], layer="silver", since=since).drop("dia")
        if present["silver_latency"] and not exact:
            from changeflow.operators.panes import latency_from_panes
            out["latency"] = latency_from_panes(frames["silver_latency"])
        else:
            out["latency"] = latency(silver, exact=exact)
        if silver_checkpoint:
            from changeflow.streaming.commits import commit_history, has_history
            if has_history(spark, silver_checkpoint):
                out["commit_latency"] = commit_latency(silver, commit_history(spark, silver_checkpoint), exact=exact)
    latest = newest_day(spark, names["gold_activity"], "gold_activity").drop("dia") if stored else frames["gold_activity"]
    out["activity_latest"] = activity_latest(latest)
    out["bot_share"] = bot_share(frames["gold_bots"])
    out["bot_share_swing"] = bot_share_swing(frames["gold_bots"])
    if present["gold_concurrent"]:
        out["concurrent_top"] = concurrent_top(frames["gold_concurrent"])
    return out


def commit_latency(silver: DataFrame, commits: DataFrame, lookback: str | None = "15 minutes",
                   exact: bool = False) -> DataFrame:
    """F2 measured to the commit: seconds from event time to the commit of
    the micro-batch that wrote the row. ``ingerido_en`` is the batch start,
    so the plain latency leaves out the batch's run time; ``commits`` is
    the silver query's ``commit_history``.

    The commit of a row is the first commit at or after its batch start. The
    lookback is applied first, so only recent rows, starts and commits meet.
    Both sides have one row per micro-batch; a descending scan with the
    distributed prefix max finds it, and the start -> commit map joins back
    on the ingest stamp."""
    from changeflow.operators.ordering import prefix_max_before

    rows = silver.select("ts_evento", "ingerido_en")
    if lookback:
        bound = silver.agg((F.max("ts_evento") - F.expr("INTERVAL " + lookback)).alias("_lo"))
        rows = rows.crossJoin(F.broadcast(bound)).filter(F.col("ts_evento") > F.col("_lo")).drop("_lo")
    starts = rows.select(F.col("ingerido_en").alias("_start")).distinct()
    points = (starts.select(F.col("_start"), (-F.unix_micros("_start")).alias("_key"),
                            F.lit(1).alias("_kind"), F.lit(None).cast("double").alias("_v"))
              .unionByName(commits.select(
                  F.lit(None).cast("timestamp").alias("_start"),
                  (-F.unix_millis("committed_at") * 1000).alias("_key"),
                  F.lit(0).alias("_kind"),
                  (-F.unix_millis("committed_at") * 1000).cast("double").alias("_v"))))
    # descending time; at equal time the commit comes first (commit >= start)
    scanned = prefix_max_before(points, ["_key", "_kind"], "_v", "_neg")
    mapping = (scanned.filter(F.col("_kind") == 1)
               .select(F.col("_start").alias("ingerido_en"),
                       F.timestamp_micros((-F.col("_neg")).cast("long")).alias("_commit")))
    lat = (rows.join(mapping, "ingerido_en", "left")
           .filter(F.col("_commit").isNotNull())
           .select((F.col("_commit").cast("double") - F.col("ts_evento").cast("double")).alias("lat")))
    if exact:
        both = summary(lat, "lat", {"_p50": 0.50, "_p95": 0.95, "_p99": 0.99}).withColumnsRenamed(
            {"valores": "filas", "minimo": "_min", "maximo": "_max"})
    else:
        both = lat.agg(F.count(F.lit(1)).alias("filas"), F.min("lat").alias("_min"), F.max("lat").alias("_max"),
                       *[F.percentile_approx("lat", F.lit(p), F.lit(10000)).alias(n)
                         for n, p in (("_p50", 0.5), ("_p95", 0.95), ("_p99", 0.99))])
    return both.select("filas", *[F.round(F.col(c), 2).alias(a) for c, a in
                                  (("_min", "minimo"), ("_p50", "p50"), ("_p95", "p95"),
                                   ("_p99", "p99"), ("_max", "maximo"))])
