"""Deterministic fault injection on a frame of change events.

Each draw is a modular hash of an integer key and a seed, so the same input
gives the same faults on any cluster and in any SQL engine. Every step is
row-local (no shuffle); J1 and J2 add flag columns so the tally of normal,
late and duplicate rows is one ``groupBy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.columns import seeded_unit

# Fixed values (the live mix the synthetic batch imitates): sites as
# (server name, wiki id); event types with their shares; namespaces drawn
# from this list; 400 titles "Pagina 1".."Pagina 400"; 60 users "Usuario1"..
# "Usuario60"; 41 % bots; schema URI; default tag "evento sintetico s<seed>".
SITES = (
    ("commons.wikimedia.org", "commonswiki"),
    ("www.wikidata.org", "wikidatawiki"),
    ("en.wikipedia.org", "enwiki"),
    ("es.wikipedia.org", "eswiki"),
    ("fr.wikipedia.org", "frwiki"),
)
TYPE_SHARES = (("edit", 0.556), ("categorize", 0.377), ("log", 0.050), ("new", 0.017))
NAMESPACES = (0, 0, 0, 6, 14)
N_TITLES, TITLE_PREFIX = 400, "Pagina "
N_USERS, USER_PREFIX = 60, "Usuario"
BOT_SHARE = 0.41
DEFAULT_TAG = "evento sintetico s%d"


def inject_late(df: DataFrame, pct: float, lo_s: float, hi_s: float, seed: int,
                key: str = "event_id", time_col: str = "ts") -> DataFrame:
    """Move the event time of ``pct`` % of rows back by uniform(lo, hi)
    seconds (whole milliseconds). Queue time is left as it was, so those
    rows arrive late. Adds ``tardio`` and ``retraso_inyectado_ms``."""
    late = seeded_unit(key, seed, 1) * F.lit(100.0) < F.lit(float(pct))
    shift_ms = F.floor(F.lit(lo_s * 1000.0) + F.lit((hi_s - lo_s) * 1000.0) * seeded_unit(key, seed, 2))
    shift_ms = F.when(late, shift_ms).otherwise(F.lit(0)).cast("long")
    return (df.withColumn("tardio", late)
            .withColumn("retraso_inyectado_ms", shift_ms)
            .withColumn(time_col, F.timestamp_micros(F.unix_micros(F.col(time_col)) - F.col("retraso_inyectado_ms") * 1000)))


def inject_duplicates(df: DataFrame, pct: float, seed: int, key: str = "event_id") -> DataFrame:
    """Emit ``pct`` % of rows twice, byte-identical (same id); ``copia``
    is 0 for the original and 1 for the copy."""
    dup = seeded_unit(key, seed, 3) * F.lit(100.0) < F.lit(float(pct))
    copies = F.when(dup, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.drop("copia").withColumn("copia", F.explode(copies))


def tag(df: DataFrame, text: str) -> DataFrame:
    """Mark a test batch in ``comment`` so its rows can be found later (H1)."""
    return df.withColumn("comment", F.lit(text))


def _pick(values, u):
    """Element of ``values`` chosen by a uniform draw ``u``."""
    idx = F.least(F.floor(u * F.lit(len(values))), F.lit(len(values) - 1)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx + 1)


def synth_events(df: DataFrame, seed: int, text: str | None = None,
                 key: str = "event_id") -> DataFrame:
    """Overwrite the page, user, site and type fields of a change frame
    with draws that follow the live mix (shares above). Time columns and
    ids are kept, so the result has the source's volume and timing."""
    t = seeded_unit(key, seed, 10)
    cum, kind = 0.0, None
    for name, share in TYPE_SHARES:
        cum += share
        kind = (F.when(t <= F.lit(cum), F.lit(name)) if kind is None
                else kind.when(t <= F.lit(cum), F.lit(name)))
    kind = kind.otherwise(F.lit("edit"))
    site = F.least(F.floor(seeded_unit(key, seed, 11) * F.lit(len(SITES))), F.lit(len(SITES) - 1)).cast("int")
    title_n = F.floor(seeded_unit(key, seed, 12) * F.lit(N_TITLES)).cast("int") + 1
    user_n = F.floor(seeded_unit(key, seed, 13) * F.lit(N_USERS)).cast("int") + 1
    return (df.withColumn("tipo", kind)
            .withColumn("servidor", F.element_at(F.array(*[F.lit(s) for s, _ in SITES]), site + 1))
            .withColumn("wiki", F.element_at(F.array(*[F.lit(w) for _, w in SITES]), site + 1))
            .withColumn("espacio", _pick(NAMESPACES, seeded_unit(key, seed, 14)))
            .withColumn("titulo", F.concat(F.lit(TITLE_PREFIX), title_n.cast("string")))
            .withColumn("usuario", F.concat(F.lit(USER_PREFIX), user_n.cast("string")))
            .withColumn("es_bot", seeded_unit(key, seed, 15) < F.lit(BOT_SHARE))
            .withColumn("comment", F.lit(text if text is not None else DEFAULT_TAG % seed)))


def tally(df: DataFrame) -> DataFrame:
    """Normal / late / duplicate counts of an injected batch."""
    kind = (F.when(F.col("copia") > 0, F.lit("duplicado"))
            .when(F.col("tardio"), F.lit("tardio")).otherwise(F.lit("normal")))
    return df.groupBy(kind.alias("clase")).agg(F.count(F.lit(1)).alias("filas"))


def mix_shares(df: DataFrame) -> DataFrame:
    """Events per type, site, namespace and bot flag, and the pages and users
    they name: what the mix of a batch looks like."""
    return (df.groupBy("tipo", "wiki", "servidor", "espacio", "es_bot")
            .agg(F.count(F.lit(1)).alias("eventos"), F.count_distinct("titulo").alias("paginas"),
                 F.count_distinct("usuario").alias("usuarios")))
