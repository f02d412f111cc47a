"""Source profile of a capture (I1-I10), as Spark jobs over any size of
capture: rates, sizes, value frequencies, duplicates, disorder, latency,
observed schema, fields typical of a type, and one example per type.

Percentiles use linear interpolation between closest ranks (``exact``), or
the mergeable approximate form. Exact percentiles of continuous values
(lags, latencies) use distributed rank selection; those of small-range
integers (events per second, sizes in bytes) use Spark's ``percentile``,
whose value -> count map is bounded by the number of distinct values.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.columns import profile_time
from changeflow.operators.common import fence
from changeflow.operators.refine import epoch_to_ts
from changeflow.operators.ordering import prefix_max_before, summary
from changeflow.session import ensure_checkpoint_dir


def _events(cap: DataFrame) -> DataFrame:
    return cap.filter(~F.col("error"))


def _pct(col: str, p: float, exact: bool):
    return (F.percentile(F.col(col), F.lit(p)) if exact
            else F.percentile_approx(F.col(col), F.lit(p), F.lit(10000)).cast("double"))


_P = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def _summary(df: DataFrame, col: str, exact: bool) -> DataFrame:
    """One row over a continuous column: valores, nulos, minimo, maximo, p50,
    p95, p99. Exact quantiles use distributed rank selection (no single-task
    value map), all from one pass over ``df``."""
    if exact:
        return summary(df, col, _P)
    return df.agg(F.count(col).alias("valores"), F.count(F.when(F.col(col).isNull(), 1)).alias("nulos"),
                  F.min(col).cast("double").alias("minimo"), F.max(col).cast("double").alias("maximo"),
                  *[F.percentile_approx(F.col(col), F.lit(p), F.lit(10000)).cast("double").alias(n) for n, p in _P.items()])


def throughput(cap: DataFrame) -> DataFrame:
    """Events, duration (max - min arrival), mean events/s (0 when the
    duration is 0) and parse errors."""
    agg = cap.agg(
        F.count(F.when(~F.col("error"), 1)).alias("eventos"),
        F.count(F.when(F.col("error"), 1)).alias("errores_parseo"),
        F.coalesce(F.max(F.when(~F.col("error"), F.col("recibido")))
                   - F.min(F.when(~F.col("error"), F.col("recibido"))), F.lit(0.0)).alias("duracion_s"))
    return agg.select("eventos", "duracion_s",
                      F.when(F.col("duracion_s") > 0, F.col("eventos") / F.col("duracion_s"))
                      .otherwise(F.lit(0.0)).alias("eps_medio"),
                      "errores_parseo")


def rate_percentiles(cap: DataFrame, exact: bool = True) -> DataFrame:
    """Events per second of arrival; the first and last second are
    partly covered and left out; p50, p95 and peak of the rest. Seconds
    without events are absent, not zero. Two seconds or fewer -> NaN, NaN, 0."""
    per_s = (_events(cap).groupBy(F.floor(F.col("recibido")).alias("s"))
             .agg(F.count(F.lit(1)).alias("n")))
    ends = per_s.agg(F.min("s").alias("_lo"), F.max("s").alias("_hi"), F.count(F.lit(1)).alias("_k"))
    inner = (per_s.crossJoin(F.broadcast(ends))
             .filter((F.col("s") > F.col("_lo")) & (F.col("s") < F.col("_hi")) & (F.col("_k") > 2)))
    agg = inner.agg(_pct("n", 0.5, exact).alias("p50"), _pct("n", 0.95, exact).alias("p95"),
                    F.max("n").alias("pico"))
    nan = F.lit(float("nan"))
    return agg.select(F.coalesce(F.col("p50").cast("double"), nan).alias("eps_p50"),
                      F.coalesce(F.col("p95").cast("double"), nan).alias("eps_p95"),
                      F.coalesce(F.col("pico"), F.lit(0)).cast("long").alias("eps_pico"))


def size_profile(cap: DataFrame, exact: bool = True) -> DataFrame:
    """Event size in UTF-8 bytes of the event text: mean, p50, p95,
    max, total MB and KB per second of capture."""
    ev = _events(cap).select(F.octet_length("evento").alias("b"), "recibido")
    agg = ev.agg(F.avg("b").alias("media"), _pct("b", 0.5, exact).alias("p50"),
                 _pct("b", 0.95, exact).alias("p95"), F.max("b").cast("long").alias("maximo"),
                 F.sum("b").cast("double").alias("_tot"),
                 (F.max("recibido") - F.min("recibido")).alias("_dur"))
    return agg.select("media", F.col("p50").cast("double").alias("p50"),
                      F.col("p95").cast("double").alias("p95"), "maximo",
                      (F.col("_tot") / F.lit(1e6)).alias("total_mb"),
                      F.when(F.col("_dur") > 0, F.col("_tot") / F.col("_dur") / F.lit(1e3)).alias("kb_s"))


# Labels for a missing value, per profiled field (fixed report values).
MISSING = {
    "type": "(sin tipo)",
    "$schema": "(sin schema)",
    "server_name": "(sin server_name)",
    "namespace": "(sin namespace)",
}


def _field(path: str):
    return F.get_json_object(F.col("evento"), "$['%s']" % path) if path.startswith("$") \
        else F.get_json_object(F.col("evento"), "$." + path)


#: the fields of the report, with the number of values shown
REPORTED = {"type": None, "$schema": None, "server_name": 12, "bot": None, "namespace": None}


def top_values(cap: DataFrame, field: str, n: int | None = None) -> DataFrame:
    """I4: frequency of a top-level field's values with their share of all
    events, most common first (ties by value). A missing field gets its
    label; ``bot`` is reported as bot / humano."""
    ev = _events(cap)
    if field == "bot":
        val = F.when(F.lower(F.coalesce(_field("bot"), F.lit("false"))) == "true", F.lit("bot")).otherwise(F.lit("humano"))
    else:
        val = F.coalesce(_field(field), F.lit(MISSING.get(field, "(sin %s)" % field)))
    total = ev.agg(F.count(F.lit(1)).alias("_t"))
    counts = ev.groupBy(val.alias("valor")).agg(F.count(F.lit(1)).alias("eventos"))
    out = (counts.crossJoin(F.broadcast(total))
           .select(F.lit(field).alias("campo"), "valor", "eventos",
                   (F.lit(100.0) * F.col("eventos") / F.col("_t")).alias("pct"))
           .orderBy(F.col("eventos").desc(), F.col("valor")))
    return out.limit(n) if n else out


def top_values_of(cap: DataFrame, fields: dict[str, int | None]) -> DataFrame:
    """I4 for many top-level fields at once: campo, valor, eventos, pct, for
    each field its n most common values (None: all), as ``top_values`` gives
    them. Each event is parsed once, and all fields share one shuffle of
    counts. (Text that is no valid JSON counts as missing
    in every field.)"""
    parsed = fence(_events(cap).select(F.from_json("evento", T.StructType(
        [T.StructField(f, T.StringType()) for f in fields])).alias("e")))

    def value(field):
        v = F.col("e.`%s`" % field)
        if field == "bot":
            return F.when(F.lower(F.coalesce(v, F.lit("false"))) == "true", F.lit("bot")).otherwise(F.lit("humano"))
        return F.coalesce(v, F.lit(MISSING.get(field, "(sin %s)" % field)))

    pairs = F.array(*[F.struct(F.lit(f).alias("campo"), value(f).alias("valor")) for f in fields])
    counts = (parsed.select(F.explode(pairs).alias("p")).groupBy("p.campo", "p.valor")
              .agg(F.count(F.lit(1)).alias("eventos")))
    total = _events(cap).agg(F.count(F.lit(1)).alias("_t"))  # parses nothing
    order = Window.partitionBy("campo").orderBy(F.col("eventos").desc(), F.col("valor"))
    most = F.coalesce(*[F.when(F.col("campo") == f, n) for f, n in fields.items() if n], F.lit(2**31 - 1))
    return (counts.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most)
            .crossJoin(F.broadcast(total))
            .select("campo", "valor", "eventos", (F.lit(100.0) * F.col("eventos") / F.col("_t")).alias("pct")))


def duplicate_report(cap: DataFrame) -> DataFrame:
    """Repeated keys and surplus deliveries (sum of counts - keys) for
    ``meta.id`` (non-empty) and for ``(wiki, id)`` with id present."""
    ev = _events(cap)
    meta = F.get_json_object(F.col("evento"), "$.meta.id")
    wid = F.get_json_object(F.col("evento"), "$.id")
    wiki = F.get_json_object(F.col("evento"), "$.wiki")

    def report(name, key_df):
        rep = key_df.groupBy("k").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
        return rep.agg(F.lit(name).alias("clave"), F.count(F.lit(1)).alias("repetidos"),
                       F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("long").alias("entregas_de_mas"))
    a = report("meta.id", ev.select(meta.alias("k")).filter((F.col("k").isNotNull()) & (F.col("k") != "")))
    b = report("(wiki, id)", ev.select(F.struct(wiki.alias("w"), wid.alias("i")).alias("k"))
               .filter(F.col("k.i").isNotNull()))
    return a.unionByName(b)


def _event_times(cap: DataFrame, path: str) -> DataFrame:
    """Event time at ``path``: ISO text (``meta.dt``), or epoch seconds for
    the ``timestamp`` field."""
    raw = F.get_json_object(F.col("evento"), "$." + path)
    if path == "timestamp":
        t = epoch_to_ts(raw.try_cast("long"))
    else:
        t = profile_time(raw)
    return _events(cap).select("recibido", "seq", t.alias("t"))


def disorder(cap: DataFrame, path: str = "meta.dt", exact: bool = True) -> DataFrame:
    """An event is late when its time is behind the running max of all
    earlier arrivals (strictly); lag = that max - its time. Events without
    a valid time are counted apart and do not move the max. The share is
    over all events. The running max is the skew-safe prefix max.
    ``path="timestamp"`` measures the same on the epoch-seconds field."""
    ev = _event_times(cap, path)
    with_t = ev.filter(F.col("t").isNotNull()).select(
        "recibido", "seq", (F.unix_micros("t") / F.lit(1e6)).alias("t"))
    scanned = prefix_max_before(with_t, ["recibido", "seq"], "t", "_max", keep=["t"])
    lags = scanned.select(F.when(F.col("t") < F.col("_max"), F.col("_max") - F.col("t")).alias("lag"))
    counts = ev.agg(F.count(F.lit(1)).alias("_total"),
                    F.count(F.when(F.col("t").isNull(), 1)).alias("sin_tiempo"))
    late = _summary(lags, "lag", exact).withColumnRenamed("valores", "desordenados")
    return (counts.crossJoin(late)
            .select((F.col("_total") - F.col("sin_tiempo")).alias("con_tiempo"), "sin_tiempo",
                    "desordenados",
                    F.when(F.col("_total") > 0, F.lit(100.0) * F.col("desordenados") / F.col("_total"))
                    .otherwise(F.lit(0.0)).alias("pct"),
                    F.col("p50").cast("double").alias("p50"), F.col("p95").cast("double").alias("p95"),
                    F.col("p99").cast("double").alias("p99"), "maximo"))


def arrival_times(cap: DataFrame, path: str = "meta.dt") -> DataFrame:
    """recibido, lat: arrival - event time in s, NULL without a valid time."""
    return _event_times(cap, path).select(
        "recibido", (F.col("recibido") - F.unix_micros("t") / F.lit(1e6)).alias("lat"))


def arrival_latency(cap: DataFrame, path: str = "meta.dt", exact: bool = True) -> DataFrame:
    """Arrival - event time in s (includes clock skew): min, p50, p95,
    p99, max; events without a valid time are counted apart."""
    out = _summary(arrival_times(cap, path), "lat", exact)
    return out.select(F.col("valores").alias("con_tiempo"), F.col("nulos").alias("sin_tiempo"), "minimo", "p50", "p95", "p99",
                      "maximo")


# Variant type name -> JSON type name of the report.
def _json_type(schema_text):
    s = F.upper(schema_text)
    return (F.when(s.startswith("OBJECT"), F.lit("struct"))
            .when(s.startswith("ARRAY"), F.lit("array"))
            .when(s == "VOID", F.lit("null"))
            .when(s == "BOOLEAN", F.lit("bool"))
            .when(s.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("int"))
            .when(s.startswith("DECIMAL") | s.isin("DOUBLE", "FLOAT"), F.lit("double"))
            .when(s == "STRING", F.lit("string"))
            .otherwise(F.lower(s)))


# a field name of a variant's schema text, quoted unless it is plain, and what
# opens or closes inside an array's type
_NAME = re.compile(r"`((?:[^`]|``)*)`|([^:`<>,]+)")
_NESTED = re.compile(r"`(?:[^`]|``)*`|[<>]")
_TYPE = re.compile(r"\w+(\([^)]*\))?")


def shape_paths(shape: str) -> list[tuple[str, str]]:
    """(dotted path, type) of every field in the schema text of an object,
    e.g. ``OBJECT<a: BIGINT, b: OBJECT<c: STRING>>``. Objects are descended,
    arrays are not; another text has no fields."""
    if not shape.startswith("OBJECT<"):
        return []
    out, above, at = [], [""], len("OBJECT<")
    while above:
        if shape[at] == ">":
            above.pop()
            at += 1
        else:
            m = _NAME.match(shape, at)
            path = above[-1] + (m[2] if m[1] is None else m[1].replace("``", "`"))
            kind = _TYPE.match(shape, m.end() + 2)
            out.append((path, kind[0]))
            at = kind.end()
            if kind[0] == "OBJECT":
                above.append(path + ".")
                at += 1
                continue
            if shape.startswith("<", at):
                depth = 0
                for token in _NESTED.finditer(shape, at):
                    depth += {"<": 1, ">": -1}.get(token[0], 0)
                    if not depth:
                        break
                at = token.end()
        if shape.startswith(", ", at):
            at += 2
    return out


def _shaped(cap: DataFrame) -> DataFrame:
    """tipo and forma of each event: its type, and its schema as text (NULL if
    it is no valid JSON). An event is parsed once."""
    v = F.col("v")
    kind = F.when(v.isNull(), F.get_json_object("evento", "$.type")).otherwise(F.try_variant_get(v, "$.type", "string"))
    parsed = fence(_events(cap).select("evento", F.try_parse_json("evento").alias("v")))
    return parsed.select(F.coalesce(kind, F.lit(MISSING["type"])).alias("tipo"), F.schema_of_variant("v").alias("forma"))


def _unfold(shapes: DataFrame) -> DataFrame:
    """A row per path of each row's shape, with the other columns."""
    rest = [f for f in shapes.schema.fields if f.name != "forma"]
    schema = T.StructType([*rest, T.StructField("ruta", T.StringType()), T.StructField("_tipo", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shape_paths(s) if s else [] for s in b.column("forma").to_pylist()]
            row = pa.array([i for i, paths in enumerate(found) for _ in paths], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(f.name).take(row) for f in rest), pa.array([p for paths in found for p, _ in paths], pa.string()),
                 pa.array([t for paths in found for _, t in paths], pa.string())], names=schema.names)

    out = shapes.mapInArrow(run, schema)
    return out.withColumn("tipo_json", _json_type(F.col("_tipo"))).drop("_tipo")


def field_paths(cap: DataFrame) -> DataFrame:
    """One row per (event, dotted path) with the path's JSON type and the
    event's type."""
    return _unfold(_shaped(cap)).select("tipo", "ruta", "tipo_json")


def shape_counts(cap: DataFrame) -> DataFrame:
    """Events per (event type, shape), shape NULL for text that is no valid
    JSON: one pass over the capture, one parse an event. Events of a stream
    have few shapes, so the paths are spelt out per shape, not per event. The
    counts are frozen with a checkpoint, so all schema reports share the pass."""
    ensure_checkpoint_dir(cap.sparkSession)
    return _shaped(cap).groupBy("tipo", "forma").agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)


def path_stats(shapes: DataFrame) -> DataFrame:
    """Events per (event type, path, JSON type), from ``shape_counts``."""
    return _unfold(shapes).groupBy("tipo", "ruta", "tipo_json").agg(F.sum("n").alias("n"))


def schema_profile(cap: DataFrame, shapes: DataFrame | None = None) -> DataFrame:
    """I8: per dotted path: presence (% of events), observed JSON types (most
    common first), a flag when there is more than one, and how many events
    have no paths because their text is no valid JSON (a repeated key is one
    way); they stay in the denominator. ``shapes``: a ``shape_counts`` to share."""
    shapes = shape_counts(cap) if shapes is None else shapes
    total = shapes.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("_t"),
                       F.coalesce(F.sum(F.when(F.col("forma").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("_bad"))
    per_type = path_stats(shapes).groupBy("ruta", "tipo_json").agg(F.sum("n").alias("n"))
    per_path = (per_type.groupBy("ruta")
                .agg(F.sum("n").alias("n"),
                     F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col("tipo_json").alias("t")))).alias("_ts")))
    return (per_path.crossJoin(F.broadcast(total))
            .select("ruta", (F.lit(100.0) * F.col("n") / F.col("_t")).alias("presencia_pct"),
                    F.array_join(F.transform("_ts", lambda x: x["t"]), ", ").alias("tipos"),
                    (F.size("_ts") > 1).alias("mixto"), F.col("_bad").alias("ilegibles"))
            .orderBy("ruta"))


def type_fields(cap: DataFrame, threshold: float = 0.9, shapes: DataFrame | None = None) -> DataFrame:
    """Per event type, fields that are not in every event but are in
    at least ``threshold`` of that type's events. A path occurs at most once
    per event, so summed counts are counts of events."""
    shapes = shape_counts(cap) if shapes is None else shapes
    stats = path_stats(shapes).groupBy("tipo", "ruta").agg(F.sum("n").alias("k"))
    per_type_n = shapes.groupBy("tipo").agg(F.sum("n").cast("long").alias("n"))
    total = per_type_n.agg(F.sum("n").alias("_t"))
    common = (stats.groupBy("ruta").agg(F.sum("k").alias("c"))
              .crossJoin(F.broadcast(total)).filter(F.col("c") == F.col("_t")).select("ruta"))
    per = (stats.join(common, "ruta", "left_anti")
           .join(per_type_n, "tipo")
           .filter(F.col("k") >= F.lit(threshold) * F.col("n"))
           .groupBy("tipo").agg(F.array_join(F.sort_array(F.collect_list("ruta")), ", ").alias("campos")))
    return (per_type_n.join(per, "tipo", "left")
            .select("tipo", "n", F.coalesce(F.col("campos"), F.lit("-")).alias("campos"))
            .orderBy(F.col("n").desc(), F.col("tipo")))


def examples(cap: DataFrame) -> DataFrame:
    """The first event (by arrival) of each type."""
    ev = _events(cap).select(
        F.coalesce(F.get_json_object("evento", "$.type"), F.lit(MISSING["type"])).alias("tipo"),
        "recibido", "seq", "evento")
    return (ev.groupBy("tipo")
            .agg(F.min_by("evento", F.struct("recibido", "seq")).alias("ejemplo")))
