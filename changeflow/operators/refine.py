"""Bronze -> silver: parse, type, filter, time columns.

One specification says where each silver column comes from: its path in the
event, the type it is parsed as, and what is done with the parsed value. The
parse schema, the projection and the filters are all derived from it, so a
column is added in one place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.columns import event_time, ingest_delay
from changeflow.operators.common import fence
from changeflow.schemas import SILVER_COLUMNS

# timestamp_seconds overflows past year 9999; such values become NULL.
_MAX_EPOCH_S = 253402300799


def epoch_to_ts(col: Column) -> Column:
    """Epoch seconds -> timestamp; NULL outside the years that exist. No
    ``abs``: it overflows for the smallest long and would stop the job."""
    return F.when(col.between(-_MAX_EPOCH_S, _MAX_EPOCH_S), F.timestamp_seconds(col))


@dataclass(frozen=True)
class Field:
    path: str
    kind: T.DataType
    use: Callable[[Column], Column] = lambda c: c
    required: bool = False


FIELDS = {
    "meta_id": Field("meta.id", T.StringType(), required=True),
    "ts_evento": Field("meta.dt", T.StringType(), event_time, required=True),
    "tipo": Field("type", T.StringType()),
    "wiki": Field("wiki", T.StringType()),
    "servidor": Field("server_name", T.StringType()),
    "espacio": Field("namespace", T.IntegerType()),
    "titulo": Field("title", T.StringType()),
    "usuario": Field("user", T.StringType()),
    "es_bot": Field("bot", T.BooleanType(), lambda c: F.coalesce(c, F.lit(False))),
    "ts_mediawiki": Field("timestamp", T.LongType(), epoch_to_ts),
}


def parse_schema(fields: dict[str, Field]) -> T.StructType:
    """Schema of the paths alone: what is not read is not parsed."""
    tree: dict = {}
    for f in fields.values():
        *above, leaf = f.path.split(".")
        node = tree
        for step in above:
            node = node.setdefault(step, {})
        node[leaf] = f.kind

    def build(node):
        return T.StructType([T.StructField(k, build(v) if isinstance(v, dict) else v) for k, v in node.items()])
    return build(tree)


EVENT = parse_schema(FIELDS)


CORRUPT = "_corrupt_record"


def parse_event(raw: DataFrame, schema: T.StructType = EVENT, text: str = "valor",
                keep: tuple[str, ...] = ("ts_cola",)) -> DataFrame:
    """JSON text -> struct column ``e`` (permissive: text that is not JSON,
    or a top-level array, gives an all-NULL struct; a wrong-typed field gives
    only that field NULL). The parse sits behind a ``fence`` so that the
    filters on parsed fields do not parse each row again."""
    return fence(raw.select(F.from_json(F.col(text), schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("e"), *keep))


def rejects(rows: DataFrame) -> list[Column]:
    """Counts over parsed rows (``refused_rows``): read, unreadable text, no id,
    no valid event time. A row counts under its first fault only."""
    bad, no_id, no_time = (F.col(c) for c in ("_bad", "_no_id", "_no_time"))

    def count(c):
        return F.count(F.when(c, 1))
    return [F.count(F.lit(1)).alias("leidas"), count(bad).alias("ilegibles"), count(~bad & no_id).alias("sin_id"),
            count(~bad & ~no_id & no_time).alias("sin_hora")]


def _typed(raw: DataFrame, kept: list[str], faults: bool) -> DataFrame:
    """The silver columns of every row, before any is dropped; with ``faults``
    also what is wrong with it."""
    schema = T.StructType([*EVENT.fields, T.StructField(CORRUPT, T.StringType())]) if faults else EVENT
    rows = parse_event(raw, schema, keep=tuple(kept))
    marks = [F.coalesce(F.col("e").isNull() | F.col("e." + CORRUPT).isNotNull(), F.lit(True)).alias("_bad")] if faults else []
    rows = rows.select(*[f.use(F.col("e." + f.path)).alias(name) for name, f in FIELDS.items()], *kept, *marks)
    if faults:
        rows = rows.withColumns({"_no_id": F.col("meta_id").isNull(), "_no_time": F.col("ts_evento").isNull()})
    return rows


def refuse_counts(raw: DataFrame) -> DataFrame:
    """C2, C5 of a batch: one row of the counts of ``rejects``."""
    rows = _typed(raw, ["ts_cola"], True)
    return rows.agg(*rejects(rows))


def refine(raw: DataFrame, ingest: Column | str | None = None, observe: str | None = None) -> DataFrame:
    """Raw envelope rows -> silver rows in table order (13 columns). Rows
    without a required field (an id, a valid event time) are dropped.
    ``ingest`` is the ingest stamp: by default the micro-batch start; a replay
    names its own column. With ``observe`` the dropped rows are counted by
    fault on the way (an observation of that name: no further pass)."""
    kept = ["ts_cola"] + ([ingest] if isinstance(ingest, str) else [])
    stamp = F.current_timestamp() if ingest is None else F.col(ingest) if isinstance(ingest, str) else ingest
    rows = _typed(raw, kept, observe is not None)
    if observe:
        rows = rows.observe(observe, *rejects(rows)).drop("_bad", "_no_id", "_no_time")
    for name, f in FIELDS.items():
        if f.required:
            rows = rows.where(F.col(name).isNotNull())
    rows = rows.withColumn("retraso_s", ingest_delay("ts_cola", "ts_evento")).withColumn("ingerido_en", stamp)
    return rows.select(*SILVER_COLUMNS)
