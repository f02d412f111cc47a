"""One read of a stream, several tables: idempotent writes per micro-batch.

A file sink has one table. Here a micro-batch is kept once and written to
several tables, each as the folder ``consulta=<query>/lote=<batch>``, which a
write replaces. (query, batch) is the transaction: Spark runs a batch that did
not finish again with the same rows, so after a kill between two writes the
second run replaces what the first had written, and nothing is there twice or
missing. Readers take the batches that the query's checkpoint has committed,
so they never see a batch that is in one table and not yet in the other.

``start_gold_parts`` writes what a micro-batch of silver adds to the three
gold tables: partial counts for P1 and P2, partial panes of editor sketches
for P3. They are mergeable, so the tables are sums and unions over batches,
late batches included, and need no window state in the stream.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators import gold, panes
from changeflow.session import apply_required
from changeflow.sources import files
from changeflow.sources.tables import stream_table
from changeflow.streaming import history
from changeflow.streaming.chain import ChainConfig

Tables = dict[str, DataFrame]


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that a checkpoint gives its query, None before the first start."""
    text = files.read_text(spark, "%s/metadata" % checkpoint.rstrip("/"))
    return json.loads(text)["id"] if text else None


def committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that the checkpoint holds as finished, -1 without one."""
    found = (re.fullmatch(r"\d+", n) for n in files.names(spark, "%s/commits" % checkpoint.rstrip("/")))
    return max((int(m[0]) for m in found if m), default=-1)


def write_parts(tables: Tables, folder: str, query: str, batch: int,
                after: Callable[[int, str], None] | None = None) -> None:
    """Write each table's part of one batch in place of an earlier try."""
    for name, df in tables.items():
        (df.write.mode("overwrite").option("compression", "zstd")
         .parquet("%s/%s/consulta=%s/lote=%d" % (folder.rstrip("/"), name, query, batch)))
        if after:
            after(batch, name)


def read_parts(spark: SparkSession, folder: str, checkpoint: str, table: str) -> DataFrame:
    """The committed parts of a table, with their batch as ``lote``."""
    query = query_id(spark, checkpoint)
    if query is None:
        raise ValueError("no query has used the checkpoint %s" % checkpoint)
    base = "%s/%s" % (folder.rstrip("/"), table)
    rows = spark.read.option("basePath", base).parquet("%s/consulta=%s" % (base, query))
    return rows.where(F.col("lote") <= committed(spark, checkpoint)).drop("consulta")


def start_parts(stream: DataFrame, split: Callable[[DataFrame], Tables], folder: str, checkpoint: str, *,
                trigger: str | None = "15 seconds", available_now: bool = False, name: str | None = None,
                after: Callable[[int, str], None] | None = None) -> StreamingQuery:
    """Start a query that writes ``split(batch)`` for every micro-batch.
    ``after`` is called with batch and table behind each write. A folder that
    holds the parts of another query is refused: a fresh checkpoint would read
    the stream from its beginning and count its rows once more."""
    spark = stream.sparkSession
    known = query_id(spark, checkpoint)
    if folder_owner(spark, folder) not in (None, known):
        raise RuntimeError("%s holds the parts of another query; use the checkpoint that wrote it, or another folder" % folder)
    history.listen(spark)
    ids: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        if not ids:  # written before the first batch
            ids.append(query_id(own, checkpoint))
        batch = batch.persist()  # one read of the stream for all tables
        try:
            write_parts(split(batch), folder, ids[0], batch_id, after)
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger) if trigger else w
    query = (w.queryName(name) if name else w).start()
    history.follow(spark, query, checkpoint)
    return query


def folder_owner(spark: SparkSession, folder: str) -> str | None:
    """The query whose parts a folder holds."""
    for table in files.names(spark, folder):
        for name in files.names(spark, "%s/%s" % (folder.rstrip("/"), table)):
            if name.startswith("consulta="):
                return name.removeprefix("consulta=")
    return None


def gold_parts(batch: DataFrame, edit_types=gold.LIVE_EDIT_TYPES) -> Tables:
    """What a set of silver rows adds to P1, P2 and P3."""
    return {"gold_activity": gold.activity(batch), "gold_bots": gold.bot_counts(batch),
            "gold_panes": panes.page_panes(batch, edit_types=edit_types)}


def parts_folder(cfg: ChainConfig) -> str:
    return "%s/gold_parts" % cfg.warehouse.rstrip("/")


def start_gold_parts(spark: SparkSession, cfg: ChainConfig,
                     after: Callable[[int, str], None] | None = None) -> StreamingQuery:
    """Silver -> three gold tables of mergeable parts, silver read once."""
    apply_required(spark)
    silver = stream_table(spark, cfg.table("silver"), "silver", cfg.fmt, max_files_per_trigger=cfg.max_files_per_trigger)
    return start_parts(silver.drop("dia"), lambda batch: gold_parts(batch, cfg.edit_types), parts_folder(cfg),
                       cfg.ckpt("gold_parts"), trigger=cfg.gold_trigger, available_now=cfg.available_now,
                       name=cfg.names.get("gold_parts"), after=after)


def gold_from_parts(spark: SparkSession, cfg: ChainConfig) -> Tables:
    """The gold tables as sums and unions of the committed parts."""
    def part(table):
        return read_parts(spark, parts_folder(cfg), cfg.ckpt("gold_parts"), table)

    counts = F.sum("eventos").cast("long").alias("eventos")
    window = ("ventana_inicio", "ventana_fin")
    return {"gold_activity": part("gold_activity").groupBy(*window, "servidor", "espacio").agg(counts),
            "gold_bots": part("gold_bots").groupBy(*window, "es_bot").agg(counts),
            "gold_concurrent": panes.pages_from_panes(part("gold_panes"))}
