"""The layer chain as streams: queue -> bronze -> silver -> gold.

One query and one checkpoint per edge, tables in between: each stage can
stop, restart and scale on its own, and a restart resumes from its own
checkpoint (exactly-once through replay plus the sink's commit log).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators import dedup, gold, panes, refine
from changeflow.session import apply_required, stream_checkpoint
from changeflow.sources.queue import stamp_ingest
from changeflow.sources.tables import layer_path, stream_table
from changeflow.streaming import history
from changeflow.streaming.run import append_stream, run_available


@dataclass
class ChainConfig:
    warehouse: str
    checkpoints: str | None = None          # default: <warehouse>/_checkpoints
    lateness: str = dedup.DEFAULT_LATENESS
    bronze_trigger: str = "10 seconds"
    silver_trigger: str = "10 seconds"
    gold_trigger: str = "15 seconds"
    available_now: bool = False
    exact_editors: bool = False
    edit_types: tuple = gold.LIVE_EDIT_TYPES
    max_files_per_trigger: int | None = None
    # Shuffle/state partitions of the stateful queries. Spark fixes them at a
    # query's first start (they are part of its checkpoint), so size them for
    # the target volume up front: state per partition = state / partitions.
    state_partitions: int | None = None
    # One streaming aggregate for P1 and P2 (table gold_counts) instead of
    # two; read them with gold.activity_from_counts / bots_from_counts.
    fold_counts: bool = False
    # P3 as stored panes of editor sketches (table gold_panes) instead of
    # sliding windows of rows; read them with panes.pages_from_panes.
    panes: bool = False
    # A latency state per minute of silver (table silver_latency), from which
    # ``report`` answers without a scan of silver.
    latency_states: bool = False
    names: dict = field(default_factory=dict)
    # "iceberg": layers are tables of the catalog's ``database`` instead of
    # Parquet folders of the warehouse.
    fmt: str = "parquet"
    database: str = "changeflow"

    def ckpt(self, job: str) -> str:
        return stream_checkpoint(job, self.warehouse, self.checkpoints)

    def table(self, layer: str) -> str:
        return layer_path(self.warehouse, layer) if self.fmt == "parquet" else "%s.%s" % (self.database, layer)


def start_bronze(spark: SparkSession, envelope: DataFrame, cfg: ChainConfig) -> StreamingQuery:
    """Raw messages, never interpreted, stamped with the ingest time."""
    apply_required(spark)
    return append_stream(stamp_ingest(envelope), cfg.table("bronze"),
                         cfg.ckpt("bronze"), day_from="ts_cola",
                         trigger=cfg.bronze_trigger, available_now=cfg.available_now,
                         name=cfg.names.get("bronze"), fmt=cfg.fmt)


def raw_stream(spark: SparkSession, cfg: ChainConfig) -> DataFrame:
    """Bronze as a stream. A micro-batch of few files is read by few tasks, so
    its messages are dealt to as many as hold the state before they are parsed;
    by their place in the queue, so redeliveries of one stay in their order."""
    raw = stream_table(spark, cfg.table("bronze"), "bronze", cfg.fmt,
                       max_files_per_trigger=cfg.max_files_per_trigger)
    if cfg.max_files_per_trigger and cfg.state_partitions and cfg.max_files_per_trigger < cfg.state_partitions:
        raw = raw.repartition(cfg.state_partitions, "origen", "particion", "desplazamiento")
    return raw


def silver_frame(spark: SparkSession, cfg: ChainConfig) -> DataFrame:
    raw = raw_stream(spark, cfg)
    typed = refine.refine(raw, observe=history.REFINE)
    return dedup.dedup_stream(dedup.with_lateness(typed, cfg.lateness))


@contextmanager
def _state_partitions(spark: SparkSession, cfg: ChainConfig) -> Iterator[None]:
    """While queries start: a query keeps the setting it was started with."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if cfg.state_partitions:
        spark.conf.set(key, str(cfg.state_partitions))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def start_silver(spark: SparkSession, cfg: ChainConfig) -> StreamingQuery:
    """Typed, deduplicated rows under the event-time watermark."""
    apply_required(spark)
    with _state_partitions(spark, cfg):
        return append_stream(silver_frame(spark, cfg), cfg.table("silver"), cfg.ckpt("silver"), day_from="ts_evento",
                             trigger=cfg.silver_trigger, available_now=cfg.available_now,
                             name=cfg.names.get("silver"), fmt=cfg.fmt)


def gold_frames(spark: SparkSession, cfg: ChainConfig) -> dict[str, DataFrame]:
    def silver_stream():
        s = stream_table(spark, cfg.table("silver"), "silver", cfg.fmt,
                         max_files_per_trigger=cfg.max_files_per_trigger)
        return dedup.with_lateness(s.drop("dia"), cfg.lateness)
    frames = ({"gold_counts": gold.activity_bot_counts(silver_stream())} if cfg.fold_counts else
              {"gold_activity": gold.activity(silver_stream()),
               "gold_bots": gold.bot_counts(silver_stream())})
    if cfg.panes:
        frames["gold_panes"] = panes.page_panes(silver_stream(), edit_types=cfg.edit_types)
    else:
        frames["gold_concurrent"] = gold.concurrent_pages(silver_stream(), exact=cfg.exact_editors,
                                                          edit_types=cfg.edit_types)
    if cfg.latency_states:
        frames["silver_latency"] = panes.latency_panes(silver_stream())
    return frames


def start_gold(spark: SparkSession, cfg: ChainConfig) -> list[StreamingQuery]:
    """Three windowed aggregates, one query each (append: a window is
    written once the watermark passes its end)."""
    apply_required(spark)
    with _state_partitions(spark, cfg):
        return [append_stream(df, cfg.table(name), cfg.ckpt(name), day_from="ventana_inicio",
                              trigger=cfg.gold_trigger, available_now=cfg.available_now,
                              name=cfg.names.get(name), fmt=cfg.fmt)
                for name, df in gold_frames(spark, cfg).items()]


def run_chain_available(spark: SparkSession, envelope: DataFrame, cfg: ChainConfig) -> None:
    """Drain everything available through the chain, stage after stage
    (``availableNow``): the batch form of the continuous chain."""
    cfg = replace(cfg, available_now=True)
    run_available([start_bronze(spark, envelope, cfg)])
    run_available([start_silver(spark, cfg)])
    run_available(start_gold(spark, cfg))


def start_chain(spark: SparkSession, envelope: DataFrame, cfg: ChainConfig) -> list[StreamingQuery]:
    """Start all five continuous queries (pair with ``run_group``)."""
    return [start_bronze(spark, envelope, cfg), start_silver(spark, cfg), *start_gold(spark, cfg)]
