"""Dedup that keeps what it turns away.

``dropDuplicatesWithinWatermark`` counts late and repeated rows and drops
them. Here a keyed state of our own decides, and every row goes on with its
verdict: kept rows to silver, late and repeated ones to a quarantine table
with the reason. Nothing vanishes: kept + late + repeated = input.

The state holds the ids that have been seen, in buckets by their hash, so that
a micro-batch calls Python and the state store once per bucket. An id is gone
once the watermark is ``lateness`` past its event; an event-time timer per
bucket removes what no later row of the bucket has removed. Spark itself drops rows
behind a query's watermark before a processor sees them, so the query runs
with a watermark that is ``grace`` behind the newest event, and the verdict
``late`` is ours: at or behind the newest event of the earlier micro-batches
less ``lateness``. Only rows later than ``grace`` are still dropped by Spark
(and counted in the progress).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from changeflow.operators import refine
from changeflow.session import SCALE_CONF, apply_required
from changeflow.streaming import history
from changeflow.streaming.chain import ChainConfig, _state_partitions, raw_stream
from changeflow.streaming.parts import Tables, read_parts, start_parts

LATE, REPEATED = "tardia", "repetida"
DAY_MS = 86_400_000
GRACE_DAYS = 3650
#: ids share a state by hash: a call to Python per bucket and micro-batch, not per id
BUCKETS = 128
IDENT, BUCKET = "identidad", "cubeta"
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


class FirstOfEach(StatefulProcessor):
    """Marks each row of a bucket of ids: first of its id (null), late or repeated."""

    def __init__(self, lateness_ms: int, grace_ms: int, time_col: str, order_col: str, columns: list[str]):
        self.lateness_ms, self.ahead_ms = lateness_ms, grace_ms - lateness_ms
        self.time_col, self.order_col, self.columns = time_col, order_col, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "ids array<string>, expira array<bigint>, reloj bigint")

    def _load(self, mark: int) -> tuple[dict[str, int], int | None, int]:
        """The bucket's ids with their expiry, less those that have expired; the
        timer that is set; how many ids are stored."""
        ids, expires, timer = self.seen.get() or ((), (), None)
        return {i: e for i, e in zip(ids, expires) if e > mark}, timer, len(ids)

    def _store(self, known: dict[str, int], timer: int | None, mark: int) -> None:
        """One timer per bucket, at the last expiry known when it is set."""
        if not known:
            self.seen.clear()
            return
        if timer is None:
            timer = max(max(known.values()), mark + 1)
            self.handle.registerTimer(timer)
        self.seen.update((list(known), list(known.values()), timer))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(rows)).sort_values(self.order_col, kind="stable")
        mark = timerValues.getCurrentWatermarkInMs()
        bound = mark + self.ahead_ms if mark > 0 else None
        # Spark runs the timers of a batch behind its rows: an expired id counts as gone
        known, timer, stored = self._load(mark)
        verdict, first = [], len(known)
        events = rows[self.time_col].to_numpy("datetime64[ns]").astype("int64") // 1_000_000
        for ident, event in zip(rows[IDENT], events.tolist()):
            if bound is not None and event <= bound:
                verdict.append(LATE)
            elif ident in known:
                verdict.append(REPEATED)
            else:
                verdict.append(None)
                known[ident] = event + self.lateness_ms - self.ahead_ms
        if len(known) != first or first != stored:
            # a timer that is due runs behind these rows and sets the next one
            self._store(known, timer, mark)
        yield rows[self.columns].assign(motivo=verdict)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        self._store(self._load(mark)[0], None, mark)
        return iter(())

    def close(self) -> None:
        pass


def with_verdict(df: DataFrame, lateness_s: int = 30, keys=("meta_id",), time_col: str = "ts_evento",
                 order_col: str = "ts_cola", grace_days: int = GRACE_DAYS, buckets: int = BUCKETS) -> DataFrame:
    """All rows of a stream with ``motivo``: null for the first row of an id,
    else why it is turned away. ``buckets`` is part of the state: a checkpoint
    keeps the number it was started with."""
    schema = T.StructType([*df.schema.fields, T.StructField("motivo", T.StringType())])
    processor = FirstOfEach(lateness_s * 1000, grace_days * DAY_MS, time_col, order_col, df.columns)
    ident = F.to_json(F.struct(*(F.col(k).alias(str(n)) for n, k in enumerate(keys))),
                      {"timestampFormat": MICROS + "XXX", "timestampNTZFormat": MICROS})
    return (df.withWatermark(time_col, "%d days" % grace_days)
            .withColumns({IDENT: ident, BUCKET: F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")}).groupBy(BUCKET)
            .transformWithStateInPandas(processor, schema, "append", "eventTime"))


def by_verdict(batch: DataFrame) -> Tables:
    """Silver rows and quarantined rows of a batch."""
    return {"silver": batch.where(F.col("motivo").isNull()).drop("motivo"),
            "quarantine": batch.where(F.col("motivo").isNotNull())}


def folder(cfg: ChainConfig) -> str:
    return "%s/silver_parts" % cfg.warehouse.rstrip("/")


@contextmanager
def _own_state_store(spark: SparkSession) -> Iterator[None]:
    """A keyed state of one's own needs the RocksDB store, whatever the session
    uses; a query keeps the setting it was started with."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, SCALE_CONF[key])
    try:
        yield
    finally:
        spark.conf.set(key, before)


def start_silver_with_quarantine(spark: SparkSession, cfg: ChainConfig, lateness_s: int = 30) -> StreamingQuery:
    """Bronze -> silver and quarantine, both written once per micro-batch."""
    apply_required(spark)
    raw = raw_stream(spark, cfg)
    with _state_partitions(spark, cfg), _own_state_store(spark):
        return start_parts(with_verdict(refine.refine(raw, observe=history.REFINE), lateness_s), by_verdict, folder(cfg), cfg.ckpt("silver_parts"),
                           trigger=cfg.silver_trigger, available_now=cfg.available_now, name=cfg.names.get("silver_parts"))


def read_silver(spark: SparkSession, cfg: ChainConfig) -> DataFrame:
    return read_parts(spark, folder(cfg), cfg.ckpt("silver_parts"), "silver").drop("lote")


def read_quarantine(spark: SparkSession, cfg: ChainConfig) -> DataFrame:
    """The rows turned away, with ``motivo`` and the micro-batch ``lote``."""
    return read_parts(spark, folder(cfg), cfg.ckpt("silver_parts"), "quarantine")
