"""A lasting record of every micro-batch.

Spark keeps the last 100 progress reports on the driver and purges old commit
files, so neither is a history. Here a listener writes one small JSON file per
finished batch into ``<checkpoint>/history``. The file is named after the
batch, so a batch that runs again after a restart replaces its own record.
Every ``ROLL`` batches the small files become one, so a query that runs for
years leaves a file per ``ROLL`` batches; of two records of a batch (a run that
was stopped between writing and removing, a batch that ran again) the later
one counts.
"""

from __future__ import annotations

import atexit
import json
import re
import threading
from collections import deque

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from changeflow.sources import files

RECORD = ("batch_id long, run_id string, started string, duration_ms long, input_rows long, input_rate double, "
          "process_rate double, late_drops long, duplicate_drops long, state_rows long, watermark string, "
          "next_watermark_ms long, committed_ms long, read_rows long, unreadable long, without_id long, without_time long")
#: the observation of the refine step, and its counts as columns of the record
REFINE = "refine"
_COUNTS = {"read_rows": "leidas", "unreadable": "ilegibles", "without_id": "sin_id", "without_time": "sin_hora"}

#: reports kept for a query whose checkpoint is not known yet, of so many
#: queries; ``append_stream`` names it right after the start
EARLY_REPORTS, EARLY_QUERIES = 100, 50
#: batches whose records share a file
ROLL = 500
_BATCH_FILE = re.compile(r"[0-9]{20}\.json")

_lock = threading.RLock()
_folders: dict[str, str] = {}
_waiting: dict[str, deque] = {}
#: per query the run and its last batch on record: batches of a run come in order
_written: dict[str, tuple[str, int]] = {}


def folder(checkpoint: str) -> str:
    return "%s/history" % checkpoint.rstrip("/")


def _number(x, key, default=0):
    return type(default)(x.get(key) or default)


def _record(spark: SparkSession, checkpoint: str, p) -> dict:
    ops = p.get("stateOperators") or []
    ops = [o if isinstance(o, dict) else json.loads(o.json) for o in ops]
    committed = "%s/commits/%d" % (checkpoint, p.get("batchId"))
    commit = files.read_text(spark, committed)
    mark = json.loads(commit.split("\n")[1]).get("nextBatchWatermarkMs") if commit else None
    seen = (p.get("observedMetrics") or {}).get(REFINE) or {}
    seen = seen if isinstance(seen, dict) else seen.asDict()
    return {
        **{name: seen.get(count) for name, count in _COUNTS.items()},
        "batch_id": p.get("batchId"), "run_id": str(p.get("runId")), "started": p.get("timestamp"),
        "duration_ms": _number(p.get("durationMs") or {}, "triggerExecution"),
        "input_rows": _number(p, "numInputRows"), "input_rate": _number(p, "inputRowsPerSecond", 0.0),
        "process_rate": _number(p, "processedRowsPerSecond", 0.0),
        "late_drops": sum(_number(o, "numRowsDroppedByWatermark") for o in ops),
        "duplicate_drops": sum(_number(o.get("customMetrics") or {}, "numDroppedDuplicateRows") for o in ops),
        "state_rows": sum(_number(o, "numRowsTotal") for o in ops),
        "watermark": (p.get("eventTime") or {}).get("watermark"), "next_watermark_ms": mark,
        "committed_ms": files.modified_ms(spark, committed)}


def roll(spark: SparkSession, checkpoint: str, below: int) -> None:
    """Put the records of the batches before ``below`` that have a file each
    into one file per ``ROLL``, then remove theirs."""
    single = [n for n in files.names(spark, folder(checkpoint)) if _BATCH_FILE.fullmatch(n) and int(n[:20]) < below]
    for lo in range(0, len(single), ROLL):
        some = single[lo:lo + ROLL]
        part = ["%s/%s" % (folder(checkpoint), n) for n in some]
        lines = [text.strip() for text in (files.read_text(spark, f) for f in part) if text]
        files.write_text(spark, "%s/to-%s" % (folder(checkpoint), some[-1]), "\n".join(lines) + "\n")
        files.remove(spark, part)


def _take(spark: SparkSession, p) -> None:
    """Write a report, or keep it until its query's checkpoint is known."""
    key = str(p.get("id"))
    with _lock:
        if key not in _folders:
            _waiting.setdefault(key, deque(maxlen=EARLY_REPORTS)).append(p)
            while len(_waiting) > EARLY_QUERIES:  # queries that nobody follows
                _waiting.pop(next(iter(_waiting)))
            return
        run, batch = str(p.get("runId")), p.get("batchId")
        if key in _written and _written[key][0] == run and batch <= _written[key][1]:
            return
        checkpoint = _folders[key]
        files.write_text(spark, "%s/%020d.json" % (folder(checkpoint), p.get("batchId")),
                         json.dumps(_record(spark, checkpoint, p)))
        _written[key] = (run, batch)
        if batch and batch % ROLL == 0:
            roll(spark, checkpoint, batch)


class _Listener(StreamingQueryListener):
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        _take(self.spark, json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


_listening: set[str] = set()


def listen(spark: SparkSession) -> None:
    """Add the listener, once per application; it is removed when Python ends,
    so that Spark does not call a process that is gone."""
    app = spark.sparkContext.applicationId
    with _lock:
        if app not in _listening:
            listener = _Listener(spark)
            spark.streams.addListener(listener)
            _listening.add(app)
            atexit.register(_unlisten, spark, listener)


def _unlisten(spark: SparkSession, listener: StreamingQueryListener) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            spark.streams.removeListener(listener)
    except (Py4JError, OSError):  # the session has ended before
        pass


def follow(spark: SparkSession, query: StreamingQuery, checkpoint: str) -> None:
    """From now on the query's batches are recorded under its checkpoint."""
    key = str(query.id)
    with _lock:
        _folders[key] = checkpoint.rstrip("/")
        early = _waiting.pop(key, [])
    for p in early:
        _take(spark, p)


def settle(spark: SparkSession, query: StreamingQuery) -> None:
    """Record what Spark still holds of the query, so that a query that has
    ended is complete even if the listener is behind."""
    for p in query.recentProgress:
        _take(spark, p if isinstance(p, dict) and "batchId" in p else json.loads(p.json))


def read(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """All recorded batches, None if there is no record."""
    if not files.names(spark, folder(checkpoint)):
        return None
    rows = spark.read.schema(RECORD).json(folder(checkpoint)).where(F.col("batch_id").isNotNull())
    newest = F.max(F.struct("started", *(c for c in rows.columns if c != "started")))
    return rows.groupBy("batch_id").agg(newest.alias("r")).select(*("r." + c for c in rows.columns))


def of_query(query: StreamingQuery) -> str | None:
    return _folders.get(str(query.id))
