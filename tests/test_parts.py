"""Several tables per micro-batch, quarantine, counted faults."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from changeflow.operators import gold, refine
from changeflow.schemas import BRONZE, SILVER
from changeflow.sources.tables import layer_path
from changeflow.streaming import history, parts, quarantine
from changeflow.streaming.chain import ChainConfig, raw_stream
from changeflow.streaming.run import run_available

T0 = dt.datetime(2026, 1, 1, 10, 0)


def _set(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def _silver(spark, n=300):
    rows = [("id%d" % i, T0 + dt.timedelta(seconds=i), "edit", "w", "s%d" % (i % 2), i % 3, "P%d" % (i % 4), "u%d" % (i % 5),
             i % 7 == 0, None, T0, 0.0, T0) for i in range(n)]
    return spark.createDataFrame(rows, SILVER)


def _write_layer(df, warehouse, layer, day, files):
    for lo in range(files):
        (df.where(F.pmod(F.xxhash64(*df.columns[:1]), F.lit(files)) == lo).coalesce(1).withColumn("dia", F.to_date(day))
         .write.mode("append").partitionBy("dia").parquet(layer_path(warehouse, layer)))


@pytest.mark.parametrize("table", ["gold_activity", "gold_bots", "gold_panes"])
def test_a_kill_between_two_writes_leaves_no_copy_and_no_gap(spark, scratch, table):
    s = _silver(spark)
    _write_layer(s, scratch, "silver", "ts_evento", 4)
    cfg = ChainConfig(warehouse=scratch, available_now=True, max_files_per_trigger=1)
    died = []

    def die(batch, name):
        if batch == 2 and name == table and not died:
            died.append(batch)
            raise RuntimeError("killed")

    with pytest.raises(StreamingQueryException):
        parts.start_gold_parts(spark, cfg, after=die).awaitTermination()
    # the batch that died is in some tables only, and in no reader's view
    assert parts.committed(spark, cfg.ckpt("gold_parts")) == 1
    for name in ("gold_activity", "gold_bots", "gold_panes"):
        seen = parts.read_parts(spark, parts.parts_folder(cfg), cfg.ckpt("gold_parts"), name)
        assert {r.lote for r in seen.select("lote").distinct().collect()} <= {0, 1}
    run_available([parts.start_gold_parts(spark, cfg)])
    found = parts.gold_from_parts(spark, cfg)
    assert _set(found["gold_activity"]) == _set(gold.activity(s))
    assert _set(found["gold_bots"]) == _set(gold.bot_counts(s))
    assert _set(found["gold_concurrent"]) == _set(gold.concurrent_pages(s, exact=True))
    # nothing new: nothing changes
    run_available([parts.start_gold_parts(spark, cfg)])
    assert _set(parts.gold_from_parts(spark, cfg)["gold_activity"]) == _set(gold.activity(s))


def test_parts_of_another_query_are_refused(spark, scratch):
    _write_layer(_silver(spark, 20), scratch, "silver", "ts_evento", 1)
    cfg = ChainConfig(warehouse=scratch, available_now=True)
    run_available([parts.start_gold_parts(spark, cfg)])
    other = ChainConfig(warehouse=scratch, checkpoints=scratch + "/other", available_now=True)
    with pytest.raises(RuntimeError, match="another query"):
        parts.start_gold_parts(spark, other)
    with pytest.raises(ValueError):
        parts.read_parts(spark, parts.parts_folder(cfg), scratch + "/none", "gold_bots")


def _message(i, event_s, queue_s):
    at = (T0 + dt.timedelta(seconds=event_s)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    return ("k", '{"meta":{"id":"%s","dt":"%s"}}' % (i, at), "o", "0", str(queue_s), T0 + dt.timedelta(seconds=queue_s), T0)


def test_quarantine_keeps_what_it_turns_away(spark, scratch):
    batches = [[_message("a", 0, 1), _message("a", 0, 2), _message("b", 100, 3)],
               # 71 s is 29 s behind the newest event, 70 s is at the bound
               [_message("c", 71, 4), _message("d", 70, 5), _message("b", 100, 6), _message("b", 100, 7)],
               # the state of a has expired: late, not repeated; e is new and again at once
               [_message("a", 0, 8), _message("e", 130, 10), _message("e", 130, 9)],
               [_message("f", 500, 11)],
               # b's state has expired: the id comes again with a newer event
               [_message("b", 490, 12), _message("b", 480, 13)]]
    cfg = ChainConfig(warehouse=scratch, available_now=True, max_files_per_trigger=1, state_partitions=2)
    for rows in batches:
        (spark.createDataFrame(rows, BRONZE).coalesce(1).withColumn("dia", F.to_date("ts_cola"))
         .write.mode("append").partitionBy("dia").parquet(layer_path(scratch, "bronze")))
    run_available([quarantine.start_silver_with_quarantine(spark, cfg)])
    kept = sorted((r.meta_id, r.ts_cola.second) for r in quarantine.read_silver(spark, cfg).collect())
    away = sorted((r.motivo, r.meta_id, r.ts_cola.second) for r in quarantine.read_quarantine(spark, cfg).collect())
    assert kept == [("a", 1), ("b", 3), ("b", 12), ("c", 4), ("e", 9), ("f", 11)]
    assert away == [("repetida", "a", 2), ("repetida", "b", 6), ("repetida", "b", 7), ("repetida", "b", 13),
                    ("repetida", "e", 10), ("tardia", "a", 8), ("tardia", "d", 5)]


class _Bucket:
    """A handle and a value state that count their calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)


class _Mark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_quarantine_asks_its_state_once_per_bucket():
    processor, bucket = quarantine.FirstOfEach(30_000, quarantine.DAY_MS, "at", "queued", ["id", "at", "queued"]), _Bucket()
    processor.init(bucket)
    at = pd.Timestamp(T0.replace(tzinfo=None))
    rows = pd.DataFrame({"id": range(1000), "at": at, "queued": 1, quarantine.IDENT: [str(i) for i in range(1000)]})
    found = pd.concat(processor.handleInputRows((0,), iter([rows, rows.head(10)]), _Mark(0)))
    assert list(found.columns) == ["id", "at", "queued", "motivo"]
    assert (found.motivo.isna().sum(), (found.motivo == quarantine.REPEATED).sum()) == (1000, 10)
    # a thousand ids: the state read and written once, one timer
    assert bucket.calls == 3 and len(bucket.value[0]) == 1000 and len(bucket.timers) == 1
    # before the ids expire they are known, behind that the timer removes them
    mark = bucket.timers[0]
    again = pd.concat(processor.handleInputRows((0,), iter([rows.head(1).assign(at=at + pd.Timedelta(minutes=2))]), _Mark(mark - 1)))
    assert list(again.motivo) == [quarantine.REPEATED] and bucket.calls == 4
    assert list(processor.handleExpiredTimer((0,), _Mark(mark), None)) == [] and bucket.value is None


def test_few_files_are_dealt_out_before_they_are_parsed(spark, scratch):
    rows = [_message(str(i), i % 20, i % 50) for i in range(400)]
    (spark.createDataFrame(rows, BRONZE).coalesce(1).withColumn("dia", F.to_date("ts_cola"))
     .write.partitionBy("dia").parquet(layer_path(scratch, "bronze")))
    seen = {}

    def run(job, **limits):
        cfg = ChainConfig(warehouse=scratch, state_partitions=4, **limits)

        def note(batch, _):
            seen[job] = batch.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()

        run_available([raw_stream(spark, cfg).writeStream.foreachBatch(note).trigger(availableNow=True)
                       .option("checkpointLocation", "%s/%s" % (scratch, job)).start()])

    run("few", max_files_per_trigger=1)
    run("all")
    assert len(seen["few"]) > 1 and sum(r["count"] for r in seen["few"]) == 400
    assert len(seen["all"]) == 1  # as many tasks as files need


def test_faults_are_counted_once_each(spark):
    good = '{"meta":{"id":"1","dt":"2024-01-01T00:00:00.000Z"}}'
    values = [good, None, "", "nope", "[]", '{"meta":{"id":"1"', "{}", '{"meta":{"dt":"2024-01-01T00:00:00.000Z"}}',
              '{"meta":{"id":"2","dt":"soon"}}', '{"meta":{"id":"3"}}', good.replace('"1"', "7")]
    raw = spark.createDataFrame([(v, T0) for v in values], "valor string, ts_cola timestamp")
    r = refine.refuse_counts(raw).first()
    assert r.leidas == len(values) == r.ilegibles + r.sin_id + r.sin_hora + refine.refine(raw).count()
    assert (r.sin_hora, refine.refine(raw).count()) == (2, 2)
    assert _set(refine.refine(raw, observe="x").drop("ingerido_en")) == _set(refine.refine(raw).drop("ingerido_en"))


def test_reports_of_unknown_queries_do_not_pile_up(spark):
    before = dict(history._waiting)
    for q in range(3 * history.EARLY_QUERIES):
        for b in range(2 * history.EARLY_REPORTS):
            history._take(spark, {"id": "unknown%d" % q, "runId": "r", "batchId": b})
    assert len(history._waiting) <= history.EARLY_QUERIES
    assert all(len(v) <= history.EARLY_REPORTS for v in history._waiting.values())
    history._waiting.clear()
    history._waiting.update(before)
