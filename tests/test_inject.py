"""Fault injection (J1-J3): rates, identity of copies, determinism."""

from pyspark.sql import functions as F

from changeflow.operators import inject
from changeflow.sources import replay

SF = "/root/testdata/sf0.01"


def _changes(spark):
    return replay.change_events(replay.read_events(spark, SF))


def test_late_shift_keeps_arrival(spark):
    ch = _changes(spark)
    late = inject.inject_late(ch, 30.0, 5.0, 60.0, seed=3)
    j = late.alias("l").join(ch.alias("c"), "event_id")
    stats = j.agg(
        F.avg(F.col("l.tardio").cast("int")).alias("share"),
        F.min(F.when(F.col("l.tardio"), F.col("l.retraso_inyectado_ms"))).alias("lo"),
        F.max(F.when(F.col("l.tardio"), F.col("l.retraso_inyectado_ms"))).alias("hi"),
        F.sum((F.col("l.ts_cola") != F.col("c.ts_cola")).cast("int")).alias("moved_arrivals"),
        F.sum(((F.unix_micros("c.ts") - F.unix_micros("l.ts")) != F.col("l.retraso_inyectado_ms") * 1000)
              .cast("int")).alias("wrong_shift")).first()
    assert 0.27 < stats.share < 0.33
    assert 5000 <= stats.lo and stats.hi < 60000
    assert stats.moved_arrivals == 0 and stats.wrong_shift == 0


def test_duplicates_are_identical_and_deterministic(spark):
    ch = _changes(spark)
    d1 = replay.to_envelope(inject.inject_duplicates(ch, 10.0, seed=9))
    d2 = replay.to_envelope(inject.inject_duplicates(ch, 10.0, seed=9))
    n, total = ch.count(), d1.count()
    assert 0.08 * n < total - n < 0.12 * n
    assert d1.exceptAll(d2).count() == 0
    # every surplus row is byte-identical to its original
    per_msg = d1.groupBy("valor", "particion", "desplazamiento", "ts_cola").count()
    assert per_msg.agg(F.sum(F.col("count") - 1)).first()[0] == total - n


def test_synthetic_mix_follows_shares(spark):
    syn = inject.synth_events(_changes(spark), seed=7)
    n = syn.count()
    shares = {r.tipo: r["count"] / n for r in syn.groupBy("tipo").count().collect()}
    assert abs(shares["edit"] - 0.556) < 0.03 and abs(shares["categorize"] - 0.377) < 0.03
    assert abs(syn.agg(F.avg(F.col("es_bot").cast("int"))).first()[0] - 0.41) < 0.03
    assert syn.select("servidor").distinct().count() == 5
    assert syn.filter(~F.col("titulo").startswith("Pagina ")).count() == 0
    assert set(r.comment for r in syn.select("comment").distinct().collect()) == {"evento sintetico s7"}


def test_inject_then_dedup_is_identity_on_ids(spark):
    from changeflow.operators import dedup, refine
    ch = _changes(spark)
    raw = replay.to_envelope(inject.inject_duplicates(inject.inject_late(ch, 20.0, 1.0, 90.0, 5), 15.0, 5))
    silver = dedup.dedup_first(refine.refine(raw, ingest="ingerido_en"))
    ids = silver.select("meta_id")
    want = ch.select(F.col("event_id").cast("string").alias("meta_id"))
    assert ids.count() == want.count()
    assert ids.exceptAll(want).count() == 0 and want.exceptAll(ids).count() == 0
