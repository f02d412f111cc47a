"""Gold windows (E1-E4): window edges and properties."""

import datetime as dt

from pyspark.sql import functions as F

from changeflow.operators import gold
from changeflow.schemas import SILVER


def _silver(spark, rows):
    full = []
    for i, (ts, user, bot, kind, title) in enumerate(rows):
        full.append(("id%d" % i, ts, kind, "enwiki", "en", 0, title, user, bot, None, ts, 0.0, ts))
    return spark.createDataFrame(full, SILVER)


T0 = dt.datetime(2026, 1, 1, 10, 0, 59)
T1 = dt.datetime(2026, 1, 1, 10, 1, 1)


def test_two_editors_across_a_minute_edge(spark):
    s = _silver(spark, [(T0, "ann", False, "edit", "P"), (T1, "bob", False, "edit", "P")])
    assert gold.concurrent_pages(s, width="1 minute", slide="1 minute", exact=True).count() == 0
    p3 = gold.concurrent_pages(s, exact=True).collect()
    # windows starting 09:57 .. 10:00 hold both rows
    assert sorted(r.ventana_inicio.minute for r in p3) == [0, 57, 58, 59]
    assert all(r.editores == 2 and r.ediciones == 2 for r in p3)


def test_not_concurrent_cases(spark):
    cases = [
        [(T0, "ann", False, "edit", "P"), (T1, "ann", False, "edit", "P")],       # same user
        [(T0, "b1", True, "edit", "P"), (T1, "b2", True, "edit", "P")],           # two bots
        [(T0, "ann", False, "edit", "P"), (T1, "b2", True, "edit", "P")],         # human + bot
        [(T0, "ann", False, "categorize", "P"), (T1, "bob", False, "categorize", "P")],
    ]
    for rows in cases:
        assert gold.concurrent_pages(_silver(spark, rows), exact=True).count() == 0
        assert gold.concurrent_pages(_silver(spark, rows)).count() == 0


def test_row_on_window_start_belongs_to_it(spark):
    s = _silver(spark, [(dt.datetime(2026, 1, 1, 10, 1, 0), "ann", False, "edit", "P")])
    r = gold.activity(s).first()
    assert r.ventana_inicio == dt.datetime(2026, 1, 1, 10, 1) and r.eventos == 1


def test_p1_and_p2_totals_agree(spark):
    from changeflow.plans.registry import silver
    s = silver(spark, "/root/testdata/sf0.001")
    p1 = gold.activity(s).groupBy("ventana_inicio").agg(F.sum("eventos").alias("a"))
    p2 = gold.bot_counts(s).groupBy("ventana_inicio").agg(F.sum("eventos").alias("b"))
    assert p1.join(p2, "ventana_inicio", "full").filter("a <> b or a is null or b is null").count() == 0


def test_each_edit_in_five_sliding_windows(spark):
    from changeflow.plans.registry import silver
    s = silver(spark, "/root/testdata/sf0.001")
    humans = s.filter(~F.col("es_bot")).filter(F.col("tipo").isin("click", "view", "purchase"))
    p3 = gold.concurrent_pages(s, min_editors=1, exact=True, edit_types=("click", "view", "purchase"))
    assert p3.agg(F.sum("ediciones")).first()[0] == 5 * humans.count()


def test_approx_close_to_exact(spark):
    from changeflow.plans.registry import silver
    s = silver(spark, "/root/testdata/sf0.01")
    kw = dict(min_editors=1, edit_types=("click", "view", "purchase"), width="1 day", slide="1 day")
    e = gold.concurrent_pages(s, exact=True, **kw).select("ventana_inicio", "wiki", "titulo", F.col("editores").alias("e"))
    a = gold.concurrent_pages(s, exact=False, **kw).select("ventana_inicio", "wiki", "titulo", F.col("editores").alias("a"))
    j = e.join(a, ["ventana_inicio", "wiki", "titulo"])
    assert j.count() > 1000
    off = j.filter(F.abs(F.col("a") - F.col("e")) > F.greatest(F.lit(1.0), F.lit(3 * 0.05) * F.col("e")))
    assert off.count() == 0


def test_folded_counts_give_p1_and_p2(spark):
    from changeflow.plans.registry import silver
    s = silver(spark, "/root/testdata/sf0.01")
    counts = gold.activity_bot_counts(s)
    p1, p2 = gold.activity(s), gold.bot_counts(s)
    f1, f2 = gold.activity_from_counts(counts), gold.bots_from_counts(counts)
    assert p1.exceptAll(f1).count() == 0 and f1.exceptAll(p1).count() == 0
    assert p2.exceptAll(f2).count() == 0 and f2.exceptAll(p2).count() == 0
