"""Distributed running max equals the single-task window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from changeflow.operators.ordering import prefix_max_before


def test_prefix_max_matches_window_with_hot_value(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        arrival = 5 if i % 3 == 0 else rnd.randint(0, 200)   # a third of rows share one arrival
        rows.append((arrival, i, float(rnd.randint(0, 10 ** 6)) if i % 17 else None))
    df = spark.createDataFrame(rows, "arrival long, id long, v double")
    w = Window.orderBy("arrival", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("m2", F.max("v").over(w))
    for parts in (7, None):          # explicit count, and AQE-sized ranges
        got = prefix_max_before(df, ["arrival", "id"], "v", "m", partitions=parts)
        j = got.join(want, ["arrival", "id"])
        assert j.count() == 3000
        assert j.filter(~F.col("m").eqNullSafe(F.col("m2"))).count() == 0


def test_exact_quantiles_match_percentile(spark):
    from changeflow.operators.ordering import exact_quantiles
    rnd = random.Random(5)
    rows = [(float(rnd.randint(0, 50)) if i % 3 else rnd.random() * 1e6,) for i in range(5000)]
    rows += [(None,)] * 7
    df = spark.createDataFrame(rows, "x double")
    got = exact_quantiles(df, "x", {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p0": 0.0, "p1": 1.0},
                          partitions=6).first()
    want = df.agg(*[F.percentile("x", F.lit(p)).alias(n) for n, p in
                    [("p50", 0.5), ("p95", 0.95), ("p99", 0.99), ("p0", 0.0), ("p1", 1.0)]]).first()
    for k in ("p50", "p95", "p99", "p0", "p1"):
        assert abs(got[k] - want[k]) <= 1e-9 * max(1.0, abs(want[k]))
    empty = exact_quantiles(df.filter("x < 0"), "x", {"p50": 0.5}).first()
    assert empty.p50 is None


def test_quantiles_of_a_value_that_most_rows_share(spark):
    from changeflow.operators import ordering
    df = spark.range(200_000).select(F.when(F.col("id") % 10 < 9, 7.0).otherwise(F.col("id").cast("double")).alias("x"))
    got = ordering.exact_quantiles(df, "x", {"a": 0.5, "b": 0.95}, partitions=8).first()
    want = df.agg(F.percentile("x", F.lit(0.5)).alias("a"), F.percentile("x", F.lit(0.95)).alias("b")).first()
    assert got.a == want.a == 7.0 and abs(got.b - want.b) < 1e-6
    counts = df.groupBy("x").agg(F.count(F.lit(1)).alias("_n"))
    sizes = [r["count"] for r in ordering._ranged(counts, ["x"], 8).groupBy("_pid").count().collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)
    plan = ordering.exact_quantiles(df, "x", {"a": 0.5}, partitions=8)._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Python" not in plan
