"""Exact top-k by inner product against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import products
from changeflow.llm.queries import op12_products

SF = "/root/testdata/sf0.01"


def brute(rows, asked, k, scale=1024.0):
    best = {}
    whole = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) and abs(x) * scale < products.LIMIT for x in v):
            whole.setdefault(i, []).append([math.floor(scale * x) for x in v])
    for q, vs in whole.items():
        if not asked(q):
            continue
        score = {}
        for a in vs:
            for i, ws in whole.items():
                for w in ws:
                    if i != q and len(w) == len(a):
                        s = sum(x * y for x, y in zip(a, w))
                        score[i] = max(score.get(i, s), s)
        best[q] = sorted(score.items(), key=lambda e: (-e[1], e[0]))[:k]
    return [(q, rank, i, s) for q in sorted(best) for rank, (i, s) in enumerate(best[q], 1)]


def result(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("block,pilot", [(8192, 2048), (37, 16), (64, 1)])
def test_equals_brute_force(spark, block, pilot):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]  # a very common vector
    rows += [(i, [0.0] * 6) for i in range(400, 405)] + [(5, rng.normal(size=6).tolist())]  # zeros, a repeated id
    df = frame(spark, [(i, v, 0) for i, v in rows])
    got = products.top_products(df, df.where("vec_id % 20 = 0"), k=7, block=block, pilot=pilot)
    assert result(got) == brute(rows, lambda i: i % 20 == 0, 7)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0, 2.0]),
            (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [1e300, 0.0]), (9, [-0.0001, 0.5]), (10, [0.0, 0.0]), (20, [-3.0, 1.0])]
    df = frame(spark, [(i, v, 0) for i, v in rows]).withColumnsRenamed({"label": "role"}).withColumn("floor", F.lit(3))
    assert result(products.top_products(df, df.where("vec_id % 10 = 0"), k=3)) == brute(rows, lambda i: i % 10 == 0, 3)
    assert products.top_products(df.limit(0), df.limit(0)).collect() == []
    assert products.top_products(df, df.limit(0)).collect() == []


def test_stops_before_the_end_of_the_lists():
    """Where a few vectors stand out, a descent reads only the heads of the
    lists, and the bound never cuts a result off."""
    rng = np.random.default_rng(1)
    vecs = rng.integers(-50, 50, (4000, 8))
    vecs[:30] = rng.integers(400, 500, (30, 8))
    index = products.ThresholdIndex(np.arange(4000), vecs, 5)
    query = rng.integers(1, 50, 8)
    ids, scores, depth = index.search(query, -1, 5, index.bounds(query[None])[0], products._NONE)
    every = vecs @ query
    order = np.lexsort((np.arange(4000), -every))[:5]
    assert ids.tolist() == order.tolist() and scores.tolist() == every[order].tolist()
    assert depth <= 4000 // 8


def test_large_components_stay_exact():
    vecs = np.array([[products.LIMIT - 1, 3], [products.LIMIT - 1, 4], [-5, products.LIMIT - 1]])
    index = products.ThresholdIndex(np.arange(3), np.tile(vecs, (1, 80)), 3)
    assert index.kind is np.int64
    query = np.tile(np.array([products.LIMIT - 1, 1]), 80)
    ids, scores, _ = index.search(query, -1, 3, index.bounds(query[None])[0], products._NONE)
    assert scores.tolist() == [80 * (vecs[i].astype(object) @ query[:2].astype(object)) for i in ids.tolist()]


def test_whole_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(SF + "/embeddings.parquet").collect()]
    assert result(op12_products(spark, SF)) == brute(rows, lambda i: i % 100 == 0, 10)
