from collections import defaultdict

import time

from pyspark.sql import functions as F

from changeflow.llm import lines
from .conftest import DOC_SCHEMA, EDGE_TEXTS, documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows):
    holders = defaultdict(set)
    for d, t in rows:
        for l in (t or "").split("\n"):
            if len(key(l)) >= 20:
                holders[key(l)].add(d)
    low = lambda d: (d is not None, d or 0)
    out = []
    for d, t in rows:
        ls = (t or "").split("\n")
        kept = [l for l in ls if len(key(l)) < 20 or len(holders[key(l)]) < 3 or max(holders[key(l)], key=low) == d]
        out.append((d, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in lines.dedup_lines(df).collect()), key=str)


A, B = "a shared licence line that repeats", "Ünïcode line of twenty-plus ☂ points"


def test_against_brute_force_with_edge_texts(spark):
    texts = [A + "\nown", "  " + A.upper() + "\t\n" + A, "x\n" + A, B, B + " ", B, "short\n" * 5, A + "\r\n" + B,
             "\n".join(["l%d" % i for i in range(130)] + [A] * 3)] + EDGE_TEXTS
    rows = list(enumerate(texts))
    assert run(documents(spark, texts)) == brute(rows)


def test_repeated_rows_null_ids_and_hot_line(spark):
    rows = [(i % 400, A + "\nown %d" % (i % 400)) for i in range(500)] + [(None, A), (None, A + "\nz"), (7, B), (7, "q\n" + B), (8, B)]
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOC_SCHEMA).repartition(5)
    assert run(df) == brute(rows)


def test_clashing_columns_and_empty_table(spark):
    df = documents(spark, [A, A, A]).withColumn("keep", F.lit(1)).withColumn("kept_text", F.lit("?")).withColumn("t1", F.lit(0))
    df = df.withColumns({c: F.lit(c) for c in ("__id", "__t1", "__keep", "__text", "doc", "KEY", "whole_text")})
    out = lines.dedup_lines(df)
    assert out.first()["__text"] == "__text" and out.first()["KEY"] == "KEY"
    assert {r.doc_id: r.kept_text for r in out.collect()} == {0: "", 1: "", 2: A}
    assert "keep" in out.columns
    assert lines.dedup_lines(df.limit(0)).count() == 0


def test_a_million_lines(spark):
    """Every second line goes: 15,625 mask words, looked up by place."""
    kept = ["own %d" % i for i in range(500_000)]
    text = "\n".join(x for k in kept for x in (k, A))
    df = documents(spark, [text, A, A])
    began = time.time()
    r = next(r for r in lines.dedup_lines(df).collect() if r.doc_id == 0)
    assert time.time() - began < 30
    assert r.n_lines == 1_000_000 and r.n_dropped == 500_000 and r.kept_text == "\n".join(kept)
