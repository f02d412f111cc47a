"""Periodic runs against a scan of every period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import periodic
from changeflow.llm.queries import op13_periodic
from .conftest import EDGE_TEXTS, documents

SF = "/root/testdata/sf0.001"


def brute(words, least=24, times=3):
    """(start, length, period) of every run, by start and period."""
    smallest = {}
    for p in range(1, len(words) // times + 1):
        i = 0
        while i < len(words) - p:
            j = i
            while j < len(words) - p and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p):
                smallest.setdefault((i, j + p), p)
            i = max(i + 1, j)
    return sorted(((s, e - s, p) for (s, e), p in smallest.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def word_lists(seed, n):
    rnd = random.Random(seed)
    for _ in range(n):
        words = [str(rnd.randrange(rnd.choice([1, 2, 3, 30]))) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            unit = [str(rnd.randrange(rnd.choice([2, 40]))) for _ in range(rnd.randint(1, 15))]
            words += (unit * 20)[:rnd.randint(1, len(unit) * 8)]
            words += [str(rnd.randrange(40)) for _ in range(rnd.choice([0, 5]))]
        yield words


@pytest.mark.parametrize("least", [3, 24])
def test_runs_equal_brute_force(least):
    for seed in range(40):
        lists = list(word_lists(seed, 5))
        got = periodic._analysed([[w.encode() for w in words] for words in lists], least, 3)
        for words, (runs, text) in zip(lists, got):
            expected = brute(words, least)
            assert [tuple(r) for r in runs.tolist()] == expected
            assert text.decode() == " ".join(collapsed(words, expected))


def test_grammar_lce_equals_comparison():
    rng = np.random.default_rng(2)
    for kinds in (1, 2, 3, 50):
        text = np.concatenate([[0], 2 + rng.integers(0, kinds, 300), 2 + np.tile(rng.integers(0, kinds, 9), 30), [1]])
        grammar = periodic.Grammar(text, 2)
        x, y = np.sort(rng.integers(1, len(text) - 1, (2, 400)), axis=0)
        x, y = x[x < y], y[x < y]
        for step in (1, -1):
            for a, b, n in zip(x.tolist(), y.tolist(), grammar.lce(x, y, step).tolist()):
                m = 0
                while text[a + step * m] == text[b + step * m]:
                    m += 1
                assert n == m


def test_equal_words_of_neighbouring_texts_make_no_run():
    got = periodic._analysed([[b"a"] * 20, [b"a"] * 20, [], [b"b", b"a"] * 12], 24, 3)
    assert [r.tolist() for r, _ in got] == [[], [], [], [[0, 24, 2]]]


def test_edges(spark):
    docs = documents(spark, EDGE_TEXTS)
    docs = docs.withColumn("runs", F.lit(1)).withColumn("start", F.lit(2)).withColumn("best", F.lit(3))
    rows = {r.doc_id: r for r in periodic.periodic_runs(docs).collect()}
    for i, text in enumerate(EDGE_TEXTS):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        runs = brute(words) if len(words) < 1000 else [(0, len(words), 1)]
        assert [tuple(r) for r in rows[i].runs] == runs and rows[i].n_words == len(words)
        assert rows[i].collapsed == " ".join(collapsed(words, runs))
        assert rows[i].start == 2 and rows[i].best == 3
    assert periodic.periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, times=2)


def test_whole_query(spark):
    got = {r.doc_id: r for r in op13_periodic(spark, SF).collect()}
    seen = 0
    for doc in spark.read.parquet(SF + "/documents.parquet").collect():
        words = re.findall("[^\x20\x09-\x0d]+", doc.text or "")
        h = zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs, r = brute(words), got.pop(doc.doc_id)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        seen += len(runs)
        expected = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *expected)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(collapsed(words, runs)).encode()).hexdigest()
    assert not got and seen > 5
