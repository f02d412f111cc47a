"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

import pytest

from changeflow.llm import phrases
from .conftest import DOC_SCHEMA, EDGE_TEXTS, documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top, share=100, depth=5):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, depth + 1):
                f.update((lang, tuple(words[i:i + size])) for i in range(len(words) - size + 1))
    found = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    out = []
    for (lang, words), a in found.items():
        if any(100 * b >= share * a and other == lang and len(long) > len(words)
               and any(long[i:i + len(words)] == words for i in range(len(long)))
               for (other, long), b in found.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]])
                for k in range(1, len(words))]
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(words), a, left, right, n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    rank, ranked = Counter(), []
    for lang, *rest in out:
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], *rest))
    return ranked


def texts(seed, n=60):
    rnd = random.Random(seed)
    word = [*"abcdefg", "É", "x\x01y", "-", "Z'"]
    weights = [9, 7, 5, 3, 2, 1, 1, 1, 1, 1, 1]
    for _ in range(n):
        out = []
        for _ in range(rnd.randint(0, 40)):
            out += rnd.choices(word, weights, k=rnd.randint(1, 6))
            out.append(rnd.choice(["", ".", ",", "\n", "\t", "  ", "?!", "New York City", "one two a one two b"]))
        yield rnd.choice(["en", "en", "en", "fr", None, "und"]), " ".join(out)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


# a small budget extends frequent prefixes, so their nodes are summed over groups
@pytest.mark.parametrize("budget", [phrases.BUDGET, 64])
def test_equals_counting(spark, budget):
    rows = list(texts(1))
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string").repartition(4)
    counts = phrases.phrase_counts(docs, min_count=12, budget=budget)
    known = {(r.lang, r.phrase, r.size): r.n for r in counts.where("size > 0").collect()}
    f = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text.translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for size in range(1, 6):
                f.update((lang or "und", " ".join(words[i:i + size]), size) for i in range(len(words) - size + 1))
    assert known == {k: n for k, n in f.items() if n >= 12}
    assert any(size == 5 for _, _, size in known)
    assert result(phrases.collocations(docs, min_count=12, top=30, budget=budget)) == brute(rows, 12, 30)


def test_share(spark):
    rows = list(texts(2, 40))
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    assert result(phrases.collocations(docs, min_count=9, share=60, top=1000)) == brute(rows, 9, 1000, 60)


def test_leaves_of_a_chunk():
    """Distinct suffixes with their totals, in bundles and back."""
    import numpy as np
    words, bits = b"a b c a b. c a b c a".split(), b"\xff" * (phrases.WORD_BITS // 8)
    every = np.full(phrases.PAIR_BITS // 8, 255, np.uint8)
    for n_groups in (1, 7):
        chunk = phrases._Chunk(bits)
        chunk.add("en", b" ".join(words))
        chunk.add("fr", b"a b")
        found = phrases._leaves(*chunk.take(), every, every, 5, n_groups)
        table = phrases._bundles(chunk, *found)
        assert table.num_rows == len(set(found[0].tolist())) and (n_groups == 1 or table.num_rows > 1)
        lang, word, leaves, total, split = phrases._unbundled(table, 5)
        got = Counter()
        for row, n in zip(leaves.tolist(), total.tolist()):
            got[lang[row[0]].as_py(), " ".join(word[i].as_py() for i in row[1:] if i >= 0)] += n
        assert got == {("en", s): 1 for s in ("a b c a b", "b c a b", "c a b", "a b", "c a b c a", "a b c a", "b c a", "c a")} | {("fr", "a b"): 1}
        assert split.all()
        chunk.forget()
        assert chunk.words  # few words are remembered


def test_exact_beyond_64_bits(spark):
    row = spark.range(1).selectExpr(
        "(cast(9000000000000 as decimal(17,0)) * (1000 * cast(90000000000000 as decimal(17,0)))) "
        "div (cast(9000000000000 as decimal(17,0)) * cast(70000000001 as decimal(17,0))) as s").first()
    assert row.s == 1000 * 9000000000000 * 90000000000000 // (9000000000000 * 70000000001)


def test_edges(spark):
    docs = documents(spark, EDGE_TEXTS * 3)
    assert result(phrases.collocations(docs, min_count=3)) == brute([("en", t) for t in EDGE_TEXTS * 3], 3, 2000)
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert phrases.collocations(empty).collect() == []
    clash = docs.selectExpr("text", "lang", "'x' as word", "1 as n", "'y' as phrase", "2 as slot", "3 as size", "4 as part")
    assert result(phrases.collocations(clash, min_count=3)) == result(phrases.collocations(docs, min_count=3))


def test_hot_phrase(spark):
    rows = [("en", "hot pair here %d, hot pair there" % (i % 50)) for i in range(3000)] + list(texts(5, 20))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(8)
    assert result(phrases.collocations(docs, min_count=50)) == brute(rows, 50, 2000)
