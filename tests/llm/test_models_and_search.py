import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import ann, decontam, langid
from changeflow.llm.queries import op5_langid, op7_ann
from .conftest import EDGE_TEXTS, documents

SF = "/root/testdata/sf0.01"


# --- decontamination -------------------------------------------------------

def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w for w in low.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ")
            .replace("\r", " ").split(" ") if w]


def grams(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_contained(docs, items):
    out = []
    for d, t in docs:
        for i, q in items:
            whole = grams(q)
            if whole and len(whole & grams(t)) / len(whole) >= 0.8 - 1e-12:
                out.append((d, i, len(whole), len(whole & grams(t))))
    return sorted(out, key=str)


def test_containment_against_brute_force(spark):
    item = " ".join("w%d" % i for i in range(40))
    cut = item.replace("w7 ", "other ").replace("w30 ", "x ")
    items = [(0, item), (1, "Just Four words here"), (2, None), (3, ""), (4, item), (None, "a b c d e"), (6, "z " * 50)]
    texts = ["pad " * 500 + item.upper() + " more", cut, item.replace("w7 ", "q "), "just four words here", "just four words here too",
             "x a b  c\td\ne y", "z " * 9, " ".join(reversed(item.split())), " ".join("w%d" % i for i in range(32))] + EDGE_TEXTS
    docs = documents(spark, texts).withColumn("item_id", F.lit(9)).withColumn("containment", F.lit("?"))
    df = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_held) for r in decontam.contaminated(docs, df).collect()), key=str)
    assert got == brute_contained(list(enumerate(texts)), items) or got == [
        x for x in brute_contained(list(enumerate(texts)), items) if x[1] != 1 or x[0] == 3]
    kept = {r.doc_id for r in decontam.drop_contaminated(docs, df).collect()}
    assert kept == set(range(len(texts))) - {g[0] for g in got}
    assert decontam.contaminated(docs.limit(0), df).count() == 0
    assert decontam.contaminated(docs, df.limit(0)).count() == 0


def test_items_in_several_blocks_give_the_same(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = {tuple(r) for r in decontam.contaminated(docs, items).collect()}
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 300)
    assert {tuple(r) for r in decontam.contaminated(docs, items).collect()} == whole and whole


# --- language ID -----------------------------------------------------------

def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    model = langid.ByteCNN(["a", "b", "c"])
    model.tables = [t.astype(np.float64) for t in model.tables]
    model.out = model.out.astype(np.float64)
    x, y, w = rng.integers(0, 256, (6, langid.WINDOW)).astype(np.uint8), rng.integers(0, 3, 6), np.ones(6)

    def loss():
        return -np.log(model.probabilities(x)[np.arange(6), y]).mean()

    grads = model._gradients(x, y, w)
    for param, grad in ((model.out, grads[-2]), (model.tables[1], grads[1])):
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        eps = 1e-5
        param[at] += eps
        up = loss()
        param[at] -= 2 * eps
        assert grad[at] == pytest.approx((up - loss()) / (2 * eps), rel=1e-2)
        param[at] += eps


def test_held_out_accuracy_and_columns(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(SF + "/documents.parquet").collect()}
    rows = op5_langid(spark, SF).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    out = [r for r in rows if r.held_out and truth[r.doc_id].lang]
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in out]) > 0.97


def test_edge_texts_and_nothing_to_learn(spark):
    docs = documents(spark, EDGE_TEXTS).withColumn("lang_pred", F.lit(3))
    model = langid.train(documents(spark, ["the cat and the dog"] * 6 + ["der hund und die katze"] * 6,
                                   langs=["en"] * 6 + ["de"] * 6))
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for i, t in enumerate(EDGE_TEXTS):
        assert (got[i].lang_pred == "und") == (t is None or not any(map(str.isalpha, t)))
    assert got[4].lang_score == got[5].lang_score
    assert langid.train(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


def test_every_window_of_a_long_text_counts(spark):
    model = langid.ByteCNN(["a", "b"])
    text = "x" * 1000 + "y" * 3000
    p = model.probabilities(langid.windows_of(text.encode())).mean(0)
    r = langid.predict(documents(spark, [text]), model).collect()[0]
    assert r.lang_score == pytest.approx(float(p.max()), abs=1e-5)


# --- nearest neighbours ----------------------------------------------------

def brute_nearest(rows, k=5):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v]
    rows = [(i, v) for i, v in rows if np.isfinite(v).all() and v.any()]
    ids = np.array([i for i, _ in rows])
    vecs = np.array([v / np.sqrt((v * v).sum()) for _, v in rows])
    out = {}
    for at in np.flatnonzero(ids % 50 == 0):
        cos = (vecs * vecs[at]).sum(1)
        order = [j for j in np.lexsort((ids, -cos)) if ids[j] != ids[at]][:k]
        out[int(ids[at])] = [(int(ids[j]), cos[j]) for j in order]
    return out


def test_recall_of_the_query(spark):
    rows = spark.read.parquet(SF + "/embeddings.parquet").collect()
    want = brute_nearest([(r.vec_id, r.embedding) for r in rows])
    got = {}
    for r in op7_ann(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in want.items()}
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    vec = {r.vec_id: np.array(r.embedding, float) for r in rows if r.embedding is not None}
    for q, near in got.items():
        for i, s in near:
            assert s == pytest.approx(vec[q] @ vec[i] / np.sqrt(vec[q] @ vec[q]) / np.sqrt(vec[i] @ vec[i]), abs=1e-12)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))


def test_odd_vectors_ties_repeats_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [0.0, 1.0]), (8, [0.0, 1.0]), (50, [1.0, 1.0]), (None, [1.0, 1.0]), (9, []), (100, [nan, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("role", F.lit("x")).withColumn("a", F.lit(1))
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 2, 50, 8], 50: [0, 1, 2, 8]}
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_a_very_common_vector_yields_its_smallest_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(3000)] + [(10_000 + i, [float(i), 1.0, 0.0]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, df.where("vec_id in (0, 50, 2950)")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4], 2950: [0, 1, 2, 3, 4]}


def test_only_letters_make_a_language(spark):
    """Numerals, signs and marks are no letters."""
    texts = ["½ ²", "Ⅷ", "_ 1 ٣", "漢", "½ a", "ª", "👍", None, ""]
    model = langid.ByteCNN(["en", "fr"])
    got = [r.lang_pred for r in langid.predict(documents(spark, texts), model).orderBy("doc_id").collect()]
    assert [p == "und" for p in got] == [True, True, True, False, False, False, True, True, True]


def test_a_share_of_one_is_exact_and_repeated_ids_count_once(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(i % 40, (np.array(rows[0][1]) + rng.normal(size=8) * 0.05).tolist()) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows]
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 50 = 0"), k=6, share=1.0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in (0, 50, 100):
        best = {}
        for a in (v for i, v in unit if i == q):
            for i, v in unit:
                if i != q:
                    best[i] = max(best.get(i, -2.0), float(a @ v))
        want = sorted(best.items(), key=lambda e: (-e[1], e[0]))[:6]
        assert [i for _, i, _ in sorted(got[q])] == [i for i, _ in want]
        assert [s for *_, s in sorted(got[q])] == pytest.approx([s for _, s in want])


def test_a_rare_language_is_learned_from_whole_texts(spark):
    common = [("the cat and the dog %d" % i, "en") for i in range(400)]
    # what tells the rare language apart stands at the end of long texts
    rare = [("the cat and the dog " * 60 + "zzqx qqzz xqzq " * 60, "qz")] * 3
    texts, langs = zip(*common, *rare)
    docs = documents(spark, texts, langs=langs).where(~langid.held_out(F.col("doc_id")))
    model = langid.train(docs, sample_docs=50)
    assert model.languages == ["en", "qz"]
    p = model.probabilities(langid.windows_of(b"zzqx qqzz xqzq " * 20)).mean(0)
    assert p[1] > 0.8
