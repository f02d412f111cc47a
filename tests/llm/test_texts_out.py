"""SentencePiece codec, packing, suffix-order dedup and the pipeline."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import packing, pieces, suffixes
from changeflow.llm.queries import PIECE_MODEL, RANK_FILE, SPLIT_PATTERN, op6_pieces, op8_packing
from .conftest import DOC_SCHEMA, EDGE_TEXTS, documents

SF = "/root/testdata/sf0.001"
MORE = ["Hello  world", "▁ literal ▁▁ mark", " leading", "trailing ", "tab\tand\r\nnewlines\n\n", "日本語 text", "naïve café",
        " private", "é combined", "🏳️‍🌈 flags"]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary(PIECE_MODEL)


@pytest.fixture(scope="module")
def codec(vocabulary):
    return pieces.Codec(vocabulary)


def brute_viterbi(vocabulary, text):
    """Best score of a segmentation, by plain dynamic programming."""
    score = {p: s for p, s, k in vocabulary if k == pieces.NORMAL}
    lowest, longest = min(score.values()), max(map(len, score))
    s = "▁" + text.replace(" ", "▁")
    best = [0.0] + [float("-inf")] * len(s)
    for e in range(1, len(s) + 1):
        for b in range(max(0, e - longest), e):
            if s[b:e] in score:
                best[e] = max(best[e], best[b] + score[s[b:e]])
        if s[e - 1] not in score:
            best[e] = max(best[e], best[e - 1] + lowest - 10)
    return best[-1]


def test_words_of_many_texts_give_the_ids_of_whole_texts(ranks):
    rnd = random.Random(1)
    some = [" ", " ", "\n", "a", "b'", "'s", "1", "漢", "é", "\x00", "\t", ".", "!", "'", "ll", "  ", "😀", "\xa0"]
    texts = ["".join(rnd.choices(some, k=rnd.randint(0, 30))) for _ in range(5000)] + [t for t in EDGE_TEXTS if t is not None]
    tok = packing.Tokenizer(ranks, SPLIT_PATTERN)
    for text, ids in zip(texts, tok.encode_all(texts)):
        assert tok.encoding.encode_ordinary(text) == ids.tolist()
    assert tok.encode_all([]) == []


def test_codec_round_trip_and_best_score(codec, vocabulary):
    lowest = min(s for _, s, k in vocabulary if k == pieces.NORMAL)
    for text in [t for t in EDGE_TEXTS + MORE if t]:
        ids = codec.encode(text)
        assert codec.decode(ids) == text
        if "▁" not in text and len(text) < 200:
            got, unknown = 0.0, bytearray()
            for i in ids.tolist():
                piece, s, kind = vocabulary[i]
                if kind == pieces.NORMAL:
                    got += s
                else:
                    unknown.append(int(piece[3:5], 16))
            got += len(unknown.decode()) * (lowest - 10)
            assert got == pytest.approx(brute_viterbi(vocabulary, text), rel=1e-12)


def test_small_vocabulary_with_ties_and_crossing_pieces():
    vocab = [("<0x%02X>" % i, 0.0, pieces.BYTE) for i in range(256)]
    vocab += [(p, s, pieces.NORMAL) for p, s in [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("b▁a", -0.5)]]
    codec = pieces.Codec(vocab)
    for text in ("ab ab", "b", "aab", "abab ab b", "c ab"):
        assert codec.decode(codec.encode(text)) == text
    assert "b▁a" in [vocab[i][0] for i in codec.encode("ab ab")]


def test_encode_and_decode_columns(spark, vocabulary):
    texts = EDGE_TEXTS + MORE
    df = documents(spark, texts).withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1))
    rows = {r.doc_id: r for r in pieces.decode(pieces.encode(df, vocabulary), vocabulary).collect()}
    for i, t in enumerate(texts):
        assert rows[i].decoded == t and (rows[i].ids is None) == (t is None)
    assert rows[1].ids == []
    assert pieces.encode(df.limit(0), vocabulary).count() == 0
    assert all(r.exact for r in op6_pieces(spark, SF).collect())


# --- packing ---------------------------------------------------------------

@pytest.fixture(scope="module")
def ranks():
    return packing.load_ranks(RANK_FILE)


def test_memo_gives_the_encoders_own_ids(ranks):
    tok = packing.Tokenizer(ranks, SPLIT_PATTERN)
    for t in [t for t in EDGE_TEXTS + MORE if t] + ["don't  stop\n\n  now 12 %%"]:
        assert tok.encode(t).tolist() == tok.encoding.encode_ordinary(t)


def brute_best_fit(lengths, row_len):
    rooms, row, offset = [], [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in rooms if r >= lengths[i]]
        room = min(fits) if fits else row_len
        if fits:
            rooms.remove(room)
        rooms.append(room - lengths[i])
    return sorted(rooms)


def test_best_fit_against_brute_force():
    rng = random.Random(4)
    for row_len in (1, 7, 64, 100):
        lengths = np.array([rng.randint(1, row_len) for _ in range(300)])
        row, offset, n = packing.best_fit_decreasing(lengths, row_len)
        used = [[False] * row_len for _ in range(n)]
        for r, o, k in zip(row, offset, lengths):
            for p in range(o, o + k):
                assert not used[r][p]
                used[r][p] = True
        assert sorted(row_len - sum(u) for u in used) == brute_best_fit(lengths.tolist(), row_len)


def test_blocks_round_trip(spark, ranks):
    texts = EDGE_TEXTS + MORE + ["word " * 20] * 5
    df = documents(spark, texts).unionByName(documents(spark, ["again"], 3)).withColumn("ids", F.lit(1))
    blocks = packing.pack(df.coalesce(1), ranks, SPLIT_PATTERN, row_len=64, block_tokens=2000)
    tok = packing.Tokenizer(ranks, SPLIT_PATTERN)
    want = sorted([(i, tok.encode(t or "").tolist()) for i, t in enumerate(texts)] + [(3, tok.encode("again").tolist())])
    assert sorted((r.doc_id, r.ids) for r in packing.unpack(blocks).collect()) == want
    for b in blocks.collect():
        ids = np.frombuffer(b.ids, "<u%d" % b.id_bytes).reshape(b.n_rows, 64)
        assert b.cu_seqlens[0] == 0 and b.cu_seqlens[-1] == ids.size
        pos = packing.positions(b)
        assert all(pos[r] == 0 for r in b.resets) and (pos < 64).all()
        assert not any(x % 64 and x // 64 != (y - 1) // 64 for x, y in zip(b.cu_seqlens, b.cu_seqlens[1:]))
    assert packing.pack(df.limit(0), ranks, SPLIT_PATTERN).count() == 0


def test_packing_query_against_the_encoder(spark, ranks):
    tok = packing.Tokenizer(ranks, SPLIT_PATTERN)
    texts = {r.doc_id: r.text for r in spark.read.parquet(SF + "/documents.parquet").collect()}
    rows = op8_packing(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tok.encode(texts[r.doc_id] or "")
        assert r.n_ids == len(ids) and r.n_pieces == max(1, -(-len(ids) // packing.ROW_LEN))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


# --- suffix-order dedup ----------------------------------------------------

def brute_removed(rows, length=50):
    first = defaultdict(lambda: None)
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if d is not None and (first[s] is None or d < first[s]):
                first[s] = d
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            f = first[b[i:i + length]]
            if d is not None and f is not None and f < d:
                gone[i:i + length] = [True] * length
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def substrings(spark, rows, **options):
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOC_SCHEMA).repartition(4)
    df = df.withColumn("first", F.lit("x")).withColumn("spans", F.lit(1)).withColumn("h", F.lit(1))
    got = suffixes.dedup_substrings(df, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["the", "ion", "é", "an", "x", "qu"]) for _ in range(rng.randint(1, 3)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(rng.randint(8, 40)) for _ in range(6)]
    rows = []
    for d in range(40):
        parts = [text(rng.randint(1, 30)) for _ in range(3)]
        for s in rng.sample(shared, 2):
            cut = rng.randint(0, len(s) // 2)
            parts.insert(rng.randint(0, 3), s[cut:] if rng.random() < 0.5 else s)
        rows.append((d, "".join(parts)))
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(200, "a" * 300), (201, "a" * 120), (202, "ab" * 60)]
    return rows


def test_substrings_against_brute_force(spark):
    rows = corpus(1)
    assert substrings(spark, rows) == brute_removed(rows)


def test_hot_anchors_and_other_lengths_give_the_same(spark):
    rows = corpus(2)
    assert substrings(spark, rows, hot=2) == brute_removed(rows)
    assert substrings(spark, rows, length=30) == brute_removed(rows, 30)


def test_repeats_known_to_a_task_give_the_same(spark):
    rng = random.Random(3)
    line = "a line that many of the documents hold, each of them in its own place."
    rows = [(d, "%d %s\n%s" % (rng.random() * 1e9, "first %d" % d, (line + "\n") * rng.randint(0, 4)
                               + line[rng.randint(0, 20):] * rng.randint(0, 2))) for d in range(60)] + corpus(4)
    rng.shuffle(rows)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")  # so that a task has several batches
    try:
        assert substrings(spark, rows) == brute_removed(rows)
        assert substrings(spark, rows, hot=3) == brute_removed(rows)
    finally:
        spark.conf.set(key, before)


def test_only_anchors_sent_for_two_texts_are_known():
    seen = suffixes.RepeatedAnchors(4)

    def known(anchor, text):
        return seen.known(np.array(anchor, np.uint64), np.array(text)).tolist()

    assert known([1, 2], [7, 7]) == [False, False]
    assert known([1, 1, 2], [7, 8, 7]) == [False, False, False]
    assert known([1, 2, 5], [9, 9, 9]) == [True, False, False]  # 5 takes the slot of 1
    assert known([1, 2], [9, 7]) == [False, True]


def test_previous_factors_against_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        n, width = rng.randint(1, 40), rng.randint(1, 6)
        words = sorted(bytes(rng.choices(b"ab", k=width)) for _ in range(n))
        docs = np.array([rng.randint(0, 6) for _ in range(n)])
        lcp = suffixes.common_prefixes(np.array(words, "S%d" % width))

        def shared(x, y):
            return next((i for i in range(width) if x[i] != y[i]), width)

        want = [max((shared(words[i], words[j]) for j in range(n) if docs[j] < docs[i]), default=0) for i in range(n)]
        assert suffixes.previous_factors(docs, lcp).tolist() == want
    long = np.concatenate([np.arange(3000), np.zeros(3000, np.int64)])  # links that are followed one by one
    assert suffixes.previous_factors(long, np.append(0, np.full(5999, 50))).tolist() == [0] + [50] * 2999 + [0] * 3000


def test_merged_by_owner():
    rng = random.Random(7)
    rows = [(rng.choice([-5, 3]), rng.randint(0, 2), b := rng.randint(0, 60), b + rng.randint(1, 6)) for _ in range(60)]
    want = set()
    for key in {r[:2] for r in rows}:
        at = sorted({x for r in rows if r[:2] == key for x in range(2 * r[2], 2 * r[3] + 1)})
        ends = [x for x in at if x - 1 not in at], [x for x in at if x + 1 not in at]
        want |= {(*key, b // 2, e // 2) for b, e in zip(*ends)}
    got = suffixes.merged_by_owner(*(np.array(c) for c in zip(*rows)))
    assert set(zip(*(c.tolist() for c in got))) == want and len(got[0]) == len(want)
    assert [len(c) for c in suffixes.merged_by_owner(*[np.zeros(0, np.int64)] * 4)] == [0] * 4


def test_hot_copies_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT_COPIES", 3)
    monkeypatch.setattr(suffixes, "PARTS", 50)
    rows = corpus(5)
    rows += ([(300 + i, rows[0][1]) for i in range(40)] + [(400 + i, "short") for i in range(20)]
             + [(500 + i, "") for i in range(9)] + [(None, rows[0][1])] * 6 + [(0, rows[0][1])] * 4)
    assert substrings(spark, rows) == brute_removed(rows)


def test_substring_edge_cases(spark):
    long = "".join(chr(97 + i % 26) + str(i) for i in range(60))
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)] + [(50, long), (50, long), (51, long), (52, long[:49]), (53, long[:50]),
            (50, long + "tail of it"), (None, long), (None, long + "zz"), (54, "q" + long), (-1, long[20:90])]
    got = substrings(spark, rows)
    want = brute_removed(rows)
    assert got == want
    assert suffixes.dedup_substrings(documents(spark, ["x"]).limit(0)).count() == 0


# --- pipeline --------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark):
    from corpus_pipeline import COLUMNS, STAGES, run

    from . import test_lines, test_models_and_search, test_simhash
    docs = spark.read.parquet(SF + "/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(SF + "/benchmark.parquet").collect()]
    steps = {}
    for name, stage in STAGES:
        before, docs = docs, stage(spark, docs, SF)
        rows = [(r.doc_id, r.text) for r in before.collect()]
        steps[name] = docs.collect()
        ids = {r.doc_id for r in steps[name]}
        if name == "language ID":
            assert ids == {d for d, t in rows if t and any(map(str.isalpha, t))}
        elif name == "line dedup":
            assert sorted((r.doc_id, r.text) for r in steps[name]) == [(x[0], x[3]) for x in sorted(test_lines.brute(rows))]
            assert all(r.n_chars == len(r.text) for r in steps[name])
        elif name == "SimHash near-dedup":
            assert ids == set(test_simhash.brute_components([d for d, _ in rows], [test_simhash.brute_fp(t) for _, t in rows]))
            assert len(steps[name]) == len(ids)
        elif name == "benchmark decontamination":
            assert ids == {d for d, _ in rows} - {x[0] for x in test_models_and_search.brute_contained(rows, items)}
        else:
            assert ids == {d for d, _ in rows} and all(r.exact for r in steps[name])
        if name != STAGES[-1][0]:
            assert docs.columns == COLUMNS
    whole = run(spark, SF).collect()
    assert sorted((r.doc_id, r.decoded_sha256) for r in whole) == sorted((r.doc_id, r.decoded_sha256) for r in steps[STAGES[-1][0]])


def test_pipeline_takes_odd_rows_and_an_empty_table(spark):
    from corpus_pipeline import STAGES
    odd = documents(spark, EDGE_TEXTS).unionByName(spark.createDataFrame(
        [(None, "der hund und die katze", None, None, None), (3, None, None, None, None), (4, "same text here", "en", "s", 3)], DOC_SCHEMA))
    for docs in (odd, odd.limit(0)):
        for _, stage in STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()
