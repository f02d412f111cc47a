import numpy as np
import xxhash
from pyspark.sql import functions as F

from changeflow.llm import simhash
from changeflow.llm.queries import op1_simhash
from .conftest import DOC_SCHEMA, EDGE_TEXTS, documents

SF = "/root/testdata/sf0.001"


def brute_fp(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ")
    for c in "\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, most=2):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= most:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(i)
    out = [None] * len(ids)
    for members in groups.values():
        known = [ids[i] for i in members if ids[i] is not None]
        for i in members:
            out[i] = min(known) if known else None
    return out


def test_fingerprints_of_edge_texts():
    for t in EDGE_TEXTS + ["one", "one two", "one two three", "A b C d", "é É x"]:
        assert simhash.fingerprint((t or "").encode()) == brute_fp(t), (t or "")[:20]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(SF + "/documents.parquet").collect()
    ids, fps = [r.doc_id for r in docs], [brute_fp(r.text) for r in docs]
    want = dict(zip(ids, brute_components(ids, fps)))
    got = op1_simhash(spark, SF).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fingerprint for r in got} == {i: "%016x" % f for i, f in zip(ids, fps)}


def test_gray_rank_orders_neighbours_one_bit_apart():
    x = np.random.default_rng(0).integers(0, 1 << 12, 4096, dtype=np.uint64)
    x = np.unique(x)
    full = np.arange(1 << 12, dtype=np.uint64)
    by = full[np.argsort(simhash.gray_rank(full))]
    assert (np.bitwise_count(by[1:] ^ by[:-1]) == 1).all()


def test_index_finds_exactly_the_pairs_within_the_distance():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fp = np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(8)])
    fp = np.unique(fp ^ (np.uint64(1) << rng.integers(0, 64, len(fp), dtype=np.uint64)))
    bucket = rng.integers(0, 3, len(fp))
    order = np.lexsort((simhash.gray_rank(fp), bucket))
    fp, bucket = fp[order], bucket[order]
    for most in (0, 1, 2, 5):
        a, b = simhash.GrayIndex(bucket, fp).pairs(np.arange(len(fp)), most)
        want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp))
                if bucket[i] == bucket[j] and bin(int(fp[i] ^ fp[j])).count("1") <= most}
        assert set(zip(a.tolist(), b.tolist())) == want


def cloud(n, seed):
    """Fingerprints in a chain of small steps plus strangers."""
    rng, out = np.random.default_rng(seed), [0x0123456789ABCDEF]
    for _ in range(n):
        out.append(out[int(rng.integers(max(0, len(out) - 30), len(out)))] ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))))
    return sorted({x - (1 << 64) if x >> 63 else x for x in out} | set(rng.integers(-2**62, 2**62, 30).tolist()))


def test_links_connect_the_same_components_by_index_and_in_hot_buckets(spark):
    fps = cloud(300, 5)
    want = brute_components(fps, [x % (1 << 64) for x in fps])
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for hot in (10_000, 3):
        roots = {r.node: r.root for r in simhash.components(simhash.links(df, hot=hot)).collect()}
        assert [roots.get(x, x) for x in fps] == want


def test_nulls_repeats_clashing_names_and_empty_tables(spark):
    texts = EDGE_TEXTS + ["some words that are repeated here"] * 3
    df = documents(spark, texts).unionByName(documents(spark, ["some words that are repeated here"], 13))
    df = df.unionByName(spark.createDataFrame([(None, "lonely text of a row without id", None, None, None),
                                               (None, "some words that are repeated here", None, None, None)], DOC_SCHEMA))
    df = df.withColumn("fp", F.lit("x")).withColumn("root", F.lit(1)).withColumn("t1", F.lit(0))
    rows = df.collect()
    found = simhash.near_duplicates(df)
    got = found.collect()
    assert len(got) == len(rows)
    want = brute_components([r.doc_id for r in rows], [brute_fp(r.text) for r in rows])
    key = lambda x: (x is None, x)
    assert sorted(((g.doc_id, g.component_id) for g in got), key=str) == sorted(zip([r.doc_id for r in rows], want), key=str)
    kept = simhash.keep_one(df, found).collect()
    assert sorted((r.doc_id for r in kept), key=key) == sorted(set(want), key=key)
    assert kept[0].asDict().keys() == rows[0].asDict().keys()
    assert simhash.near_duplicates(df.limit(0)).count() == 0
