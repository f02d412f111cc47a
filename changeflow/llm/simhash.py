"""SimHash near-dedup with a Gray-order hierarchical index.

1. Fingerprints: one pass over the texts, no shuffle. Equal fingerprints
   collapse (``groupBy`` with map-side combine), so a group of exact copies is
   one row from here on.
2. Search. Two fingerprints that differ in at most d bits agree on one of d+1
   bit blocks, so each fingerprint goes to d+1 buckets (8 bytes each, no
   texts). In a bucket, fingerprints are sorted by Gray rank and indexed as a
   tree: a node keeps the bits that all its fingerprints share and that its
   parent does not keep already. A search adds up the differing bits on its
   way down and leaves a whole group as soon as there are more than d.
   Buckets above ``HOT_BUCKET`` fingerprints are not gathered: there every
   fingerprint names itself and its d=2 half-way neighbours (one flipped
   bit), and two fingerprints are within 2 bits if they name a common one.
   That is exact, grows linearly, and no group exceeds 65 rows.
3. Links leave a task as a spanning forest (at most one link per fingerprint
   and bucket), so a dense group never becomes all its pairs.
4. Components: alternating large-star and small-star steps over the links, a
   stored table per step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import drop_stored, free_names, id_and_text, small_batches, stored, text_key, words_of

SEED = 42
HOT_BUCKET = 65_536
FANOUT = 16
#: fingerprints of whole buckets that a task indexes at once
CHUNK = 50_000
QUERIES_AT_ONCE = 2_048
_SLICE = 65_536


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles, repeats included: a bit is 1 if it
    is set in over half the hashes. No word: 0."""
    words = words_of(text)
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    stop = ends[min(shingle, len(words)) - 1:]
    start = [0, *ends]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b - 1], SEED) for a, b in zip(start, stop)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, _SLICE):
        bits = np.unpackbits(hashes[i:i + _SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(((2 * counts > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long), t1 and t2 (which text
    it is) for every row; a null text has no words."""
    small_batches(docs.sparkSession)
    src = id_and_text(docs, id_col, text_col).select("doc_id", *text_key("text"), "text")
    schema = T.StructType([*src.schema.fields[:3], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column(3).cast(pa.binary()).to_pylist()]
            out = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], out], names=["doc_id", "t1", "t2", "fp"])

    return src.mapInArrow(run, schema)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of a bit pattern in Gray order."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class GrayIndex:
    """Tree over fingerprints sorted by bucket and Gray rank. Level 0 holds
    the fingerprints; each node of level k+1 stands for ``FANOUT`` of level k.
    ``shared``: the bits in which all below a node agree, ``value``: these
    bits, ``own``: those of them that the parent does not hold."""

    def __init__(self, bucket: np.ndarray, fp: np.ndarray):
        full = ~np.uint64(0)
        low, high = [fp], [fp]  # and, or of all below
        first, last = [bucket], [bucket]
        while len(low[-1]) > FANOUT:
            cut = np.arange(0, len(low[-1]), FANOUT)
            low.append(np.bitwise_and.reduceat(low[-1], cut))
            high.append(np.bitwise_or.reduceat(high[-1], cut))
            first.append(np.minimum.reduceat(first[-1], cut))
            last.append(np.maximum.reduceat(last[-1], cut))
        self.bucket, self.fp, self.first, self.last = bucket, fp, first, last
        self.value, self.own = low, []
        shared = [full ^ (a ^ b) for a, b in zip(low, high)]
        for k, s in enumerate(shared):
            above = shared[k + 1][np.arange(len(s)) // FANOUT] if k + 1 < len(shared) else np.uint64(0)
            self.own.append(s & ~above)

    def pairs(self, query: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """For fingerprints by place: links to later places of their bucket."""
        top = len(self.own) - 1
        q = np.repeat(query, len(self.own[top]))
        node = np.tile(np.arange(len(self.own[top])), len(query))
        gone = np.zeros(len(q), np.uint8)
        for k in range(top, -1, -1):
            if k < top:
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                q, gone = np.repeat(q, FANOUT), np.repeat(gone, FANOUT)
            b = self.bucket[q]
            ok = node < len(self.own[k])
            q, node, gone, b = q[ok], node[ok], gone[ok], b[ok]
            # only places after the query's, and only nodes that hold its bucket
            ok = ((node + 1) * FANOUT ** k > q + 1) & (self.first[k][node] <= b) & (self.last[k][node] >= b)
            q, node, gone = q[ok], node[ok], gone[ok]
            gone = gone + np.bitwise_count((self.fp[q] ^ self.value[k][node]) & self.own[k][node])
            ok = gone <= most
            q, node, gone = q[ok], node[ok], gone[ok]
        ok = node > q
        return q[ok], node[ok]


def _forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest place that each of n places is linked to, over all links."""
    root = np.arange(n)
    for a, b in links:
        while True:
            x, y = root[a], root[b]
            open_ = x != y
            if not open_.any():
                break
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (up := root[root]).tobytes() != root.tobytes():
                root = up
    return root


def _bucket_links(bucket: np.ndarray, fp: np.ndarray, most: int) -> pa.RecordBatch:
    order = np.lexsort((gray_rank(fp), bucket))
    bucket, fp = bucket[order], fp[order]
    index = GrayIndex(bucket, fp)
    places = np.arange(len(fp))
    root = _forest(len(fp), (index.pairs(places[i:i + QUERIES_AT_ONCE], most)
                             for i in range(0, len(fp), QUERIES_AT_ONCE)))
    linked = root != places
    return pa.RecordBatch.from_arrays([pa.array(fp[linked].view(np.int64)), pa.array(fp[root[linked]].view(np.int64))],
                                      names=["a", "b"])


def _search(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_b, held_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for b in batches:
            held_b = np.concatenate([held_b, b.column(0).to_numpy()])
            held_f = np.concatenate([held_f, b.column(1).to_numpy().view(np.uint64)])
            if len(held_b) >= CHUNK and held_b[0] != held_b[-1]:
                cut = int(np.searchsorted(held_b, held_b[-1]))  # the last bucket may go on
                yield _bucket_links(held_b[:cut], held_f[:cut], most)
                held_b, held_f = held_b[cut:], held_f[cut:]
        if len(held_b):
            yield _bucket_links(held_b, held_f, most)

    return run


def links(fps: DataFrame, most: int = 2, hot: int = HOT_BUCKET) -> DataFrame:
    """A spanning forest (a, b) of the links within each bucket, over the
    distinct fingerprints ``fp``; together they connect exactly what bits
    within ``most`` connect."""
    cuts = [64 * i // (most + 1) for i in range(most + 2)]
    buckets = F.array(*[
        (F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) * (most + 1) + i)
        for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))])
    rows = fps.select(F.explode(buckets).alias("bucket"), "fp")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(sizes, "bucket")
    cold = (rows.where(F.col("n") <= hot).select("bucket", "fp")
            .repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_search(most), "a long, b long"))
    if most != 2:  # the half-way neighbours below are those of two bits
        return rows.select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
            _search(most), "a long, b long")
    flips = F.transform(F.sequence(F.lit(-1), F.lit(63)), lambda i: F.when(i < 0, F.col("fp")).otherwise(
        F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    near = rows.where(F.col("n") > hot).select(F.explode(flips).alias("centre"), "fp").distinct()
    first = near.groupBy("centre").agg(F.min("fp").alias("b"))
    warm = near.join(first, "centre").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return cold.unionByName(warm)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): the root is the
    smallest value its component holds."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        after = stored(small, "links")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_stored(now)
        now = after
        if mark == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = mark


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, most: int = 2) -> DataFrame:
    """doc_id, fp, component_id, t1, t2 for every row of ``docs``.

    component_id: the smallest doc_id that links of ``most`` or fewer
    differing bits reach, itself included. Null, empty and blank texts have
    fingerprint 0 and are linked like any other. Rows that repeat an id are
    rows of their own; null ids do not become a component_id unless no row of
    the component has an id (then it is null). An empty table gives an empty
    table. Other columns of the input are not read."""
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    each = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(each.select("fp"), most))
    each = each.join(roots, each["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = each.groupBy("root").agg(F.min("first").alias("component_id"))
    found = each.join(ids, "root").select("fp", "component_id")
    return rows.join(found, "fp").select("doc_id", "fp", "component_id", "t1", "t2")


def keep_one(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each component of ``near_duplicates``: the
    one with the smallest id (of rows that share it, the smallest text hash;
    of rows that are alike, one)."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")
    # a component without any id is told apart by its fingerprint
    group = F.when(F.col("component_id").isNull(), F.col("fp"))
    doc, x1, x2, y1, y2 = free_names(docs, "doc", "x1", "x2", "y1", "y2")
    kept = found.groupBy("component_id", group.alias("g")).agg(F.min(key).alias("k")).select(
        F.col("k.doc_id").alias(doc), F.col("k.t1").alias(x1), F.col("k.t2").alias(x2)).distinct()
    t1, t2 = text_key(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    src = docs.withColumn(y1, t1).withColumn(y2, t2)
    return (src.join(kept, src[id_col].eqNullSafe(F.col(doc)) & (F.col(y1) == F.col(x1))
                     & (F.col(y2) == F.col(x2)), "left_semi")
            .dropDuplicates([id_col, y1, y2]).drop(y1, y2))
