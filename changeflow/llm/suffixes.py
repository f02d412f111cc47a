"""Suffix-order dedup: later copies of long byte strings go, the first stays.

A suffix array over a whole corpus fits no machine, so only those stretches
are put in suffix order that can repeat at all, in bounded groups:

1. Every string of ``length`` bytes has an anchor, the smallest hash among its
   ``K``-byte strings, which depends on the string alone. So two documents
   that share a string of ``length`` bytes share its anchor. Anchors
   (about one in 18 bytes) are shuffled as hash and text number, and those
   that two different texts hold are kept. An anchor that a task has sent for
   two texts already is certain to be kept; its further rows are salted.
2. For these, each text sends the stretch around the anchor that strings with
   this anchor can reach (``2 length - K`` bytes), with all its places in the
   text, grouped by anchor. A stretch that the task has sent for a smaller
   document is covered whole and is not sent. A task
   puts the suffixes of its groups' stretches in order, with the common
   prefixes of neighbours. The previous and the next suffix of a smaller
   document give each suffix its longest previous factor (cut at ``length``,
   as the suffixes are); where that is ``length`` the string is a later copy.
   Bytes are compared as bytes; a hash only says which ones are compared.
   Equal stretches are put in order once. Anchors of more than ``HOT``
   stretches are not gathered: their strings are compared by a plain
   ``groupBy`` with map-side combine (strings as keys).
3. The covered intervals of a text are merged in the tasks that find them and
   once more where they meet, and go back to its first document.

Exact copies of whole texts are found by ``groupBy`` first, on a hash of 128
bits; only the first of them is searched, the rest go whole. Copies of a text
that more than one row in ``PARTS`` has learn its first document from a
broadcast of fewer than ``PARTS`` rows and are not gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import drop_stored, id_and_text, small_batches, stored, text_key

LENGTH = 50
K = 16
HOT = 20_000
#: stretches of whole groups that a task puts in order at once
CHUNK = 12_000
SEEN = 1_000_000
#: stretches that a task remembers to have sent, and places it looks at at once
SENT = 100_000
SLICE = 16_384
#: slots of a task's memory of anchors, and salts of those it knows to repeat
SLOTS = 1 << 20
SALTS = 256
#: a text of more than ``HOT_COPIES`` rows and one row in ``PARTS`` is hot
HOT_COPIES, PARTS = 1_000, 1_000
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD)


def kmer_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each string of K bytes."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _A
    h ^= h >> np.uint64(29)
    n, factor = 1, int(_B)
    while n < K:  # of n bytes, then of twice as many
        h = h[:-n] * np.uint64(factor) + (h[n:] ^ (h[n:] >> np.uint64(31)))
        factor, n = (factor * factor * 3) % 2**64 | 1, 2 * n
    h *= _C
    return h ^ (h >> np.uint64(32))


def anchors(text: bytes, length: int) -> np.ndarray:
    """The distinct anchors of all strings of ``length`` bytes."""
    if len(text) < length:
        return np.zeros(0, np.uint64)
    low, n, size = kmer_hashes(np.frombuffer(text, np.uint8)), 1, length - K + 1
    while 2 * n <= size:
        low, n = np.minimum(low[:-n], low[n:]), 2 * n
    if n < size:
        low = np.minimum(low[:n - size], low[size - n:])
    return np.unique(low)


class RepeatedAnchors:
    """What a task remembers of the anchors it has sent: a slot holds the last
    anchor that fell there, a text that has it, and whether another one has it
    too. What a slot forgets is only sent once more as unknown."""

    def __init__(self, slots: int = SLOTS):
        self.mask = np.uint64(slots - 1)
        self.anchor = ~np.arange(slots, dtype=np.uint64)  # no anchor of that slot
        self.text = np.zeros(slots, np.int64)
        self.repeated = np.zeros(slots, bool)

    def known(self, anchor: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Which anchors had been sent for two texts before this call."""
        slot = (anchor & self.mask).astype(np.int64)
        same = self.anchor[slot] == anchor
        known = same & self.repeated[slot]
        self.repeated[slot[~same]] = False
        self.anchor[slot[~same]] = anchor[~same]
        self.text[slot[~same]] = text[~same]
        self.repeated[slot[(self.anchor[slot] == anchor) & (self.text[slot] != text)]] = True
        return known


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sent = RepeatedAnchors()
        for b in batches:
            hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for t, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                if t in seen:  # a copy that this task has had already
                    continue
                if len(seen) < SEEN:
                    seen.add(t)
                hashes.append(anchors(text, length))
                owners.append(np.full(len(hashes[-1]), t))
            h, owner = np.concatenate(hashes), np.concatenate(owners)
            salt = np.where(sent.known(h, owner), 1 + owner % SALTS, 0).astype(np.int16)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(owner), pa.array(salt)],
                                             names=["h", "t1", "salt"])

    return run


def _stretches(length: int):
    """Rows (h, t1, first, pos, left, size, bytes): a stretch around a wanted
    anchor and all places where the text has it; ``bytes`` is null if a
    smaller document is known to have the whole stretch."""
    names = ["h", "t1", "first", "pos", "left", "size", "bytes"]

    def batch(hashes, owners, rows) -> pa.RecordBatch:
        places, left, size, cut = zip(*rows)
        t1, first, n = (np.array(x) for x in zip(*owners))
        ends = np.cumsum([0, *map(len, places)])
        flat = np.fromiter(chain.from_iterable(places), np.int32, ends[-1])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.repeat(t1, n)), pa.array(np.repeat(first, n)),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), pa.array(left, pa.int32()),
             pa.array(size, pa.int32()), pa.array(cut, pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[tuple[int, bytes], int] = {}
        hashes, owners, rows = [], [], []  # of several texts, for one batch
        for b in batches:
            for t1, first, text, hs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                           b.column(2).cast(pa.binary()).to_pylist(), b.column(3)):
                wanted = np.sort(hs.values.to_numpy().view(np.uint64))
                every = kmer_hashes(np.frombuffer(text, np.uint8))
                at = np.minimum(np.searchsorted(wanted, every), len(wanted) - 1)
                pos = np.flatnonzero(wanted[at] == every)
                for lo in range(0, len(pos), SLICE):
                    places: dict[tuple[int, bytes], list[int]] = {}
                    for x in pos[lo:lo + SLICE].tolist():
                        left = min(x, length - K)
                        cut = text[x - left:x + length]
                        if len(cut) >= length:
                            places.setdefault((left, cut), []).append(x)
                    for stretch, xs in places.items():
                        least = sent.get(stretch)
                        covered = least is not None and least < first
                        if not covered:
                            if len(sent) >= SENT:
                                sent.clear()
                            sent[stretch] = first
                        left, cut = stretch
                        rows.append((xs, left, len(cut), None if covered else cut))
                    if places:
                        hashes.append(every[[xs[0] for xs in places.values()]])
                        owners.append((t1, first, len(places)))
                    if len(rows) >= SLICE // 4:
                        yield batch(hashes, owners, rows)
                        hashes, owners, rows = [], [], []
        if rows:
            yield batch(hashes, owners, rows)

    return run


def _rows_as_bytes(parts: list[np.ndarray]) -> np.ndarray:
    """Rows of byte matrices side by side, as strings that sort by bytes."""
    whole = np.ascontiguousarray(np.concatenate(parts, axis=1))
    return whole.view("S%d" % whole.shape[1]).ravel()


def _as_bytes(x: np.ndarray, kind: str) -> np.ndarray:
    return np.ascontiguousarray(x.astype(kind)).view(np.uint8).reshape(len(x), -1)


def _same_as_before(keys: np.ndarray) -> np.ndarray:
    raw = keys.view(np.uint8).reshape(len(keys), -1)
    return np.concatenate([[False], (raw[1:] == raw[:-1]).all(1)])


def common_prefixes(keys: np.ndarray) -> np.ndarray:
    """How many first bytes each string shares with the one before it (0 for
    the first string)."""
    raw = keys.view(np.uint8).reshape(len(keys), -1)
    differs = np.ones((len(raw) - 1, raw.shape[1] + 1), bool)  # the last column ends equal ones
    np.not_equal(raw[1:], raw[:-1], out=differs[:, :-1])
    return np.concatenate([[0], differs.argmax(1)])


def _to_smaller_before(doc: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """The common prefix of each suffix and the nearest one before it, in
    suffix order, from a smaller document (0 if there is none). All suffixes
    follow their links at once: the suffixes between one and the target of
    its link are from no smaller documents, so whoever meets it there may
    take its link as well."""
    link, common = np.arange(len(doc)) - 1, lcp.copy()
    going = np.flatnonzero(common)
    going = going[doc[link[going]] >= doc[going]]
    while len(going):
        over = link[going]
        common[going] = np.minimum(common[going], common[over])
        link[going] = link[over]
        going = going[common[going] > 0]
        going = going[doc[link[going]] >= doc[going]]
    return common


def previous_factors(doc: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """The longest previous factor of each suffix: ``doc`` are the documents
    of the suffixes in suffix order, ``lcp`` the common prefixes with the
    suffix before. A factor is previous if it starts in a smaller document;
    the longest one is shared with the previous or the next suffix of a
    smaller document in that order."""
    after = _to_smaller_before(doc[::-1], np.append(lcp[1:], 0)[::-1])[::-1]
    return np.maximum(_to_smaller_before(doc, lcp), after)


def earlier_copies(h, first, left, flat, offsets, length: int) -> np.ndarray:
    """For stretches (rows; anchors h, documents ``first``): a matrix that
    says, for each start from ``length - K`` bytes before the anchor to the
    anchor, whether the string of ``length`` bytes there also stands in a
    stretch of the same anchor from a smaller document."""
    n, reach = len(h), length - K
    width = reach + length
    size = np.diff(offsets)
    begin = reach - left
    grid = np.zeros((n, width), np.uint8)
    row = np.repeat(np.arange(n), size)
    grid[row, np.arange(len(flat)) - offsets[row] + begin[row]] = flat
    # equal stretches of an anchor count once, with their smallest document
    keys = _rows_as_bytes([_as_bytes(h, ">i8"), _as_bytes(begin, ">u2"), _as_bytes(size, ">u2"), grid])
    order = np.argsort(keys, kind="stable")
    new = ~_same_as_before(keys[order])
    which = np.empty(n, np.int64)
    which[order] = np.cumsum(new) - 1
    one = order[new]
    doc = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(doc, which, first)
    starts = np.arange(reach + 1)
    valid = (starts >= begin[one][:, None]) & (starts + length <= (begin + size)[one][:, None])
    factor = np.zeros((len(one), reach + 1), np.int64)
    # suffix order among the anchors that have different stretches
    group = np.cumsum(np.concatenate([[True], h[one][1:] != h[one][:-1]])) - 1
    several = np.bincount(group)[group] > 1
    u, s = np.nonzero(valid & several[:, None])
    if len(u):
        suffix = np.lib.stride_tricks.sliding_window_view(grid[one], length, axis=1)[u, s]
        head = [_as_bytes(group[u], ">u4"), _as_bytes(s, ">u2")]  # equal strings have their anchor at one place
        keys = _rows_as_bytes([*head, suffix])
        order = np.argsort(keys, kind="stable")
        lcp = np.maximum(common_prefixes(keys[order]) - sum(x.shape[1] for x in head), 0)
        factor[u[order], s[order]] = previous_factors(doc[u[order]], lcp)
    return valid[which] & ((doc[which] < first)[:, None] | (factor[which] >= length))


def merged_by_owner(t1, first, b, e) -> tuple[np.ndarray, ...]:
    """Maximal intervals of overlapping or touching ones of each (t1, first)."""
    order = np.lexsort((b, first, t1))
    t1, first, b, e = (x[order] for x in (t1, first, b, e))
    other = np.append(True, (t1[1:] != t1[:-1]) | (first[1:] != first[:-1]))[:len(b)]
    owner = np.cumsum(other) << 32
    reach = np.maximum.accumulate(owner + e) if len(b) else owner
    new = np.flatnonzero(np.append(True, owner[1:] + b[1:] > reach[:-1])[:len(b)])
    last = np.append(new[1:], len(b))[:len(new)] - 1
    return t1[new], first[new], b[new].astype(np.int32), (reach[last] - owner[last]).astype(np.int32)


def _one_array(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return column if isinstance(column, pa.Array) else column.chunk(0)


def _covered(length: int):
    reach = length - K

    def intervals(table: pa.Table) -> pa.RecordBatch:
        h, t1, first, left = (table.column(i).to_numpy() for i in range(4))
        places, cut = (_one_array(table.column(i)) for i in (4, 5))
        n_places, pos = places.value_lengths().to_numpy(), places.flatten().to_numpy()
        offsets = np.frombuffer(cut.buffers()[1], np.int32)[cut.offset:cut.offset + len(cut) + 1].astype(np.int64)
        flat = np.frombuffer(cut.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] else np.zeros(0, np.uint8)
        hit = earlier_copies(h, first, left.astype(np.int64), flat, offsets - offsets[0], length)
        edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, start = np.nonzero(edge == 1)
        _, stop = np.nonzero(edge == -1)
        # each interval at each place of its stretch
        times = n_places[row]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        at = pos[np.repeat((np.cumsum(n_places) - n_places)[row], times) + nth] - reach
        spans = merged_by_owner(np.repeat(t1[row], times), np.repeat(first[row], times), at + np.repeat(start, times),
                                at + np.repeat(stop - 1 + length, times))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in spans], names=["t1", "first", "b", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= CHUNK:
                table = pa.Table.from_batches(held)
                h = table.column(0).to_numpy()
                if h[0] == h[-1]:
                    continue
                cut = int(np.flatnonzero(h != h[-1])[-1]) + 1  # the last group may go on
                yield intervals(table.slice(0, cut))
                held = pa.Table.from_arrays([c.combine_chunks() for c in table.slice(cut).columns],
                                            names=table.column_names).to_batches()
                n -= cut
        if n:
            yield intervals(pa.Table.from_batches(held))

    return run


def _covered_hot(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchors of very many stretches, string by string."""
    each = rows.select("h", "t1", "first", "pos", "left", "bytes", F.explode(F.sequence(
        F.lit(0), F.col("size") - length)).alias("s"))
    each = each.select("h", "t1", "first", "pos", (F.col("s") - F.col("left")).alias("from"),
                       F.expr(f"substring(bytes, s + 1, {length})").alias("x"))
    least = each.groupBy("h", "x").agg(F.min("first").alias("least"))
    found = each.join(least, ["h", "x"]).where("least < first").select(
        "t1", "first", "from", F.explode("pos").alias("p"))
    return found.select("t1", "first", (F.col("p") + F.col("from")).alias("b"), (F.col("p") + F.col("from") + length).alias("e"))


def covered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
            hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): ``texts`` has t1, t2, n (rows) and ``first``, the
    smallest id, of each different text; ``spans`` has t1, first and the
    intervals (b, e) of that document that earlier documents hold, as an
    array. t1 and the first document name a text; a text whose t1 another one
    shares gets that one's anchors besides its own, which are not in it."""
    spark = docs.sparkSession
    small_batches(spark)
    src = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long"), *text_key("text"), "text")
    texts = stored(src.groupBy("t1", "t2").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n")), "texts")
    rows = src.select("t1", "text").mapInArrow(_anchor_rows(length), "h long, t1 long, salt short")
    w = Window.partitionBy("h", "salt")
    rows = rows.select("h", "t1", "salt", F.min("t1").over(w).alias("low"), F.max("t1").over(w).alias("high")).where(
        "salt > 0 or low <> high")
    wanted = stored(rows.groupBy("t1").agg(F.collect_set("h").alias("hs")), "anchors")
    # the id in the key deals the copies of a text to all tasks
    owners = texts.join(wanted, "t1").select("t1", "t2", F.col("first").alias("doc_id"), "hs")
    cut = (src.join(owners, ["t1", "t2", "doc_id"]).select("t1", F.col("doc_id").alias("first"), "text", "hs")
           .mapInArrow(_stretches(length),
                       "h long, t1 long, first long, pos array<int>, left int, size int, bytes binary"))
    spans = _intervals(cut, length, hot)
    drop_stored(wanted)
    return texts, spans


def _intervals(cut: DataFrame, length: int, hot: int) -> DataFrame:
    cut = stored(cut, "stretches")  # read for covered stretches, usual and hot anchors
    whole = cut.where("bytes is null").select("t1", "first", "left", "size", F.explode("pos").alias("p")).select(
        "t1", "first", (F.col("p") - F.col("left")).alias("b"), (F.col("p") - F.col("left") + F.col("size")).alias("e"))
    sent = cut.where("bytes is not null")
    # stored, so the planner knows its size: broadcast if it is small, else shuffled
    hots = stored(sent.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("h"), "hot")
    cold = (sent.join(hots, "h", "left_anti").select("h", "t1", "first", "left", "pos", "bytes")
            .repartition("h").sortWithinPartitions("h").mapInArrow(_covered(length), "t1 long, first long, b int, e int"))
    found = whole.unionByName(cold).unionByName(_covered_hot(sent.join(hots, "h", "left_semi"), length))
    # one exchange by text, for the merging windows and for both groupings
    w = Window.partitionBy("t1", "first").orderBy("b", "e")
    reach = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.withColumn("new", F.when(reach >= F.col("b"), 0).otherwise(1)).select(
        "t1", "first", "b", "e", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    runs = runs.groupBy("t1", "first", "run").agg(F.min("b").alias("b"), F.max("e").alias("e"))
    spans = stored(runs.groupBy("t1", "first").agg(F.sort_array(F.collect_list(F.struct("b", "e"))).alias("spans")), "spans")
    drop_stored(cut)
    drop_stored(hots)
    return spans


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                     hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``kept`` (binary) for every row.

    A byte goes if a string of ``length`` bytes that covers it also starts in
    a document with a smaller id, judged on the input; matches stay within a
    document and overlaps count. n_spans: maximal removed runs. ``kept``: the
    rest, as bytes, since a cut may fall inside a character. Null texts are
    empty. Rows of one id are no earlier documents of each other, and a null
    id is neither earlier nor later than any: its row stays whole. An empty
    table gives an empty table. Other columns are not read; ids are read as
    long."""
    texts, spans = covered(docs, id_col, text_col, length, hot)
    src = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long"), *text_key("text"), "text")
    owned = texts.join(spans, ["t1", "first"], "left").select("t1", "t2", "first", "spans")
    rows_in_all = texts.agg(F.sum("n")).first()[0] or 0
    hot = texts.where(F.col("n") > max(HOT_COPIES, rows_in_all // PARTS)).select("t1", "t2", F.col("first").alias("known"))
    src = src.join(F.broadcast(hot), ["t1", "t2"], "left").withColumn("size", F.octet_length("text"))
    # a later copy of a hot text needs nothing from ``owned``: any task will do, and one that goes leaves its text behind
    later = F.col("known").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("known"))
    goes = later & (F.col("doc_id") > F.col("known")) & (F.col("size") >= length)
    src = src.select("doc_id", "t2", "known", "size", F.when(goes, None).otherwise(F.col("text")).alias("text"),
                     F.when(later, F.xxhash64("doc_id", F.spark_partition_id())).otherwise(F.col("t1")).alias("t1"))
    rows = src.join(owned, ["t1", "t2"], "left").select(
        "doc_id", "text", F.coalesce("known", "first").alias("first"), "spans", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_removed, n_spans, kept = [], [], []
            for doc, text, first, own, size in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(),
                                                   *(b.column(i).to_pylist() for i in (2, 3, 4))):
                if doc is None or first is None:
                    gone = []
                elif doc > first:
                    gone = [(0, size)] if size >= length else []
                else:
                    gone = [(x["b"], x["e"]) for x in own or []]
                edges = [0, *(x for span in gone for x in span), size]
                rest = b"" if text is None else b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2]))
                n_removed.append(size - len(rest))
                n_spans.append(len(gone))
                kept.append(rest)
            longs = [pa.array(x, pa.int64()) for x in (n_removed, n_spans)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(4).cast(pa.int64()), *longs, pa.array(kept, pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
