"""Phrase collocations by vertical partitioning of a depth-truncated suffix tree.

The suffix tree of all word suffixes, cut at ``depth`` words, is never built
as a whole. As in ERA, its top is cut into word prefixes, the prefixes are
grouped by a memory budget, and each group's subtrees are built on their own.

1. Word counts (prefixes of one word), with map-side combine. A phrase that
   occurs ``min_count`` times consists of words that do, so all other words end
   a suffix just as a piece's end does.
2. Counts of two-word prefixes over what is left, in hash slots: a slot's total
   is an upper bound of each of its prefixes. Suffixes whose slot stays below
   ``min_count`` hold no candidate, so the tree is not extended there (the
   elastic range of ERA).
3. Suffixes of the remaining prefixes, cut where the elastic range ends, leave
   a task as distinct leaves with a total, one row per group. A prefix goes to one of
   ``2 x suffixes / budget`` groups; one of more than ``budget / 8`` suffixes
   is extended to the full depth first, so its leaves spread over all groups.
   A group fits the budget whatever a prefix's share of the corpus is.
4. A group's task sorts its leaves, and every node's count is the sum of the
   leaf totals below it. Nodes of extended prefixes are summed over groups.

What is known about words and slots travels to the tasks as bitmaps of a fixed
number of bits (``WORD_BITS``, ``PAIR_BITS``). They only save work: a bit that
is set by chance costs a leaf more; counts come from words, never from hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import ASCII_LOWER, ASCII_UPPER, drop_stored, small_batches, stored

DEPTH = 5
MIN_COUNT = 100
TOP = 2_000
#: leaves that one group's subtrees may have in memory
BUDGET = 400_000
#: bits of the two bitmaps (2 MB and 8 MB)
WORD_BITS, PAIR_BITS = 1 << 24, 1 << 26
#: words that a task holds as codes, and different words it remembers
CHUNK_WORDS = 4_000_000
MEMO_WORDS = 400_000
#: bytes of leaves that leave a task at once
BUNDLE_BYTES = 4 << 20
#: languages whose totals may be broadcast
LANGS = 10_000
_SEED = 42
_END = b"."
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(ASCII_UPPER.encode() + _ENDS, ASCII_LOWER.encode() + _END * len(_ENDS))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_and_ends(text: bytes) -> list[bytes]:
    """The words of a text in order, with ``.`` where a piece ends (no word
    holds one)."""
    return text.translate(_FOLD).replace(_END, b" . ").split()


def _source(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
                       docs[text_col].cast("string").alias("text")).where(F.col("text").isNotNull())


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n), and (lang, null, n) for all words of a language."""
    counts: dict[str, Counter] = {}

    def rows() -> pa.RecordBatch:
        langs, words, ns = [], [], []
        for lang, c in counts.items():
            c.pop(_END, None)
            langs += [lang] * (len(c) + 1)
            words += [*c, None]
            ns += [*c.values(), sum(c.values())]
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary()).cast(pa.string()),
                                           pa.array(ns, pa.int64())], names=["lang", "word", "n"])

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            counts.setdefault(lang, Counter()).update(words_and_ends(text))
        if sum(map(len, counts.values())) > MEMO_WORDS:
            yield rows()
    if counts:
        yield rows()


class _Words(dict):
    """The code of each word of a language in this chunk; -1 for piece ends
    and words whose bit is not set."""

    def __init__(self, lang: str, chunk: _Chunk):
        super().__init__()
        self.lang, self.seed, self.chunk = lang, xxhash.xxh64_intdigest(lang.encode(), _SEED), chunk

    def __missing__(self, word: bytes) -> int:
        h, code, chunk = xxhash.xxh64_intdigest(word, self.seed), -1, self.chunk
        bit = h & (WORD_BITS - 1)
        if word != _END and chunk.bits[bit >> 3] >> (bit & 7) & 1:
            code = len(chunk.words)
            chunk.words.append(word)
            chunk.langs.append(self.lang)
            chunk.hashes.append(h)
        self[word] = code
        return code


class _Chunk:
    """Up to CHUNK_WORDS words of many texts, as codes."""

    def __init__(self, bits: bytes):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.by_lang: dict[str, _Words] = {}
        self.words, self.langs, self.hashes = [], [], []
        self.codes, self.size = [], 0

    def add(self, lang: str, text: bytes) -> None:
        words = words_and_ends(text)
        words.append(_END)
        of = self.by_lang.get(lang)
        if of is None:
            of = self.by_lang[lang] = _Words(lang, self)
        self.codes.append(np.fromiter(map(of.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """All codes so far, and the word hash of each code."""
        codes = np.concatenate(self.codes)
        self.codes, self.size = [], 0
        return codes, np.array(self.hashes, np.uint64)

    def forget(self) -> None:
        if len(self.words) > MEMO_WORDS or sum(map(len, self.by_lang.values())) > 4 * MEMO_WORDS:
            self.clear()


def _chunks(batches: Iterator[pa.RecordBatch], bits: bytes) -> Iterator[tuple[_Chunk, np.ndarray, np.ndarray]]:
    chunk = _Chunk(bits)
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            chunk.add(lang, text)
        if chunk.size >= CHUNK_WORDS:
            yield chunk, *chunk.take()
            chunk.forget()
    if chunk.size:
        yield chunk, *chunk.take()


def _pair_slots(codes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two words that may be frequent follow each other, and the slots
    of these prefixes."""
    at = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
    if not len(at):
        return at, np.zeros(0, np.int64)
    h = hashes[codes[at]] * _MIX + (hashes[codes[at + 1]] ^ (hashes[codes[at + 1]] >> np.uint64(29)))
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return at, (h >> np.uint64(32)).astype(np.int64) & (PAIR_BITS - 1)


def _has_bit(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


def _bitmap(rows: DataFrame, position: str, size: int) -> bytes:
    """The set bits of ``position`` (0 to size - 1) as one bitmap of that
    size; at most size / 32768 rows reach the driver."""
    out = np.zeros(size // 8, np.uint8)
    cells = rows.groupBy(F.expr(f"shiftright({position}, 15)").alias("cell")).agg(
        F.expr(f"bitmap_construct_agg({position} & 32767)").alias("bits"))
    for row in cells.toLocalIterator():
        at = row["cell"] * 4096
        part = np.frombuffer(bytes(row["bits"]), np.uint8)[:len(out) - at]
        out[at:at + len(part)] = part
    return out.tobytes()


def _leaves(codes, hashes, wanted, heavy, depth: int, n_groups: int) -> tuple[np.ndarray, ...]:
    """Distinct suffixes of a chunk, by group: their groups, words (a row of
    ``depth`` codes, -1 behind the end), totals, and whether their prefix is
    extended."""
    at, slots = _pair_slots(codes, hashes)
    keep = _has_bit(wanted, slots)
    at, slots = at[keep], slots[keep]
    goes_on = np.zeros(len(codes) + depth, bool)
    goes_on[at] = True
    padded = np.concatenate([codes, np.full(depth, -1, np.int32)])
    columns, alive = [padded[at]], np.ones(len(at), bool)
    for d in range(1, depth):
        alive = alive & goes_on[at + d - 1]
        columns.append(np.where(alive, padded[at + d], -1))
    table = pa.table({**{str(d): c for d, c in enumerate(columns)}, "slot": slots})
    table = table.group_by(table.column_names).aggregate([([], "count_all")])
    words = np.stack([table.column(str(d)).to_numpy() for d in range(depth)], axis=1)
    slots, total = table.column("slot").to_numpy(), table.column("count_all").to_numpy()
    split = _has_bit(heavy, slots)
    whole = np.zeros(len(slots), np.uint64)
    for c in words.T if len(hashes) else ():
        whole = (whole ^ np.where(c >= 0, hashes[c], np.uint64(1))) * _MIX
        whole ^= whole >> np.uint64(32)
    group = (np.where(split, (whole >> np.uint64(20)).astype(np.int64), slots) % n_groups).astype(np.int32)
    order = np.argsort(group, kind="stable")
    return group[order], words[order], total[order], split[order]


def _binary(rows: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes of the rows from each start to the next one."""
    ends = np.append(starts, len(rows)).astype(np.int64) * (rows[:1].nbytes if len(rows) else 1)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(
        np.ascontiguousarray(rows))]).cast(pa.binary())


def _bundles(chunk: _Chunk, group, words, total, split) -> pa.Table:
    """A row per group: its leaves of this chunk, with their words numbered
    within the row, so that a word is sent once."""
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])[:len(group)])
    there = words >= 0
    row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(group))))
    key = np.broadcast_to(row[:, None], words.shape)[there] * len(chunk.words) + words[there]
    different, number = np.unique(key, return_inverse=True)
    first = np.searchsorted(different, np.arange(len(starts) + 1) * max(1, len(chunk.words)))
    words = words.copy()
    words[there] = number.ravel() - np.broadcast_to(first[row][:, None], there.shape)[there]
    code = pa.array(different % max(1, len(chunk.words)))
    first = pa.array(first.astype(np.int32))
    return pa.table({
        "part": pa.array(group[starts]),
        "lang": pa.ListArray.from_arrays(first, pa.array(chunk.langs, pa.string()).take(code)),
        "word": pa.ListArray.from_arrays(first, pa.array(chunk.words, pa.binary()).cast(pa.string()).take(code)),
        "codes": _binary(words.astype("<i4"), starts), "n": _binary(total.astype("<i8"), starts),
        "split": _binary(split.astype(np.uint8), starts)})


BUNDLE = "part int, lang array<string>, word array<string>, codes binary, n binary, split binary"


def _whole(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _unbundled(table: pa.Table, depth: int) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Languages and words (distinct), and of every leaf the codes of its
    language and words (-1 behind the end), its total and its mark."""
    lists = _whole(table.column("word"))
    base = np.cumsum(np.append(0, lists.value_lengths().to_numpy()[:-1]))
    word = lists.flatten().dictionary_encode()
    lang = _whole(table.column("lang")).flatten().dictionary_encode()
    word_of, lang_of = (x.indices.to_numpy() for x in (word, lang))

    def joined(name, kind):
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    codes, total, split = joined("codes", "<i4").reshape(-1, depth), joined("n", "<i8"), joined("split", np.uint8)
    sizes = pc.binary_length(_whole(table.column("split"))).to_numpy()
    codes = np.where(codes >= 0, codes + np.repeat(base, sizes)[:, None], -1)
    leaf = np.concatenate([lang_of[codes[:, :1]], np.where(codes >= 0, word_of[codes], -1)], axis=1)
    return lang.dictionary, word.dictionary, leaf, total, split.astype(bool)


def _subtrees(depth: int, least: int):
    """Counts of the nodes of a group: (lang, phrase, size, n)."""

    def run(table: pa.Table) -> pa.Table:
        langs, words, leaves, total, split = _unbundled(table, depth)
        order = np.lexsort(leaves.T[::-1])
        leaves, total, split = leaves[order], total[order], split[order]
        new, out = np.zeros(len(order), bool), []
        new[:1] = True
        for d in range(depth + 1):
            new[1:] |= leaves[1:, d] != leaves[:-1, d]
            if d < 2:
                continue
            first = np.flatnonzero(new)  # the leaves that open a node of d words
            n = np.add.reduceat(total, first)
            keep = (leaves[first, d] >= 0) & ((n >= least) | split[first])
            nodes = leaves[first[keep]]
            phrase = pc.binary_join_element_wise(*(words.take(pa.array(nodes[:, i])) for i in range(1, d + 1)), " ")
            out.append(pa.table({"lang": langs.take(pa.array(nodes[:, 0])), "phrase": phrase,
                                 "size": pa.array(np.full(len(nodes), d, np.int32)), "n": pa.array(n[keep])}))
        return pa.concat_tables(out)

    return run


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", depth: int = DEPTH,
                  min_count: int = MIN_COUNT, budget: int = BUDGET) -> DataFrame:
    """lang, phrase, size, n: every phrase of 1 to ``depth`` words that occurs
    ``min_count`` times or more within pieces of a language's texts, overlaps
    included, and a row of size 0 (phrase null) with the number of all words
    of each language. A stored table."""
    spark = docs.sparkSession
    small_batches(spark)
    src = _source(docs, text_col, lang_col)
    words = src.mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")).where(F.col("word").isNull() | (F.col("n") >= min_count))
    words = stored(words, "words")
    word_bits = spark.sparkContext.broadcast(_bitmap(
        words.where("word is not null").select((F.xxhash64("lang", "word").bitwiseAND(WORD_BITS - 1)).alias("bit")),
        "bit", WORD_BITS))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, codes, hashes in _chunks(batches, word_bits.value):
            slot, n = np.unique(_pair_slots(codes, hashes)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n.astype(np.int64))], names=["slot", "n"])

    slots = stored(src.mapInArrow(pairs, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
                   .where(F.col("n") >= min_count), "slots")
    suffixes = slots.agg(F.sum("n")).first()[0] or 0
    n_groups = max(1, -(-2 * suffixes // budget))
    pair_bits = spark.sparkContext.broadcast((
        _bitmap(slots, "slot", PAIR_BITS), _bitmap(slots.where(F.col("n") > budget // 8), "slot", PAIR_BITS)))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, heavy = (np.frombuffer(x, np.uint8) for x in pair_bits.value)
        for chunk, codes, hashes in _chunks(batches, word_bits.value):
            rows = _bundles(chunk, *_leaves(codes, hashes, wanted, heavy, depth, n_groups))
            yield from rows.to_batches(max_chunksize=max(1, int(BUNDLE_BYTES * len(rows) / max(1, rows.nbytes))))

    nodes = (src.mapInArrow(leaves, BUNDLE)
             .groupBy("part").applyInArrow(_subtrees(depth, min_count), "lang string, phrase string, size int, n long")
             .groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
    singles = words.select("lang", F.col("word").alias("phrase"),
                           F.when(F.col("word").isNull(), 0).otherwise(1).alias("size"), "n")
    out = stored(nodes.unionByName(singles), "phrases")
    drop_stored(words)
    drop_stored(slots)
    return out


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", depth: int = DEPTH,
                 min_count: int = MIN_COUNT, share: int = 100, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of two or
    more words of each language.

    a: occurrences of the phrase; n: words of the language; a cut after the
    first k words gives l and r, the occurrences of the two parts, and the
    score floor(1000 a n / (l r)), exact (decimals); the cut with the lowest
    score counts, ties to the smallest k. A phrase whose words stand within a
    longer one that occurs at least ``share`` percent as often is left out.
    Order: score and a descending, phrase ascending by bytes.

    A text's A-Z are lower-cased; it is split at ``[.,;:!?\\x0A-\\x0D]``, and
    words end at spaces and tabs. Null texts are empty, a null language is
    ``und``. Rows that repeat count each time. Other columns are not read; an
    empty table gives an empty table."""
    counts = phrase_counts(docs, text_col, lang_col, depth, min_count, budget)
    known = counts.where("size > 0").select("lang", "phrase", "n")
    found = counts.where("size > 1").withColumnRenamed("n", "a").withColumn("words", F.split("phrase", " "))
    cuts = found.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k",
                       F.array_join(F.slice("words", 1, F.col("k")), " ").alias("before"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("after"))
    totals = counts.where("size = 0").select("lang", "n")
    if totals.count() <= LANGS:  # else joined by language, which a shuffle deals to as many tasks
        totals = F.broadcast(totals)
    cuts = (cuts.join(known.select("lang", F.col("phrase").alias("before"), F.col("n").alias("l")), ["lang", "before"])
            .join(known.select("lang", F.col("phrase").alias("after"), F.col("n").alias("r")), ["lang", "after"])
            .join(totals, "lang"))
    score = F.expr("(cast(a as decimal(17,0)) * (1000 * cast(n as decimal(17,0)))) "
                   "div (cast(l as decimal(17,0)) * cast(r as decimal(17,0)))")
    best = (cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "n", "cut.*"))
    # a phrase within a longer one is also within one longer by a word, which
    # occurs at least as often as the longer one
    longer = (found.where("size > 2").select("lang", "a", F.explode(F.array(
        F.expr("slice(words, 1, size - 1)"), F.expr("slice(words, 2, size - 1)"))).alias("part"))
        .select("lang", F.array_join("part", " ").alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = best.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    w = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (kept.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
