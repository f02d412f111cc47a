"""Benchmark decontamination: which test items stand in which documents.

Size-partitioned MinHash containment search. A long document's own MinHash
says nothing about a short passage inside it, so the sketch is taken of the
item: the ``k`` smallest shingle hashes of an item (its bottom-k MinHash
sketch) are looked up among all shingle hashes of a document.

* Size partitions: items are partitioned by their number of shingles, powers
  of two apart. The partition of an item with q shingles fixes its sketch
  length, ``q - ceil(threshold * q) + 1``: a document that holds ``threshold``
  of the shingles must hold one of so many, whichever they are, so the search
  loses nothing. A document of fewer shingles than an item's partition asks
  for skips the whole partition.
* Candidates are verified by exact shingle containment, on the shingles
  themselves, not their hashes.

The items are a stated query set; they are sent to the tasks in blocks of at
most ``BLOCK_WORDS`` words (a proven bound), one pass over the documents per
block. Documents are never shuffled.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import BoundedCache, free_names, id_and_text, small_batches, words_of

SHINGLE = 5
THRESHOLD = 0.8
BLOCK_WORDS = 2_000_000
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 7)


def shingle_hashes(words: list[bytes], cache, size: int = SHINGLE) -> np.ndarray:
    """A 64-bit hash per shingle of ``size`` words, in order of the text;
    fewer words: one shingle of all of them."""
    size = min(size, len(words))
    each = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = (out ^ (out >> np.uint64(29))) * _MIX[i % 5] + each[i:i + n]
    return out ^ (out >> np.uint64(32))


def shingles(words: list[bytes], size: int = SHINGLE) -> set[bytes]:
    if len(words) <= size:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)}


def needed(q: int, threshold: float) -> int:
    """How many of q shingles a document must hold."""
    return max(1, math.ceil(threshold * q - 1e-9))


class ItemIndex:
    """Sketches of a block of items, by size partition."""

    def __init__(self, items: list[tuple[int, list[bytes]]], size: int, threshold: float):
        self.size, self.threshold, self.items = size, threshold, []
        cache = BoundedCache(_word_hash, 100_000)
        sketches: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for item_id, words in items:
            whole = shingles(words, size)
            if not whole:
                continue
            hashes = np.unique(shingle_hashes(words, cache, size))
            k = len(whole) - needed(len(whole), threshold) + 1
            sketches[len(whole).bit_length()] += [(int(h), len(self.items)) for h in hashes[:k]]
            # an item of fewer than ``size`` words only equals whole documents
            self.items.append((item_id, whole, len(words) if len(words) < size else 0))
        self.partitions = []
        for bits, pairs in sorted(sketches.items()):
            owners = defaultdict(list)
            for h, at in pairs:
                owners[h].append(at)
            keys = np.array(sorted(owners), np.uint64)
            self.partitions.append((needed(1 << (bits - 1), threshold), keys, [owners[int(h)] for h in keys]))

    def candidates(self, hashes: np.ndarray) -> set[int]:
        found: set[int] = set()
        for least, keys, owners in self.partitions:
            if len(hashes) < least:  # this and all larger partitions ask for more
                break
            at = np.searchsorted(keys, hashes)
            at[at == len(keys)] = 0
            for i in np.unique(at[keys[at] == hashes]).tolist():
                found.update(owners[i])
        return found

    def search(self, words: list[bytes], cache) -> list[tuple[int, int, int]]:
        """(item_id, shingles of the item, those the document holds)."""
        if not words:
            return []
        hits = self.candidates(shingle_hashes(words, cache, self.size))
        if not hits:
            return []
        own, out = shingles(words, self.size), []
        for at in sorted(hits):
            item_id, whole, short = self.items[at]
            if short and short != len(words):
                continue
            held = len(whole & own)
            if held >= needed(len(whole), self.threshold):
                out.append((item_id, len(whole), held))
        return out


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Blocks of at most BLOCK_WORDS words, streamed to the driver."""
    block, size = [], 0
    for r in items.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        words = words_of((r.t or "").encode())
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((r.i, words))
        size += len(words)
    yield block


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text",
                 size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_held, containment) for every row of
    ``docs`` and item of which the document holds ``threshold`` or more of the
    distinct shingles of ``size`` words (A-Z lower-cased, split at blanks).

    Items of fewer words are one shingle of all their words and only found in
    documents of exactly these words. Null, empty and blank texts hold nothing
    and are held by nothing. Repeated rows give repeated results; null ids are
    carried along; empty tables give an empty table. Other columns of the
    inputs are not read."""
    spark = docs.sparkSession
    small_batches(spark)
    src = id_and_text(docs, id_col, text_col)
    schema = T.StructType([src.schema.fields[0], T.StructField("item_id", items.schema[item_id_col].dataType),
                           T.StructField("n_shingles", T.LongType()), T.StructField("n_held", T.LongType()),
                           T.StructField("containment", T.DoubleType())])
    found = None
    for block in _item_blocks(items, item_id_col, item_text_col):
        sent = spark.sparkContext.broadcast(block)
        part = src.mapInArrow(_scan(sent, size, threshold), schema)
        found = part if found is None else found.unionByName(part)
    return found


def _scan(sent, size: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, cache = ItemIndex(sent.value, size, threshold), BoundedCache(_word_hash, 300_000)
        for b in batches:
            at, rows = [], []
            for i, text in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                for row in index.search(words_of(text), cache):
                    at.append(i)
                    rows.append((*row, row[2] / row[1]))
            if rows:
                item, n, held, share = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), pa.array(item), pa.array(n, pa.int64()),
                     pa.array(held, pa.int64()), pa.array(share, pa.float64())],
                    names=["doc_id", "item_id", "n_shingles", "n_held", "containment"])

    return run


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """The rows of ``docs`` that hold no item. Rows are told apart by id and
    text, so a clean row stays even if another row of its id is not clean."""
    key, bad = free_names(docs, "key", "bad")
    text = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    marked = docs.withColumn(key, F.struct(docs[id_col].alias("id"), text.alias("t")))
    found = contaminated(marked, items, key, text_col, **options).select(F.col("doc_id").alias(bad)).distinct()
    return marked.join(found, F.col(key).eqNullSafe(F.col(bad)), "left_anti").drop(key)
