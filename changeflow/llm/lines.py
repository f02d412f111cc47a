"""Line dedup: lines that many documents hold stay in one document only.

Only DataFrame and SQL functions. Every line of at least ``min_chars`` code
points becomes one small row (128-bit hash of its key, document, position);
texts are not shuffled for the search.

1. The hash space is cut into equal ranges; rows go to (range, salt of the
   document), so that a line which a third of all documents hold is spread
   over ``SALTS`` tasks. Each partition is sorted by hash, document
   (descending) and position and read as a stream: the first document of a
   hash is the one to keep, those after it are counted.
2. Rows behind the ``min_docs`` first documents of their salt are certain to
   go. At most ``min_docs`` documents per hash and salt meet by hash range in
   a second pass of the same form, which decides the rest exactly.
3. Dropped positions become sparse 64-line keep masks per document
   (``bit_or`` with map-side combine), and only these join the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import ASCII_LOWER, ASCII_UPPER, BLANKS, free_names, id_and_text

SALTS = 32
RANGE_BITS = 12


def _line_rows(src: DataFrame, min_chars: int) -> DataFrame:
    keys = F.transform(F.split("text", "\n", -1),
                       lambda x: F.btrim(F.translate(x, ASCII_UPPER, ASCII_LOWER), F.lit(BLANKS)))
    # the hash of a text is computed below the explode: once a text, not once a line
    return (src.select("doc_id", F.xxhash64("text").alias("t1"), keys.alias("keys"))
            .select("doc_id", "t1", F.posexplode("keys").alias("line_no", "key"))
            .where(F.char_length("key") >= min_chars)
            .select("doc_id", "t1", "line_no", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit("second"), "key").alias("h2")))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document that loses lines: doc_id, t1 (hash of its text, which
    tells apart rows that share an id) and ``keep``, the compressed bitmap: an
    array of (word, mask) for those words of 64 lines that have a dropped
    line, bit i of word w set if line 64 w + i stays. Words that are not
    listed stay whole.

    Rows of one doc_id count as one document. A null id is a document that
    sorts below all others."""
    rows = _line_rows(id_and_text(docs, id_col, text_col), min_chars)
    rows = (rows.withColumn("range_id", F.shiftrightunsigned("h1", 64 - RANGE_BITS))
            .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
            .repartition("range_id", "salt"))
    first = _ranked(rows, ["range_id", "salt", "h1", "h2"])
    # rows that are certain to go leave the hash's group, so it stays bounded
    first = (first.withColumn("part", F.when(F.col("rank") > min_docs, F.col("salt") + 1).otherwise(0))
             .select("doc_id", "t1", "line_no", "h1", "h2", "range_id", "part")
             .repartition("range_id", "part"))
    keys = ["range_id", "part", "h1", "h2"]
    second = _ranked(first, keys).withColumn("docs", F.max("rank").over(Window.partitionBy(*keys)))
    gone = second.where((F.col("part") > 0) | ((F.col("docs") >= min_docs) & (F.col("rank") >= 2)))
    words = (gone.select("doc_id", "t1", F.floor(F.col("line_no") / 64).cast("int").alias("word"),
                         F.expr("shiftleft(1L, line_no % 64)").alias("bit"))
             .groupBy("doc_id", "t1", "word").agg(F.bit_or("bit").alias("bits")))
    return words.groupBy("doc_id", "t1").agg(
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("mask")))).alias("keep"))


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rank``: 1 for rows of the largest document of a hash, 2 for the next."""
    w = Window.partitionBy(*keys).orderBy(F.col("doc_id").desc_nulls_last(), "line_no")
    before = F.lag(F.struct("doc_id")).over(w)
    opens = F.when(before.isNull() | ~before.eqNullSafe(F.struct("doc_id")), 1).otherwise(0)
    return (rows.withColumn("opens", opens)
            .withColumn("rank", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .drop("opens"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All columns of ``docs`` plus ``kept_text``, ``n_lines`` (before) and
    ``n_dropped``.

    A line's key is the line without blanks at both ends, A-Z lower-cased.
    Keys of at least ``min_chars`` code points that ``min_docs`` or more
    documents hold lose their lines except in the largest id that holds them
    (all of that document's lines with the key stay). A null or empty text is
    one empty line. Repeated rows of one id are one document and are treated
    alike; an empty table gives an empty table. Columns of the input named
    like the added ones are replaced."""
    doc, key, keep, text = free_names(docs, "doc", "key", "keep", "whole_text")
    maps = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs).select(
        F.col("doc_id").alias(doc), F.col("t1").alias(key), F.col("keep").alias(keep))
    added = ["kept_text", "n_lines", "n_dropped"]
    src = docs.drop(*[c for c in added if c not in (id_col, text_col)])
    src = src.withColumn(text, F.coalesce(src[text_col].cast("string"), F.lit("")))
    both = src.join(maps, src[id_col].eqNullSafe(F.col(doc)) & (F.xxhash64(text) == F.col(key)), "left")
    # a mask for every word up to the last listed one, made once per text and looked up by place
    masks = (f"flatten(transform({keep}, (x, i) -> concat(array_repeat(-1L, x.word - coalesce(get({keep}, i - 1).word, -1) - 1), "
             "array(x.mask))))")
    kept = F.expr(f"get(transform(array({masks}), m -> array_join(filter(split({text}, '\n', -1), (l, i) -> "
                  "getbit(coalesce(get(m, cast(i div 64 as int)), -1L), i % 64) = 1), '\n')), 0)")
    both = both.withColumn("kept_text", F.when(F.col(keep).isNull(), F.col(text)).otherwise(kept))
    dropped = F.expr(f"coalesce(aggregate({keep}, 0L, (a, x) -> a + 64 - bit_count(x.mask)), 0L)")
    return (both.withColumn("n_lines", F.size(F.split(text, "\n", -1)).cast("long"))
            .withColumn("n_dropped", dropped).drop(text, doc, key, keep))
