"""Integrity of the raw layer: duplicates, per-partition continuity and a
verdict (G1-G3). Works on any frame with a (partition, offset) pair.

``duplicate_count`` and ``continuity`` shuffle every different offset.
``offset_bitmaps`` keeps a partition's offsets as bitmaps of 32,768 each, built
by map-side aggregates, so a dense partition costs one bit an offset; counts,
bounds, the verdict and the missing ranges all come from that one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 15


def as_queue(df: DataFrame, partition_col: str, offset_col: str) -> DataFrame:
    """View any table as queue coordinates (text, as in the envelope)."""
    return df.select(F.col(partition_col).cast("string").alias("particion"),
                     F.col(offset_col).cast("string").alias("desplazamiento"))


def duplicate_count(df: DataFrame, keys=("particion", "desplazamiento")) -> DataFrame:
    """G1: total rows, distinct key tuples, duplicates = difference.

    The tuple is counted as a struct on purpose: COUNT(DISTINCT a, b) skips
    every row where a part is NULL (a queue without partition ids would look
    all-duplicate)."""
    return (df.agg(F.count(F.lit(1)).alias("filas"),
                   F.count_distinct(F.struct(*keys)).alias("distintos"))
            .withColumn("duplicados", F.col("filas") - F.col("distintos")))


def continuity(df: DataFrame, partition_col: str = "particion",
               offset_col: str = "desplazamiento") -> DataFrame:
    """Per partition rows, distinct offsets, first, last, gaps, and rows
    whose offset is no integer (they can neither fill nor show a gap).

    Gaps are counted over distinct offsets, (last - first + 1) - distinct,
    so a duplicate cannot hide a gap in the same partition. Offsets that are
    not integers give NULL bounds instead of an error."""
    off = F.expr("try_cast(%s AS BIGINT)" % offset_col)
    per = (df.select(F.col(partition_col).alias("particion"), off.alias("_off"))
           .groupBy("particion")
           .agg(F.count(F.lit(1)).alias("filas"),
                F.count_distinct("_off").alias("distintos"),
                F.min("_off").alias("primero"),
                F.max("_off").alias("ultimo"),
                F.count(F.when(F.col("_off").isNull(), 1)).alias("ilegibles")))
    return (per.withColumn("huecos", F.col("ultimo") - F.col("primero") + 1 - F.col("distintos"))
            .orderBy(F.expr("try_cast(particion AS INT)"), F.col("particion")))


def verdict(df: DataFrame, contiguous: bool = True, keys=("particion", "desplazamiento")) -> DataFrame:
    """One row; ok iff no duplicates and, for a source with consecutive
    offsets, no gaps and no offset that cannot be read. A source whose offsets
    only grow is judged on duplicates alone (``contiguous=False``)."""
    dup = duplicate_count(df, keys)
    if contiguous:
        gaps = continuity(df, keys[0], keys[1]).agg(
            F.coalesce(F.sum("huecos"), F.lit(0)).cast("long").alias("huecos"),
            F.coalesce(F.sum("ilegibles"), F.lit(0)).cast("long").alias("ilegibles"))
    else:
        nothing = F.lit(None).cast("long")
        gaps = df.sparkSession.range(1).select(nothing.alias("huecos"), nothing.alias("ilegibles"))
    clean = ((F.col("duplicados") == 0) & (F.coalesce(F.col("huecos"), F.lit(0)) == 0)
             & (F.coalesce(F.col("ilegibles"), F.lit(0)) == 0))
    return (dup.crossJoin(gaps)
            .select("filas", "distintos", "duplicados", "huecos", "ilegibles",
                    F.lit(contiguous).alias("contiguo"), clean.alias("ok")))


def offset_bitmaps(df: DataFrame, partition_cols=("particion",), offset_col: str = "desplazamiento") -> DataFrame:
    """Per partition and bucket of 2^15 offsets: tramo (NULL: offsets that are
    no integers), filas, primero, ultimo, bits (offset modulo 2^15), and
    ``raros``: rows whose offset text is not the usual form of its number
    (``007``); such rows repeat a number, not a message.

    With several origins in one table give both columns, e.g. ("origen",
    "particion"): offsets of different topics are no gaps of each other."""
    off = F.expr("try_cast(%s AS BIGINT)" % offset_col)
    rows = df.select(*partition_cols, off.alias("_off"), F.col(offset_col).cast("string").alias("_text"))
    odd = F.col("_off").isNotNull() & (F.col("_off").cast("string") != F.col("_text"))
    return (rows.groupBy(*partition_cols, F.shiftright("_off", BUCKET_BITS).alias("tramo"))
            .agg(F.count(F.lit(1)).alias("filas"), F.min("_off").alias("primero"), F.max("_off").alias("ultimo"),
                 F.bitmap_construct_agg(F.col("_off").bitwiseAND((1 << BUCKET_BITS) - 1)).alias("bits"),
                 F.count(F.when(odd, 1)).alias("raros")))


def continuity_from_bitmaps(bitmaps: DataFrame, partition_cols=("particion",)) -> DataFrame:
    """G2 from ``offset_bitmaps``: the columns of ``continuity``."""
    known = F.col("tramo").isNotNull()
    per = bitmaps.groupBy(*partition_cols).agg(
        F.sum("filas").cast("long").alias("filas"),
        F.coalesce(F.sum(F.when(known, F.bitmap_count("bits"))), F.lit(0)).cast("long").alias("distintos"),
        F.min("primero").alias("primero"), F.max("ultimo").alias("ultimo"),
        F.coalesce(F.sum(F.when(~known, F.col("filas"))), F.lit(0)).cast("long").alias("ilegibles"))
    return per.withColumn("huecos", F.col("ultimo") - F.col("primero") + 1 - F.col("distintos"))


def gap_ranges(bitmaps: DataFrame, partition_cols=("particion",)) -> DataFrame:
    """The partition columns, desde, hasta, faltan: every maximal range of
    missing offsets between a partition's first and last one.

    A gap inside a bucket is a run of zeros in its bits; a gap that crosses
    buckets lies between the last offset of one and the first of the next
    bucket there is. The window over buckets reads a row per 2^15 offsets."""
    keys, known = list(partition_cols), bitmaps.where(F.col("tramo").isNotNull())
    order = Window.partitionBy(*keys).orderBy("tramo")
    between = (known.select(*keys, (F.lag("ultimo").over(order) + 1).alias("desde"), (F.col("primero") - 1).alias("hasta"))
               .where(F.col("desde") <= F.col("hasta")))
    last = (1 << BUCKET_BITS) - 1
    # a byte's lowest bit is its first offset; only the bytes from the first to the last offset are spelt out
    digits = F.expr("array_join(transform(sequence(cast((primero & %d) div 8 as int), cast((ultimo & %d) div 8 as int)), "
                    "i -> reverse(lpad(conv(hex(substring(bits, i + 1, 1)), 16, 2), 8, '0'))), '')" % (last, last))
    span = F.expr("cast(ultimo - primero + 1 as int)")
    runs = (known.where(F.bitmap_count("bits") < span)
            .select(*keys, "tramo", "primero", F.posexplode(F.regexp_extract_all(
                F.substr(digits, F.expr("cast(primero & 7 as int) + 1"), span), F.lit("0+|1+"), F.lit(0)))
                .alias("_i", "_run")))
    before = Window.partitionBy(*keys, "tramo").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    length = F.char_length("_run")
    runs = runs.withColumn("desde", F.col("primero") + F.coalesce(F.sum(length).over(before), F.lit(0)))
    inside = runs.where(F.col("_run").startswith("0")).select(*keys, "desde", (F.col("desde") + length - 1).alias("hasta"))
    return between.unionByName(inside).withColumn("faltan", F.col("hasta") - F.col("desde") + 1)


def verdict_from_bitmaps(bitmaps: DataFrame, partition_cols=("particion",)) -> DataFrame:
    """G3 for a source with consecutive offsets, from one aggregate: the
    columns of ``verdict``. A message is its partition and the number of its
    offset; offsets that are no numbers are not told apart (``distintos``
    leaves them out) and fail the verdict as unreadable."""
    total = continuity_from_bitmaps(bitmaps, partition_cols).agg(*[
        F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("filas", "distintos", "huecos", "ilegibles")])
    dups = F.col("filas") - F.col("ilegibles") - F.col("distintos")
    return total.select("filas", "distintos", dups.alias("duplicados"), "huecos", "ilegibles", F.lit(True).alias("contiguo"),
                        ((dups == 0) & (F.col("huecos") == 0) & (F.col("ilegibles") == 0)).alias("ok"))
