"""Running maximum and quantiles over one global order, without one task
seeing it all.

A plain ``max() OVER (ORDER BY ...)`` has no partition key, so Spark moves
every row into a single task. Here the rows are range-partitioned on the
order, frozen with a reliable checkpoint so that partition ids are stable
across the passes, and every pass carries one row per partition (a size that
is bounded by the partition count, not by the data, so it may be broadcast).

* ``prefix_max_before``: a partition's carry is the maximum of all earlier
  partitions; a window inside each partition does the rest. The order must
  have a tie-breaker, or equal rows meet in one range.
* ``exact_quantiles``: equal values are counted first (map-side combine, so a
  value that most rows share is one row per task), and the distinct values
  are ranged; only the few partitions that hold a wanted rank are ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.session import ensure_checkpoint_dir


def prefix_max_before(df: DataFrame, order_cols: list[str], value_col: str, out_col: str,
                      partitions: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """Add ``out_col`` = max(``value_col``) over all rows strictly earlier in
    the total order ``order_cols`` (NULL for the first row). ``value_col``
    must be numeric (cast timestamps to microseconds first). Only the columns
    ``keep`` (default: all) go through the scan and come out."""
    wanted = None if keep is None else [*dict.fromkeys([*keep, *order_cols, value_col])]
    ranged = _ranged(df, order_cols, partitions, wanted)
    part_max = ranged.groupBy("_pid").agg(F.max(value_col).cast("double").alias("_pmax"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = part_max.select("_pid", F.max("_pmax").over(before).alias("_carry"))  # a row per partition
    within = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    scanned = (ranged.withColumn(out_col, F.max(F.col(value_col).cast("double")).over(within))
               .join(F.broadcast(carry), "_pid", "left")
               .withColumn(out_col, F.greatest(out_col, "_carry")))
    return scanned.select(*(keep if keep is not None else df.columns), out_col)


def _ranged(df: DataFrame, order_cols: list[str], partitions: int | None,
            keep: list[str] | None = None) -> DataFrame:
    """Range-partition on the order, sort inside partitions, number the
    partitions and freeze the result (reliable checkpoint). Without an
    explicit count AQE coalesces adjacent ranges to its advisory size, so
    the partition count follows the data volume; merged ranges stay in
    order, so partition ids still follow the global order."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    byrange = (df.repartitionByRange(partitions, *order_cols) if partitions
               else df.repartitionByRange(*order_cols))
    ordered = byrange.sortWithinPartitions(*order_cols)
    if keep is not None:
        ordered = ordered.select(*keep)
    return ordered.withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)


def exact_quantiles(df: DataFrame, col: str, probs: dict[str, float],
                    partitions: int | None = None) -> DataFrame:
    """Exact quantiles (linear interpolation between the closest ranks,
    ``lo + (hi - lo) * frac`` at rank (n - 1) * p) of a numeric column,
    as one row with one column per name in ``probs``. NULLs are ignored;
    an empty input gives NULLs.

    Unlike ``percentile`` no task merges the counts of all values: values are
    ranged with their counts, the ranks at which a partition begins come from
    the partitions' sums, and the running count is built only in the (at most
    two per quantile) partitions that hold a wanted rank."""
    return summary(df, col, probs, partitions).select(*probs)


def summary(df: DataFrame, col: str, probs: dict[str, float], partitions: int | None = None) -> DataFrame:
    """One row: valores, nulos, minimo, maximo and the quantiles of
    ``exact_quantiles``, all from one pass over ``df``: the counts of its
    values are frozen, and everything else reads them."""
    counts = df.select(F.col(col).cast("double").alias("_v")).groupBy("_v").agg(F.count(F.lit(1)).alias("_c"))
    frozen = _ranged(counts, ["_v"], partitions)
    null = F.col("_v").isNull()
    edges = frozen.agg(F.coalesce(F.sum(F.when(~null, F.col("_c"))), F.lit(0)).cast("long").alias("valores"),
                       F.coalesce(F.sum(F.when(null, F.col("_c"))), F.lit(0)).cast("long").alias("nulos"),
                       F.min("_v").alias("minimo"), F.max("_v").alias("maximo"))
    ranged = frozen.where(~null).withColumnRenamed("_c", "_n")
    sizes = ranged.groupBy("_pid").agg(F.sum("_n").alias("_s"))
    every = Window.orderBy("_pid")  # over one row per partition
    marks = sizes.select("_pid", "_s", (F.sum("_s").over(every) - F.col("_s")).alias("_off"),
                         F.sum("_s").over(Window.partitionBy()).alias("_total"))
    at = {name: (F.col("_total") - 1).cast("double") * F.lit(float(p)) for name, p in probs.items()}
    ranks = [f(pos).cast("long") for pos in at.values() for f in (F.floor, F.ceil)]
    inside = F.lit(False)
    for r in ranks:
        inside = inside | ((r >= F.col("_off")) & (r < F.col("_off") + F.col("_s")))
    near = ranged.join(F.broadcast(marks.where(inside)), "_pid")
    w = Window.partitionBy("_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_upto", F.col("_off") + F.sum("_n").over(w))

    def value(rank):
        return F.max(F.when((F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank), F.col("_v")))

    out = []
    for name, pos in at.items():
        lo, hi, frac = value(F.floor(pos)), value(F.ceil(pos)), F.max(pos - F.floor(pos))
        out.append((lo + (hi - lo) * frac).alias(name))
    return edges.crossJoin(near.agg(*out))
