"""Layer tables: creation, batch and streaming scans.

Tables are Parquet folders partitioned by day (``dia``) and compressed with
zstd. A folder written by a streaming sink carries a ``_spark_metadata``
log, and every scan of it (batch or stream) lists only committed files.
With an Iceberg catalog on the cluster, pass ``fmt="iceberg"`` and a table
name instead of a folder.
"""

from __future__ import annotations

import json
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.schemas import LAYERS
from changeflow.sources import files

PARTITION_COL = "dia"
TARGET_FILE_BYTES = 128 * 1024 * 1024


def layer_path(warehouse: str, layer: str) -> str:
    return "%s/%s" % (warehouse.rstrip("/"), layer)


def table_schema(layer: str) -> T.StructType:
    """Schema of a layer as stored: its columns plus the day partition."""
    schema, _ = LAYERS[layer]
    return T.StructType(schema.fields + [T.StructField(PARTITION_COL, T.DateType())])


def table_ddl(layer: str, warehouse: str, database: str = "changeflow", fmt: str = "parquet") -> str:
    """The statement that creates one layer table. Parquet: a folder of the
    warehouse, partitioned by the stored day. Iceberg: a catalog table with a
    hidden day partition of its time column and files of the target size."""
    schema, time_col = LAYERS[layer]
    name = "%s.%s" % (database, layer)
    if fmt == "iceberg":
        cols = ", ".join("`%s` %s" % (f.name, f.dataType.simpleString()) for f in schema.fields)
        return ("CREATE TABLE IF NOT EXISTS %s (%s) USING iceberg PARTITIONED BY (days(%s)) TBLPROPERTIES ("
                "'write.target-file-size-bytes'='%d', 'write.parquet.compression-codec'='zstd')"
                % (name, cols, time_col, TARGET_FILE_BYTES))
    cols = ", ".join("`%s` %s" % (f.name, f.dataType.simpleString()) for f in table_schema(layer).fields)
    return ("CREATE TABLE IF NOT EXISTS %s (%s) USING parquet PARTITIONED BY (%s) "
            "LOCATION '%s' OPTIONS (compression 'zstd')" % (name, cols, PARTITION_COL, layer_path(warehouse, layer)))


def ensure_tables(spark: SparkSession, warehouse: str, database: str = "changeflow",
                  fmt: str = "parquet") -> list[str]:
    """B1: create the database and the layer tables if absent (idempotent)."""
    spark.sql("CREATE DATABASE IF NOT EXISTS %s" % database)
    for layer in LAYERS:
        spark.sql(table_ddl(layer, warehouse, database, fmt))
    return ["%s.%s" % (database, layer) for layer in LAYERS]


def is_folder(name_or_path: str) -> bool:
    """Folders have a slash or a scheme, catalog names have neither."""
    return "/" in name_or_path or ":" in name_or_path


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet",
               layer: str | None = None, since: str | None = None) -> DataFrame:
    """Batch scan of a layer, by catalog name or by path (no catalog).
    With ``layer`` the fixed schema is used (an empty table still scans).
    ``since`` (timestamp text) keeps rows from then on and adds the matching
    day predicate, so whole day partitions are pruned at planning time. A
    table without the stored day (a hidden partition of its time column)
    prunes by the time itself."""
    if is_folder(name_or_path):
        reader = spark.read.format(fmt)
        if layer is None:
            layer = name_or_path.rstrip("/").rsplit("/", 1)[-1]
        if fmt == "parquet" and layer in LAYERS:
            reader = reader.schema(table_schema(layer))
        df = reader.load(name_or_path)
    else:
        df = spark.table(name_or_path)
        layer = layer or name_or_path.rsplit(".", 1)[-1]
    if since is not None and layer in LAYERS:
        time_col = LAYERS[layer][1]
        if PARTITION_COL in df.columns:
            df = df.filter(F.col(PARTITION_COL) >= F.to_date(F.lit(since)))
        df = df.filter(F.col(time_col) >= F.to_timestamp(F.lit(since)))
    return df


def table_exists(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> bool:
    """A table may be missing legitimately: its job has not run yet. A folder
    of a layer has a fixed schema, so there its existence is asked first."""
    if fmt == "parquet" and is_folder(name_or_path) and not files.names(spark, name_or_path):
        return False
    if is_folder(name_or_path):
        try:
            read_table(spark, name_or_path, fmt).schema  # noqa: B018
            return True
        except AnalysisException as e:  # any other fault (storage, rights) is raised
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
    return spark.catalog.tableExists(name_or_path)


def stream_table(spark: SparkSession, path: str, layer: str, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A5: streaming scan of a layer folder with its fixed schema."""
    reader = spark.readStream.format(fmt)
    if fmt == "parquet":
        reader = reader.schema(table_schema(layer))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def compact_day(spark: SparkSession, src: str, dst: str, layer: str, day: str,
                target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite one day partition of a layer into files of about
    ``target_bytes`` (a stream writes one small file per task and batch).

    The output goes to another folder (``dst``), overwriting only that day
    there (dynamic partition overwrite): a streaming sink's own folder is
    listed by its commit log and must not be rewritten in place. Returns
    the number of files written. The day's record (see ``compactions``) comes
    last, so a day without one was not finished."""
    part = "%s/%s=%s" % (src.rstrip("/"), PARTITION_COL, day)
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(part)
             .agg(F.count("length").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("size")).first())
    n_files = max(1, -(-found["size"] // int(target_bytes)))
    rows = read_table(spark, src, layer=layer).filter(F.col(PARTITION_COL) == F.to_date(F.lit(day)))
    (rows.repartition(n_files)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd")
     .partitionBy(PARTITION_COL)
     .parquet(dst))
    written = footer_scan(spark, dst, layer).filter(F.col(PARTITION_COL) == F.to_date(F.lit(day)))
    files.write_text(spark, "%s/%s/%s.json" % (dst.rstrip("/"), RECORDS, day), json.dumps({
        "day": day, "committed_ms": int(time.time() * 1000), "rows": written.count(),
        "files_before": found["n"], "files_after": n_files, "bytes_before": found["size"]}))
    return n_files


#: folder of a compacted table's records; scans skip names with an underscore
RECORDS = "_compactions"
COMPACTION = "day string, committed_ms long, rows long, files_before long, files_after long, bytes_before long"


def compactions(spark: SparkSession, path: str) -> DataFrame:
    """A row per compacted day of a folder: when, rows, files and bytes.
    Empty for a folder that no job compacts."""
    folder = "%s/%s" % (path.rstrip("/"), RECORDS)
    if not files.names(spark, folder):
        return spark.createDataFrame([], COMPACTION)
    return spark.read.schema(COMPACTION).json(folder)


def compact_closed_days(spark: SparkSession, src: str, dst: str, layer: str,
                        target_bytes: int = TARGET_FILE_BYTES) -> list[tuple[str, int]]:
    """Compact every day of a layer but the newest one (a stream may still
    write to it) that ``dst`` does not hold yet: (day, files). Run it daily;
    readers of old days use ``dst``."""
    prefix = PARTITION_COL + "="
    days = {n[len(prefix):] for n in files.names(spark, src) if n.startswith(prefix) and n[len(prefix):len(prefix) + 1].isdigit()}
    done = {n.removesuffix(".json") for n in files.names(spark, "%s/%s" % (dst.rstrip("/"), RECORDS))}
    return [(day, compact_day(spark, src, dst, layer, day, target_bytes)) for day in sorted(days - {max(days, default="")} - done)]


V1_LIST = "spark.sql.sources.useV1SourceList"


def footer_scan(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """Batch scan of a stored layer by the v2 Parquet source, which answers
    counts and bounds of numbers from the files' footers, also per day: no
    column is read. (Bounds of timestamps are not kept there; a day's rows
    are found by its partition.)"""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    before = spark.conf.get(V1_LIST)
    spark.conf.set(V1_LIST, ",".join(x for x in before.split(",") if x != "parquet"))
    try:
        return spark.read.schema(table_schema(layer)).parquet(path)
    finally:
        spark.conf.set(V1_LIST, before)


def newest_day(spark: SparkSession, name_or_path: str, layer: str) -> DataFrame:
    """The rows of a layer's newest day: the day is the maximum of the
    partition column, and only its folder is read. Without a stored day it is
    the day of the newest time, and the bound on the time prunes."""
    rows = read_table(spark, name_or_path, layer=layer)
    if PARTITION_COL not in rows.columns:
        newest = rows.agg(F.max(LAYERS[layer][1])).first()[0]
        return rows if newest is None else rows.filter(
            F.col(LAYERS[layer][1]) >= F.date_trunc("day", F.lit(newest)))
    day = rows.agg(F.max(PARTITION_COL).alias("dia"))
    return rows.join(F.broadcast(day), PARTITION_COL, "left_semi")


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Store a frame as a table bucketed and sorted by ``keys``: grouping and
    joining by them needs no exchange. Two tables that are to be joined need
    the same number of buckets."""
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
     .option("compression", "zstd").mode("overwrite").format("parquet").saveAsTable(table))
    return df.sparkSession.table(table)
