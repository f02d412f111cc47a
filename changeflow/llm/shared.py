"""Helpers of the training-data operators: shared storage, input columns,
bounded caches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()
#: bytes.translate table that lower-cases A-Z only
LOWER_TABLE = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())
#: the white space of ``[\x20\x09-\x0D]``
BLANKS = " \t\n\x0b\x0c\r"

CLEAN_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
#: bytes of rows that a Python worker gets at once; texts may be long
BATCH_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder driver and executors share: ``spark.checkpoint.dir`` of the
    session, else the context's checkpoint folder. Only where neither is set
    (tests on a local master) a scratch folder is made and set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="changeflow-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return "%s/llm-%s-%s" % (shared_dir(spark), name, uuid.uuid4().hex)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Spark removes a query's shuffle files as soon as that query ends."""
    before = spark.conf.get(CLEAN_KEY, None)
    spark.conf.set(CLEAN_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_KEY)
        else:
            spark.conf.set(CLEAN_KEY, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives
    the loss of executors, and gives the planner true sizes."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove a table that ``stored`` made and nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, for tables with long texts. The
    number of rows stays as the session has it, so that queries on narrow rows
    keep their large batches."""
    spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns, as ``doc_id`` and ``text`` (null: empty), so that
    further columns of the input can't clash with those of an operator."""
    return df.select(df[id_col].alias("doc_id"),
                     F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes not to
    be a column of ``df`` (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def text_key(text: Column | str) -> list[Column]:
    """128 bits that stand for a text, as two columns ``t1`` and ``t2``."""
    col = F.col(text) if isinstance(text, str) else text
    return [F.xxhash64(col).alias("t1"), F.xxhash64(F.lit("second"), col).alias("t2")]


class BoundedCache(dict):
    """A memo of at most ``size`` entries; emptied when full."""

    def __init__(self, compute, size: int):
        super().__init__()
        self.compute, self.size = compute, size

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.size:
            self.clear()
        if len(key) <= 64:
            self[key] = value
        return value


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes."""
    return text.translate(LOWER_TABLE).split()


def has_letter(text: str) -> bool:
    """Whether a character is a letter (Unicode category L); numerals such as
    a half sign or a Roman one are not."""
    return any(map(str.isalpha, text))
