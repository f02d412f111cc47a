"""Small metadata files on whatever store the cluster uses (Hadoop FS)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it does not exist."""
    _, path, fs = _open(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    jvm, p, fs = _open(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def modified_ms(spark: SparkSession, path: str) -> int | None:
    """When a file was written, None if it does not exist."""
    _, p, fs = _open(spark, path)
    return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else None


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Remove single files."""
    for path in paths:
        _, p, fs = _open(spark, path)
        fs.delete(p, False)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    _, p, fs = _open(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def deliver(spark: SparkSession, path: str, to: str, modified_ms: int) -> None:
    """Move a finished file into a watched folder, with the time by which a
    file stream orders its input."""
    jvm, p, fs = _open(spark, path)
    target = jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError("cannot move %s to %s" % (path, to))
    fs.setTimes(target, modified_ms, -1)


def signature(spark: SparkSession, path: str) -> tuple:
    """What tells a rewritten file or folder of files from what it was."""
    _, p, fs = _open(spark, path)
    if not fs.exists(p):
        return ()
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)))
