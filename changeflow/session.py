"""Session settings shared by every job."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job needs for correct results: UTC so that event-time text
# with a literal zone and window boundaries do not move with the host zone.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings for scale: AQE re-plans joins and shuffle sizes at runtime; the
# RocksDB state store keeps large dedup / window state off the JVM heap and
# changelog checkpointing uploads only the delta per micro-batch.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # The default keeps 100 state versions; checkpoints then outgrow the data.
    "spark.sql.streaming.minBatchesToRetain": "10",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The ordered passes freeze data with reliable checkpoints; remove those
    # files once nothing references them (set when the context starts).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "changeflow",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the required and scale settings.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf.update(REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_required(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_required(spark: SparkSession) -> None:
    """Pin the settings results depend on, also on a session made elsewhere."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if not value:
        value = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared checkpoint folder the cluster names. Only a local
    master (tests, a laptop) may fall back to a fresh scratch folder; on a
    cluster an unset ``spark.checkpoint.dir`` is an error, because a
    machine-local folder does not survive the loss of an executor."""
    root = checkpoint_root(spark) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        root = tempfile.mkdtemp(prefix="changeflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def stream_checkpoint(job: str, warehouse: str, base: str | None = None) -> str:
    """Checkpoint location of one streaming query: under ``base`` if given,
    else ``$CHECKPOINTS``, else next to the tables it writes. A checkpoint
    belongs to one warehouse: two that shared one would each skip what the
    other has read."""
    root = base or os.environ.get("CHECKPOINTS") or "%s/_checkpoints" % warehouse.rstrip("/")
    return "%s/%s" % (root.rstrip("/"), job)
