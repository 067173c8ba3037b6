"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job wants; sizes (shuffle partitions, memory) belong to the cluster.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A session that serves many queries should not compile them again each time.
    "spark.sql.codegen.cache.maxEntries": "1000",
}

# Streams keep window state in RocksDB, so state may outgrow the executor heap;
# changelog checkpoints upload only what a batch changed.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str, **conf: str) -> SparkSession:
    """Session for a batch or streaming job; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**JOB_CONF, **STREAM_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: casts between zoned and zone-less timestamps depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def stream_settings(spark: SparkSession, parallelism: int | None = None) -> Iterator[None]:
    """Settings for the streams started inside, which keep them; the session does not.

    The state store stays as it is where the session names one. ``parallelism`` is the
    number of state partitions, fixed for the life of a checkpoint.
    """
    settings = {k: v for k, v in STREAM_CONF.items() if spark.conf.get(k, None) is None}
    if parallelism:
        settings["spark.sql.shuffle.partitions"] = str(parallelism)
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without one may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wayfare-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def new_workdir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created until Spark writes there."""
    return f"{shared_dir(spark)}/wayfare/{purpose}-{uuid.uuid4().hex}"
