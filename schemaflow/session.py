"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import SparkSession

ICEBERG_EXTENSION = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
STATE_STORE = "spark.sql.streaming.stateStore"
STATE_PROVIDER = f"{STATE_STORE}.providerClass"
# Keyed state on local disk: a batch appends its changes to a log, and all state of an executor shares one bounded cache.
DISK_STATE = {
    STATE_PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{STATE_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}


def recommended_options() -> dict[str, str]:
    """Builder settings for a cluster session.

    Skew and partition counts are left to adaptive execution; keyed stream state goes to RocksDB so that its size is
    bounded by local disk and not by the heap.
    """
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def catalog_options(warehouse: str, catalog: str = "lake", extensions: str = "") -> dict[str, str]:
    """Builder settings that register a path-based Iceberg catalog.

    The extension list is a static setting, so it must be given before the session starts; ``extensions`` is whatever
    the session already uses and is kept.
    """
    present = [e.strip() for e in extensions.split(",") if e.strip()]
    if ICEBERG_EXTENSION not in present:
        present.append(ICEBERG_EXTENSION)
    prefix = f"spark.sql.catalog.{catalog}"
    return {
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": "hadoop",
        f"{prefix}.warehouse": warehouse,
        "spark.sql.extensions": ",".join(present),
    }


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    All paths of an application lie below one folder, which its file system removes when the application ends; an application that is
    killed leaves it behind. A machine-local folder is used only where that setting is absent and the session is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{tempfile.gettempdir()}/schemaflow"
    own = f"{base.rstrip('/')}/schemaflow-{spark.sparkContext.applicationId}"
    place = spark._jvm.org.apache.hadoop.fs.Path(own)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.mkdirs(place):
        fs.deleteOnExit(place)
    return f"{own}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A fresh path like that of :func:`scratch_dir`, removed when the block ends."""
    path = scratch_dir(spark, label)
    try:
        yield path
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of a block; afterwards it has the value it had, or none."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started in the block keep their state on local disk; where a state store was chosen, that one stays.

    The default store holds every key on the heap, which millions of small groups do not fit.
    """
    with ExitStack() as settings:
        if spark.conf.get(STATE_PROVIDER, None) is None:
            for key, value in DISK_STATE.items():
                settings.enter_context(setting(spark, key, value))
        yield


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a path, on whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
