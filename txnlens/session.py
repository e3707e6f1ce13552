"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "txnlens", *, hive: bool = False, **conf: str) -> SparkSession:
    """A session with what the library relies on; cluster sizing is left to spark-submit.

    Days, hours and windows are taken in UTC. RocksDB keeps stream state off the
    heap, so the state of a large stream is bounded by disk rather than memory;
    a batch then stores what it changed rather than all of it.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Days, hours and windows are taken in the session's zone and would shift in any other."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in ("UTC", "ETC/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"spark.sql.session.timeZone has to be UTC, not {zone}")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder named by ``spark.checkpoint.dir``.

    Executors must all see it, so a machine-local folder is made up only for a
    local master that names none. What lies there is deleted when the driver ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="txnlens-")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/txnlens/{spark.sparkContext.applicationId}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{folder.toString()}/{label}-{uuid.uuid4().hex}"
