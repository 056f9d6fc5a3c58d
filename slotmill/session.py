"""Session defaults and the folder shared by driver and executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "slotmill", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on and UTC dates; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temp folder only for an unset local session."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="slotmill-")
    return _local_roots[app]


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, removed when the driver's JVM ends."""
    folder = f"{shared_root(spark).rstrip('/')}/slotmill-{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return folder
