"""Session helpers.

Library code never creates a session on its own; tests, the bench and the
entry module call :func:`get_spark`.  Settings that a cluster already has
(checkpoint dir, shuffle partitions) are only filled in when unset.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once the datasets that use them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # PySpark 4 records the Python call site of every Column call for error
    # messages (a conf lookup and a stack walk per call); plans of a few
    # hundred expressions then take seconds to build.  Off by default here.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "pitchlake") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PITCHLAKE_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.  On a cluster it must be named in
    ``spark.checkpoint.dir``; only a local session without one (tests) gets a
    local folder, removed when the process ends."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not conf_dir:
        master = sc.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="pitchlake-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_folders: dict[str, str] = {}


def run_folder(spark: SparkSession) -> str:
    """The session's own folder below the shared checkpoint dir, for written
    intermediates.  It is removed when the session's JVM ends, as results may be
    read from it until then."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/run-{app}"
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(where)
        fs.deleteOnExit(where)
        _folders[app] = path
    return _folders[app]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder in :func:`run_folder` for written intermediates (split
    outputs, round trips).  Shared storage, so it survives executor loss."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
