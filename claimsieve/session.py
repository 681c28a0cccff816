"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_own_folders: set[str] = set()

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # no call-site capture per expression: plans of many columns are built several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | str = "*", **extra: str) -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("claimsieve")
    settings = SETTINGS | {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"} | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_folder(spark: SparkSession) -> str:
    """A fresh path in the session's own folder below `spark.checkpoint.dir`, or below the warehouse where that is unset.

    Both are folders that every executor reaches. The session's folder goes when its driver ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/claimsieve-{spark.sparkContext.applicationId}"
    if folder not in _own_folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _own_folders.add(folder)
    return f"{folder}/{uuid.uuid4().hex}"
