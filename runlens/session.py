"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. Cluster sizing (executors, memory, shuffle
# partitions) stays with spark-submit.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str = "runlens", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings above. `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have the folder at `path` removed when the application ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by `spark.checkpoint.dir`.

    Executors on other machines read what is written here, so a machine-local
    folder is used only when Spark itself runs on a single machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = f"file:{tempfile.gettempdir()}"
    return f"{base.rstrip('/')}/runlens-{name}-{uuid.uuid4().hex}"
