"""Several file systems under one name."""

from __future__ import annotations

from pyspark.sql import SparkSession


def mount(spark: SparkSession, name: str, folders: dict[str, str]) -> str:
    """Shows folders, on whatever file systems they are, as folders of one: `viewfs://<name>/`.

    `folders` maps a folder's name there to the path it stands for, which must exist when it is
    opened; one without a file system is on the default one. Settings of the session carry
    the mounts to all executors, so jobs keep their paths when data moves to another store.
    Returns the root of the mounted tree.
    """
    if not name.replace("-", "").isalnum():
        raise ValueError(f"not a name for a mount: {name!r}")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder, target in folders.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        whole = path.getFileSystem(hadoop).makeQualified(path).toUri().toString()
        spark.conf.set(f"fs.viewfs.mounttable.{name}.link./{folder.strip('/')}", whole)
    return f"viewfs://{name}"
