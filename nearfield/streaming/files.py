"""Which batch folders a stream has written, through the Hadoop file system of the path (any store Spark reads)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def numbered_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers n of the complete folders ``<path>/<prefix>=<n>``, ascending; empty when ``path`` does not exist."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{prefix}=") and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name.split("=", 1)[1]))
    return sorted(found)
