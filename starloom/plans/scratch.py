"""Where intermediate tables go."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor reaches: the one in ``spark.checkpoint.dir``.

    Only a local session that does not name one gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/starloom-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="starloom-")


def dropped_at_exit(spark: SparkSession, folder: str) -> str:
    """Make a folder that is deleted when the application's JVM ends in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder
