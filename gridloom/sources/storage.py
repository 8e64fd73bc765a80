"""Folders of files that tasks read and write themselves.

A path without a scheme belongs to the file system Spark uses by default (``fs.defaultFS``), not
to the local disk of whichever machine runs the task: ``qualified`` puts the scheme on it once, on
the driver.  Tasks then open the qualified folder with ``filesystem``.
"""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` as a URI of the file system that Spark's readers would use for it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return path.getFileSystem(conf).makeQualified(path).toString().rstrip("/")


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """A pyarrow file system and root path for a folder given as a URI (or as a plain local path)."""
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder[len("file:"):].lstrip("/")
    if "://" not in folder:
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder)
