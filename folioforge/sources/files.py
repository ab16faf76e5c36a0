"""Path helpers on whatever file system a path names."""

from __future__ import annotations

import re

import pyarrow.fs
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark's file sources print it, with its scheme."""
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.makeQualified(hadoop_path).toString()


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table; a path that is gone already is fine."""
    file_system, hadoop_path = _file_system(spark, path)
    file_system.delete(hadoop_path, True)


def touch(spark: SparkSession, path: str) -> None:
    """Write an empty file."""
    file_system, hadoop_path = _file_system(spark, path)
    file_system.create(hadoop_path, True).close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none for a folder that isn't there."""
    if not exists(spark, path):
        return []
    file_system, hadoop_path = _file_system(spark, path)
    return [status.getPath().getName() for status in file_system.listStatus(hadoop_path)]


def latest_snapshot(spark: SparkSession, root: str) -> int | None:
    """Highest ``snapshot=<n>`` under ``root`` whose write was committed."""
    found = (re.fullmatch(r"snapshot=(\d+)", name) for name in children(spark, root))
    for number in sorted((int(match.group(1)) for match in found if match), reverse=True):
        snapshot = f"{root}/snapshot={number}"
        if exists(spark, f"{snapshot}/commits/0") or exists(spark, f"{snapshot}/_SUCCESS"):
            return number
    return None


# Schemes that Hadoop and pyarrow name differently.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasb": "abfs"}


def open_bytes(path: str) -> pyarrow.NativeFile:
    """A seekable stream of the file that a path of Spark names, for use inside a task."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return pyarrow.fs.LocalFileSystem().open_input_file("/" + (rest if colon else path).lstrip("/"))
    system, name = pyarrow.fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
    return system.open_input_file(name)
