"""Small files beside the tables, on any store that Spark reads: markers, state, identities of inputs.

They go through Spark's own Hadoop file system from the driver, without a job.
"""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of a file, or of all files under a folder; 0 when it is not there."""
    fs, where = _file_system(spark, path)
    return fs.getContentSummary(where).getLength() if fs.exists(where) else 0


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole of a small file; None when there is none."""
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing one of that name."""
    fs, where = _file_system(spark, path)
    stream = fs.create(where, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none when it is not there."""
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds."""
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def versions(spark: SparkSession, files: Iterable[str]) -> list[str]:
    """Each file (as ``DataFrame.inputFiles`` names it) with its length and time of modification; one
    listing for each folder."""
    wanted: dict[str, set[str]] = {}
    for folder, _, name in (f.rpartition("/") for f in files):
        wanted.setdefault(folder, set()).add(unquote(name))
    found = []
    for folder, names in wanted.items():
        where = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(folder))
        for status in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where):
            name = status.getPath().getName()
            if name in names:
                found.append(f"{folder}/{name} {status.getLen()} {status.getModificationTime()}")
    return sorted(found)
