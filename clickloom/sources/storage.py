"""Thin helpers over Spark's own file system access."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(conf), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def plain(path: str) -> str:
    """One spelling of a path: a single slash after the scheme."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):/+(?=[^/])", lambda m: f"{m[1]}:/" if m[1] == "file" else m[0], path)


def list_files(spark: SparkSession, pattern: str) -> list[tuple[str, str, int]]:
    """(path, name, bytes) of the files a glob matches, by name.

    The name is the path below the folders that the pattern names without wildcards.
    """
    fs, p = _fs(spark, pattern)
    fixed = re.split(r"[*?\[{]", pattern, maxsplit=1)[0]
    folder = pattern.rsplit("/", 1)[0] if fixed == pattern else fixed.rsplit("/", 1)[0]
    root = plain(_fs(spark, folder or "/")[0].makeQualified(_fs(spark, folder or "/")[1]).toString()).rstrip("/") + "/"
    found = [s for s in (fs.globStatus(p) or []) if s.isFile()]
    paths = [(plain(s.getPath().toString()), s.getLen()) for s in found]
    return sorted(((path, path.removeprefix(root), size) for path, size in paths), key=lambda f: f[1])


def version(spark: SparkSession, path: str) -> tuple:
    """Changes whenever the file or folder does: bytes, files, modification time."""
    fs, p = _fs(spark, path)
    summary = fs.getContentSummary(p)
    return summary.getLength(), summary.getFileCount(), fs.getFileStatus(p).getModificationTime()
