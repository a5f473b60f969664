"""Small files on any file system: model files and settings by pyarrow, without a session; documents beside tables by the
file systems that Spark knows."""

from __future__ import annotations

import os
import posixpath
import re
from urllib.parse import urlparse

import pyarrow.fs
from pyspark.sql import SparkSession


def is_uri(path: str) -> bool:
    """Whether the path names a file system other than the local one."""
    scheme = urlparse(path).scheme
    return len(scheme) > 1 and scheme != "file"


def place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if len(urlparse(path).scheme) < 2:
        return pyarrow.fs.LocalFileSystem(), os.path.abspath(path)
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def is_file(path: str) -> bool:
    fs, at = place(path)
    return fs.get_file_info(at).is_file


def is_folder(path: str) -> bool:
    fs, at = place(path)
    return fs.get_file_info(at).type == pyarrow.fs.FileType.Directory


def read(path: str) -> bytes:
    fs, at = place(path)
    with fs.open_input_stream(at) as f:
        return f.read()


# ---------------------------------------------------------------- by Spark's file systems


def hadoop(spark: SparkSession, path: str):
    """The path and its file system, as Spark sees them."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = hadoop(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at, fs = hadoop(spark, path)
    fs.delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none where there is no folder."""
    at, fs = hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def write(spark: SparkSession, path: str, text: str) -> None:
    """A small document, written beside and then renamed over the old one, so that readers see either."""
    jvm = spark.sparkContext._jvm
    at, fs = hadoop(spark, path)
    fs.mkdirs(at.getParent())
    tmp = hadoop(spark, posixpath.join(posixpath.dirname(path), f".{posixpath.basename(path)}.tmp"))[0]
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    modes = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    over = jvm.java.lang.reflect.Array.newInstance(modes, 1)
    over[0] = jvm.java.lang.Enum.valueOf(modes, "OVERWRITE")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(at).toUri(), conf).rename(fs.makeQualified(tmp), fs.makeQualified(at), over)
