"""Files and folders by Hadoop paths, wherever they are stored."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.utils import AnalysisException

HIDDEN = ("_", ".")


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def data_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """All files below the paths or patterns, by name, but for hidden ones."""
    found = []
    for one in [path] if isinstance(path, str) else path:
        fs, target = _path(spark, one)
        matches = fs.globStatus(target)
        if not matches:
            raise AnalysisException(f"no such path: {one}")
        waiting = list(matches)
        while waiting:
            status = waiting.pop()
            if status.isDirectory():
                waiting += [
                    s for s in fs.listStatus(status.getPath()) if not s.getPath().getName().startswith(HIDDEN)
                ]
            else:
                found.append(status.getPath().toString())
    return sorted(found)


@contextlib.contextmanager
def open_text(spark: SparkSession, path: str) -> Iterator:
    """A Java line reader over a UTF-8 file, unpacked where its name says that it is packed."""
    jvm = spark._jvm
    fs, target = _path(spark, path)
    stream = fs.open(target)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
            spark._jsc.hadoopConfiguration()
        ).getCodec(target)
        plain = stream if codec is None else codec.createInputStream(stream)
        yield jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
    finally:
        stream.close()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's entries; none where there is no such folder."""
    fs, target = _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file that must not exist yet."""
    fs, target = _path(spark, path)
    fs.create(target, False).close()


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)
