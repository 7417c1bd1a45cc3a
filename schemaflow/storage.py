"""Small files of the shared file system, as the driver needs them: create if absent, list, remove."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """The path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def make_directory(spark: SparkSession, path: str) -> None:
    place, fs = located(spark, path)
    fs.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    place, fs = located(spark, path)
    fs.delete(place, True)


def listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names below a directory, ascending, with their modification times in milliseconds; none if it does not exist."""
    place, fs = located(spark, path)
    if not fs.exists(place):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(place))


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Store a small text unless the file exists; True if this call made it.

    The text is written to a hidden file first, so nobody sees a part of it. The step that gives it its name fails if another
    writer was faster: a hard link on a local file system, elsewhere a rename, which must not replace files (HDFS keeps to that;
    object stores do not).
    """
    place, fs = located(spark, path)
    fs.mkdirs(place.getParent())
    hidden = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}.part")
    out = fs.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() != "file":
            return fs.rename(hidden, place)
        name, source = (spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (place, hidden))
        spark._jvm.java.nio.file.Files.createLink(name, source)
        return True
    except Py4JJavaError as failure:
        if failure.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        fs.delete(hidden, False)
