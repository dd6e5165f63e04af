"""Directory listings through the Hadoop file system of the session."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a directory; none if it does not exist."""
    if not exists(spark, path):
        return []
    found = _file_system(spark, path).listStatus(_path(spark, path))
    return sorted(s.getPath().getName() for s in found)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a directory with everything in it."""
    _file_system(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _file_system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole file unless there is one; False if there is.

    The file appears complete or not at all. Of several writers one succeeds, on
    local disks by a hard link and elsewhere by a rename that refuses to replace,
    which has to be atomic in the file system, as it is in HDFS.
    """
    fs, target = _file_system(spark, path), _path(spark, path)
    draft = _path(spark, f"{target.getParent()}/.{target.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
            return True
        jvm, gateway = spark._jvm, spark.sparkContext._gateway
        kind = jvm.org.apache.hadoop.fs.Options.Rename
        options = gateway.new_array(kind, 1)
        options[0] = getattr(kind, "NONE")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            target.toUri(), spark._jsc.hadoopConfiguration()
        )
        context.rename(draft, target, options)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)
