"""Folders on whatever file system the session uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _path(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _path(spark, path)
    fs.delete(where, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, where = _path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(where)] if fs.exists(where) else []


def glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, where = _path(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(where) or []]


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _path(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; raises if it exists."""
    fs, where = _path(spark, path)
    stream = fs.create(where, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, unpacked if its name says that it is packed."""
    jvm = spark._jvm
    fs, where = _path(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(where)
    stream = fs.open(where)
    try:
        plain = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a folder and of those in it, or the one file; hidden ones are left out."""
    fs, where = _path(spark, path)
    if not fs.exists(where):
        return []
    if fs.getFileStatus(where).isFile():
        return [path]
    found, todo = [], [where]
    while todo:
        for status in fs.listStatus(todo.pop()):
            if not status.getPath().getName().startswith(("_", ".")):
                if status.isDirectory():
                    todo.append(status.getPath())
                elif status.getLen():
                    found.append(status.getPath().toString())
    return sorted(found)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``; where that is
    unset, as in tests, a folder in the warehouse, which they reach as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def new_name(stem: str) -> str:
    return f"{stem}-{uuid.uuid4().hex}"
