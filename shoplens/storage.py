"""Small files on whatever file system Spark's paths name: commit records and
ledgers of staged tables. Data goes through Spark; only these records, a few
hundred bytes each, pass through the driver."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Entry(NamedTuple):
    name: str
    path: str
    is_dir: bool
    size: int
    modified_ms: int


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _is(e: Py4JJavaError, name: str) -> bool:
    return e.java_exception.getClass().getSimpleName() == name


def _entry(status) -> Entry:
    p = status.getPath()
    return Entry(p.getName(), p.toString(), status.isDirectory(), status.getLen(), status.getModificationTime())


def entries(spark: SparkSession, folder: str) -> list[Entry]:
    """What a folder holds, by name; a folder that is not there holds nothing."""
    p, fs = _path(spark, folder)
    try:
        return sorted(_entry(s) for s in fs.listStatus(p))
    except Py4JJavaError as e:
        if not _is(e, "FileNotFoundException"):
            raise
        return []


def input_files(spark: SparkSession, paths: str | list[str]) -> list[Entry]:
    """Every data file under the paths (globs are fine), by path."""
    out = []
    for path in [paths] if isinstance(paths, str) else paths:
        p, fs = _path(spark, path)
        for found in fs.globStatus(p) or ():
            if found.isDirectory():
                files = fs.listFiles(found.getPath(), True)
                while files.hasNext():
                    out.append(_entry(files.next()))
            else:
                out.append(_entry(found))
    return sorted((e for e in out if not e.name.startswith(("_", "."))), key=lambda e: e.path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole of a small file, or None if it is not there."""
    p, fs = _path(spark, path)
    try:
        stream = fs.open(p)
    except Py4JJavaError as e:
        if not _is(e, "FileNotFoundException"):
            raise
        return None
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """Write a small file whole or not at all: it is written beside its
    place and renamed. Without ``replace``, a file that is there stays and
    the answer is False."""
    p, fs = _path(spark, path)
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = gateway.new_array(rename, 1 if replace else 0)
    if replace:
        how[0] = rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(tmp, p, how)
    except Py4JJavaError as e:
        fs.delete(tmp, False)
        if replace or not _is(e, "FileAlreadyExistsException"):
            raise
        return False
    return True


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder when the driver's JVM ends."""
    p, fs = _path(spark, path)
    fs.deleteOnExit(p)
