"""Small text files and folders on the file system a path belongs to, whatever store that is."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Times a file whose checksum does not match is read.
READS = 50


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text, None if there is no such file. A local file that is being replaced is new a moment
    before its checksum is, so one that does not match is read again."""
    system, where = _at(spark, path)
    for left in reversed(range(READS)):
        if not system.exists(where):
            return None
        try:
            source = system.open(where)
            try:
                return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
            finally:
                source.close()
        except Py4JJavaError as error:
            kind = error.java_exception.getClass().getName()
            if "FileNotFoundException" in kind:
                return None
            if "ChecksumException" not in kind or not left:
                raise
            time.sleep(0.02)


def write_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Write a file that readers see as a whole or not at all. Without ``replace`` a file that is there
    stays as it is, and the answer is False."""
    system, where = _at(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = system.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    option = spark._jvm.org.apache.hadoop.fs.Options.Rename
    kinds = spark.sparkContext._gateway.new_array(option, 1)
    kinds[0] = option.OVERWRITE if replace else option.NONE
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        files.rename(aside, where, kinds)
    except Py4JJavaError as error:
        system.delete(aside, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path."""
    system, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(where) if s.isDirectory())


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files with rows right below a path."""
    system, where = _at(spark, path)
    names = [s.getPath().getName() for s in system.listStatus(where) if s.isFile()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file to a place that has none. One that has been moved before stays where it is."""
    system, where = _at(spark, source)
    place = spark._jvm.org.apache.hadoop.fs.Path(target)
    if system.exists(place) or not system.exists(where):
        return
    system.mkdirs(place.getParent())
    if not system.rename(where, place):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds."""
    system, where = _at(spark, path)
    system.delete(where, True)


def remove_if_empty(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    if system.exists(where) and not len(system.listStatus(where)):
        system.delete(where, True)
