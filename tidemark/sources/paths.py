"""Small files and folders on whatever file system the cluster uses."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class AlreadyThere(Exception):
    """A file that was to be new exists: another writer was first."""

    def __init__(self, path: str):
        super().__init__(f"{path} exists")


def _open(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Entries of a folder, sorted; none if it does not exist."""
    fs, target = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def modified(spark: SparkSession, path: str) -> float:
    """When an entry was last changed, in epoch seconds."""
    fs, target = _open(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet.

    Stores that can are asked to refuse the file at its end too, when two
    writers began at once; others ignore that option.
    """
    fs, target = _open(spark, path)
    if fs.exists(target):
        raise AlreadyThere(path)
    builder = fs.createFile(target).overwrite(False).recursive()
    builder = builder.opt("fs.option.create.conditional.overwrite", "true")
    try:
        stream = builder.build()
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
    except Py4JJavaError as failure:
        if "AlreadyExists" in failure.java_exception.getClass().getName() or "412" in str(failure.java_exception.getMessage()):
            raise AlreadyThere(path) from failure
        raise


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)
