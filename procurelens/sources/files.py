"""Names, small texts and deletions in whatever store Spark writes to, through Hadoop's file system."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    modified_ms: int


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _store(spark, path)
    return store.exists(where)


def entries(spark: SparkSession, folder: str) -> list[Entry]:
    """What a folder holds, by name; nothing if it is missing."""
    store, where = _store(spark, folder)
    if not store.exists(where):
        return []
    found = [Entry(s.getPath().getName(), s.getModificationTime()) for s in store.listStatus(where)]
    return sorted(found, key=lambda e: e.name)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if another writer has made it."""
    store, where = _store(spark, path)
    try:
        out = store.create(where, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or store.exists(where):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    store, where = _store(spark, path)
    source = store.open(where)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def delete(spark: SparkSession, path: str) -> None:
    store, where = _store(spark, path)
    store.delete(where, True)
