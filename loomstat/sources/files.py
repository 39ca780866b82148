"""Folders and small files of any file system that Spark reaches, by Hadoop's client."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str, *, older_than: float | None = None) -> list[str]:
    """Names in a folder, in order; none where there is no folder. ``older_than`` keeps those unchanged for as many seconds."""
    fs, place = _at(spark, folder)
    if not fs.exists(place):
        return []
    latest = None if older_than is None else (time.time() - older_than) * 1000
    found = fs.listStatus(place)
    return sorted(f.getPath().getName() for f in found if latest is None or f.getModificationTime() <= latest)


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one already: whole or not at all, and True for one writer only."""
    fs, place = _at(spark, path)
    fs.mkdirs(place.getParent())
    draft = place.suffix(f".{time.time_ns()}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.exists(place) and fs.rename(draft, place):
        return True
    fs.delete(draft, False)
    return False


def get(spark: SparkSession, path: str) -> str:
    fs, place = _at(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
