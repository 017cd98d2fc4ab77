"""Paths of any file system the session knows: moving, replacing with a way back, small texts."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """A Hadoop path and its file system, for any URI scheme the session knows."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    location, fs = hadoop_path(spark, path)
    return fs.exists(location)


def remove_path(spark: SparkSession, path: str) -> None:
    location, fs = hadoop_path(spark, path)
    fs.delete(location, True)


def path_bytes(spark: SparkSession, path: str) -> int:
    location, fs = hadoop_path(spark, path)
    return fs.getContentSummary(location).getLength()


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename, or raise: file systems tell a refused rename in either way."""
    old, fs = hadoop_path(spark, source)
    new, _ = hadoop_path(spark, target)
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def aside(path: str) -> str:
    """Where what `path` holds waits while it is replaced; readers skip such names."""
    folder, _, name = path.rpartition("/")
    return f"{folder}/_old_{name}"


def recover(spark: SparkSession, path: str) -> None:
    """Undo a replacement that the end of a driver left halfway.

    What was set aside comes back if nothing has taken its place, and goes if something has."""
    old = aside(path)
    if path_exists(spark, old):
        if path_exists(spark, path):
            remove_path(spark, old)
        else:
            rename_path(spark, old, path)


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[None]:
    """Free `path` for what the body moves there. If the body fails, what was there comes back."""
    recover(spark, path)
    location, fs = hadoop_path(spark, path)
    fs.mkdirs(location.getParent())
    old = aside(path)
    had = path_exists(spark, path)
    if had:
        rename_path(spark, path, old)
    try:
        yield
    except BaseException:
        remove_path(spark, path)
        if had:
            rename_path(spark, old, path)
        raise
    if had:
        try:
            remove_path(spark, old)
        except Exception:
            log.warning("%s is replaced, but %s could not be removed", path, old, exc_info=True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Put `source` in the place of `target`; if that fails, `target` stays as it was."""
    with replacing(spark, target):
        rename_path(spark, source, target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, in place at once or not at all."""
    part = f"{path}.part"
    location, fs = hadoop_path(spark, part)
    stream = fs.create(location, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    move_path(spark, part, path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file; None if there is none."""
    location, fs = hadoop_path(spark, path)
    if not fs.exists(location):
        return None
    stream = fs.open(location)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
