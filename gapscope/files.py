"""Small file operations on the shared store, through Hadoop, so on any store that Spark can write."""

from __future__ import annotations

import time
import uuid
from typing import Any, NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    path: str
    name: str
    folder: bool
    size: int
    modified: float   # seconds, by the store's clock


def _open(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _entry(status: Any) -> Entry:
    p = status.getPath()
    return Entry(p.toString(), p.getName(), status.isDirectory(), status.getLen(), status.getModificationTime() / 1000)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What lies directly in a folder (nothing, if there is none), by name."""
    fs, target = _open(spark, path)
    return sorted((_entry(s) for s in fs.listStatus(target)), key=lambda e: e.name) if fs.exists(target) else []


def matching(spark: SparkSession, pattern: str) -> list[Entry]:
    """What a path with wildcards names."""
    fs, target = _open(spark, pattern)
    return [_entry(s) for s in fs.globStatus(target) or []]


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Moves a file or folder to a name that is free."""
    fs, target = _open(spark, path)
    goal = spark._jvm.org.apache.hadoop.fs.Path(to)
    if fs.exists(goal) or not fs.rename(target, goal):
        raise OSError(f"cannot rename {path} to {to}")


def touch(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.create(target, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there with all its text or not at all."""
    aside = f"{path}.{uuid.uuid4().hex[:12]}"
    fs, target = _open(spark, aside)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()
    delete(spark, path)
    rename(spark, aside, path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, aside: str, path: str) -> None:
    """Puts the finished folder ``aside`` in the place of ``path``: what is there steps back by a rename and goes
    once the new one is in its place, or comes back if that fails."""
    old = f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:12]}"
    there = exists(spark, path)
    if there:
        rename(spark, path, old)
    try:
        rename(spark, aside, path)
    except Exception:
        if there:
            rename(spark, old, path)
        raise
    if there:
        delete(spark, old)


def now() -> float:
    return time.time()
