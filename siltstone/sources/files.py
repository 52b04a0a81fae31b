"""Folders of a table in whatever file system its path names: listing, removal, replacement."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(context._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _located(spark, path)
    return system.exists(location)


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written; 0 if it is not there."""
    system, location = _located(spark, path)
    return time.time() - system.getFileStatus(location).getModificationTime() / 1000 if system.exists(location) else 0.0


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files and folders; what is already gone is no error."""
    for path in paths:
        system, location = _located(spark, path)
        system.delete(location, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    system, location = _located(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(location)) if system.exists(location) else []


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder, making the target's parent; False if there is nothing to move."""
    system, there = _located(spark, target)
    _, here = _located(spark, source)
    system.mkdirs(there.getParent())
    return bool(system.exists(here) and not system.exists(there) and system.rename(here, there))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if it is not there."""
    system, location = _located(spark, path)
    if not system.exists(location):
        return None
    stream = system.open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it is there as a whole or not at all."""
    base, _, name = path.rpartition("/")
    written = f"{base}/.{name}-{uuid.uuid4().hex}"
    system, location = _located(spark, written)
    stream = system.create(location, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    _, target = _located(spark, path)
    if system.exists(target):
        system.delete(target, True)
    if not system.rename(location, target):
        raise OSError(f"cannot write {path}")


def _folders(spark: SparkSession, path: str, columns: Sequence[str]) -> list[list[str]]:
    """Parts of the relative path of each folder by ``columns``, by listing folders only."""
    system, location = _located(spark, "/".join([path, *(f"{c}=*" for c in columns)]))
    return [s.getPath().toString().rsplit("/", len(columns))[1:] for s in system.globStatus(location) or []]


def folder_names(spark: SparkSession, path: str, columns: Sequence[str]) -> list[str]:
    """Relative paths of the folders by ``columns``: no data file is opened."""
    return sorted("/".join(parts) for parts in _folders(spark, path, columns))


def folder_values(spark: SparkSession, path: str, columns: Sequence[str]) -> list[tuple[int, ...]]:
    """Values of the number-valued folder columns: no data file is opened."""
    values = []
    for parts in _folders(spark, path, columns):
        named = [p.partition("=")[2] for p in parts]
        if all(v.isdigit() for v in named):
            values.append(tuple(map(int, named)))
    return sorted(values)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a replacement that stopped after the old table was set aside.

    That happens only once its successor is complete, so the successor is put in
    place; what was set aside is deleted when the table is there again.  Taken
    twice at once, one of the two moves finds nothing left to do.
    """
    base, slash, name = path.rstrip("/").rpartition("/")
    aside = [n for n in names_in(spark, base or slash or ".") if n.startswith(f".{name}-old-")]
    for old in aside:
        staged = f"{base}{slash}.{name}-staged-{old.rpartition('-')[2]}"
        if not exists(spark, path) and not move(spark, staged, path):
            move(spark, f"{base}{slash}{old}", path)
    if exists(spark, path):
        remove(spark, [f"{base}{slash}{old}" for old in aside])


def replace_table(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a sibling folder, then put that in the place of the table.

    If writing fails, the old table stays as it was; it may be read while its
    successor is written.  The old one is deleted after the new one is in place.
    A stop between the two renames is made good by ``recover``, which the next
    reader or writer calls.
    """
    recover(spark, path)
    base, slash, name = path.rstrip("/").rpartition("/")
    staged, old = (f"{base}{slash}.{name}-{kind}-{mark}" for mark in [uuid.uuid4().hex] for kind in ("staged", "old"))
    try:
        write(staged)
    except BaseException:
        remove(spark, [staged])
        raise
    if exists(spark, path) and not move(spark, path, old):
        raise OSError(f"cannot set {path} aside")
    # A reader that found the table missing may have put its successor there already.
    if not move(spark, staged, path) and not exists(spark, path):
        move(spark, old, path)
        raise OSError(f"cannot put the new table at {path}")
    spark.catalog.refreshByPath(path)
    remove(spark, [old])
