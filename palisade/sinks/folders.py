"""Folders of partitioned tables, through the file system that holds them."""

from __future__ import annotations

from typing import NamedTuple
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession


# Spark's folder name for a NULL partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Partition(NamedTuple):
    values: dict[str, str]
    path: str
    files: frozenset[str]
    sizes: dict[str, int] = {}  # bytes of each file, where asked for


def _located(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _located(spark, path)
    return system.exists(place)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and without a trailing slash, so that two ways to write one are equal."""
    system, place = _located(spark, path)
    return system.makeQualified(place).toString()


def uri(spark: SparkSession, path: str) -> str:
    """The path as Spark's file metadata has it."""
    system, place = _located(spark, path)
    return system.makeQualified(place).toUri().toString()


def delete(spark: SparkSession, path: str) -> None:
    system, place = _located(spark, path)
    system.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, by name; nothing if there is no such folder."""
    system, place = _located(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    system, place = _located(spark, source)
    if not system.rename(place, _located(spark, target)[1]):
        raise OSError(f"{source} can't be moved to {target}")


def make(spark: SparkSession, path: str) -> None:
    system, place = _located(spark, path)
    system.mkdirs(place)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    system, place = _located(spark, path)
    _, beside = _located(spark, f"{path}.writing")
    out = system.create(beside, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    if not system.rename(beside, place):
        raise OSError(f"{path} can't be written")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, None if there is none."""
    system, place = _located(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def shown(name: str) -> bool:
    return not name.startswith(("_", "."))


def _partition(system, place, values: dict[str, str], sizes: bool) -> Partition:
    files = {f.getPath().getName(): f.getLen() for f in system.listStatus(place) if f.isFile() and shown(f.getPath().getName())}
    return Partition(values, place.toString(), frozenset(files), files if sizes else {})


def partitions(spark: SparkSession, path: str, columns, sizes: bool = False) -> list[Partition]:
    """The partitions below ``path``, which has one level of folders for each of ``columns``."""
    system, root = _located(spark, path)
    if not columns:
        return [_partition(system, system.makeQualified(root), {}, sizes)] if system.exists(root) else []
    _, pattern = _located(spark, "/".join([path.rstrip("/"), *[f"{name}=*" for name in columns]]))
    found = []
    for status in system.globStatus(pattern) or []:
        place = status.getPath()
        parts = place.toString().split("/")[-len(columns) :]
        found.append(_partition(system, place, {name: unquote(value) for name, _, value in (part.partition("=") for part in parts)}, sizes))
    return found


def partition_path(path: str, values: dict[str, str | None]) -> str:
    """The folder of a partition; None stands for NULL."""
    shown_as = {name: NO_VALUE if value is None else quote(value, safe="") for name, value in values.items()}
    return "/".join([path.rstrip("/"), *[f"{name}={value}" for name, value in shown_as.items()]])


def some_partitions(spark: SparkSession, path: str, wanted: list[dict[str, str]], sizes: bool = False) -> list[Partition]:
    """Those of the wanted partitions that are there; no other folder is listed. Values are plain, such as numbers and dates."""
    found = []
    for values in wanted:
        system, place = _located(spark, partition_path(path, values))
        if system.exists(place):
            found.append(_partition(system, system.makeQualified(place), values, sizes))
    return found
