"""Few large files in place of many small ones.

A plan of what replaces what is written beside the data before anything changes, so a run that ends at any point is
finished, or taken back, by the next one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from palisade.sinks import folders

TARGET_BYTES = 128 << 20
STAGED = "_compaction-"


class Group(NamedTuple):
    """Files, named from the table's root, that become one file of a folder."""

    folder: str
    files: list[str]


def packed(files: Sequence[tuple[str, str, int]], target: int) -> list[Group]:
    """Groups of files (folder to go to, name from the root, bytes) of about ``target`` bytes: first fit, largest first.

    Files of half the target or more stay as they are, and so does a file that finds no other.
    """
    by_folder: dict[str, list[tuple[int, str]]] = {}
    for folder, name, size in files:
        if 2 * size < target:
            by_folder.setdefault(folder, []).append((size, name))
    groups: list[Group] = []
    for folder, small in sorted(by_folder.items()):
        least = min(size for size, _ in small)
        filled: list[list[str]] = []
        room: list[tuple[int, list[str]]] = []  # bins that can still take the smallest file
        for size, name in sorted(small, reverse=True):
            at = next((i for i, (free, _) in enumerate(room) if free >= size), None)
            free, names = room.pop(at) if at is not None else (target, [])
            names.append(name)
            (filled.append(names) if free - size < least else room.append((free - size, names)))
        groups += [Group(folder, names) for names in [*filled, *(names for _, names in room)] if len(names) > 1]
    return groups


def compact(
    spark: SparkSession,
    path: str,
    partition_by=(),
    target: int = TARGET_BYTES,
    only: list[dict[str, str]] | None = None,
    across: str | None = None,
    closed: Callable[[dict[str, str]], bool] = lambda values: True,
    sort_by=(),
    options: dict[str, str] | None = None,
) -> int:
    """Rewrite the small Parquet files of each partition into files of about ``target`` bytes; the number of files replaced.

    ``only`` names the partitions to look at, ``closed`` says which of them nothing is written to any more. ``across`` is a
    partition column, such as the number of a micro-batch, whose folders are emptied into one of value -1; the batch folders
    keep their marks, so a batch that is tried again is known to be done. Rows stay as they are, sorted by ``sort_by`` within
    a file. Everything is one Spark job, with a task for each file written.

    A run that was cut off is finished first if all it wrote is there, and otherwise taken back, so a repetition is always
    safe. It isn't a transaction: while files are exchanged, a reader may see rows of a folder twice. One writer at a time.
    """
    recover(spark, path)
    if only is not None:
        parts = folders.some_partitions(spark, path, only, sizes=True)
    else:
        parts = folders.partitions(spark, path, partition_by, sizes=True)
    root = folders.qualified(spark, path)
    listed = []
    for part in parts:
        if closed(part.values):
            goal = {**part.values, across: "-1"} if across else part.values
            here = part.path.removeprefix(root).strip("/")
            listed += [(folders.partition_path("", goal).strip("/"), f"{here}/{name}".strip("/"), size) for name, size in part.sizes.items()]
    groups = packed(listed, target)
    if not groups:
        return 0
    staged = f"{path}/{STAGED}{uuid.uuid4().hex}"
    _rewrite(spark, path, groups, f"{staged}/data", sort_by, options or {})
    moves = []
    for number, group in enumerate(groups):
        made = [name for name in folders.names(spark, f"{staged}/data/group={number}") if folders.shown(name)]
        # A task that writes several groups gives their files one name.
        new = {f"{number}-{name}": f"group={number}/{name}" for name in made}
        moves.append({"folder": group.folder, "old": group.files, "new": new})
    folders.write_text(spark, f"{staged}/plan.json", json.dumps(moves))
    _exchange(spark, path, staged, moves)
    return sum(len(group.files) for group in groups)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or take back what an earlier run left. A plan is written after all data, so without one the data is dropped."""
    for name in folders.names(spark, path):
        if name.startswith(STAGED):
            staged = f"{path}/{name}"
            if (plan := folders.read_text(spark, f"{staged}/plan.json")) is None:
                folders.delete(spark, staged)
            else:
                _exchange(spark, path, staged, json.loads(plan))


def _rewrite(spark: SparkSession, path: str, groups: list[Group], target: str, sort_by, options: dict[str, str]) -> None:
    """Each row finds its group by its file, and each group becomes one file, by a task of its own."""
    names = [(folders.uri(spark, f"{path}/{name}"), number) for number, group in enumerate(groups) for name in group.files]
    one_slash = lambda column: F.regexp_replace(column, "^file:/+", "file:/")
    plan = spark.createDataFrame(names, "`file name` string, `group` int").withColumn("file name", one_slash(F.col("file name")))
    rows = spark.read.option("mergeSchema", "true").parquet(*[f"{path}/{name}" for group in groups for name in group.files])
    tagged = rows.select("*", one_slash(F.col("_metadata.file_path")).alias("file name"))
    known = F.coalesce("group", F.raise_error(F.concat(F.lit("no group for "), "file name")).cast("int"))
    grouped = tagged.join(plan, "file name", "left").select(*rows.columns, known.alias("group"))
    laid = grouped.repartitionById(len(groups), "group").sortWithinPartitions("group", *sort_by)
    laid.write.options(compression="snappy", **options).partitionBy("group").parquet(target)


def _exchange(spark: SparkSession, path: str, staged: str, moves: list[dict]) -> None:
    """Bring the new files in, then take the old ones away. Each step may be done already.

    Until the first new file is in, all old ones are there. If some aren't, another writer has replaced the folder since, and
    the new files are out of date.
    """
    for move in moves:
        folder = f"{path}/{move['folder']}" if move["folder"] else path
        there = set(folders.names(spark, folder))
        if not there & move["new"].keys() and not all(folders.exists(spark, f"{path}/{name}") for name in move["old"]):
            continue
        folders.make(spark, folder)
        for name, source in move["new"].items():
            if name not in there:
                folders.move(spark, f"{staged}/data/{source}", f"{folder}/{name}")
        for name in move["old"]:
            folders.delete(spark, f"{path}/{name}")
    folders.delete(spark, staged)
