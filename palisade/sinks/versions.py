"""Tables whose partitions are replaced together, or not at all.

Each partition keeps its rows in a folder for each version. What a change writes is of one version higher, and it counts from
the moment that a mark of this version is there; until then readers see the partitions as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.sinks import folders
from palisade.sinks.tables import laid_out

VERSION = "version"
MARK = "_version-"


def current(spark: SparkSession, root: str) -> int:
    """The version that counts; 0 if nothing was ever written."""
    return max((int(name.removeprefix(MARK)) for name in folders.names(spark, root) if name.startswith(MARK)), default=0)


def commit(spark: SparkSession, root: str, version: int) -> None:
    """Let a version count. Older marks go."""
    folders.write_text(spark, f"{root}/{MARK}{version}", "")
    for name in folders.names(spark, root):
        if name.startswith(MARK) and name != f"{MARK}{version}":
            folders.delete(spark, f"{root}/{name}")


class Parts:
    """One table below ``root``, with one folder for each value of its partition column, and in it one for each version."""

    def __init__(self, spark: SparkSession, root: str, name: str, column: str, schema: str):
        self.spark, self.path, self.column, self.schema = spark, f"{root}/{name}", column, schema

    def _folders(self, values: list | None) -> list[str]:
        if values is None:
            return [name for name in folders.names(self.spark, self.path) if name.startswith(f"{self.column}=")]
        return [f"{self.column}={value}" for value in values]

    def _versions(self, folder: str) -> list[int]:
        return [int(name.partition("=")[2]) for name in folders.names(self.spark, f"{self.path}/{folder}") if name.startswith(f"{VERSION}=")]

    def read(self, at: int, values: list | None = None) -> DataFrame:
        """The rows as of a version: all partitions, or those of ``values`` only, of which no other folder is listed."""
        paths = []
        for folder in self._folders(values):
            if known := [v for v in self._versions(folder) if v <= at]:
                place = f"{self.path}/{folder}/{VERSION}={max(known)}"
                if any(folders.shown(name) for name in folders.names(self.spark, place)):
                    paths.append(place)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        wanted = self.spark.createDataFrame([], self.schema).schema
        found = self.spark.read.option("basePath", self.path).parquet(*paths)
        return found.select(*[F.col(field.name).cast(field.dataType) for field in wanted.fields])

    def write(self, rows: DataFrame, version: int, values: list) -> None:
        """Replace the partitions of ``values``; one without rows becomes empty."""
        for folder in self._folders(values):
            folders.delete(self.spark, f"{self.path}/{folder}/{VERSION}={version}")  # of a run that was cut off
            folders.make(self.spark, f"{self.path}/{folder}/{VERSION}={version}")
        laid = laid_out(rows.withColumn(VERSION, F.lit(version)), [self.column], [self.column])
        laid.write.mode("append").option("compression", "snappy").partitionBy(self.column, VERSION).parquet(self.path)

    def tidy(self, at: int, values: list | None = None) -> None:
        """Remove what no version that counts needs: newer folders of a run that was cut off, and older ones."""
        for folder in self._folders(values):
            versions = self._versions(folder)
            kept = max((v for v in versions if v <= at), default=None)
            for v in versions:
                if v != kept:
                    folders.delete(self.spark, f"{self.path}/{folder}/{VERSION}={v}")
