"""Table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palisade.sinks.evolution import read_known


def read_table(spark: SparkSession, name_or_path: str, merge_schema: bool = False) -> DataFrame:
    """A catalog table by name, or Parquet files by path (anything with a slash).

    A table that keeps its schema (``sinks/evolution.py``) is read by that. ``merge_schema`` finds columns that only later
    files have; it opens the footer of every file.
    """
    if "/" in name_or_path:
        if not merge_schema:
            return read_known(spark, name_or_path)
        return spark.read.option("mergeSchema", merge_schema).parquet(name_or_path)
    return spark.table(name_or_path)


def new_files(spark: SparkSession, path: str, schema, file_format: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A stream of files that this stream's checkpoint has not seen yet."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
