"""The package for Python workers that don't have it on their path."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def on_path(spark: SparkSession) -> SparkSession:
    """Put the folder that holds the package on the path of the session's Python workers.

    Enough wherever the folder can be read, as on one machine; a cluster gets the package with ``--py-files`` or installed.
    """
    environment = spark.sparkContext.environment
    folder = str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "")
    if folder not in known.split(":"):
        environment["PYTHONPATH"] = f"{known}:{folder}" if known else folder
    return spark
