"""Distinct devices by mergeable sketches.

An hour's devices become one HyperLogLog sketch of fixed size. Sketches of any hours, and of any keys left out, fold into one
by union, so a day, a month or a filter needs no pass over silver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.plans.gold import HOURLY_KEYS
from palisade.sinks.tables import write_table

# 2**14 registers: a standard error of 0.8 %; at most 16 KB for a sketch, and few bytes for few devices.
LOG_REGISTERS = 14
TABLE = "hourly_device_sketches"


def hourly_sketches(silver: DataFrame) -> DataFrame:
    """Per hour, category, OS and country: events and the sketch of their devices. Rows without device count as events only.

    Sketches are built on the map side, so a hot hour sends one sketch for each task.
    """
    return silver.groupBy(*HOURLY_KEYS).agg(F.count("*").alias("events"), F.hll_sketch_agg("device_id", F.lit(LOG_REGISTERS)).alias("devices"))


def write_sketches(silver: DataFrame, path: str, dates: list[str] | None = None) -> int:
    """Write the sketches by date. With ``dates`` only these are read and replaced, as a merge into silver names them."""
    if dates is None:
        return write_table(hourly_sketches(silver), path, ["event_date"], whole=True)
    wanted = silver.where(F.col("event_date").isin(dates))
    return write_table(hourly_sketches(wanted), path, ["event_date"], stale=lambda values: values["event_date"] in dates)


def folded(sketches: DataFrame, *keys: Column | str) -> DataFrame:
    """Sketches united over ``keys``: events, the united sketch and the estimated number of devices. No key means all."""
    united = sketches.groupBy(*keys).agg(F.sum("events").alias("events"), F.hll_union_agg("devices").alias("devices"))
    return united.withColumn("devices_estimate", F.hll_sketch_estimate("devices"))


def by_day(sketches: DataFrame) -> DataFrame:
    return folded(sketches, "event_date")


def by_month(sketches: DataFrame) -> DataFrame:
    return folded(sketches, F.trunc("event_date", "MM").alias("month"))
