"""The threat leaderboard kept up to date by changed dates.

The state holds what each date contributes, and how many dates hold each pair of a threat and a customer, device or country.
A refresh reads the changed dates of silver, finds which of their pairs came or went, adds that to the counts of these pairs,
and counts the pairs again in the buckets concerned. History is not read, however long it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.operators.ranking import dense_rank_by_count
from palisade.plans.gold import THREAT_KEYS
from palisade.session import scratch, settle
from palisade.sinks.versions import Parts, commit, current

BUCKETS = 64
KINDS = {"customer": "customer_id", "device": "device_id", "country": "country_code"}
_THREAT = ", ".join(f"{name} string" for name in THREAT_KEYS)
_DETAIL = "severity string, severity_score int, os_type string"


class State:
    """The tables below ``root``.

    - days: per date and threat, severity and OS: events, first and last seen
    - pairs: the distinct pairs of each date
    - counted: by bucket, each pair and the number of dates that hold it
    - totals: by bucket, the number of its pairs of each threat and kind
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        pair = f"{_THREAT}, kind string, value string"
        self.days = Parts(spark, root, "days", "event_date", f"event_date date, {_THREAT}, {_DETAIL}, events bigint, first_seen timestamp, last_seen timestamp")
        self.pairs = Parts(spark, root, "pairs", "event_date", f"event_date date, {pair}")
        self.counted = Parts(spark, root, "counted", "bucket", f"bucket int, {pair}, dates bigint")
        self.totals = Parts(spark, root, "totals", "bucket", f"bucket int, {_THREAT}, kind string, pairs bigint")

    def tables(self) -> list[Parts]:
        return [self.days, self.pairs, self.counted, self.totals]


def refresh(silver: DataFrame, root: str, dates: list[str], buckets: int = BUCKETS) -> int:
    """Bring the state up to date with silver's rows of ``dates``, those that were added, changed or removed; its version.

    The date condition is on silver's partition column, so no other date is read. A refresh that ends before its end changes
    nothing; a repetition finds no difference. A first refresh takes all dates of silver. One writer at a time; ``buckets``
    stays as it was at first.
    """
    spark = silver.sparkSession
    state, dates = State(spark, root), sorted({str(date) for date in dates})
    version = current(spark, root)
    if not dates:
        return version
    for table in (state.days, state.pairs):
        table.tidy(version, dates)
    after = version + 1
    with scratch(spark):
        recent = silver.where(F.col("event_date").isin(dates))
        days = recent.groupBy("event_date", *THREAT_KEYS, "severity", "severity_score", "os_type").agg(
            F.count("*").alias("events"), F.min("event_timestamp").alias("first_seen"), F.max("event_timestamp").alias("last_seen")
        )
        state.days.write(days, after, dates)
        now = settle(_pairs(recent), "pairs")
        state.pairs.write(now, after, dates)

        sign = lambda rows, by: rows.select(*THREAT_KEYS, "kind", "value", F.lit(by).cast("bigint").alias("dates"))
        change = sign(now, 1).unionAll(sign(state.pairs.read(version, dates), -1)).groupBy(*THREAT_KEYS, "kind", "value")
        change = change.agg(F.sum("dates").alias("dates")).where("dates <> 0")
        bucket = F.pmod(F.xxhash64(*THREAT_KEYS, "kind", "value"), F.lit(buckets)).cast("int")
        change = settle(change.select(bucket.alias("bucket"), *THREAT_KEYS, "kind", "value", "dates"), "change")
        touched = sorted(row.bucket for row in change.select("bucket").distinct().collect())
        if touched:
            for table in (state.counted, state.totals):
                table.tidy(version, touched)
            whole = state.counted.read(version, touched).unionByName(change).groupBy("bucket", *THREAT_KEYS, "kind", "value")
            counted = settle(whole.agg(F.sum("dates").alias("dates")).where("dates > 0"), "counted")
            state.counted.write(counted, after, touched)
            state.totals.write(counted.groupBy("bucket", *THREAT_KEYS, "kind").agg(F.count("*").alias("pairs")), after, touched)
        commit(spark, root, after)
    for table in (state.days, state.pairs):
        table.tidy(after, dates)
    for table in (state.counted, state.totals):
        table.tidy(after, touched)
    return after


def _pairs(rows: DataFrame) -> DataFrame:
    """The distinct pairs of each date; grouping sets, as for the other distinct counts."""
    names = list(KINDS.values())
    sets = [["event_date", *THREAT_KEYS, name] for name in names]
    marks = [(F.grouping(name) == 0).alias(f"is {kind}") for kind, name in KINDS.items()]
    found = rows.groupingSets(sets, "event_date", *THREAT_KEYS, *names).agg(F.count("*").alias("events"), *marks)
    kind, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for label, name in KINDS.items():
        kind, value = F.when(F.col(f"is {label}"), label).otherwise(kind), F.when(F.col(f"is {label}"), F.col(name)).otherwise(value)
    return found.select("event_date", *THREAT_KEYS, kind.alias("kind"), value.alias("value")).where("value IS NOT NULL")


def totals(spark: SparkSession, root: str) -> DataFrame:
    """The leaderboard without its rank, from the state alone: rows of dates and of buckets, not events or pairs."""
    state, version = State(spark, root), current(spark, root)
    empty = lambda kind: F.lit(None).cast(kind)
    days = state.days.read(version).select(*THREAT_KEYS, "severity", "severity_score", "os_type", "events", "first_seen", "last_seen", *[F.lit(0).cast("bigint").alias(k) for k in KINDS])
    counts = state.totals.read(version).select(
        *THREAT_KEYS,
        empty("string").alias("severity"),
        empty("int").alias("severity_score"),
        empty("string").alias("os_type"),
        F.lit(0).cast("bigint").alias("events"),
        empty("timestamp").alias("first_seen"),
        empty("timestamp").alias("last_seen"),
        *[F.when(F.col("kind") == k, F.col("pairs")).otherwise(0).alias(k) for k in KINDS],
    )
    return days.unionAll(counts).groupBy(*THREAT_KEYS).agg(
        F.sum("events").alias("global_hit_count"),
        F.sum("customer").alias("customers_affected"),
        F.sum("device").alias("devices_affected"),
        F.sum("country").alias("countries_affected"),
        F.max("severity").alias("max_severity"),
        F.max_by("severity", "severity_score").alias("max_severity_by_score"),
        F.max("severity_score").alias("max_severity_score"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sort_array(F.collect_set("os_type")).alias("os_types_affected"),
    )


def leaderboard(spark: SparkSession, root: str) -> DataFrame:
    """All threats with their global rank by hits, equal to ``gold.threat_leaderboard`` over the silver of the last refresh."""
    return dense_rank_by_count(settle(totals(spark, root), "threat-totals"), "global_hit_count", "threat_rank")
