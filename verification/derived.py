"""Inputs derived from the test data: bronze events, scans, topic messages and CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.session import settle
from palisade.sinks.messages import to_messages

# Offset between the message numbers of an event and of its re-delivered copy.
COPY_OFFSET = 10_000_000

# Those that bronze is made of.
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]

BASE_COLUMNS = [
    """CASE WHEN event_id % 29 = 0 THEN concat('bad-', CAST(event_id AS STRING))
            ELSE lpad(CAST(event_id AS STRING), 32, '0') END AS event_id""",
    "CASE WHEN event_id % 37 <> 0 THEN concat('DEV-', CAST(user_id * 4 + event_id % 4 AS STRING)) END AS device_id",
    "concat('CUST-', CAST(CASE WHEN user_id % 10 < 4 THEN user_id % 3 ELSE user_id END AS STRING)) AS customer_id",
    """CASE WHEN event_id % 41 = 0 THEN TIMESTAMP '1999-12-31 00:00:00'
            WHEN event_id % 43 = 0 THEN TIMESTAMP '2999-01-01 00:00:00'
            ELSE CAST(ts + (event_id % 3) * INTERVAL '40' DAY AS TIMESTAMP) END AS event_timestamp""",
    """element_at(array('Ransomware.A', 'trojan.B', 'Spyware.C', 'ADWARE.D', 'Worm.E', 'Virus.F', 'Worm.Trojan.G',
                        'Tool.H', NULL), CAST(event_id % 9 + 1 AS INT)) AS threat_name""",
    "CASE WHEN event_id % 9 <> 8 THEN concat('h', CAST(event_id % 50 AS STRING)) END AS threat_hash",
    """CASE event_type WHEN 'error' THEN ' critical ' WHEN 'purchase' THEN 'High' WHEN 'click' THEN 'MEDIUM'
            WHEN 'view' THEN 'low'
            ELSE CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'UNKNOWN' ELSE 'low ' END END AS severity""",
    """CASE WHEN copy = 1 THEN 'clean' ELSE element_at(array('quarantine', 'Delete', 'ALLOW', ' block', 'CLEAN'),
            CAST((event_id * 7 + user_id) % 5 + 1 AS INT)) END AS action_taken""",
    """element_at(array('signature', 'HEURISTIC', 'behavioral', 'machine_learning', 'Reputation'),
            CAST((event_id + user_id) % 5 + 1 AS INT)) AS detection_type""",
    "concat('/data/f', CAST(event_id AS STRING), '.bin') AS file_path",
    "CAST(floor(value * 1024) AS BIGINT) AS file_size_bytes",
    """element_at(array('windows', 'MacOS', 'LINUX', 'android', 'ios', 'solaris'),
            CAST((user_id + event_id % 3) % 6 + 1 AS INT)) AS os_type""",
    "concat('v', CAST(event_id % 4 AS STRING)) AS os_version",
    "concat('24.', CAST(event_id % 3 AS STRING)) AS product_version",
    "element_at(array('US', 'DE', 'IN', NULL), CAST((user_id + event_id % 2) % 4 + 1 AS INT)) AS country_code",
    """CASE WHEN event_id % 11 = 0 THEN 'fe80::1'
            ELSE concat_ws('.', '10', CAST(user_id % 250 AS STRING), CAST(event_id % 250 AS STRING),
                           CAST(event_id % 199 AS STRING)) END AS ip_address""",
    "CAST(event_id % 6 AS INT) AS kafka_partition",
    f"event_id + copy * {COPY_OFFSET} AS kafka_offset",
    "CAST(ts + INTERVAL '5' MINUTE + copy * INTERVAL '60' MINUTE AS TIMESTAMP) AS ingestion_timestamp",
]


def bronze_from_events(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """One bronze row per event, and a second, later delivery of every twentieth event.

    A row group goes to one task, and a file of events may have few. With ``spread`` the events are first written once by all
    tasks, for queries that read them many times or have much to do with each row.
    """
    events = spark.read.parquet(f"{folder}/events.parquet")
    if spread:
        events = settle(events.select(*EVENT_COLUMNS).repartition(F.xxhash64("event_id", "ts", "user_id")), "events")
    deliveries = F.when(F.col("event_id") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.withColumn("copy", F.explode(deliveries)).selectExpr(*BASE_COLUMNS)


def scans_from_bronze(bronze: DataFrame) -> DataFrame:
    """A scan count per date, version, OS and country: every bronze row stands for one scan."""
    keys = [F.to_date("event_timestamp").alias("kpi_date"), "product_version", "os_type", "country_code"]
    return bronze.groupBy(*keys).agg(F.count("*").alias("total_scans"))


def topic_from_bronze(bronze: DataFrame, environment: str) -> DataFrame:
    """Messages as a topic would deliver them; every thirteenth is cut off before its end."""
    events = bronze.withColumns(
        {"partition": F.col("kafka_partition"), "offset": F.col("kafka_offset"), "timestamp": F.col("ingestion_timestamp")}
    )
    whole = to_messages(events, environment, carry=["partition", "offset", "timestamp"])
    cut = F.expr("substring(value, 1, length(value) - 7)")
    return whole.withColumn("value", F.when(F.col("offset") % 13 == 0, cut).otherwise(F.col("value")))


def broken_from_bronze(bronze: DataFrame, environment: str) -> DataFrame:
    """Messages broken in six ways by their offset: not UTF-8, two objects, empty, ``null``, an array, cut off."""
    events = bronze.withColumns(
        {"partition": F.col("kafka_partition"), "offset": F.col("kafka_offset"), "timestamp": F.col("ingestion_timestamp")}
    )
    whole = to_messages(events, environment, carry=["partition", "offset", "timestamp"])
    value, kind = F.col("value"), F.col("offset") % 6
    text = lambda t: F.encode(F.lit(t), "UTF-8")
    broken = (
        F.when(kind == 0, F.concat(F.unhex(F.lit("FF")), value))
        .when(kind == 1, F.concat(value, text(" "), value))
        .when(kind == 2, text(" "))
        .when(kind == 3, text("null"))
        .when(kind == 4, F.concat(text("["), value, text("]")))
        .otherwise(F.expr("substring(value, 1, length(value) - 7)"))
    )
    return whole.withColumn("value", broken)


def write_order_files(spark: SparkSession, folder: str, path: str, gap: str = " ") -> None:
    """The ``orders`` table as CSV files of five layouts, a fifth of the rows each.

    All columns in order; two columns reversed; one column; a repeated column; values with commas, quotes and
    ``gap`` between their words.
    """
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    part = F.col("o_orderkey") % 5
    # The writer trims the trailing space, so this header names the key twice.
    repeated = (-F.col("o_orderkey")).alias("o_orderkey ")
    note = F.concat(F.lit(f'priority,{gap}"'), "o_orderpriority", F.lit('"'))
    layouts = {
        "whole": orders.where(part == 0).withColumn("o_orderdate", F.col("o_orderdate").cast("date")),
        "reversed": orders.where(part == 1).select("o_totalprice", "o_orderkey"),
        "single": orders.where(part == 2).select("o_orderkey"),
        "repeated": orders.where(part == 3).select("o_orderkey", "o_custkey", repeated),
        "quoted": orders.where(part == 4).select(note.alias("note"), "o_orderkey"),
    }
    for name, rows in layouts.items():
        rows.write.option("header", True).option("escape", '"').csv(f"{path}/{name}")
