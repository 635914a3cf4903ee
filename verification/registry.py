"""Every operator and table as a query over the test data folder.

Results show dates, timestamps, decimals, arrays, flags and integers that may be NULL as text, so that they
compare equal across engines and clients.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade import schemas as S
from palisade.functions.classify import severity_score
from palisade.functions.dates import with_date_parts
from palisade.operators.conform import PROBLEMS, conform
from palisade.operators.contract import contract_report
from palisade.operators.latest import latest_per_key
from palisade.operators.metrics import stage_counts
from palisade.operators.screening import accepted, standardise_enums, with_flags
from palisade.plans import gold, jobs, leaderboard, reports, sketches
from palisade.plans.silver import mask_addresses, quarantined_events, silver_events
from palisade.session import in_utc, settle, shared_folder
from palisade.sinks import folders
from palisade.sinks.compaction import compact
from palisade.sinks.key_index import merge_by_index
from palisade.sinks.messages import dead_letters, to_messages
from palisade.sinks.tables import layout_report, merge_table, register_table, write_quarantine, write_table
from palisade.sources import aligned_csv
from verification.derived import broken_from_bronze, bronze_from_events, scans_from_bronze, topic_from_bronze, write_order_files
from palisade.sources.messages import batch_stats, parse_messages, unreadable
from palisade.sources.tables import new_files, read_table
from palisade.streaming import events as stream_events
from palisade.streaming.files import lake_new_files
from palisade.streaming.ingest import ingest, run_available, write_batch

NOW = "2026-12-01 00:00:00"
MONTHLY_AS_OF = "2024-06-01"
WEEKLY_AS_OF = "2024-04-20"
OTHER_DATES = "event_date <> DATE '2024-02-15'"
ENVIRONMENT = "dev"
TOPIC = "detections.raw"

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _as_text(df: DataFrame) -> DataFrame:
    """Types that engines print differently become text."""

    def shown(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, "|")
        elif isinstance(field.dataType, (T.DateType, T.DecimalType, T.BinaryType, T.BooleanType)):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*[shown(field) for field in df.schema.fields])


def _text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("string") for name in names})


def query(function: Callable[[SparkSession, str], DataFrame]):
    """Register under the function's name, less a trailing underscore."""

    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _as_text(function(in_utc(spark), folder))

    QUERIES[function.__name__.rstrip("_")] = run
    return run


def _bronze(spark, folder):
    return bronze_from_events(spark, folder)


def _spread_bronze(spark, folder):
    return bronze_from_events(spark, folder, spread=True)


def _standard(spark, folder):
    return standardise_enums(_bronze(spark, folder))


def _silver(spark, folder):
    return silver_events(_bronze(spark, folder), NOW)


def _shown_gold(df: DataFrame) -> DataFrame:
    """Without the load time, which differs from run to run."""
    return df.drop("gold_processed_at", "environment")


# --- Checks and silver -------------------------------------------------------------------------
@query
def std_enums(spark, folder):
    return _standard(spark, folder).select("event_id", "kafka_offset", *S.STANDARDISED_COLUMNS)


@query
def check_flags(spark, folder):
    flagged = with_flags(_standard(spark, folder), NOW)
    return flagged.select("event_id", "kafka_offset", *[name for name in flagged.columns if name.startswith("is_")])


@query
def valid_rows(spark, folder):
    return accepted(_standard(spark, folder), NOW).select(
        "event_id", "device_id", "customer_id", *S.STANDARDISED_COLUMNS, "kafka_offset", "event_timestamp", "ingestion_timestamp"
    )


@query
def quarantine_rows(spark, folder):
    return quarantined_events(_bronze(spark, folder), NOW).drop("quarantine_ts")


@query
def dedup_latest(spark, folder):
    return latest_per_key(accepted(_standard(spark, folder), NOW)).select(
        "event_id", "action_taken", "kafka_partition", "kafka_offset", "ingestion_timestamp"
    )


@query
def ip_mask(spark, folder):
    return mask_addresses(_bronze(spark, folder)).select("event_id", "kafka_offset", "ip_address_masked")


@query
def date_parts(spark, folder):
    return with_date_parts(_bronze(spark, folder)).select(
        "event_id", "kafka_offset", "event_date", "event_hour", "event_year", "event_month"
    )


@query
def severity_score_(spark, folder):
    return _standard(spark, folder).select(
        "event_id", "kafka_offset", "severity", severity_score(F.col("severity")).alias("severity_score")
    )


@query
def threat_category(spark, folder):
    return _silver(spark, folder).select("event_id", "threat_name", "threat_category")


@query
def silver(spark, folder):
    return _silver(spark, folder)


# --- Tables written and read back --------------------------------------------------------------
@query
def silver_roundtrip(spark, folder):
    path = shared_folder(spark, "silver")
    write_table(_silver(spark, folder), path, jobs.SILVER_PARTITIONS)
    return read_table(spark, path)


@query
def silver_one_month(spark, folder):
    """One month of the written table; the date filter prunes its folders."""
    path = shared_folder(spark, "silver")
    write_table(_silver(spark, folder), path, jobs.SILVER_PARTITIONS)
    return read_table(spark, path).where("event_date >= DATE '2024-02-01' AND event_date < DATE '2024-03-01'")


@query
def quarantine_roundtrip(spark, folder):
    path = shared_folder(spark, "quarantine")
    for _ in range(2):  # the second run replaces the first
        write_quarantine(quarantined_events(_bronze(spark, folder), NOW), path, "2026-12-01")
    return read_table(spark, path).drop("quarantine_ts", "batch")


def _read_and_dropped(spark, name: str) -> DataFrame:
    """A copy of the table; its name doesn't stay in the catalog."""
    found = settle(spark.table(name), "read")
    spark.sql(f"DROP TABLE {name}")
    return found


@query
def external_daily_summary(spark, folder):
    path = shared_folder(spark, "daily-summary")
    layout = S.DAILY_SUMMARY_TABLE
    write_table(gold.daily_threat_summary(_silver(spark, folder)), path, ["event_date"], layout.cluster_by, layout.sort_by)
    name = "palisade_daily_" + path.rsplit("-", 1)[1]
    register_table(spark, name, path)
    return _read_and_dropped(spark, name)


@query
def registered_after_write(spark, folder):
    """The table by its catalog name after a second write that leaves a date out."""
    path = shared_folder(spark, "hourly")
    name = "palisade_hourly_" + path.rsplit("-", 1)[1]
    hourly = settle(gold.hourly_detection_trend(_silver(spark, folder)), "hourly")
    write_table(hourly, path, ["event_date"], table=name)
    write_table(hourly.where(OTHER_DATES), path, ["event_date"], whole=True, table=name)
    return _read_and_dropped(spark, name)


@query
def silver_two_deliveries(spark, folder):
    """Two increments, the second of them twice: late dates come in, copies replace originals."""
    path = shared_folder(spark, "silver")
    bronze = _spread_bronze(spark, folder)
    first = F.col("kafka_offset") % 7 < 5
    for part in (bronze.where(first), bronze.where(~first), bronze.where(~first)):
        jobs.bronze_to_silver(part, path, f"{path}-quarantine", ENVIRONMENT, "one", NOW, mode=jobs.MERGE)
    return read_table(spark, path).drop("silver_processed_at", "pipeline_version", "environment")


@query
def merge_by_index_(spark, folder):
    """Four deliveries merged by a key index, one of them twice; the events' order has nothing to do with their dates."""
    path = shared_folder(spark, "silver")
    bronze = _spread_bronze(spark, folder)
    turn = F.pmod(F.xxhash64("kafka_offset"), F.lit(4))
    for part in (0, 1, 2, 2, 3):
        jobs.bronze_to_silver(
            bronze.where(turn == part), path, f"{path}-quarantine", ENVIRONMENT, str(part), NOW, mode=jobs.MERGE, index=f"{path}-index"
        )
    return read_table(spark, path).drop("silver_processed_at", "pipeline_version", "environment")


@query
def silver_new_column(spark, folder):
    """A delivery with a narrower integer and without two columns, then one that has them; read through the catalog."""
    path = shared_folder(spark, "silver")
    name = "palisade_silver_" + path.rsplit("-", 1)[1]
    bronze = _spread_bronze(spark, folder)
    late = F.col("kafka_offset") % 7 >= 5
    first = silver_events(bronze.where(~late), NOW).drop("file_path", "product_version").withColumn("file_size_bytes", F.col("file_size_bytes").cast("int"))
    for delivery in (first, silver_events(bronze.where(late), NOW)):
        merge_table(delivery, path, jobs.SILVER_PARTITIONS, table=name, schema_change=True)
    return _read_and_dropped(spark, name)


@query
def silver_audited(spark, folder):
    path = shared_folder(spark, "silver")
    jobs.bronze_to_silver(_bronze(spark, folder), path, f"{path}-quarantine", ENVIRONMENT, "one", NOW, mode=jobs.REPLACE)
    return read_table(spark, path)


@query
def layout_report_(spark, folder):
    """The daily summary as it lies: each customer of a date in one file, rows in order."""
    path = shared_folder(spark, "daily-summary")
    layout = S.DAILY_SUMMARY_TABLE
    write_table(gold.daily_threat_summary(_silver(spark, folder)), path, ["event_date"], layout.cluster_by, layout.sort_by)
    report = layout_report(read_table(spark, path), ["event_date"], layout.cluster_by, layout.sort_by)
    return report.agg(F.sum("rows").alias("rows"), F.max("most_files_per_key").alias("files_per_key"), F.every("in_order").alias("in_order"))


# --- Gold as the jobs write it -----------------------------------------------------------------
def _written(spark, folder, *tables: str, since: str | None = None) -> str:
    """Run the jobs up to the gold tables named; the folder of gold."""
    root = shared_folder(spark, "gold")
    write_table(_silver(spark, folder), f"{root}/silver", jobs.SILVER_PARTITIONS)
    scans = scans_from_bronze(_standard(spark, folder))
    silver = read_table(spark, f"{root}/silver")
    jobs.silver_to_gold(silver, root, ENVIRONMENT, NOW, scans=scans, only=tables)
    if since:
        jobs.silver_to_gold(silver.where(OTHER_DATES), root, ENVIRONMENT, NOW, since=since, scans=scans, only=tables)
    return root


@query
def written_daily_threat_summary(spark, folder):
    name = S.DAILY_SUMMARY_TABLE.name
    return read_table(spark, f"{_written(spark, folder, name)}/{name}")


@query
def maintained_leaderboard(spark, folder):
    """Kept by the dates that two deliveries touched, and a date that silver lost."""
    root = shared_folder(spark, "board")
    bronze = _spread_bronze(spark, folder)
    first = F.col("kafka_offset") % 7 < 5
    for part in (bronze.where(first), bronze.where(~first)):
        dates = merge_by_index(silver_events(part, NOW), f"{root}/silver", f"{root}/index", jobs.SILVER_PARTITIONS).partitions
        leaderboard.refresh(read_table(spark, f"{root}/silver"), f"{root}/state", [date["event_date"] for date in dates])
    leaderboard.refresh(read_table(spark, f"{root}/silver").where(OTHER_DATES), f"{root}/state", ["2024-02-15"])
    return leaderboard.leaderboard(spark, f"{root}/state")


@query
def device_sketches(spark, folder):
    """Devices by day and by month, exact and whether the folded sketches of the hours come within 3 %."""
    silver = settle(_silver(spark, folder), "silver")
    path = shared_folder(spark, "sketches")
    sketches.write_sketches(silver, path)
    hours = read_table(spark, path)
    shown = []
    for name, found, day in (("day", sketches.by_day(hours), F.col("event_date")), ("month", sketches.by_month(hours), F.trunc("event_date", "MM"))):
        exact = silver.groupBy(day.alias("period")).agg(F.count_distinct("device_id").alias("devices"))
        found = found.withColumnRenamed(found.columns[0], "period")
        close = F.abs(F.col("devices_estimate") - F.col("devices_exact")) <= 0.03 * F.col("devices_exact")
        joined = found.drop("devices").join(exact.withColumnRenamed("devices", "devices_exact"), "period")
        shown.append(joined.select(F.lit(name).alias("level"), "period", "events", "devices_exact", close.alias("within_3_percent")))
    return shown[0].unionAll(shown[1])


@query
def rolling_distinct_threats(spark, folder):
    return gold.rolling_distinct_threats(_silver(spark, folder))


@query
def risk_join_bucketed(spark, folder):
    """The summary with the customer's risk from two bucketed catalog tables, joined without an exchange."""
    events = settle(_silver(spark, folder), "silver")
    name = shared_folder(spark, "pair").rsplit("-", 1)[1]
    pair = f"palisade_summary_{name}", f"palisade_risk_{name}"
    reports.write_bucketed_pair(gold.daily_threat_summary(events), gold.customer_risk_scores(events), *pair, buckets=16)
    joined = settle(reports.summary_with_risk(*map(spark.table, pair)), "joined")
    for table in pair:
        spark.sql(f"DROP TABLE {table}")
    return joined.select(*gold.SUMMARY_KEYS, "total_events", "risk_score", "risk_tier")


@query
def written_threat_leaderboard(spark, folder):
    name = S.LEADERBOARD_TABLE.name
    return read_table(spark, f"{_written(spark, folder, name)}/{name}")


@query
def written_hourly_trend(spark, folder):
    name = S.HOURLY_TREND_TABLE.name
    return read_table(spark, f"{_written(spark, folder, name)}/{name}")


@query
def written_customer_risk(spark, folder):
    name = S.CUSTOMER_RISK_TABLE.name
    return read_table(spark, f"{_written(spark, folder, name)}/{name}")


@query
def written_product_kpis(spark, folder):
    name = S.PRODUCT_KPI_TABLE.name
    kpis = read_table(spark, f"{_written(spark, folder, name)}/{name}")
    return kpis.drop("false_positive_rate", "avg_detection_time_ms", "protection_score")


@query
def gold_rebuild_after_removal(spark, folder):
    """A date that has left silver leaves gold with a rebuild that starts before it."""
    name = S.HOURLY_TREND_TABLE.name
    return read_table(spark, f"{_written(spark, folder, name, since='2024-02-01')}/{name}").drop("gold_processed_at", "environment")


def _reports(spark, folder) -> str:
    tables = [S.DAILY_SUMMARY_TABLE.name, S.CUSTOMER_RISK_TABLE.name, S.LEADERBOARD_TABLE.name]
    root = _written(spark, folder, *tables)
    jobs.gold_to_reports(root, f"{root}/reports", spark, MONTHLY_AS_OF, WEEKLY_AS_OF)
    return f"{root}/reports"


@query
def written_executive_summary(spark, folder):
    summary = read_table(spark, f"{_reports(spark, folder)}/executive_summary")
    return summary.withColumn("avg_threat_severity", F.round("avg_threat_severity", 8))


@query
def written_top_threats(spark, folder):
    return read_table(spark, f"{_reports(spark, folder)}/top_threats_weekly")


@query
def written_warehouse(spark, folder):
    """How many rows of each gold table the warehouse takes, and how many it doesn't."""
    root = _written(spark, folder, *S.WAREHOUSE_TABLES)
    counts = jobs.gold_to_warehouse(root, f"{root}/warehouse", spark, NOW)
    return spark.createDataFrame(list(counts.items()), "part STRING, rows BIGINT")


# --- Gold --------------------------------------------------------------------------------------
@query
def daily_threat_summary(spark, folder):
    return gold.daily_threat_summary(_silver(spark, folder))


@query
def threat_leaderboard(spark, folder):
    return gold.threat_leaderboard(_silver(spark, folder))


@query
def days_active(spark, folder):
    board = gold.with_days_active(gold.threat_leaderboard(_silver(spark, folder)))
    return board.select(*gold.THREAT_KEYS, "days_active")


@query
def hourly_trend(spark, folder):
    return gold.hourly_detection_trend(_silver(spark, folder))


@query
def daily_rollup(spark, folder):
    return gold.daily_customer_rollup(_silver(spark, folder))


@query
def customer_risk(spark, folder):
    return gold.customer_risk_scores(_silver(spark, folder))


@query
def product_kpis(spark, folder):
    scans = scans_from_bronze(_standard(spark, folder))
    kpis = gold.product_performance_kpis(_silver(spark, folder), scans)
    return kpis.drop("false_positive_rate", "avg_detection_time_ms", "protection_score")


# --- Reports -----------------------------------------------------------------------------------
@query
def risk_join(spark, folder):
    events = settle(_silver(spark, folder), "silver")
    joined = reports.summary_with_risk(gold.daily_threat_summary(events), gold.customer_risk_scores(events))
    return joined.select(*gold.SUMMARY_KEYS, "total_events", "risk_score", "risk_tier")


@query
def executive_summary(spark, folder):
    events = settle(_silver(spark, folder), "silver")
    summary = reports.executive_summary(gold.daily_threat_summary(events), gold.customer_risk_scores(events), MONTHLY_AS_OF)
    return summary.withColumn("avg_threat_severity", F.round("avg_threat_severity", 8))


@query
def top_threats_weekly(spark, folder):
    return reports.top_threats_weekly(gold.threat_leaderboard(_silver(spark, folder)), WEEKLY_AS_OF)


# --- Warehouse ---------------------------------------------------------------------------------
@query
def warehouse_daily_summary(spark, folder):
    return _shown_gold(conform(gold.daily_threat_summary(_silver(spark, folder)), S.DAILY_SUMMARY_TABLE)[0])


@query
def warehouse_leaderboard(spark, folder):
    board = gold.with_days_active(gold.threat_leaderboard(_silver(spark, folder)))
    return _shown_gold(conform(board, S.LEADERBOARD_TABLE)[0])


@query
def warehouse_rejects(spark, folder):
    board = gold.with_days_active(gold.threat_leaderboard(_silver(spark, folder)))
    return conform(board, S.LEADERBOARD_TABLE)[1].select(*gold.THREAT_KEYS, "threat_rank", PROBLEMS)


@query
def warehouse_customer_risk(spark, folder):
    return _shown_gold(conform(gold.customer_risk_scores(_silver(spark, folder)), S.CUSTOMER_RISK_TABLE)[0])


@query
def warehouse_hourly_trend(spark, folder):
    return _shown_gold(conform(gold.hourly_detection_trend(_silver(spark, folder)), S.HOURLY_TREND_TABLE)[0])


@query
def warehouse_product_kpis(spark, folder):
    scans = scans_from_bronze(_standard(spark, folder))
    kpis = gold.product_performance_kpis(_silver(spark, folder), scans)
    return _text(_shown_gold(conform(kpis, S.PRODUCT_KPI_TABLE)[0]), "avg_detection_time_ms")


# --- Messages and streams ----------------------------------------------------------------------
def _topic(spark, folder):
    return settle(topic_from_bronze(_bronze(spark, folder), ENVIRONMENT), "topic")


@query
def publish_rows(spark, folder):
    shown_header = lambda header: F.concat(header["key"], F.lit("="), F.decode(header["value"], "UTF-8"))
    return to_messages(_bronze(spark, folder), ENVIRONMENT).select(
        F.decode("key", "UTF-8").alias("key"),
        F.decode("value", "UTF-8").alias("value"),
        F.transform("headers", shown_header).alias("headers"),
    )


@query
def dead_letters_(spark, folder):
    letters = dead_letters(unreadable(parse_messages(_topic(spark, folder))), TOPIC, NOW)
    shape = "original_event STRING, error STRING, failed_at STRING, topic STRING"
    return letters.select(F.from_json(F.decode("value", "UTF-8"), shape).alias("letter")).select("letter.*").drop("failed_at")


@query
def message_stats(spark, folder):
    return batch_stats(parse_messages(_topic(spark, folder)))


def _ingested(spark, folder) -> str:
    """Run the topic through the ingest stream; the folder with what it wrote."""
    root = shared_folder(spark, "topic")
    topic_from_bronze(_spread_bronze(spark, folder), ENVIRONMENT).write.parquet(f"{root}/topic")
    messages = new_files(spark, f"{root}/topic", S.MESSAGE)
    ingest(messages, TOPIC, f"{root}/bronze", f"{root}/letters", f"{root}/stats", f"{root}/checkpoint-ingest")
    return root


NULLABLE_BRONZE = S.BRONZE.replace(" NOT NULL", "")


# One task writes a file, and one reads it again, as it is one row group. So a batch of more than this comes in several: some
# 100,000 compressed rows.
ARRIVING_BYTES = 4 << 20


def _files_per_batch(size: int, batches: int) -> int:
    return max(1, -(-size // (batches * ARRIVING_BYTES)))


def _kept(spark, folder, batches: int = 1, index: bool = False) -> str:
    """The ingested bronze rows merged by the silver stream in so many micro-batches; the folder with what it wrote."""
    root = _ingested(spark, folder)
    rows = spark.read.parquet(f"{root}/bronze").drop("batch_id")
    files = _files_per_batch(sum(sum(part.sizes.values()) for part in folders.partitions(spark, f"{root}/bronze", ["batch_id"], sizes=True)), batches)
    rows.repartition(batches * files, F.xxhash64("kafka_offset")).write.parquet(f"{root}/arriving")
    arrived = new_files(spark, f"{root}/arriving", NULLABLE_BRONZE, files_per_batch=files)
    stream_events.keep_silver(
        arrived, f"{root}/silver", f"{root}/checkpoint-silver", f"{root}/quarantine", f"{root}/hourly", NOW, f"{root}/index" if index else None
    )
    return root


@query
def stream_silver(spark, folder):
    return spark.read.parquet(f"{_kept(spark, folder)}/silver")


@query
def stream_silver_in_batches(spark, folder):
    return spark.read.parquet(f"{_kept(spark, folder, 4)}/silver")


@query
def stream_silver_by_index(spark, folder):
    return spark.read.parquet(f"{_kept(spark, folder, 4, index=True)}/silver")


@query
def compacted_bronze(spark, folder):
    """Silver from bronze that came in 50 micro-batches, after their small files were compacted, the second time in vain."""
    root = shared_folder(spark, "bronze")
    _bronze(spark, folder).repartition(50, F.xxhash64("kafka_offset")).write.parquet(f"{root}/arriving")
    arrived = new_files(spark, f"{root}/arriving", NULLABLE_BRONZE, files_per_batch=1)
    run_available(arrived, lambda batch, number: write_batch(batch, f"{root}/bronze", number), f"{root}/checkpoint")
    for _ in range(2):
        compact(spark, f"{root}/bronze", ["batch_id"], across="batch_id")
    return silver_events(spark.read.parquet(f"{root}/bronze").drop("batch_id"), NOW)


@query
def stream_quarantine(spark, folder):
    return spark.read.parquet(f"{_kept(spark, folder)}/quarantine").drop("quarantine_ts", "batch_id")


@query
def stream_hourly(spark, folder):
    return spark.read.parquet(f"{_kept(spark, folder)}/hourly")


@query
def stream_hourly_in_batches(spark, folder):
    """Batches in an order that has nothing to do with time."""
    return spark.read.parquet(f"{_kept(spark, folder, 4)}/hourly")


@query
def dead_letter_kinds(spark, folder):
    """Messages broken in six ways, one after the other."""
    letters = dead_letters(unreadable(parse_messages(broken_from_bronze(_bronze(spark, folder), ENVIRONMENT))), TOPIC, NOW)
    shape = "original_event STRING, error STRING, original_base64 STRING"
    return letters.select(F.from_json(F.decode("value", "UTF-8"), shape).alias("letter")).select("letter.*")


# --- Misaligned CSV ----------------------------------------------------------------------------
def _order_files(spark, folder, gap: str = " ") -> str:
    path = shared_folder(spark, "orders-csv")
    write_order_files(spark, folder, path, gap)
    return path


@query
def csv_aligned(spark, folder):
    lines = aligned_csv.read_aligned(spark, _order_files(spark, folder), [*ORDER_COLUMNS, "note"], ORDER_TYPES)
    return _text(lines.drop("surplus", "file", "modified"), "o_custkey")


@query
def csv_multi_line(spark, folder):
    path = _order_files(spark, folder, "\n")
    records = aligned_csv.read_aligned(spark, path, [*ORDER_COLUMNS, "note"], ORDER_TYPES, multi_line=True)
    return _text(records.drop("surplus", "file", "modified"), "o_custkey")


@query
def csv_torn_records(spark, folder):
    """Files with line breaks inside values, found among the others and read whole."""
    records = aligned_csv.read_aligned(spark, _order_files(spark, folder, "\n"), [*ORDER_COLUMNS, "note"], ORDER_TYPES)
    return _text(records.drop("surplus", "file", "modified"), "o_custkey")


@query
def csv_headers(spark, folder):
    headers = aligned_csv.file_headers(aligned_csv.read_lines(spark, _order_files(spark, folder)))
    return aligned_csv.header_report(headers, ORDER_COLUMNS).drop("file").distinct()


def _per_day(lake: DataFrame) -> DataFrame:
    sums = [F.count("*").alias("rows"), F.sum("o_orderkey").alias("key_sum"), F.count("note").alias("notes")]
    return _text(lake.groupBy("year", "month", "day").agg(*sums), "year", "month", "day")


LAKE_COLUMNS = [*ORDER_COLUMNS, "note"]


@query
def csv_lake(spark, folder):
    lake = shared_folder(spark, "orders-lake")
    lines = aligned_csv.read_aligned(spark, _order_files(spark, folder), LAKE_COLUMNS, ORDER_TYPES)
    aligned_csv.write_lake(lines, lake, "one", "o_orderdate")
    return _per_day(read_table(spark, lake))


@query
def csv_lake_two_loads(spark, folder):
    """Two loads with rows of the same days, the second of them twice."""
    lake = shared_folder(spark, "orders-lake")
    lines = aligned_csv.read_aligned(spark, _order_files(spark, folder), LAKE_COLUMNS, ORDER_TYPES)
    for load, rest in (("one", 0), ("two", 1), ("two", 1)):
        aligned_csv.write_lake(lines.where(F.col("o_orderkey") % 2 == rest), lake, load, "o_orderdate")
    return _per_day(read_table(spark, lake))


@query
def stream_csv_lake(spark, folder):
    lake = shared_folder(spark, "orders-lake")
    lines = aligned_csv.new_lines(spark, _order_files(spark, folder))
    lake_new_files(lines, lake, f"{lake}-checkpoint", LAKE_COLUMNS, ORDER_TYPES, "o_orderdate")
    return _per_day(read_table(spark, lake))


# --- Contract and counts -----------------------------------------------------------------------
@query
def schema_contract(spark, folder):
    return contract_report(_bronze(spark, folder), S.BRONZE)


@query
def row_counts(spark, folder):
    return stage_counts(_bronze(spark, folder), NOW)


@query
def run_metrics(spark, folder):
    """Both jobs from bronze to the written gold tables; the counts come from the writes."""
    root = shared_folder(spark, "run")
    bronze = _spread_bronze(spark, folder)
    counts = jobs.bronze_to_silver(bronze, f"{root}/silver", f"{root}/quarantine", ENVIRONMENT, "first", NOW, mode=jobs.REPLACE)
    scans = scans_from_bronze(standardise_enums(bronze))
    counts |= jobs.silver_to_gold(read_table(spark, f"{root}/silver"), f"{root}/gold", ENVIRONMENT, NOW, scans=scans)
    counts |= jobs.gold_to_reports(f"{root}/gold", f"{root}/reports", spark, MONTHLY_AS_OF, WEEKLY_AS_OF)
    return spark.createDataFrame(list(counts.items()), "stage STRING, rows BIGINT")

