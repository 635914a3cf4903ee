"""Fixed data contract: event fields, domain values, warehouse column types."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: domains ---------------------------------------------------------------------
SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
ACTIONS = ["QUARANTINE", "DELETE", "ALLOW", "BLOCK", "CLEAN"]
DETECTION_TYPES = ["SIGNATURE", "HEURISTIC", "BEHAVIORAL", "MACHINE_LEARNING", "REPUTATION"]
OS_TYPES = ["WINDOWS", "MACOS", "LINUX", "ANDROID", "IOS"]

SEVERITY_SCORES = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1}
UNKNOWN_SEVERITY_SCORE = 0

# A category is looked for in this order; the first one found in the threat name wins.
THREAT_CATEGORIES = ["RANSOMWARE", "TROJAN", "SPYWARE", "ADWARE", "WORM", "VIRUS"]
OTHER_CATEGORY = "OTHER"

EVENT_ID_PATTERN = r"^[0-9a-fA-F-]{32,36}$"
EARLIEST_EVENT = "2010-01-01 00:00:00"

STANDARDISED_COLUMNS = ["severity", "action_taken", "detection_type", "os_type"]
REQUIRED_COLUMNS = ["event_id", "device_id", "customer_id", "event_timestamp"]

RISK_WEIGHTS = {"rolling_30d_severity": 0.5, "rolling_30d_unique_threats": 10, "rolling_30d_events": 0.1}
RISK_TIERS = [("CRITICAL", 500), ("HIGH", 200), ("MEDIUM", 50)]
LOWEST_RISK_TIER = "LOW"
RISK_WINDOW_DAYS = 30

PIPELINE_VERSION = "2.0.0"
QUARANTINE_REASON = "VALIDATION_FAILURE"
MESSAGE_SCHEMA_VERSION = "1.0"
MESSAGE_SOURCE = "ENDPOINT_AGENT"
MESSAGE_CONTENT_TYPE = "application/json"

# --- Event layouts -----------------------------------------------------------------------------
# JSON payload of one message; timestamps travel as ISO text.
MESSAGE_PAYLOAD = """
    event_id STRING, device_id STRING, customer_id STRING, event_timestamp STRING,
    threat_name STRING, threat_hash STRING, severity STRING, action_taken STRING,
    detection_type STRING, file_path STRING, file_size_bytes BIGINT,
    os_type STRING, os_version STRING, product_version STRING, country_code STRING,
    ip_address STRING, ingestion_timestamp STRING, kafka_source STRING, schema_version STRING
"""

# One message as a topic delivers it.
MESSAGE = """
    key BINARY, value BINARY, headers ARRAY<STRUCT<key: STRING, value: BINARY>>,
    partition INT, offset BIGINT, timestamp TIMESTAMP
"""

BRONZE = """
    event_id STRING NOT NULL, device_id STRING NOT NULL, customer_id STRING NOT NULL,
    event_timestamp TIMESTAMP NOT NULL, threat_name STRING, threat_hash STRING, severity STRING,
    action_taken STRING, detection_type STRING, file_path STRING, file_size_bytes BIGINT,
    os_type STRING, os_version STRING, product_version STRING, country_code STRING,
    ip_address STRING, kafka_partition INT, kafka_offset BIGINT, ingestion_timestamp TIMESTAMP
"""


# --- Warehouse tables --------------------------------------------------------------------------
@dataclass(frozen=True)
class WarehouseColumn:
    """``width`` is the longest text in bytes; ``default`` replaces a missing value ("now": the load time)."""

    name: str
    type: str
    width: int | None = None
    required: bool = False
    default: int | str | None = None


@dataclass(frozen=True)
class WarehouseTable:
    """``cluster_by`` is the distribution key, ``sort_by`` the order inside each file."""

    name: str
    columns: tuple[WarehouseColumn, ...]
    cluster_by: tuple[str, ...]
    sort_by: tuple[str, ...]


def _text(name, width, required=False):
    return WarehouseColumn(name, "string", width=width, required=required)


def _count(name, kind="int"):
    return WarehouseColumn(name, kind, default=0)


def _plain(name, kind, required=False):
    return WarehouseColumn(name, kind, required=required)


def _load_time():
    return WarehouseColumn("gold_processed_at", "timestamp", default="now")


DAILY_SUMMARY_TABLE = WarehouseTable(
    "daily_threat_summary",
    (
        _text("customer_id", 50, required=True),
        _plain("event_date", "date", required=True),
        _text("country_code", 2),
        _text("os_type", 20),
        _count("total_events", "bigint"),
        _count("affected_devices"),
        _count("unique_threats"),
        _count("critical_count"),
        _count("high_count"),
        _count("medium_count"),
        _count("low_count"),
        _count("quarantined_count"),
        _count("deleted_count"),
        _count("blocked_count"),
        _plain("avg_severity_score", "decimal(5,2)"),
        _plain("max_severity_score", "int"),
        _text("product_version", 20),
        _load_time(),
        _text("environment", 10),
    ),
    cluster_by=("customer_id",),
    sort_by=("event_date", "customer_id"),
)

# Every node of the warehouse holds a copy of the leaderboard, so it has no distribution key.
LEADERBOARD_TABLE = WarehouseTable(
    "global_threat_leaderboard",
    (
        _text("threat_name", 500, required=True),
        _text("threat_hash", 64),
        _text("threat_category", 50),
        _text("detection_type", 30),
        _count("global_hit_count", "bigint"),
        _count("customers_affected"),
        _count("devices_affected"),
        _count("countries_affected", "smallint"),
        _text("max_severity", 10),
        _plain("max_severity_score", "int"),
        _plain("first_seen", "timestamp"),
        _plain("last_seen", "timestamp"),
        _plain("threat_rank", "int"),
        _plain("days_active", "int"),
        _load_time(),
        _text("environment", 10),
    ),
    cluster_by=(),
    sort_by=("threat_rank", "global_hit_count"),
)

CUSTOMER_RISK_TABLE = WarehouseTable(
    "customer_risk_scores",
    (
        _text("customer_id", 50, required=True),
        _plain("event_date", "date", required=True),
        _plain("daily_severity_sum", "decimal(10,2)"),
        _plain("daily_events", "int"),
        _plain("daily_unique_threats", "int"),
        _plain("rolling_30d_severity", "decimal(12,2)"),
        _plain("rolling_30d_events", "bigint"),
        _plain("rolling_30d_unique_threats", "int"),
        _plain("risk_score", "decimal(12,2)"),
        _text("risk_tier", 10),
        _load_time(),
        _text("environment", 10),
    ),
    cluster_by=("customer_id",),
    sort_by=("customer_id", "event_date"),
)

HOURLY_TREND_TABLE = WarehouseTable(
    "hourly_detection_trend",
    (
        _plain("event_date", "date", required=True),
        _plain("event_hour", "smallint", required=True),
        _text("threat_category", 50),
        _text("os_type", 20),
        _text("country_code", 2),
        _plain("detection_count", "int"),
        _plain("devices_count", "int"),
        _plain("avg_severity_score", "decimal(5,2)"),
        _plain("high_critical_count", "int"),
        _load_time(),
        _text("environment", 10),
    ),
    cluster_by=(),
    sort_by=("event_date", "event_hour"),
)

PRODUCT_KPI_TABLE = WarehouseTable(
    "product_performance_kpis",
    (
        _plain("kpi_date", "date", required=True),
        _text("product_version", 20, required=True),
        _text("os_type", 20),
        _text("country_code", 2),
        _plain("detection_rate", "decimal(7,4)"),
        _plain("false_positive_rate", "decimal(7,4)"),
        _plain("avg_detection_time_ms", "int"),
        _plain("active_devices", "int"),
        _plain("total_scans", "bigint"),
        _plain("threats_blocked", "bigint"),
        _plain("protection_score", "decimal(5,2)"),
        _load_time(),
    ),
    cluster_by=("product_version",),
    sort_by=("kpi_date", "product_version"),
)

WAREHOUSE_TABLES = {
    table.name: table
    for table in (
        DAILY_SUMMARY_TABLE,
        LEADERBOARD_TABLE,
        CUSTOMER_RISK_TABLE,
        HOURLY_TREND_TABLE,
        PRODUCT_KPI_TABLE,
    )
}
