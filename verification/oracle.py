"""The registered queries once more as DuckDB SQL, written on their own to check the Spark results.

Dates, timestamps, decimals, arrays, flags and integers that may be NULL are compared as text, on both sides.
"""

from __future__ import annotations

# The bronze fixture: FIXTURES.md, section 3.
BASE = """
base AS (
 SELECT
  CASE WHEN event_id % 29 = 0 THEN concat('bad-', CAST(event_id AS STRING)) ELSE lpad(CAST(event_id AS STRING), 32, '0') END AS event_id,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE concat('DEV-', CAST(user_id * 4 + event_id % 4 AS STRING)) END AS device_id,
  concat('CUST-', CAST(CASE WHEN user_id % 10 < 4 THEN user_id % 3 ELSE user_id END AS STRING)) AS customer_id,
  CASE WHEN event_id % 41 = 0 THEN TIMESTAMP '1999-12-31 00:00:00' WHEN event_id % 43 = 0 THEN TIMESTAMP '2999-01-01 00:00:00'
       ELSE CAST(ts + (event_id % 3) * INTERVAL '40' DAY AS TIMESTAMP) END AS event_timestamp,
  CASE event_id % 9 WHEN 0 THEN 'Ransomware.A' WHEN 1 THEN 'trojan.B' WHEN 2 THEN 'Spyware.C' WHEN 3 THEN 'ADWARE.D' WHEN 4 THEN 'Worm.E'
       WHEN 5 THEN 'Virus.F' WHEN 6 THEN 'Worm.Trojan.G' WHEN 7 THEN 'Tool.H' END AS threat_name,
  CASE WHEN event_id % 9 = 8 THEN NULL ELSE concat('h', CAST(event_id % 50 AS STRING)) END AS threat_hash,
  CASE event_type WHEN 'error' THEN ' critical ' WHEN 'purchase' THEN 'High' WHEN 'click' THEN 'MEDIUM' WHEN 'view' THEN 'low'
       ELSE CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'UNKNOWN' ELSE 'low ' END END AS severity,
  CASE (event_id * 7 + user_id) % 5 WHEN 0 THEN 'quarantine' WHEN 1 THEN 'Delete' WHEN 2 THEN 'ALLOW' WHEN 3 THEN ' block' ELSE 'CLEAN' END AS action_taken,
  CASE (event_id + user_id) % 5 WHEN 0 THEN 'signature' WHEN 1 THEN 'HEURISTIC' WHEN 2 THEN 'behavioral' WHEN 3 THEN 'machine_learning' ELSE 'Reputation' END AS detection_type,
  concat('/data/f', CAST(event_id AS STRING), '.bin') AS file_path,
  CAST(floor(value * 1024) AS BIGINT) AS file_size_bytes,
  CASE (user_id + event_id % 3) % 6 WHEN 0 THEN 'windows' WHEN 1 THEN 'MacOS' WHEN 2 THEN 'LINUX' WHEN 3 THEN 'android' WHEN 4 THEN 'ios' ELSE 'solaris' END AS os_type,
  concat('v', CAST(event_id % 4 AS STRING)) AS os_version,
  concat('24.', CAST(event_id % 3 AS STRING)) AS product_version,
  CASE (user_id + event_id % 2) % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'DE' WHEN 2 THEN 'IN' ELSE NULL END AS country_code,
  CASE WHEN event_id % 11 = 0 THEN 'fe80::1' ELSE concat('10.', CAST(user_id % 250 AS STRING), '.', CAST(event_id % 250 AS STRING), '.', CAST(event_id % 199 AS STRING)) END AS ip_address,
  CAST(event_id % 6 AS INT) AS kafka_partition,
  event_id AS kafka_offset,
  CAST(ts + INTERVAL '5' MINUTE AS TIMESTAMP) AS ingestion_timestamp,
  event_id AS src
 FROM events),
bronze AS (
 SELECT * FROM base
 UNION ALL
 SELECT event_id, device_id, customer_id, event_timestamp, threat_name, threat_hash, severity, 'clean' AS action_taken, detection_type, file_path, file_size_bytes,
        os_type, os_version, product_version, country_code, ip_address, kafka_partition, kafka_offset + 10000000 AS kafka_offset,
        CAST(ingestion_timestamp + INTERVAL '60' MINUTE AS TIMESTAMP) AS ingestion_timestamp, src
 FROM base WHERE src % 20 = 0)
"""

# {arrived} restricts the bronze rows that the later steps see.
STEPS = """,
arrived AS (SELECT * FROM bronze WHERE {arrived}),
std AS (
 SELECT * REPLACE (upper(trim(severity)) AS severity, upper(trim(action_taken)) AS action_taken,
                   upper(trim(detection_type)) AS detection_type, upper(trim(os_type)) AS os_type) FROM arrived),
checked AS (
 SELECT *,
  regexp_matches(event_id, '^[0-9a-fA-F-]{{32,36}}$') AS is_valid_event_id,
  severity IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL') AS is_valid_severity,
  action_taken IN ('QUARANTINE', 'DELETE', 'ALLOW', 'BLOCK', 'CLEAN') AS is_valid_action,
  detection_type IN ('SIGNATURE', 'HEURISTIC', 'BEHAVIORAL', 'MACHINE_LEARNING', 'REPUTATION') AS is_valid_detection,
  os_type IN ('WINDOWS', 'MACOS', 'LINUX', 'ANDROID', 'IOS') AS is_valid_os,
  (event_id IS NOT NULL AND device_id IS NOT NULL AND customer_id IS NOT NULL AND event_timestamp IS NOT NULL) AS is_not_null,
  (event_timestamp >= TIMESTAMP '2010-01-01 00:00:00' AND event_timestamp <= TIMESTAMP '2026-12-01 00:00:00') AS is_valid_timestamp
 FROM std),
flagged AS (
 SELECT *, coalesce(is_valid_event_id AND is_valid_severity AND is_valid_action AND is_valid_detection
                    AND is_not_null AND is_valid_timestamp, FALSE) AS is_valid_record
 FROM checked),
latest AS (
 SELECT * FROM flagged WHERE is_valid_record
 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp DESC NULLS LAST,
                            kafka_partition DESC NULLS LAST, kafka_offset DESC NULLS LAST) = 1),
silver AS (
 SELECT *,
  regexp_replace(ip_address, '\\.\\d+$', '.xxx') AS ip_address_masked,
  CAST(event_timestamp AS DATE) AS event_date,
  CAST(extract(hour FROM event_timestamp) AS INT) AS event_hour,
  CAST(extract(year FROM event_timestamp) AS INT) AS event_year,
  CAST(extract(month FROM event_timestamp) AS INT) AS event_month,
  CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END AS severity_score,
  CASE WHEN threat_name ILIKE '%ransomware%' THEN 'RANSOMWARE' WHEN threat_name ILIKE '%trojan%' THEN 'TROJAN'
       WHEN threat_name ILIKE '%spyware%' THEN 'SPYWARE' WHEN threat_name ILIKE '%adware%' THEN 'ADWARE'
       WHEN threat_name ILIKE '%worm%' THEN 'WORM' WHEN threat_name ILIKE '%virus%' THEN 'VIRUS' ELSE 'OTHER' END AS threat_category
 FROM latest),
daily AS (
 SELECT customer_id, event_date, country_code, os_type,
  count(*) AS total_events, count(DISTINCT device_id) AS affected_devices, count(DISTINCT threat_hash) AS unique_threats,
  count(*) FILTER (severity = 'CRITICAL') AS critical_count, count(*) FILTER (severity = 'HIGH') AS high_count,
  count(*) FILTER (severity = 'MEDIUM') AS medium_count, count(*) FILTER (severity = 'LOW') AS low_count,
  count(*) FILTER (action_taken = 'QUARANTINE') AS quarantined_count,
  count(*) FILTER (action_taken = 'DELETE') AS deleted_count, count(*) FILTER (action_taken = 'BLOCK') AS blocked_count,
  avg(severity_score) AS avg_severity_score, max(severity_score) AS max_severity_score,
  list_sort(list(DISTINCT threat_category)) AS threat_categories_detected,
  first(product_version ORDER BY event_timestamp DESC, product_version DESC) AS product_version
 FROM silver GROUP BY ALL),
totals AS (
 SELECT threat_name, threat_hash, threat_category, detection_type,
  count(*) AS global_hit_count, count(DISTINCT customer_id) AS customers_affected,
  count(DISTINCT device_id) AS devices_affected, count(DISTINCT country_code) AS countries_affected,
  max(severity) AS max_severity, arg_max(severity, severity_score) AS max_severity_by_score,
  max(severity_score) AS max_severity_score, min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen,
  list_sort(list(DISTINCT os_type)) AS os_types_affected
 FROM silver GROUP BY ALL),
board AS (
 SELECT *, CAST(dense_rank() OVER (ORDER BY global_hit_count DESC) AS INT) AS threat_rank,
  CAST(date_diff('day', first_seen, last_seen) AS INT) AS days_active FROM totals),
hourly AS (
 SELECT event_date, event_hour, threat_category, os_type, country_code, count(*) AS detection_count,
  count(DISTINCT device_id) AS devices_count, avg(severity_score) AS avg_severity_score,
  count(*) FILTER (severity_score >= 3) AS high_critical_count
 FROM silver GROUP BY ALL),
rollup_days AS (
 SELECT customer_id, event_date, CAST(sum(severity_score) AS BIGINT) AS daily_severity_sum, count(*) AS daily_events,
  count(DISTINCT threat_hash) AS daily_unique_threats
 FROM silver GROUP BY ALL),
rolling AS (
 SELECT *,
  CAST(sum(daily_severity_sum) OVER span AS BIGINT) AS rolling_30d_severity,
  CAST(sum(daily_events) OVER span AS BIGINT) AS rolling_30d_events,
  CAST(sum(daily_unique_threats) OVER span AS BIGINT) AS rolling_30d_unique_threats
 FROM rollup_days
 WINDOW span AS (PARTITION BY customer_id ORDER BY event_date RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW)),
scored AS (
 SELECT *, rolling_30d_severity * CAST(0.5 AS DOUBLE) + rolling_30d_unique_threats * 10 + rolling_30d_events * CAST(0.1 AS DOUBLE) AS risk_score
 FROM rolling),
risk AS (
 SELECT *, CASE WHEN risk_score >= 500 THEN 'CRITICAL' WHEN risk_score >= 200 THEN 'HIGH' WHEN risk_score >= 50 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
 FROM scored)
"""

STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"
TEXT = "CAST({0} AS VARCHAR) AS {0}"
LIST = "array_to_string({0}, '|') AS {0}"

EVENT_TIMES = STAMP.format("event_timestamp") + ", " + STAMP.format("ingestion_timestamp")
FLAG_NAMES = (
    "is_valid_event_id is_valid_severity is_valid_action is_valid_detection is_valid_os is_not_null "
    "is_valid_timestamp is_valid_record"
).split()
FLAGS = ", ".join(TEXT.format(name) for name in FLAG_NAMES)
SILVER_COLUMNS = (
    "event_id, device_id, customer_id, threat_name, threat_hash, severity, action_taken, detection_type, file_path, "
    "file_size_bytes, os_type, os_version, product_version, country_code, kafka_partition, kafka_offset, "
    f"ip_address_masked, event_hour, event_year, event_month, severity_score, threat_category, "
    f"{TEXT.format('event_date')}, {EVENT_TIMES}"
)
DAILY_COLUMNS = f"* REPLACE ({TEXT.format('event_date')}, {LIST.format('threat_categories_detected')})"
BOARD_COLUMNS = f"* REPLACE ({STAMP.format('first_seen')}, {STAMP.format('last_seen')}, {LIST.format('os_types_affected')})"
DATED = f"* REPLACE ({TEXT.format('event_date')})"

# Mean of two decimals, rounded half up from the exact integers.
MEAN_2 = "CAST(CAST(floor((sum_score * 200 + n) / (2 * n)) / 100 AS DECIMAL(5,2)) AS VARCHAR)"


def _sql(body: str, arrived: str = "TRUE") -> str:
    return "WITH " + BASE + STEPS.format(arrived=arrived) + body


def _as(kind: str, *columns: str) -> str:
    return ", ".join(f"CAST({column} AS {kind}) AS {column}" for column in columns)


def _decimal(column: str, precision: int, scale: int) -> str:
    return f"CAST(CAST({column} AS DECIMAL({precision},{scale})) AS VARCHAR) AS {column}"


READABLE = "kafka_offset % 13 <> 0"

PAYLOAD = """to_json({'event_id': event_id, 'device_id': device_id, 'customer_id': customer_id,
  'event_timestamp': strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00',
  'threat_name': threat_name, 'threat_hash': threat_hash, 'severity': severity, 'action_taken': action_taken,
  'detection_type': detection_type, 'file_path': file_path, 'file_size_bytes': file_size_bytes, 'os_type': os_type,
  'os_version': os_version, 'product_version': product_version, 'country_code': country_code, 'ip_address': ip_address,
  'ingestion_timestamp': strftime(ingestion_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00',
  'kafka_source': 'ENDPOINT_AGENT', 'schema_version': '1.0'})::VARCHAR"""

BRONZE_TYPES = [
    ("event_id", "string"), ("device_id", "string"), ("customer_id", "string"), ("event_timestamp", "timestamp"),
    ("threat_name", "string"), ("threat_hash", "string"), ("severity", "string"), ("action_taken", "string"),
    ("detection_type", "string"), ("file_path", "string"), ("file_size_bytes", "bigint"), ("os_type", "string"),
    ("os_version", "string"), ("product_version", "string"), ("country_code", "string"), ("ip_address", "string"),
    ("kafka_partition", "int"), ("kafka_offset", "bigint"), ("ingestion_timestamp", "timestamp"),
]
REQUIRED = ("event_id", "device_id", "customer_id", "event_timestamp")


def _contract() -> str:
    lines = []
    for name, kind in BRONZE_TYPES:
        nulls = f"count(*) FILTER ({name} IS NULL)" if name in REQUIRED else "0"
        lines.append(
            f"SELECT '{name}' AS \"column\", '{kind}' AS expected, '{kind}' AS actual, count(*) AS \"rows\", "
            f"CAST({nulls} AS BIGINT) AS forbidden_nulls, CAST({nulls} = 0 AS VARCHAR) AS agrees FROM bronze"
        )
    return _sql(" UNION ALL ".join(lines))


FAILED = " || ".join(
    f"CASE WHEN coalesce({name}, FALSE) THEN [] ELSE ['{name}'] END"
    for name in (
        "is_valid_event_id", "is_valid_severity", "is_valid_action", "is_valid_detection", "is_not_null", "is_valid_timestamp",
    )
)

QUARANTINE = f"""SELECT event_id, device_id, customer_id, threat_name, threat_hash, severity, action_taken, detection_type,
  file_path, file_size_bytes, os_type, os_version, product_version, country_code, kafka_partition, kafka_offset, {FLAGS},
  regexp_replace(ip_address, '\\.\\d+$', '.xxx') AS ip_address_masked, array_to_string({FAILED}, '|') AS failed_checks,
  'VALIDATION_FAILURE' AS quarantine_reason, {EVENT_TIMES} FROM flagged WHERE NOT is_valid_record"""

EXECUTIVE = """SELECT strftime(month_start, '%Y-%m-%d') AS report_month,
  count(DISTINCT who) AS active_customers, CAST(sum(events) AS BIGINT) AS total_threats_detected,
  CAST(sum(severe) AS BIGINT) AS high_severity_threats, CAST(sum(stopped) AS BIGINT) AS threats_blocked,
  round(sum(mean_score) / count(mean_score), 8) AS avg_threat_severity,
  count(DISTINCT who) FILTER (tier = 'CRITICAL') AS customers_at_critical_risk
 FROM (SELECT date_trunc('month', daily.event_date) AS month_start, daily.customer_id AS who, total_events AS events,
        critical_count + high_count AS severe, quarantined_count + deleted_count + blocked_count AS stopped,
        avg_severity_score AS mean_score,
        (SELECT risk_tier FROM risk WHERE risk.customer_id = daily.customer_id AND risk.event_date = daily.event_date) AS tier
       FROM daily WHERE daily.event_date >= DATE '2023-12-01')
 GROUP BY month_start"""

WEEKLY = """SELECT threat_name, threat_category, CAST(sum(global_hit_count) AS BIGINT) AS weekly_hits,
  max_severity AS peak_severity, CAST(sum(customers_affected) AS BIGINT) AS total_customers, threat_rank
 FROM board WHERE CAST(last_seen AS DATE) BETWEEN DATE '2024-04-13' AND DATE '9999-12-31'
 GROUP BY ALL ORDER BY weekly_hits DESC, threat_name NULLS LAST, threat_category, peak_severity, threat_rank LIMIT 10"""

KPIS = """SELECT CAST(k.kpi_date AS VARCHAR) AS kpi_date, k.product_version, k.os_type, k.country_code,
  CAST(CAST(floor((detected * 20000 + total_scans) / (2 * total_scans)) / 10000 AS DECIMAL(7,4)) AS VARCHAR) AS detection_rate,
  active_devices, total_scans, threats_blocked
 FROM (SELECT event_date AS kpi_date, product_version, os_type, country_code, count(*) AS detected,
        count(DISTINCT device_id) AS active_devices,
        count(*) FILTER (action_taken IN ('QUARANTINE', 'DELETE', 'BLOCK')) AS threats_blocked
       FROM silver GROUP BY ALL) k
 JOIN (SELECT CAST(event_timestamp AS DATE) AS kpi_date, product_version, os_type, country_code, count(*) AS total_scans
       FROM std GROUP BY ALL) s
 ON k.kpi_date = s.kpi_date AND k.product_version = s.product_version AND k.os_type = s.os_type
    AND k.country_code IS NOT DISTINCT FROM s.country_code"""

WAREHOUSE_DAILY = f"""SELECT customer_id, CAST(event_date AS VARCHAR) AS event_date, country_code, os_type, total_events,
  {_as('INT', 'affected_devices', 'unique_threats', 'critical_count', 'high_count', 'medium_count', 'low_count')},
  {_as('INT', 'quarantined_count', 'deleted_count', 'blocked_count')}, {MEAN_2} AS avg_severity_score, max_severity_score, product_version
 FROM (SELECT *, total_events AS n, critical_count * 4 + high_count * 3 + medium_count * 2 + low_count AS sum_score FROM daily)"""

WAREHOUSE_BOARD = f"""SELECT threat_name, threat_hash, threat_category, detection_type, global_hit_count,
  {_as('INT', 'customers_affected', 'devices_affected')}, {_as('SMALLINT', 'countries_affected')}, max_severity, max_severity_score, {STAMP.format('first_seen')},
  {STAMP.format('last_seen')}, threat_rank, days_active FROM board WHERE threat_name IS NOT NULL"""

WAREHOUSE_REJECTS = """SELECT threat_name, threat_hash, threat_category, detection_type, threat_rank,
  'missing:threat_name' AS rejected_for FROM board WHERE threat_name IS NULL"""

WAREHOUSE_RISK = f"""SELECT customer_id, CAST(event_date AS VARCHAR) AS event_date, {_decimal('daily_severity_sum', 10, 2)},
  {_as('INT', 'daily_events', 'daily_unique_threats')}, {_decimal('rolling_30d_severity', 12, 2)}, rolling_30d_events,
  {_as('INT', 'rolling_30d_unique_threats')}, {_decimal('risk_score', 12, 2)}, risk_tier FROM risk"""

WAREHOUSE_HOURLY = f"""SELECT CAST(event_date AS VARCHAR) AS event_date, {_as('SMALLINT', 'event_hour')}, threat_category, os_type,
  country_code, {_as('INT', 'detection_count', 'devices_count', 'high_critical_count')}, {MEAN_2} AS avg_severity_score
 FROM (SELECT event_date, event_hour, threat_category, os_type, country_code, count(*) AS detection_count, count(*) AS n,
        count(DISTINCT device_id) AS devices_count, sum(severity_score) AS sum_score,
        count(*) FILTER (severity_score >= 3) AS high_critical_count FROM silver GROUP BY ALL)"""

MESSAGES = f"""SELECT device_id AS "key", {PAYLOAD} AS "value",
  'schema_version=1.0|environment=dev|source=ENDPOINT_AGENT|content_type=application/json' AS headers FROM bronze"""

LETTERS = f"""SELECT substr(payload, 1, length(payload) - 7) AS original_event, 'UNREADABLE_JSON' AS error,
  'detections.raw' AS topic FROM (SELECT {PAYLOAD} AS payload FROM bronze WHERE kafka_offset % 13 = 0)"""

AUDIT = "'2026-12-01 00:00:00.000000' AS gold_processed_at, 'dev' AS environment"
OTHER_DATES = "event_date <> DATE '2024-02-15'"

LETTER_KINDS = f"""SELECT
  CASE kafka_offset % 6 WHEN 0 THEN NULL WHEN 1 THEN payload || ' ' || payload WHEN 2 THEN ' ' WHEN 3 THEN 'null'
    WHEN 4 THEN '[' || payload || ']' ELSE substr(payload, 1, length(payload) - 7) END AS original_event,
  CASE kafka_offset % 6 WHEN 0 THEN 'INVALID_UTF8' WHEN 1 THEN 'SEVERAL_VALUES' WHEN 2 THEN 'EMPTY_MESSAGE' WHEN 3 THEN 'NOT_AN_OBJECT'
    WHEN 4 THEN 'NOT_AN_OBJECT' ELSE 'UNREADABLE_JSON' END AS error,
  CASE kafka_offset % 6 WHEN 0 THEN base64(unhex('FF') || encode(payload)) END AS original_base64
 FROM (SELECT kafka_offset, {PAYLOAD} AS payload FROM bronze)"""

CSV_ROWS = """SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus,
  CAST(NULL AS DOUBLE) AS o_totalprice, CAST(NULL AS VARCHAR) AS o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority,
  CAST(NULL AS VARCHAR) AS note FROM orders WHERE o_orderkey % 5 = 2
 UNION ALL SELECT o_orderkey, CAST(o_custkey AS VARCHAR), o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR), o_orderpriority, NULL
  FROM orders WHERE o_orderkey % 5 = 0
 UNION ALL SELECT o_orderkey, NULL, NULL, o_totalprice, NULL, NULL, NULL FROM orders WHERE o_orderkey % 5 = 1
 UNION ALL SELECT o_orderkey, CAST(o_custkey AS VARCHAR), NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 5 = 3
 UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL, 'priority, "' || o_orderpriority || '"' FROM orders WHERE o_orderkey % 5 = 4"""

CSV_LAKE = f"""SELECT CAST(extract(year FROM load_date) AS VARCHAR) AS "year",
  CAST(extract(month FROM load_date) AS VARCHAR) AS "month", CAST(extract(day FROM load_date) AS VARCHAR) AS "day", count(*) AS "rows", CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
  count(note) AS notes
 FROM (SELECT *, CAST(o_orderdate AS DATE) AS load_date FROM ({CSV_ROWS})) GROUP BY load_date"""

CSV_HEADERS = """SELECT n AS column_count, missing, repeated, unknown FROM (VALUES
  (0, 6, '', '', ''),
  (1, 2, 'o_custkey|o_orderdate|o_orderpriority|o_orderstatus', '', ''),
  (2, 1, 'o_custkey|o_orderdate|o_orderpriority|o_orderstatus|o_totalprice', '', ''),
  (3, 3, 'o_orderdate|o_orderpriority|o_orderstatus|o_totalprice', 'o_orderkey', ''),
  (4, 2, 'o_custkey|o_orderdate|o_orderpriority|o_orderstatus|o_totalprice', '', 'note')) t(part, n, missing, repeated, unknown)
 WHERE part IN (SELECT o_orderkey % 5 FROM orders)"""


def oracle_sql() -> dict[str, str]:
    silver = f"SELECT {SILVER_COLUMNS} FROM silver"
    counts = """SELECT 'bronze' AS stage, count(*) AS "rows" FROM flagged
      UNION ALL SELECT 'accepted', count(*) FROM flagged WHERE is_valid_record
      UNION ALL SELECT 'rejected', count(*) FROM flagged WHERE NOT is_valid_record
      UNION ALL SELECT 'silver', count(*) FROM silver"""
    written = """ UNION ALL SELECT 'daily_threat_summary', count(*) FROM daily
      UNION ALL SELECT 'global_threat_leaderboard', count(*) FROM board
      UNION ALL SELECT 'hourly_detection_trend', count(*) FROM hourly
      UNION ALL SELECT 'customer_risk_scores', count(*) FROM risk"""
    tables = {
        "daily_threat_summary": "daily", "global_threat_leaderboard": "board", "hourly_detection_trend": "hourly", "customer_risk_scores": "risk",
        "product_performance_kpis": f"({KPIS})",
    }
    report_counts = f""" UNION ALL SELECT 'product_performance_kpis', count(*) FROM ({KPIS})
      UNION ALL SELECT 'executive_summary', count(*) FROM ({EXECUTIVE})
      UNION ALL SELECT 'top_threats_weekly', count(*) FROM ({WEEKLY})"""
    taken = " UNION ALL ".join(
        f"SELECT '{name}' AS part, count(*) AS \"rows\" FROM {source} WHERE {'threat_name IS NOT NULL' if source == 'board' else 'TRUE'} "
        f"UNION ALL SELECT 'rejected {name}', count(*) FROM {source} WHERE {'threat_name IS NULL' if source == 'board' else 'FALSE'}"
        for name, source in tables.items()
    )

    def audited(body: str) -> str:
        return f"SELECT *, {AUDIT} FROM ({_sql(body)})"
    return {
        "std_enums": _sql("SELECT event_id, kafka_offset, severity, action_taken, detection_type, os_type FROM std"),
        "check_flags": _sql(f"SELECT event_id, kafka_offset, {FLAGS} FROM flagged"),
        "valid_rows": _sql(
            "SELECT event_id, device_id, customer_id, severity, action_taken, detection_type, os_type, kafka_offset, "
            f"{EVENT_TIMES} FROM flagged WHERE is_valid_record"
        ),
        "quarantine_rows": _sql(QUARANTINE),
        "dedup_latest": _sql(f"SELECT event_id, action_taken, kafka_partition, kafka_offset, {STAMP.format('ingestion_timestamp')} FROM latest"),
        "ip_mask": _sql("SELECT event_id, kafka_offset, regexp_replace(ip_address, '\\.\\d+$', '.xxx') AS ip_address_masked FROM bronze"),
        "date_parts": _sql(
            "SELECT event_id, kafka_offset, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS event_date, "
            "CAST(extract(hour FROM event_timestamp) AS INT) AS event_hour, CAST(extract(year FROM event_timestamp) AS INT) AS event_year, "
            "CAST(extract(month FROM event_timestamp) AS INT) AS event_month FROM bronze"
        ),
        "severity_score": _sql(
            "SELECT event_id, kafka_offset, severity, CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 "
            "WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END AS severity_score FROM std"
        ),
        "threat_category": _sql("SELECT event_id, threat_name, threat_category FROM silver"),
        "silver": _sql(silver),
        "silver_roundtrip": _sql(silver),
        "silver_one_month": _sql(silver + " WHERE event_date >= DATE '2024-02-01' AND event_date < DATE '2024-03-01'"),
        "quarantine_roundtrip": _sql(QUARANTINE),
        "daily_threat_summary": _sql(f"SELECT {DAILY_COLUMNS} FROM daily"),
        "external_daily_summary": _sql(f"SELECT {DAILY_COLUMNS} FROM daily"),
        "threat_leaderboard": _sql(f"SELECT {BOARD_COLUMNS} FROM (SELECT * EXCLUDE (days_active) FROM board)"),
        "maintained_leaderboard": _sql(
            f"SELECT {BOARD_COLUMNS} FROM (SELECT * EXCLUDE (days_active) FROM board)", "CAST(event_timestamp AS DATE) <> DATE '2024-02-15'"
        ),
        "device_sketches": _sql(
            " UNION ALL ".join(
                f"SELECT '{level}' AS level, CAST({period} AS VARCHAR) AS period, count(*) AS events, count(DISTINCT device_id) AS devices_exact, "
                "'true' AS within_3_percent FROM silver GROUP BY ALL"
                for level, period in (("day", "event_date"), ("month", "CAST(date_trunc('month', event_date) AS DATE)"))
            )
        ),
        "rolling_distinct_threats": _sql(
            "SELECT r.customer_id, CAST(r.event_date AS VARCHAR) AS event_date, count(DISTINCT s.threat_hash) AS rolling_30d_distinct_threats "
            "FROM rollup_days r JOIN silver s ON r.customer_id = s.customer_id AND s.event_date BETWEEN r.event_date - 30 AND r.event_date GROUP BY ALL"
        ),
        "risk_join_bucketed": _sql(
            "SELECT d.customer_id, CAST(d.event_date AS VARCHAR) AS event_date, country_code, os_type, total_events, risk_score, "
            "risk_tier FROM daily d LEFT JOIN risk r ON d.customer_id = r.customer_id AND d.event_date = r.event_date"
        ),
        "days_active": _sql(f"SELECT threat_name, threat_hash, threat_category, detection_type, days_active FROM board"),
        "hourly_trend": _sql(f"SELECT {DATED} FROM hourly"),
        "daily_rollup": _sql(f"SELECT {DATED} FROM rollup_days"),
        "customer_risk": _sql(f"SELECT {DATED} FROM risk"),
        "risk_join": _sql(
            f"SELECT d.customer_id, CAST(d.event_date AS VARCHAR) AS event_date, country_code, os_type, total_events, risk_score, "
            "risk_tier FROM daily d LEFT JOIN risk r ON d.customer_id = r.customer_id AND d.event_date = r.event_date"
        ),
        "executive_summary": _sql(EXECUTIVE),
        "top_threats_weekly": _sql(WEEKLY),
        "product_kpis": _sql(KPIS),
        "warehouse_daily_summary": _sql(WAREHOUSE_DAILY),
        "warehouse_leaderboard": _sql(WAREHOUSE_BOARD),
        "warehouse_rejects": _sql(WAREHOUSE_REJECTS),
        "warehouse_customer_risk": _sql(WAREHOUSE_RISK),
        "warehouse_hourly_trend": _sql(WAREHOUSE_HOURLY),
        "warehouse_product_kpis": _sql(
            f"SELECT * REPLACE ({_as('INT', 'active_devices')}), CAST(NULL AS VARCHAR) AS false_positive_rate, "
            f"CAST(NULL AS VARCHAR) AS avg_detection_time_ms, CAST(NULL AS VARCHAR) AS protection_score FROM ({KPIS})"
        ),
        "publish_rows": _sql(MESSAGES),
        "dead_letters": _sql(LETTERS),
        "message_stats": _sql(
            "SELECT count(*) AS total, count(*) FILTER (kafka_offset % 13 <> 0) AS success, "
            "count(*) FILTER (kafka_offset % 13 = 0) AS failures FROM bronze"
        ),
        "stream_silver": _sql(silver, READABLE),
        "stream_silver_in_batches": _sql(silver, READABLE),
        "stream_silver_by_index": _sql(silver, READABLE),
        "stream_hourly": _sql(f"SELECT {DATED} FROM hourly", READABLE),
        "stream_hourly_in_batches": _sql(f"SELECT {DATED} FROM hourly", READABLE),
        "dead_letter_kinds": _sql(LETTER_KINDS),
        "silver_two_deliveries": _sql(silver),
        "merge_by_index": _sql(silver),
        "silver_new_column": _sql(
            f"SELECT * REPLACE (CASE WHEN kafka_offset % 7 >= 5 THEN file_path END AS file_path, "
            f"CASE WHEN kafka_offset % 7 >= 5 THEN product_version END AS product_version) FROM ({silver})"
        ),
        "compacted_bronze": _sql(silver),
        "silver_audited": f"SELECT *, '2026-12-01 00:00:00.000000' AS silver_processed_at, '2.0.0' AS pipeline_version, 'dev' AS environment FROM ({_sql(silver)})",
        "layout_report": _sql("SELECT count(*) AS \"rows\", CAST(1 AS BIGINT) AS files_per_key, 'true' AS in_order FROM daily"),
        "registered_after_write": _sql(f"SELECT {DATED} FROM hourly WHERE {OTHER_DATES}"),
        "gold_rebuild_after_removal": _sql(f"SELECT {DATED} FROM hourly WHERE {OTHER_DATES}"),
        "written_daily_threat_summary": audited(f"SELECT {DAILY_COLUMNS} FROM daily"),
        "written_threat_leaderboard": audited(f"SELECT {BOARD_COLUMNS} FROM board"),
        "written_hourly_trend": audited(f"SELECT {DATED} FROM hourly"),
        "written_customer_risk": audited(f"SELECT {DATED} FROM risk"),
        "written_product_kpis": audited(KPIS),
        "written_executive_summary": _sql(EXECUTIVE),
        "written_top_threats": _sql(WEEKLY),
        "written_warehouse": _sql(taken),
        "stream_quarantine": _sql(QUARANTINE, READABLE),
        "stream_csv_lake": CSV_LAKE,
        "csv_aligned": CSV_ROWS,
        "csv_multi_line": CSV_ROWS.replace("'priority, \"'", "'priority,' || chr(10) || '\"'"),
        "csv_torn_records": CSV_ROWS.replace("'priority, \"'", "'priority,' || chr(10) || '\"'"),
        "csv_headers": CSV_HEADERS,
        "csv_lake": CSV_LAKE,
        "csv_lake_two_loads": CSV_LAKE,
        "schema_contract": _contract(),
        "row_counts": _sql(counts),
        "run_metrics": _sql(counts + written + report_counts),
    }
