from __future__ import annotations

from datetime import datetime

import pytest
from conftest import NOW
from pyspark.sql import Row
from pyspark.sql import functions as F

from palisade.operators.screening import accepted, drop_flags, quarantine, rejected, split, standardise_enums, with_flags
from palisade.plans.silver import mask_addresses, quarantined_events

GOOD = dict(
    event_id="0" * 32,
    device_id="d",
    customer_id="c",
    event_timestamp=datetime(2024, 1, 1),
    severity="low",
    action_taken=" Clean ",
    detection_type="SIGNATURE",
    os_type="ios",
    ip_address="10.0.0.1",
)
SHAPE = (
    "event_id STRING, device_id STRING, customer_id STRING, event_timestamp TIMESTAMP, severity STRING, "
    "action_taken STRING, detection_type STRING, os_type STRING, ip_address STRING"
)

CASES = [
    ({}, True, []),
    ({"event_id": "123e4567-e89b-12d3-a456-426614174000"}, True, []),
    ({"event_id": "0" * 31}, False, ["is_valid_event_id"]),
    ({"event_id": "0" * 37}, False, ["is_valid_event_id"]),
    ({"event_id": "g" * 32}, False, ["is_valid_event_id"]),
    ({"event_id": None}, False, ["is_valid_event_id", "is_not_null"]),
    ({"severity": "severe"}, False, ["is_valid_severity"]),
    ({"severity": None}, False, ["is_valid_severity"]),
    ({"severity": "\tlow"}, False, ["is_valid_severity"]),
    ({"action_taken": "shrug"}, False, ["is_valid_action"]),
    ({"detection_type": "luck"}, False, ["is_valid_detection"]),
    ({"os_type": "solaris"}, True, []),
    ({"os_type": None}, True, []),
    ({"device_id": None}, False, ["is_not_null"]),
    ({"customer_id": None}, False, ["is_not_null"]),
    ({"event_timestamp": None}, False, ["is_not_null", "is_valid_timestamp"]),
    ({"event_timestamp": datetime(2009, 12, 31, 23, 59, 59)}, False, ["is_valid_timestamp"]),
    ({"event_timestamp": datetime(2010, 1, 1)}, True, []),
    ({"event_timestamp": datetime(2026, 12, 1)}, True, []),
    ({"event_timestamp": datetime(2026, 12, 1, 0, 0, 1)}, False, ["is_valid_timestamp"]),
]


@pytest.fixture(scope="module")
def cases(spark):
    rows = [Row(number=number, **{**GOOD, **change}) for number, (change, _, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, f"number INT, {SHAPE}")


def test_every_branch(cases):
    flagged = with_flags(standardise_enums(cases), NOW).orderBy("number").collect()
    assert [row.is_valid_record for row in flagged] == [good for _, good, _ in CASES]


def test_reasons(cases):
    kept = quarantine(rejected(standardise_enums(cases), NOW), NOW).collect()
    assert {row.number: row.failed_checks for row in kept} == {
        number: reasons for number, (_, good, reasons) in enumerate(CASES) if not good
    }
    assert {row.quarantine_reason for row in kept} == {"VALIDATION_FAILURE"}
    assert {row.ip_address_masked for row in kept} == {"10.0.0.xxx"}
    assert "ip_address" not in kept[0].asDict()


def test_split_keeps_every_row_once(bronze):
    good, bad = split(standardise_enums(bronze), NOW)
    assert good.count() == 850 and bad.count() == 200
    assert bronze.count() == 1050


def test_flags_are_three_valued_but_the_composite_is_not(cases):
    flagged = with_flags(standardise_enums(cases), NOW)
    missing = flagged.where("number = 7").first()
    assert missing.is_valid_severity is None and missing.is_valid_record is False


def test_checks_on_bare_columns_reach_the_scan(spark, bronze, tmp_path, plan):
    bronze.write.parquet(str(tmp_path / "b"))
    text = plan(accepted(standardise_enums(spark.read.parquet(str(tmp_path / "b"))), NOW))
    assert "GreaterThanOrEqual(event_timestamp" in text and "IsNotNull(device_id)" in text


def test_flags_can_be_dropped(bronze):
    standard = standardise_enums(bronze)
    assert drop_flags(with_flags(standard, NOW)).columns == standard.columns


def test_masking(spark):
    given = ["10.1.2.3", "fe80::1", "1.2.3.4:80", "::ffff:1.2.3.44", None]
    rows = spark.createDataFrame([(value,) for value in given], "ip_address STRING")
    masked = [row.ip_address_masked for row in mask_addresses(rows).collect()]
    assert masked == ["10.1.2.xxx", "fe80::1", "1.2.3.4:80", "::ffff:1.2.3.xxx", None]


def test_no_dotted_address_in_quarantine(bronze):
    kept = quarantined_events(bronze, NOW, NOW)
    assert kept.where(F.col("ip_address_masked").rlike(r"\.\d+$")).count() == 0
