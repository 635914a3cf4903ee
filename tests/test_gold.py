from __future__ import annotations

import datetime as dt
from collections import defaultdict

import pytest
from conftest import NOW
from pyspark.sql import Window
from pyspark.sql import functions as F

from palisade import schemas as S
from palisade.functions.classify import risk_tier, severity_score, threat_category
from palisade.operators.ranking import dense_rank_by_count
from palisade.plans import gold
from palisade.plans.silver import silver_events


@pytest.fixture(scope="module")
def silver(bronze):
    held = silver_events(bronze, NOW).cache()
    yield held
    held.unpersist()


@pytest.fixture(scope="module")
def events(silver):
    return silver.collect()


def grouped(events, keys):
    groups = defaultdict(list)
    for event in events:
        groups[tuple(event[key] for key in keys)].append(event)
    return groups


def distinct(rows, name):
    return len({row[name] for row in rows if row[name] is not None})


def test_daily_summary_by_hand(silver, events):
    groups = grouped(events, gold.SUMMARY_KEYS)
    found = gold.daily_threat_summary(silver).collect()
    assert len(found) == len(groups)
    for row in found:
        rows = groups[tuple(row[key] for key in gold.SUMMARY_KEYS)]
        count = lambda name, value: sum(r[name] == value for r in rows)
        assert row.total_events == len(rows)
        assert row.affected_devices == distinct(rows, "device_id")
        assert row.unique_threats == distinct(rows, "threat_hash")
        assert [row.critical_count, row.high_count, row.medium_count, row.low_count] == [
            count("severity", name) for name in ("CRITICAL", "HIGH", "MEDIUM", "LOW")
        ]
        assert [row.quarantined_count, row.deleted_count, row.blocked_count] == [
            count("action_taken", name) for name in ("QUARANTINE", "DELETE", "BLOCK")
        ]
        assert row.avg_severity_score == sum(r.severity_score for r in rows) / len(rows)
        assert row.max_severity_score == max(r.severity_score for r in rows)
        assert row.threat_categories_detected == sorted({r.threat_category for r in rows})
        assert row.product_version == max((r.event_timestamp, r.product_version) for r in rows)[1]


def test_leaderboard_by_hand(silver, events):
    groups = grouped(events, gold.THREAT_KEYS)
    found = gold.with_days_active(gold.threat_leaderboard(silver)).collect()
    assert len(found) == len(groups)
    counts = sorted({len(rows) for rows in groups.values()}, reverse=True)
    for row in found:
        rows = groups[tuple(row[key] for key in gold.THREAT_KEYS)]
        first, last = min(r.event_timestamp for r in rows), max(r.event_timestamp for r in rows)
        assert row.global_hit_count == len(rows)
        assert row.threat_rank == counts.index(len(rows)) + 1
        assert row.customers_affected == distinct(rows, "customer_id")
        assert row.devices_affected == distinct(rows, "device_id")
        assert row.countries_affected == distinct(rows, "country_code")
        assert row.max_severity == max(r.severity for r in rows)
        assert row.max_severity_by_score == max((r.severity_score, r.severity) for r in rows)[1]
        assert (row.first_seen, row.last_seen) == (first, last)
        assert row.days_active == (last.date() - first.date()).days
        assert row.os_types_affected == sorted({r.os_type for r in rows})


def test_medium_beats_critical_in_text_but_not_by_score(spark):
    rows = spark.createDataFrame(
        [("t", "h", "OTHER", "SIGNATURE", severity, score, "c", "d", None, "LINUX") for severity, score in
         (("MEDIUM", 2), ("CRITICAL", 4))],
        "threat_name STRING, threat_hash STRING, threat_category STRING, detection_type STRING, severity STRING, "
        "severity_score INT, customer_id STRING, device_id STRING, country_code STRING, os_type STRING",
    ).withColumn("event_timestamp", F.lit("2024-01-01").cast("timestamp"))
    row = gold.threat_totals(rows).first()
    assert (row.max_severity, row.max_severity_by_score, row.countries_affected) == ("MEDIUM", "CRITICAL", 0)


def test_hourly_trend_adds_up(silver):
    trend = gold.hourly_detection_trend(silver)
    assert trend.agg(F.sum("detection_count")).first()[0] == silver.count()
    assert trend.agg(F.sum("high_critical_count")).first()[0] == silver.where("severity_score >= 3").count()


def test_counts_add_up_to_silver(silver):
    total = silver.count()
    assert gold.daily_threat_summary(silver).agg(F.sum("total_events")).first()[0] == total
    assert gold.threat_totals(silver).agg(F.sum("global_hit_count")).first()[0] == total
    assert gold.daily_customer_rollup(silver).agg(F.sum("daily_events")).first()[0] == total


def test_rolling_window_covers_31_dates(spark):
    start = dt.date(2024, 1, 1)
    days = [("c", start + dt.timedelta(days=number), 1, 1, 1) for number in (0, 29, 30, 31)]
    rows = spark.createDataFrame(
        days, "customer_id STRING, event_date DATE, daily_severity_sum BIGINT, daily_events BIGINT, daily_unique_threats BIGINT"
    )
    sums = [row.rolling_30d_events for row in gold.rolling_customer_risk(rows).orderBy("event_date").collect()]
    assert sums == [1, 2, 3, 3]
    shorter = [row.rolling_30d_events for row in gold.rolling_customer_risk(rows, days=1).orderBy("event_date").collect()]
    assert shorter == [1, 1, 2, 2]


def test_risk_score_and_tiers(spark):
    rows = spark.createDataFrame([(500.0,), (499.9,), (200.0,), (50.0,), (49.9,)], "score DOUBLE")
    tiers = [row[0] for row in rows.select(risk_tier(F.col("score"))).collect()]
    assert tiers == ["CRITICAL", "HIGH", "HIGH", "MEDIUM", "LOW"]
    day = spark.createDataFrame(
        [("c", dt.date(2024, 1, 1), 8, 3, 2)],
        "customer_id STRING, event_date DATE, daily_severity_sum BIGINT, daily_events BIGINT, daily_unique_threats BIGINT",
    )
    assert gold.rolling_customer_risk(day).first().risk_score == 8 * 0.5 + 2 * 10 + 3 * 0.1


def test_classification(spark):
    names = ["Ransomware.Trojan", "TROJAN.worm", "x.spyware", "AdWare", "worm.virus", "Virus", "tool", "", None]
    rows = spark.createDataFrame([(name,) for name in names], "n STRING")
    assert [row[0] for row in rows.select(threat_category(F.col("n"))).collect()] == [
        "RANSOMWARE", "TROJAN", "SPYWARE", "ADWARE", "WORM", "VIRUS", "OTHER", "OTHER", "OTHER",
    ]
    severities = spark.createDataFrame([(s,) for s in ["CRITICAL", "HIGH", "MEDIUM", "LOW", "low", None]], "s STRING")
    assert [row[0] for row in severities.select(severity_score(F.col("s"))).collect()] == [4, 3, 2, 1, 0, 0]


def test_rank_equals_the_single_task_window(spark):
    groups = spark.range(500).select(F.col("id").alias("group"), (F.col("id") * 7 % 23 + 1).alias("hits"))
    ranked = dense_rank_by_count(groups, "hits", "place")
    wanted = groups.withColumn("place", F.dense_rank().over(Window.orderBy(F.desc("hits"))))
    assert ranked.select("group", "hits", "place").exceptAll(wanted).count() == 0
    assert ranked.count() == 500


def test_only_distinct_counts_reach_the_single_task(silver, plan):
    text = plan(dense_rank_by_count(gold.threat_totals(silver), "global_hit_count", "threat_rank"))
    single = text[text.index("Arguments: SinglePartition") - 200 : text.index("Arguments: SinglePartition")]
    assert "Input [1]: [global_hit_count" in single


def test_first_aggregation_is_hashed_and_map_side(silver, plan):
    for table in (gold.daily_threat_summary(silver), gold.threat_totals(silver), gold.hourly_detection_trend(silver)):
        text = plan(table)
        assert "SortAggregate" not in text and "Cartesian" not in text and "NestedLoop" not in text
        assert "HashAggregate" in text.split("\n\n")[0].split("Expand")[0]


def test_kpis_without_and_with_scans(spark, silver):
    declared = [column.name for column in S.PRODUCT_KPI_TABLE.columns if column.name != "gold_processed_at"]
    bare = gold.product_performance_kpis(silver)
    assert bare.columns == declared
    assert bare.where("detection_rate IS NOT NULL OR total_scans IS NOT NULL OR protection_score IS NOT NULL").count() == 0
    blocked = silver.where(F.col("action_taken").isin("QUARANTINE", "DELETE", "BLOCK")).count()
    assert bare.agg(F.sum("threats_blocked")).first()[0] == blocked
    keys = ["kpi_date", "product_version", "os_type", "country_code"]
    counted = silver.withColumnRenamed("event_date", "kpi_date").groupBy(*keys).agg((F.count("*") * 4).alias("total_scans"))
    rated = gold.product_performance_kpis(silver, counted)
    assert [str(row[0]) for row in rated.select("detection_rate").distinct().collect()] == ["0.2500"]
    assert rated.count() == bare.count()
    none = gold.product_performance_kpis(silver, counted.withColumn("total_scans", F.lit(0)))
    assert none.where("detection_rate IS NOT NULL").count() == 0


def test_scans_are_joined_by_key(silver, plan):
    """Null-safe equality still joins by key: no nested loop, also when neither side can be broadcast."""
    keys = ["kpi_date", "product_version", "os_type", "country_code"]
    counted = silver.withColumnRenamed("event_date", "kpi_date").groupBy(*keys).agg(F.count("*").alias("total_scans"))
    text = plan(gold.product_performance_kpis(silver, counted))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "SortMergeJoin" in text or "HashJoin" in text


def test_fixture_counts(spark, silver):
    assert gold.daily_threat_summary(silver).count() == 701
    assert gold.hourly_detection_trend(silver).count() == 815
    tiers = {row.risk_tier: row["count"] for row in gold.customer_risk_scores(silver).groupBy("risk_tier").count().collect()}
    assert tiers == {"CRITICAL": 12, "HIGH": 206, "MEDIUM": 269, "LOW": 30}
