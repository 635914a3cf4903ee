"""Reports over the gold tables; the reporting date is a parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.functions.dates import within_days, within_months
from palisade.sinks.tables import write_bucketed

RISK_JOIN_KEYS = ["customer_id", "event_date"]
REPORT_MONTHS = 6
TOP_DAYS = 7
TOP_ROWS = 10


def summary_with_risk(daily_summary: DataFrame, customer_risk: DataFrame) -> DataFrame:
    """Each summary row with the customer's risk on that date, if there is one."""
    risk = customer_risk.select("customer_id", "event_date", "risk_score", "risk_tier")
    return daily_summary.join(risk, RISK_JOIN_KEYS, "left")


def write_bucketed_pair(daily_summary: DataFrame, customer_risk: DataFrame, summary: str, risk: str, buckets: int) -> None:
    """Both sides of ``summary_with_risk`` as catalog tables bucketed by its keys, so that joining them needs no exchange."""
    write_bucketed(daily_summary, summary, RISK_JOIN_KEYS, buckets)
    write_bucketed(customer_risk, risk, RISK_JOIN_KEYS, buckets)


def executive_summary(daily_summary: DataFrame, customer_risk: DataFrame, as_of=None) -> DataFrame:
    """Monthly figures of the last six months, newest month first.

    Rows are first folded per month and customer, which turns both distinct customer counts into plain
    counts. The average is a mean over summary rows, not over events.
    """
    recent = daily_summary.where(within_months(F.col("event_date"), as_of, REPORT_MONTHS))
    risk = customer_risk.where(within_months(F.col("event_date"), as_of, REPORT_MONTHS))
    per_customer = (
        summary_with_risk(recent, risk)
        .groupBy(F.trunc("event_date", "MM").alias("report_month"), "customer_id")
        .agg(
            F.sum("total_events").alias("events"),
            F.sum(F.col("critical_count") + F.col("high_count")).alias("severe"),
            F.sum(F.col("quarantined_count") + F.col("deleted_count") + F.col("blocked_count")).alias("blocked"),
            F.sum("avg_severity_score").alias("score_sum"),
            F.count("avg_severity_score").alias("score_rows"),
            F.count_if(F.col("risk_tier") == "CRITICAL").alias("critical_rows"),
        )
    )
    return (
        per_customer.groupBy("report_month")
        .agg(
            F.count("customer_id").alias("active_customers"),
            F.sum("events").alias("total_threats_detected"),
            F.sum("severe").alias("high_severity_threats"),
            F.sum("blocked").alias("threats_blocked"),
            (F.sum("score_sum") / F.sum("score_rows")).alias("avg_threat_severity"),
            F.count_if((F.col("critical_rows") > 0) & F.col("customer_id").isNotNull()).alias("customers_at_critical_risk"),
        )
        .orderBy(F.col("report_month").desc())
    )


def top_threats_weekly(leaderboard: DataFrame, as_of=None) -> DataFrame:
    """The ten threats with most hits among those last seen in the past seven days.

    Hits are lifetime totals of the leaderboard. Ties are broken by name, category, severity and rank.
    """
    keys = ["threat_name", "threat_category", "max_severity", "threat_rank"]
    return (
        leaderboard.where(within_days(F.to_date("last_seen"), as_of, TOP_DAYS))
        .groupBy(*keys)
        .agg(F.sum("global_hit_count").alias("weekly_hits"), F.sum("customers_affected").alias("total_customers"))
        .orderBy(F.col("weekly_hits").desc(), *[F.col(name).asc_nulls_last() for name in keys])
        .limit(TOP_ROWS)
        .select(
            "threat_name",
            "threat_category",
            "weekly_hits",
            F.col("max_severity").alias("peak_severity"),
            "total_customers",
            "threat_rank",
        )
    )
