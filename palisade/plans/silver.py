"""Silver: accepted events, one row per event, masked and classified."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade import schemas as S
from palisade.functions.classify import severity_score, threat_category
from palisade.functions.dates import moment, with_date_parts
from palisade.functions.text import mask_last_octet
from palisade.operators.latest import latest_per_key
from palisade.operators.screening import accepted, quarantine, rejected, standardise_enums


def mask_addresses(events: DataFrame) -> DataFrame:
    return events.withColumn("ip_address_masked", mask_last_octet(F.col("ip_address"))).drop("ip_address")


def classify(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "severity_score": severity_score(F.col("severity")),
            "threat_category": threat_category(F.col("threat_name")),
        }
    )


def with_silver_audit(events: DataFrame, environment: str, processed_at=None) -> DataFrame:
    return events.withColumns(
        {
            "silver_processed_at": moment(processed_at),
            "pipeline_version": F.lit(S.PIPELINE_VERSION),
            "environment": F.lit(environment),
        }
    )


def enrich(events: DataFrame) -> DataFrame:
    """The row-wise part of silver; no shuffle, so it also runs on a stream."""
    return classify(with_date_parts(mask_addresses(events)))


def silver_events(bronze: DataFrame, now=None) -> DataFrame:
    """Accepted, latest and enriched events without the audit columns."""
    return enrich(latest_per_key(accepted(standardise_enums(bronze), now)))


def quarantined_events(bronze: DataFrame, now=None, quarantined_at=None) -> DataFrame:
    return quarantine(rejected(standardise_enums(bronze), now), quarantined_at)
