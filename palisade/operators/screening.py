"""The quality contract: named checks, the split into accepted and rejected rows, quarantine."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade import schemas as S
from palisade.functions.dates import moment
from palisade.functions.text import mask_last_octet, standardise

WARNING_CHECKS = {"is_valid_os"}


def standardise_enums(events: DataFrame) -> DataFrame:
    return events.withColumns({name: standardise(F.col(name)) for name in S.STANDARDISED_COLUMNS})


def checks(now=None) -> dict[str, Column]:
    """Every check by the name of its flag column, for standardised events.

    A flag is NULL when the value it looks at is NULL. ``is_valid_os`` only warns.
    """
    stamp = F.col("event_timestamp")
    return {
        "is_valid_event_id": F.col("event_id").rlike(S.EVENT_ID_PATTERN),
        "is_valid_severity": F.col("severity").isin(S.SEVERITIES),
        "is_valid_action": F.col("action_taken").isin(S.ACTIONS),
        "is_valid_detection": F.col("detection_type").isin(S.DETECTION_TYPES),
        "is_valid_os": F.col("os_type").isin(S.OS_TYPES),
        "is_not_null": reduce(and_, (F.col(name).isNotNull() for name in S.REQUIRED_COLUMNS)),
        "is_valid_timestamp": stamp.between(F.lit(S.EARLIEST_EVENT).cast("timestamp"), moment(now)),
    }


def rejecting_checks(now=None) -> dict[str, Column]:
    return {name: check for name, check in checks(now).items() if name not in WARNING_CHECKS}


def is_accepted(now=None) -> Column:
    """TRUE or FALSE, never NULL: a check that cannot be decided counts as failed."""
    return F.coalesce(reduce(and_, rejecting_checks(now).values()), F.lit(False))


def with_flags(events: DataFrame, now=None) -> DataFrame:
    """All flags plus the composite ``is_valid_record``, which is made of the flags, so each check runs once."""
    flagged = events.withColumns(checks(now))
    composite = reduce(and_, (F.col(name) for name in rejecting_checks(now)))
    return flagged.withColumn("is_valid_record", F.coalesce(composite, F.lit(False)))


def accepted(events: DataFrame, now=None) -> DataFrame:
    """Rows that pass. A plain conjunction, so the parts on bare columns reach the Parquet scan."""
    return events.where(reduce(and_, rejecting_checks(now).values()))


def rejected(events: DataFrame, now=None) -> DataFrame:
    """Rows that fail or cannot be decided, with their flags; together with ``accepted`` all rows."""
    return with_flags(events, now).where(~F.col("is_valid_record"))


def split(events: DataFrame, now=None) -> tuple[DataFrame, DataFrame]:
    return accepted(events, now), rejected(events, now)


def failed_checks() -> Column:
    """Names of the rejecting checks that did not come out TRUE, over the flag columns."""
    names = [name for name in checks() if name not in WARNING_CHECKS]
    return F.array_compact(F.array(*[F.when(~F.coalesce(F.col(name), F.lit(False)), F.lit(name)) for name in names]))


def quarantine(rejected_events: DataFrame, quarantined_at=None) -> DataFrame:
    """What is kept of rejected rows: flags, reasons and a masked address."""
    return (
        rejected_events.withColumns(
            {
                "ip_address_masked": mask_last_octet(F.col("ip_address")),
                "failed_checks": failed_checks(),
                "quarantine_reason": F.lit(S.QUARANTINE_REASON),
                "quarantine_ts": moment(quarantined_at),
            }
        )
    ).drop("ip_address")


def drop_flags(events: DataFrame) -> DataFrame:
    """Without the columns that ``with_flags`` adds."""
    return events.drop(*checks(), "is_valid_record")
