"""Date parts of an event and the moving date filters of the reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(value: datetime | str | Column | None) -> Column:
    """A timestamp column; the current time when nothing is given."""
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def day(value: date | str | Column | None) -> Column:
    """A date column; today when nothing is given."""
    if value is None:
        return F.current_date()
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def with_date_parts(events: DataFrame) -> DataFrame:
    stamp = F.col("event_timestamp")
    return events.withColumns(
        {
            "event_date": F.to_date(stamp),
            "event_hour": F.hour(stamp),
            "event_year": F.year(stamp),
            "event_month": F.month(stamp),
        }
    )


def within_months(column: Column, as_of, months: int) -> Column:
    return column >= F.add_months(day(as_of), -months)


def within_days(column: Column, as_of, days: int) -> Column:
    return column >= F.date_sub(day(as_of), days)
