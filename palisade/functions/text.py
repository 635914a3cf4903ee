"""Text expressions: enum standardising and address masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def standardise(value: Column) -> Column:
    """Upper case without surrounding spaces (spaces only, tabs stay)."""
    return F.upper(F.trim(value))


def mask_last_octet(address: Column) -> Column:
    """``10.1.2.3`` becomes ``10.1.2.xxx``; text that does not end in a dotted number stays as it is."""
    return F.regexp_replace(address, r"\.\d+$", ".xxx")


def iso_instant(moment: Column) -> Column:
    """ISO-8601 with microseconds and zone offset."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
