"""Derived classes: severity score, threat category, risk tier."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade import schemas as S


def first_match(cases: list[tuple[Column, object]], otherwise: object) -> Column:
    """The value of the first condition that holds, as one CASE expression."""
    case = F
    for condition, value in cases:
        case = case.when(condition, F.lit(value))
    return case.otherwise(F.lit(otherwise))


def severity_score(severity: Column) -> Column:
    return first_match([(severity == name, score) for name, score in S.SEVERITY_SCORES.items()], S.UNKNOWN_SEVERITY_SCORE)


def threat_category(threat_name: Column) -> Column:
    name = F.lower(threat_name)
    return first_match([(name.contains(word.lower()), word) for word in S.THREAT_CATEGORIES], S.OTHER_CATEGORY)


def risk_score() -> Column:
    """Weighted sum of the rolling measures, in double arithmetic, added from left to right."""
    severity, threats, events = (F.col(name) * F.lit(weight) for name, weight in S.RISK_WEIGHTS.items())
    return severity + threats + events


def risk_tier(score: Column) -> Column:
    return first_match([(score >= floor, tier) for tier, floor in S.RISK_TIERS], S.LOWEST_RISK_TIER)
