"""Row counts per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from palisade.operators.screening import is_accepted, standardise_enums


def stage_counts(bronze: DataFrame, now=None) -> DataFrame:
    """Rows read, accepted, rejected and kept after deduplication, from one pass over bronze."""
    valid = is_accepted(now)
    counts = standardise_enums(bronze).agg(
        F.count("*").alias("bronze"),
        F.count_if(valid).alias("accepted"),
        F.count_if(~valid).alias("rejected"),
        F.count_distinct(F.when(valid, F.col("event_id"))).alias("silver"),
    )
    return counts.unpivot([], counts.columns, "stage", "rows")


def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """``df`` with metrics that its next write fills in, so no extra job counts the rows."""
    observation = Observation(name)
    columns = [expression.alias(metric) for metric, expression in metrics.items()]
    return df.observe(observation, *columns), observation
