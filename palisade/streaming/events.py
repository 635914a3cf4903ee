"""Silver and the hourly trend as streams.

Each micro-batch is merged into date-partitioned silver, and what depends on the dates it touches is built anew from
silver. So results don't depend on how the input is cut into batches, no event is too late, and a batch that is tried
again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palisade import schemas as S
from palisade.operators.screening import accepted, standardise_enums
from palisade.plans.gold import hourly_detection_trend
from palisade.plans.jobs import SILVER_PARTITIONS
from palisade.plans.silver import enrich, quarantined_events, silver_events
from palisade.sinks.key_index import merge_by_index
from palisade.sinks.tables import merge_table, write_table
from palisade.streaming.ingest import run_available, write_batch


def silver_stream(bronze: DataFrame, now=None) -> DataFrame:
    """Accepted and enriched events as they arrive, re-deliveries included. Works on batches as well."""
    return enrich(accepted(standardise_enums(bronze), now))


def keep_silver(
    bronze: DataFrame, silver: str, checkpoint: str, quarantine: str | None = None, hourly: str | None = None, now=None, index: str | None = None
) -> StreamingQuery:
    """Merge every micro-batch into silver: one row per event, the latest delivery over all batches.

    With ``index``, the folder of a key index, a batch opens only the dates that its events have or had, however long the
    history is.

    ``quarantine`` keeps the rejected rows by batch, so that no row is lost. ``hourly`` is the hourly trend by date.
    """

    def handle(batch: DataFrame, number: int) -> None:
        events = silver_events(batch, now)
        dates = merge_by_index(events, silver, index, SILVER_PARTITIONS).partitions if index else merge_table(events, silver, SILVER_PARTITIONS)
        if quarantine:
            write_batch(quarantined_events(batch, now, now), quarantine, number)
        if hourly and dates:
            rebuild_hours(batch.sparkSession.read.parquet(silver), hourly, dates)

    return run_available(bronze, handle, checkpoint)


def rebuild_hours(silver: DataFrame, hourly: str, dates: list[dict[str, str]]) -> None:
    """Replace the dates' rows of the hourly trend by what silver has for them now."""
    wanted = [date["event_date"] for date in dates]
    trend = hourly_detection_trend(silver.where(F.col("event_date").isin(wanted)))
    layout = S.HOURLY_TREND_TABLE
    write_table(trend, hourly, ["event_date"], layout.cluster_by, layout.sort_by, stale=lambda values: values["event_date"] in wanted)
