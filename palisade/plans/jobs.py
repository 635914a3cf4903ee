"""The two batch jobs: bronze to silver, silver to gold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade import schemas as S
from palisade.functions.dates import day
from palisade.operators.conform import conform
from palisade.operators.contract import required_columns
from palisade.operators.metrics import observed
from palisade.operators.screening import quarantine, standardise_enums, with_flags
from palisade.plans import gold, leaderboard, reports
from palisade.plans.silver import silver_events, with_silver_audit
from palisade.session import scratch
from palisade.sinks import folders
from palisade.sinks.evolution import evolve
from palisade.sinks.key_index import merge_by_index
from palisade.sinks.tables import merge_table, write_quarantine, write_table
from palisade.sources.tables import read_table

SILVER_PARTITIONS = ["event_year", "event_month", "event_date"]
REPLACE, MERGE = "replace", "merge"


def bronze_to_silver(
    bronze: DataFrame,
    silver_path: str,
    quarantine_path: str,
    environment: str,
    batch: str,
    now=None,
    *,
    mode: str,
    table: str | None = None,
    index: str | None = None,
    schema_change: bool = False,
) -> dict[str, int]:
    """Write silver and quarantine; the row counts come from the two writes themselves.

    With the mode ``replace``, ``bronze`` is everything there is, and silver is built anew. With ``merge`` it is one more
    delivery: its events are added, later deliveries of known events win, and only the dates concerned are rewritten.
    Bronze is scanned once per write. The quarantine pass has no shuffle and sees every row, so it also counts what was
    read, accepted and rejected. A bronze table that lacks a column of the contract is refused. ``silver`` counts the rows of the dates written. ``table`` is silver's catalog name.
    ``index`` is the folder of a key index for merges, so that their cost follows the delivery and not the history; a
    replacement drops it, as the next merge builds it anew. With ``schema_change`` a merged delivery may bring new columns
    and wider types, which silver and its catalog entry take up; a replacement has the schema of what it writes.
    """
    if mode not in (REPLACE, MERGE):
        raise ValueError(f"mode {mode}")
    required_columns(bronze, S.BRONZE)
    seen, intake = observed(
        with_flags(standardise_enums(bronze), now),
        "intake",
        bronze=F.count(F.lit(1)),
        accepted=F.count_if(F.col("is_valid_record")),
        rejected=F.count_if(~F.col("is_valid_record")),
    )
    write_quarantine(quarantine(seen.where(~F.col("is_valid_record")), now), quarantine_path, batch)
    silver = with_silver_audit(silver_events(bronze, now), environment, now)
    if mode == MERGE:
        if index:
            if schema_change:
                silver = evolve(silver, silver_path, SILVER_PARTITIONS)
            dates = merge_by_index(silver, silver_path, index, SILVER_PARTITIONS, table=table).partitions
        else:
            dates = merge_table(silver, silver_path, SILVER_PARTITIONS, table=table, schema_change=schema_change)
        written = read_table(bronze.sparkSession, silver_path) if dates else None
        rows = written.where(F.col("event_date").isin([date["event_date"] for date in dates])).count() if dates else 0
    else:
        if index:
            folders.delete(bronze.sparkSession, index)
        rows = write_table(silver, silver_path, SILVER_PARTITIONS, whole=True, table=table)
    return {**intake.get, "silver": rows}


def gold_tables(silver: DataFrame, since=None, scans: DataFrame | None = None) -> dict[str, Callable[[], DataFrame]]:
    """How to build each table; nothing runs before a table is asked for.

    With ``since`` the dated ones hold only that date and later ones. The filter is on the partition column, so older
    silver is not read, but for the days a rolling sum looks back. The leaderboard has no date and always covers
    everything. ``scans`` fills the scan counts of the KPI table.
    """
    recent = silver if since is None else silver.where(F.col("event_date") >= day(since))

    def risk() -> DataFrame:
        if since is None:
            return gold.customer_risk_scores(silver)
        looked_at = silver.where(F.col("event_date") >= F.date_sub(day(since), S.RISK_WINDOW_DAYS))
        return gold.customer_risk_scores(looked_at).where(F.col("event_date") >= day(since))

    return {
        S.DAILY_SUMMARY_TABLE.name: lambda: gold.daily_threat_summary(recent),
        S.LEADERBOARD_TABLE.name: lambda: gold.with_days_active(gold.threat_leaderboard(silver)),
        S.HOURLY_TREND_TABLE.name: lambda: gold.hourly_detection_trend(recent),
        S.CUSTOMER_RISK_TABLE.name: risk,
        S.PRODUCT_KPI_TABLE.name: lambda: gold.product_performance_kpis(recent, scans),
    }


def silver_to_gold(
    silver: DataFrame,
    gold_path: str,
    environment: str,
    now=None,
    since=None,
    scans: DataFrame | None = None,
    catalog: str | None = None,
    only=None,
    board_state: str | None = None,
    changed: list[str] | None = None,
) -> dict[str, int]:
    """Write the gold tables, each clustered and sorted as its warehouse table asks.

    Without ``since`` every table is built anew. With it, that date and all later ones are: dates that have left silver
    leave gold too, and older ones stay. ``catalog`` is a prefix of catalog names to keep up to date. ``only`` names the
    tables wanted. With ``board_state``, a folder, the leaderboard is kept by the dates that ``changed`` names since the last
    run, such as a merge returns; no other date of silver is read for it. Without ``changed`` all dates count as changed.
    """
    written = {}
    with scratch(silver.sparkSession):
        tables = gold_tables(silver, since, scans)
        if board_state and (only is None or S.LEADERBOARD_TABLE.name in only):
            if changed is None:
                changed = [row.event_date for row in silver.select("event_date").distinct().collect()]
            leaderboard.refresh(silver, board_state, changed)
            tables[S.LEADERBOARD_TABLE.name] = lambda: gold.with_days_active(leaderboard.leaderboard(silver.sparkSession, board_state))
        for name, build in tables.items():
            if only is not None and name not in only:
                continue
            table = build()
            layout = S.WAREHOUSE_TABLES[name]
            dates = [column for column in ("event_date", "kpi_date") if column in table.columns]
            written[name] = write_table(
                gold.with_gold_audit(table, environment, now),
                f"{gold_path}/{name}",
                dates,
                layout.cluster_by,
                layout.sort_by,
                whole=since is None,
                stale=lambda values: next(iter(values.values())) >= str(since),
                table=catalog and f"{catalog}{name}",
            )
    return written


def gold_to_reports(gold_path: str, reports_path: str, spark, monthly_as_of=None, weekly_as_of=None) -> dict[str, int]:
    """Write the two reports, a few rows each, from the written gold tables."""
    daily, risk, board = (
        read_table(spark, f"{gold_path}/{table.name}") for table in (S.DAILY_SUMMARY_TABLE, S.CUSTOMER_RISK_TABLE, S.LEADERBOARD_TABLE)
    )
    built = {
        "executive_summary": reports.executive_summary(daily, risk, monthly_as_of),
        "top_threats_weekly": reports.top_threats_weekly(board, weekly_as_of),
    }
    return {name: write_table(report, f"{reports_path}/{name}") for name, report in built.items()}


def gold_to_warehouse(gold_path: str, warehouse_path: str, spark, loaded_at=None) -> dict[str, int]:
    """Write what the warehouse can load of every gold table, and below ``rejected`` the rest with the reasons."""
    written = {}
    for name, layout in S.WAREHOUSE_TABLES.items():
        loadable, rejected = conform(read_table(spark, f"{gold_path}/{name}"), layout, loaded_at)
        written[name] = write_table(loadable, f"{warehouse_path}/{name}", (), layout.cluster_by, layout.sort_by)
        written[f"rejected {name}"] = write_table(rejected, f"{warehouse_path}/rejected/{name}")
    return written
