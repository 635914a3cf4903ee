"""What is kept up to date by changes: the leaderboard, device sketches; rolling distinct threats and the bucketed pair."""

from __future__ import annotations

import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from palisade.plans import gold, leaderboard, reports, sketches
from palisade.sinks import versions
from palisade.sinks.tables import write_table

SCHEMA = (
    "threat_name string, threat_hash string, threat_category string, detection_type string, severity string, severity_score int, os_type string, "
    "customer_id string, device_id string, country_code string, event_date date, event_hour int, event_timestamp timestamp"
)
SCORES = {"LOW": 1, "HIGH": 3, "CRITICAL": 4}
DAY = dt.date(2024, 1, 1)


def event(pick: random.Random, day: int):
    severity = pick.choice(list(SCORES))
    at = dt.datetime.combine(DAY + dt.timedelta(days=day), dt.time(pick.randrange(24), pick.randrange(60)))
    name = pick.choice(["a", "b", None])
    return (
        name, pick.choice(["h1", "h2", "h3", None]), "OTHER", pick.choice(["S", "T"]), severity, SCORES[severity], pick.choice(["X", None]),
        pick.choice(["c1", "c2", None]), f"d{pick.randrange(6)}", pick.choice(["US", None]), at.date(), at.hour, at,
    )


def written(spark, path, by_day: dict[int, list]):
    rows = [row for day in by_day.values() for row in day]
    write_table(spark.createDataFrame(rows, SCHEMA), str(path), ["event_date"], whole=True)
    return spark.read.schema(SCHEMA).parquet(str(path))


def shown(board):
    return sorted(map(str, board.select(sorted(board.columns)).collect()))


def dates(*days):
    return [str(DAY + dt.timedelta(days=day)) for day in days]


def test_the_leaderboard_follows_added_changed_and_removed_dates(spark, tmp_path, monkeypatch):
    pick = random.Random(3)
    by_day = {day: [event(pick, day) for _ in range(12)] for day in range(4)}
    state = str(tmp_path / "state")
    silver = written(spark, tmp_path / "one", by_day)
    leaderboard.refresh(silver, state, dates(0, 1, 2, 3), buckets=3)
    assert shown(leaderboard.leaderboard(spark, state)) == shown(gold.threat_leaderboard(silver))

    # One date changes, one comes, one goes; all other dates of silver can't even be read.
    by_day[1] = [event(pick, 1) for _ in range(9)]
    by_day[5] = [event(pick, 5) for _ in range(9)]
    del by_day[2]
    silver = written(spark, tmp_path / "two", by_day)
    wanted = shown(gold.threat_leaderboard(silver))
    for day in (0, 3):
        shutil.rmtree(tmp_path / f"two/event_date={dates(day)[0]}")
    changed = spark.read.schema(SCHEMA).parquet(str(tmp_path / "two"))
    before = shown(leaderboard.totals(spark, state))
    with monkeypatch.context() as patched:
        patched.setattr(leaderboard, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError()))
        with pytest.raises(RuntimeError):
            leaderboard.refresh(changed, state, dates(1, 2, 5), buckets=3)
    assert shown(leaderboard.totals(spark, state)) == before
    for _ in range(2):  # the second time nothing has changed
        leaderboard.refresh(changed, state, dates(1, 2, 5), buckets=3)
        assert shown(leaderboard.leaderboard(spark, state)) == wanted
    leaderboard.refresh(changed.where("false"), state, dates(0, 1, 2, 3, 5), buckets=3)
    assert leaderboard.leaderboard(spark, state).count() == 0
    assert leaderboard.refresh(changed, state, []) == versions.current(spark, state)


def test_each_date_keeps_one_version(spark, tmp_path):
    pick = random.Random(5)
    silver = written(spark, tmp_path / "s", {0: [event(pick, 0)], 1: [event(pick, 1)]})
    for _ in range(2):
        leaderboard.refresh(silver, str(tmp_path / "state"), dates(0, 1), buckets=2)
    for table in ("days", "pairs", "counted"):
        for folder in (tmp_path / "state" / table).glob("*=*"):
            assert len(list(folder.glob("version=*"))) == 1


def test_sketches_fold_and_follow_a_changed_date(spark, tmp_path):
    rows = lambda first, last, day: spark.range(first, last).select(
        F.concat(F.lit("d"), "id").alias("device_id"), F.lit(str(day)).cast("date").alias("event_date"), (F.col("id") % 5).cast("int").alias("event_hour"),
        F.lit("OTHER").alias("threat_category"), F.lit("X").alias("os_type"), F.lit(None).cast("string").alias("country_code"),
    )
    path = str(tmp_path / "sketches")
    one, two = dates(0, 1)
    sketches.write_sketches(rows(0, 20_000, one).unionAll(rows(10_000, 30_000, two)), path)
    hours = spark.read.parquet(path)
    assert hours.count() == 10
    assert [abs(r.devices_estimate - 20_000) < 600 for r in sketches.by_day(hours).collect()] == [True, True]
    assert abs(sketches.by_month(hours).first().devices_estimate - 30_000) < 900
    some = sketches.folded(hours.where("event_hour = 2 AND event_date = DATE '2024-01-01'")).first()
    assert some.events == 4000 and abs(some.devices_estimate - 4000) < 120
    sketches.write_sketches(rows(0, 50, two), path, [two])
    assert {str(r.event_date): r.events for r in sketches.by_day(spark.read.parquet(path)).collect()} == {one: 20_000, two: 50}
    sketches.write_sketches(rows(0, 50, one), path, [two])
    assert sketches.by_day(spark.read.parquet(path)).count() == 1


@pytest.mark.parametrize("days", [0, 3, 30])
def test_rolling_distinct_threats_equal_a_plain_count(spark, days):
    pick = random.Random(days)
    rows = [event(pick, pick.randrange(90)) for _ in range(150)]
    found = {(r.customer_id, r.event_date): r.rolling_30d_distinct_threats for r in gold.rolling_distinct_threats(spark.createDataFrame(rows, SCHEMA), days).collect()}
    wanted = {}
    for customer, day in {(r[7], r[10]) for r in rows}:
        wanted[customer, day] = len({r[1] for r in rows if r[7] == customer and r[1] and 0 <= (day - r[10]).days <= days})
    assert found == wanted


def test_the_bucketed_pair_is_joined_without_an_exchange(spark, plan):
    summary = spark.range(500).selectExpr("concat('c', id % 20) AS customer_id", "date_add(DATE '2024-01-01', int(id % 9)) AS event_date", "id AS total_events")
    risk = summary.groupBy("customer_id", "event_date").agg(F.sum("total_events").cast("double").alias("risk_score"), F.lit("LOW").alias("risk_tier"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for _ in range(2):
            reports.write_bucketed_pair(summary, risk, "pair_summary", "pair_risk", 4)
        joined = reports.summary_with_risk(spark.table("pair_summary"), spark.table("pair_risk"))
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        assert "Exchange" in plan(reports.summary_with_risk(summary, risk))
        assert sorted(map(str, joined.collect())) == sorted(map(str, reports.summary_with_risk(summary, risk).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("pair_summary", "pair_risk"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
