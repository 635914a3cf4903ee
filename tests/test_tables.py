from __future__ import annotations

import uuid

import pytest
from conftest import NOW
from pyspark.sql import functions as F

from palisade import session
from palisade.plans import jobs
from palisade.plans.silver import quarantined_events, silver_events
from palisade.session import scratch, settle, shared_folder
from palisade.sinks import tables
from palisade.sinks.tables import laid_out, merge_table, register_table, write_quarantine, write_table
from palisade.sources.tables import read_table


@pytest.fixture(scope="module")
def run(spark, bronze, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    paths = {name: str(root / name) for name in ("silver", "quarantine", "gold")}
    counts = [jobs.bronze_to_silver(bronze, paths["silver"], paths["quarantine"], "dev", "one", NOW, mode=mode) for mode in (jobs.REPLACE, jobs.MERGE)]
    counts.append(jobs.silver_to_gold(read_table(spark, paths["silver"]), paths["gold"], "dev", NOW))
    return paths, counts


def test_counts_come_with_the_writes(run):
    assert run[1] == [
        {"bronze": 1050, "accepted": 850, "rejected": 200, "silver": 815},
        {"bronze": 1050, "accepted": 850, "rejected": 200, "silver": 815},
        {"daily_threat_summary": 701, "global_threat_leaderboard": 651, "hourly_detection_trend": 815, "customer_risk_scores": 517,
         "product_performance_kpis": 680},
    ]


def test_second_run_changes_nothing(spark, run):
    assert read_table(spark, run[0]["silver"]).count() == 815
    assert read_table(spark, run[0]["quarantine"]).count() == 200


def test_refresh_from_a_date(spark, run, tmp_path):
    """The newest dates rebuilt on their own equal those of the full build, rolling sums included."""
    silver = read_table(spark, run[0]["silver"])
    counts = jobs.silver_to_gold(silver, str(tmp_path), "dev", NOW, since="2024-03-20")
    for name in ("daily_threat_summary", "hourly_detection_trend", "customer_risk_scores"):
        full = read_table(spark, f"{run[0]['gold']}/{name}").where("event_date >= DATE '2024-03-20'")
        fresh = read_table(spark, f"{tmp_path}/{name}")
        assert fresh.count() == full.count() == counts[name] > 0
        assert fresh.exceptAll(full.select(*fresh.columns)).count() == 0


def test_silver_columns_and_audit(spark, run):
    silver = read_table(spark, run[0]["silver"])
    assert "ip_address" not in silver.columns and not [name for name in silver.columns if name.startswith("is_")]
    assert [tuple(row) for row in silver.select("pipeline_version", "environment").distinct().collect()] == [("2.0.0", "dev")]
    assert silver.where(F.col("ip_address_masked").rlike(r"\.\d+$")).count() == 0


def test_partition_filter_prunes(spark, run, plan):
    month = read_table(spark, run[0]["silver"]).where("event_date = DATE '2024-02-15'")
    filters = [line for line in plan(month).splitlines() if "PartitionFilters" in line]
    assert "event_date" in filters[0]


def test_gold_reads_only_its_columns(spark, run, plan):
    from palisade.plans.gold import daily_customer_rollup

    schema = [line for line in plan(daily_customer_rollup(read_table(spark, run[0]["silver"]))).splitlines() if "ReadSchema" in line]
    assert schema == ["ReadSchema: struct<customer_id:string,threat_hash:string,severity_score:int>"]


@pytest.mark.parametrize("name", ["daily_threat_summary", "global_threat_leaderboard"])
def test_registered_without_copying(spark, run, name):
    table = register_table(spark, f"check_{name}", f"{run[0]['gold']}/{name}")
    assert table.count() == read_table(spark, f"{run[0]['gold']}/{name}").count() > 0
    assert spark.sql(f"SELECT * FROM check_{name}").columns == table.columns
    spark.sql(f"DROP TABLE check_{name}")


def test_empty_quarantine_writes_no_data_file(spark, bronze, tmp_path):
    write_quarantine(quarantined_events(bronze, NOW).where("false"), str(tmp_path / "q"), "one")
    assert not list((tmp_path / "q").rglob("*.parquet"))


def test_quarantine_keeps_other_batches(spark, bronze, tmp_path):
    rejected = quarantined_events(bronze, NOW)
    for batch in ("one", "two", "one"):
        write_quarantine(rejected, str(tmp_path / "q"), batch)
    assert read_table(spark, str(tmp_path / "q")).count() == 2 * rejected.count()


def test_only_touched_partitions_are_replaced(spark, bronze, tmp_path):
    silver, path = silver_events(bronze, NOW), str(tmp_path / "t")
    write_table(silver, path, ["event_date"])
    write_table(silver.where("event_date = DATE '2024-02-15'").limit(1), path, ["event_date"])
    written = read_table(spark, path)
    day = silver.where("event_date = DATE '2024-02-15'").count()
    assert day > 1 and written.count() == silver.count() - day + 1


def test_rows_are_sorted_inside_files(spark, run):
    path = f"{run[0]['gold']}/global_threat_leaderboard"
    ranks = [row.threat_rank for row in spark.read.parquet(path).coalesce(1).collect()]
    assert ranks == sorted(ranks)


def test_hot_cluster_is_split(spark, tmp_path):
    """Nine tenths of the rows share one key; AQE gives them to several tasks, so to several files."""
    key = F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id"))
    rows = spark.range(400_000).select(key.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        laid_out(rows, ["key"], ["key"]).write.parquet(str(tmp_path / "hot"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.read.parquet(str(tmp_path / "hot"))
    assert written.where("key = 0").select("_metadata.file_path").distinct().count() > 4
    assert written.count() == 400_000


def test_shared_folder_is_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second and (root is None or first.startswith(root))


def test_settled_table_is_read_back(spark, plan):
    settled = settle(spark.range(10).withColumn("text", F.lit("x")), "test")
    assert settled.count() == 10 and "ReadSchema: struct<id:bigint>" in plan(settled.select("id"))


def test_read_by_name_or_path(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "old"))
    spark.range(2).withColumn("more", F.lit("x")).write.mode("append").parquet(str(tmp_path / "old"))
    assert read_table(spark, str(tmp_path / "old"), merge_schema=True).columns == ["id", "more"]
    spark.range(4).createOrReplaceTempView("four")
    assert read_table(spark, "four").count() == 4


def shifted(bronze, days):
    """The copies with another date and a later ingestion."""
    again = bronze.where("kafka_offset >= 10000000")
    return again.withColumns({"event_timestamp": F.expr(f"event_timestamp + INTERVAL {days} DAYS"), "ingestion_timestamp": F.expr("ingestion_timestamp + INTERVAL 1 DAY")})


def test_a_delivery_that_moves_its_date_leaves_the_old_one(spark, bronze, tmp_path):
    paths = str(tmp_path / "s"), str(tmp_path / "q")
    jobs.bronze_to_silver(bronze, *paths, "dev", "one", NOW, mode=jobs.REPLACE)
    counts = jobs.bronze_to_silver(shifted(bronze, 1000), *paths, "dev", "two", NOW, mode=jobs.MERGE)
    found = read_table(spark, paths[0])
    wanted = silver_events(bronze.unionByName(shifted(bronze, 1000)), NOW)
    assert found.count() == found.select("event_id").distinct().count() == wanted.count() == 815
    assert found.select(*wanted.columns).exceptAll(wanted).count() == 0
    assert counts["bronze"] == 50 and 0 < counts["silver"] < 815


def test_a_date_whose_only_event_moves_goes(spark, tmp_path):
    row = lambda i, day, at: spark.createDataFrame([(i, day, at)], "event_id string, day string, at int")
    path = str(tmp_path / "t")
    for new in (row("a", "1", 1), row("b", "2", 1), row("a", "2", 2), row("a", "1", 1)):
        merge_table(new, path, ["day"], order=["at"])
    assert sorted(tuple(r) for r in read_table(spark, path).select("event_id", "at", "day").collect()) == [("a", 2, 2), ("b", 1, 2)]
    assert not (tmp_path / "t/day=1").exists()


def test_unknown_mode_is_refused(bronze, tmp_path):
    with pytest.raises(ValueError):
        jobs.bronze_to_silver(bronze, str(tmp_path / "s"), str(tmp_path / "q"), "dev", "one", NOW, mode="append")


def test_rebuild_removes_what_has_left(spark, run, tmp_path):
    silver, gold = read_table(spark, run[0]["silver"]), str(tmp_path)
    jobs.silver_to_gold(silver, gold, "dev", NOW)
    less = silver.where("event_date NOT IN (DATE '2024-01-10', DATE '2024-03-21')")
    jobs.silver_to_gold(less, gold, "dev", NOW, since="2024-03-20")
    dates = {str(r.event_date) for r in read_table(spark, f"{gold}/hourly_detection_trend").select("event_date").distinct().collect()}
    assert "2024-01-10" in dates and "2024-03-21" not in dates
    jobs.silver_to_gold(less, gold, "dev", NOW)
    assert read_table(spark, f"{gold}/hourly_detection_trend").where("event_date = DATE '2024-01-10'").count() == 0


def test_since_reads_only_the_needed_folders(spark, run, plan):
    built = jobs.gold_tables(read_table(spark, run[0]["silver"]), since="2024-03-20")["hourly_detection_trend"]()
    filters = [line for line in plan(built).splitlines() if "PartitionFilters" in line]
    assert "2024-03-20" in filters[0] and "event_date" in filters[0]


def test_rows_are_counted_above_the_exchange(spark, bronze, tmp_path, monkeypatch, plan):
    from palisade.sinks import tables

    seen = []
    monkeypatch.setattr(tables, "observed", lambda df, *a, real=tables.observed, **m: (seen.append(real(df, *a, **m)), seen[-1])[1])
    assert write_table(silver_events(bronze, NOW), str(tmp_path / "t"), ["event_date"]) == 815
    lines = [line.strip(" +-*:") for line in plan(seen[0][0]).splitlines()]
    nodes = [line for line in lines if line.startswith(("CollectMetrics", "Exchange"))]
    assert nodes[0].startswith("CollectMetrics")


def test_another_folder_is_refused_and_quotes_are_no_sql(spark, tmp_path):
    for name in ("a", "it's"):
        spark.range(3).write.parquet(str(tmp_path / name))
    assert register_table(spark, "check_one", str(tmp_path / "it's")).count() == 3
    with pytest.raises(ValueError):
        register_table(spark, "check_one", str(tmp_path / "a"))
    spark.sql("DROP TABLE check_one")


def test_scratch_is_empty_after_the_jobs_and_after_a_failure(spark, run, tmp_path, monkeypatch):
    folder = lambda _, purpose: str(tmp_path / "shared" / f"{purpose}-{uuid.uuid4().hex}")
    monkeypatch.setattr(session, "shared_folder", folder)
    silver = read_table(spark, run[0]["silver"])
    jobs.silver_to_gold(silver, str(tmp_path / "gold"), "dev", NOW)
    with pytest.raises(RuntimeError), scratch(spark):
        assert settle(spark.range(3), "kept").count() == 3
        raise RuntimeError
    assert (tmp_path / "shared").exists() and not list((tmp_path / "shared").rglob("*.parquet"))


def test_gold_plans_run_nothing_before_they_are_asked_for(spark, run):
    tracker = spark.sparkContext.statusTracker()
    silver = read_table(spark, run[0]["silver"])
    before = len(tracker.getJobIdsForGroup())
    assert set(jobs.gold_tables(silver)) == set(run[1][2])
    assert len(tracker.getJobIdsForGroup()) == before


def test_whole_gold_job(spark, run, tmp_path):
    gold = run[0]["gold"]
    counts = jobs.gold_to_reports(gold, str(tmp_path / "r"), spark, "2024-06-01", "2024-04-20")
    assert counts == {"executive_summary": 4, "top_threats_weekly": 10}
    loaded = jobs.gold_to_warehouse(gold, str(tmp_path / "w"), spark, NOW)
    assert loaded["global_threat_leaderboard"] + loaded["rejected global_threat_leaderboard"] == 651
    assert "missing:threat_name" in str(read_table(spark, str(tmp_path / "w/rejected/global_threat_leaderboard")).first())


def test_a_large_partition_is_dealt_over_tasks(spark, tmp_path):
    day = "CASE WHEN id < 700 THEN NULL WHEN id < 950 THEN 'b' ELSE 'c' END AS day"
    made = spark.range(1000).coalesce(1).selectExpr("id % 10 AS id", day)
    dealt = tables._dealt(made, ["day"], 100).groupBy("day", tables.TURN).count().collect()
    sizes = {name: sorted(row["count"] for row in dealt if row.day == name) for name in (None, "b", "c")}
    assert [len(sizes[name]) for name in (None, "b", "c")] == [7, 3, 1]
    assert max(max(found) for found in sizes.values()) <= 101
    assert tables.write_table(made, str(tmp_path / "t"), ["day"], most_rows=100) == 1000
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.columns == ["id", "day"] and sorted(map(str, back.collect())) == sorted(map(str, made.collect()))
