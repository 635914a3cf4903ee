from __future__ import annotations

import pytest
from conftest import NOW, SMALL
from pyspark.sql import functions as F

from palisade import schemas as S
from palisade.operators.screening import split, standardise_enums
from palisade.plans.gold import hourly_detection_trend
from palisade.plans.silver import silver_events
from verification import registry
from verification.derived import topic_from_bronze
from palisade.sources.aligned_csv import new_lines
from palisade.sources.tables import new_files
from palisade.streaming.events import keep_silver
from palisade.streaming.files import lake_new_files
from palisade.streaming.ingest import ingest, run_available, total_stats, write_batch

NULLABLE_BRONZE = S.BRONZE.replace(" NOT NULL", "")


@pytest.fixture(scope="module")
def topic(spark, bronze, tmp_path_factory):
    """The topic in two deliveries: first deliveries, then the re-delivered copies."""
    root = tmp_path_factory.mktemp("stream")
    messages = topic_from_bronze(bronze, "dev")
    for part, condition in (("one", "offset < 10000000"), ("two", "offset >= 10000000")):
        messages.where(condition).coalesce(1).write.parquet(str(root / part))
    return root


def deliver(root, part, target):
    """Copy one delivery into the watched folder."""
    target.mkdir(exist_ok=True)
    for file in (root / part).glob("*.parquet"):
        (target / f"{part}.parquet").write_bytes(file.read_bytes())


@pytest.fixture(scope="module")
def ingested(spark, topic):
    """Two runs of the ingest stream, one per delivery, and a third with nothing new."""
    counts = []
    paths = {name: str(topic / name) for name in ("bronze", "letters", "stats", "checkpoint")}
    for part in ("one", "two", None):
        if part:
            deliver(topic, part, topic / "watched")
        messages = new_files(spark, str(topic / "watched"), S.MESSAGE, files_per_batch=1)
        ingest(messages, "raw", paths["bronze"], paths["letters"], paths["stats"], paths["checkpoint"])
        counts.append(tuple(total_stats(spark.read.parquet(paths["stats"])).first()))
    return paths, counts


def test_each_run_takes_only_new_messages(ingested):
    assert ingested[1] == [(1000, 923, 77), (1050, 969, 81), (1050, 969, 81)]


def test_bronze_and_letters_add_up(spark, ingested):
    assert spark.read.parquet(ingested[0]["bronze"]).count() == 969
    assert spark.read.parquet(ingested[0]["letters"]).count() == 81


@pytest.fixture(scope="module")
def kept(spark, ingested, tmp_path_factory):
    """The bronze rows merged in two micro-batches."""
    root = tmp_path_factory.mktemp("kept")
    paths = {name: str(root / name) for name in ("silver", "checkpoint", "quarantine", "hourly")}
    arrived = new_files(spark, ingested[0]["bronze"], NULLABLE_BRONZE, files_per_batch=1)
    keep_silver(arrived, paths["silver"], paths["checkpoint"], paths["quarantine"], paths["hourly"], NOW)
    return paths


def test_latest_wins_across_batches(spark, bronze, kept):
    streamed = spark.read.parquet(kept["silver"])
    batch = silver_events(bronze.where("kafka_offset % 13 <> 0"), NOW)
    assert streamed.count() == batch.count()
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0


def test_screening_keeps_every_row(spark, bronze, kept):
    rejected = spark.read.parquet(kept["quarantine"])
    _, bad = split(standardise_enums(bronze.where("kafka_offset % 13 <> 0")), NOW)
    assert rejected.count() == bad.count() and "ip_address" not in rejected.columns


def test_hours_equal_the_batch_table_whatever_the_batches(spark, bronze, kept, tmp_path):
    readable = bronze.where("kafka_offset % 13 <> 0")
    wanted = hourly_detection_trend(silver_events(readable, NOW))
    readable.repartition(5, F.xxhash64("event_id", "kafka_offset")).write.parquet(str(tmp_path / "in"))
    arrived = new_files(spark, str(tmp_path / "in"), NULLABLE_BRONZE, files_per_batch=1)
    keep_silver(arrived, str(tmp_path / "silver"), str(tmp_path / "c"), hourly=str(tmp_path / "hourly"), now=NOW)
    for path in (kept["hourly"], str(tmp_path / "hourly")):
        found = spark.read.parquet(path)
        assert found.count() == wanted.count() == 750
        assert found.select(*wanted.columns).exceptAll(wanted).count() == 0


def test_a_retried_batch_does_not_double_the_quarantine(spark, topic, tmp_path):
    """The ingest stream dies after its writes and before its commit, and the next stream has read its files already."""
    deliver(topic, "one", tmp_path / "in")
    paths = {name: str(tmp_path / name) for name in ("bronze", "letters", "stats", "checkpoint", "silver", "c", "quarantine")}
    run = lambda: ingest(new_files(spark, str(tmp_path / "in"), S.MESSAGE), "raw", *[paths[n] for n in ("bronze", "letters", "stats", "checkpoint")])
    screen = lambda: keep_silver(new_files(spark, paths["bronze"], NULLABLE_BRONZE), paths["silver"], paths["c"], paths["quarantine"], now=NOW)
    run()
    screen()
    counts = spark.read.parquet(paths["quarantine"]).count()
    for file in (tmp_path / "checkpoint/commits").iterdir():
        file.unlink()
    run()
    screen()
    assert spark.read.parquet(paths["quarantine"]).count() == counts > 0
    assert spark.read.parquet(paths["bronze"]).count() == 923


def test_a_poison_message_does_not_stop_the_stream(spark, tmp_path):
    rows = [(None, value, None, 1, n, None) for n, value in enumerate([b"\xff\xfe", b'{"event_id": "a"}', b"{} {}"])]
    spark.createDataFrame(rows, S.MESSAGE).write.parquet(str(tmp_path / "in"))
    paths = [str(tmp_path / name) for name in ("bronze", "letters", "stats", "checkpoint")]
    ingest(new_files(spark, str(tmp_path / "in"), S.MESSAGE), "raw", *paths)
    assert tuple(total_stats(spark.read.parquet(paths[2])).first()) == (3, 1, 2)


def test_csv_files_as_they_arrive(spark, tmp_path):
    inbox, lake, checkpoint = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "checkpoint")
    inbox.mkdir()
    counts = []
    for name, text in (("a.csv", "day,v\n2024-01-02,1\n"), ("b.csv", "v,day,v\n2,2024-01-02,9\n3,2024-01-03,9\n"), (None, None)):
        if name:
            (inbox / name).write_text(text)
        lake_new_files(new_lines(spark, str(inbox)), lake, checkpoint, ["day", "v"], {"v": "int", "day": "date"}, "day")
        counts.append(spark.read.parquet(lake).count())
    assert counts == [1, 3, 3]
    found = spark.read.parquet(lake).select("year", "month", F.dayofmonth("modified").isNotNull(), "v").orderBy("v").collect()
    assert [tuple(row) for row in found] == [(2024, 1, True, 1), (2024, 1, True, 2), (2024, 1, True, 3)]


def test_csv_report_and_torn_files_of_a_stream(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.csv").write_text('day,v,w\n2024-01-02,1,"x\ny"\n')
    lake_new_files(new_lines(spark, str(inbox)), str(tmp_path / "lake"), str(tmp_path / "c"), ["day", "v"], {"v": "int"}, "day", report=str(tmp_path / "r"))
    assert [row.v for row in spark.read.parquet(str(tmp_path / "lake")).collect()] == [1]
    assert [row.unknown for row in spark.read.parquet(str(tmp_path / "r")).collect()] == [["w"]]


def test_repeated_batch_stays_as_it_is(spark, tmp_path):
    for _ in range(2):
        write_batch(spark.range(5), str(tmp_path / "log"), 7)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 5


def test_run_available_hands_over_batches(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "in"))
    seen = []
    run_available(new_files(spark, str(tmp_path / "in"), "id BIGINT"), lambda batch, number: seen.append((number, batch.count())), str(tmp_path / "c"))
    assert seen == [(0, 10)]


@pytest.mark.parametrize("batches", [1])
def test_a_batch_arrives_in_files_of_bounded_size(spark, tmp_path, monkeypatch, batches):
    monkeypatch.setattr(registry, "ARRIVING_BYTES", 8_000)
    monkeypatch.setattr(registry, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    root = registry._kept(spark, SMALL, batches)
    files = list((tmp_path / "topic" / "arriving").glob("*.parquet"))
    assert len(files) > batches and max(file.stat().st_size for file in files) < 40_000
    assert len(list((tmp_path / "topic" / "quarantine").glob("batch_id=*"))) == batches
    bronze = spark.read.parquet(f"{root}/bronze")
    assert spark.read.parquet(f"{root}/silver").count() == silver_events(bronze, NOW).count()
