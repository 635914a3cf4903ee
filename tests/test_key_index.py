from __future__ import annotations

import pytest
from conftest import NOW
from test_tables import shifted

from palisade.plans import jobs
from palisade.plans.silver import silver_events
from palisade.sinks import folders, key_index
from palisade.sinks.key_index import merge_by_index
from palisade.sinks.tables import merge_table
from palisade.sources.tables import read_table


def table(spark, rows):
    return spark.createDataFrame(rows, "event_id string, day string, at int, other int")


def held(spark, path):
    return sorted((tuple(r) for r in read_table(spark, path).selectExpr("event_id", "string(day)", "at").collect()), key=str)


def merge(new, root, **options):
    return merge_by_index(new, f"{root}/t", f"{root}/index", ["day"], order=["at"], **options)


def history(spark, days: int, each: int = 20):
    return table(spark, [(f"k{day}-{i}", f"d{day:04}", 1, 0) for day in range(days) for i in range(each)])


def test_the_same_rows_as_without_an_index(spark, tmp_path):
    deliveries = [
        [("a", "1", 1, 0), ("b", "2", 1, 0), ("b", "2", 1, 0)],
        [("a", "2", 2, 0), ("c", "3", 1, 0)],
        [("a", "1", 1, 0)],
        [("c", "4", 5, 0), ("d", "7", 1, 0), ("e", "9", 1, 0)],
        [],
        [("d", "1", 2, 0), ("e", "8", 2, 0)],
    ]
    for rows in deliveries:
        for _ in range(2):
            merge(table(spark, rows), tmp_path, buckets=4)
            merge_table(table(spark, rows), f"{tmp_path}/plain", ["day"], order=["at"])
            assert held(spark, f"{tmp_path}/t") == held(spark, f"{tmp_path}/plain")
    assert not (tmp_path / "t/day=3").exists() and not (tmp_path / "t/day=9").exists()


def test_files_opened_follow_the_delivery_not_the_history(spark, tmp_path):
    opened = []
    for days in (30, 120):
        root = tmp_path / str(days)
        merge(history(spark, days), root, buckets=16)
        delivery = table(spark, [("k3-1", "d0003", 2, 0), ("k7-2", "d0008", 2, 0), ("new", "d0003", 1, 0)])
        found = merge(delivery, root)
        assert sorted(p["day"] for p in found.partitions) == ["d0003", "d0007", "d0008"]
        opened.append((found.index_files, found.table_files))
    assert opened[0] == opened[1]
    assert opened[0][0] <= 3 and opened[0][1] == 3


def test_only_the_touched_folders_are_listed(spark, tmp_path, monkeypatch):
    merge(history(spark, 40), tmp_path, buckets=8)

    def refused(*_, **__):
        raise AssertionError("all folders are listed")

    monkeypatch.setattr(folders, "partitions", refused)
    merge(table(spark, [("k3-1", "d0003", 2, 0)]), tmp_path)
    assert read_table(spark, f"{tmp_path}/t").count() == 800


def test_a_table_without_an_index_gets_one(spark, tmp_path):
    merge_table(history(spark, 6), f"{tmp_path}/t", ["day"], order=["at"])
    merge(table(spark, [("k3-1", "d0001", 2, 0)]), tmp_path, buckets=8)
    assert ("k3-1", "d0001", 2) in held(spark, f"{tmp_path}/t") and read_table(spark, f"{tmp_path}/t").count() == 120
    assert folders.names(spark, f"{tmp_path}/index") == ["buckets=8"]


@pytest.mark.parametrize("step", ["after the index", "before the old partition goes"])
def test_a_merge_that_failed_is_mended_by_the_next(spark, tmp_path, monkeypatch, step):
    merge(table(spark, [("a", "1", 1, 0), ("b", "2", 1, 0)]), tmp_path, buckets=4)
    delivery = table(spark, [("a", "2", 2, 0), ("c", "5", 1, 0)])
    with monkeypatch.context() as patched:

        def fail(*_, **__):
            raise RuntimeError

        if step == "after the index":
            patched.setattr(key_index, "replace_partitions", fail)
        else:
            patched.setattr(folders, "some_partitions", lambda *a, real=folders.some_partitions, seen=[], **k: real(*a, **k) if len(seen) < 2 and not seen.append(1) else fail())
        with pytest.raises(RuntimeError):
            merge(delivery, tmp_path)
    merge(delivery, tmp_path)
    assert held(spark, f"{tmp_path}/t") == [("a", "2", 2), ("b", "2", 1), ("c", "5", 1)]


def test_buckets_of_many_files_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "BUCKET_FILES", 3)
    for i in range(9):
        merge(table(spark, [(f"k{i}", "1", 1, 0)]), tmp_path, buckets=1)
    parts = folders.some_partitions(spark, f"{tmp_path}/index/buckets=1", [{"bucket": "0"}])
    assert len(parts[0].files) <= 4
    merge(table(spark, [(f"k{i}", "2", 2, 0) for i in range(9)]), tmp_path)
    assert held(spark, f"{tmp_path}/t") == [(f"k{i}", "2", 2) for i in range(9)]


def test_more_keys_than_go_to_the_scan_one_by_one(spark, tmp_path):
    merge(history(spark, 10, 30), tmp_path, buckets=4)
    again = table(spark, [(f"k{day}-{i}", "d9999", 2, 0) for day in range(5) for i in range(30)])
    assert len(merge(again, tmp_path).partitions) == 6
    assert read_table(spark, f"{tmp_path}/t").where("day = 'd9999'").count() == 150
    assert read_table(spark, f"{tmp_path}/t").count() == 300


def test_the_index_has_bloom_filters(spark, tmp_path):
    merge(history(spark, 10), tmp_path, buckets=1)
    few = key_index._entries_of(spark, f"{tmp_path}/index/buckets=1", [0], key_index._hashed(table(spark, [("k1-1", "d", 1, 0)]), ["event_id"], 1).select("bucket", "key_hash"))[0]
    assert few.count() == 1
    import pyarrow.parquet as pq

    file = next((tmp_path / "index/buckets=1/bucket=0").glob("*.parquet"))
    plain = tmp_path / "plain"
    spark.read.parquet(str(file)).coalesce(1).write.option("compression", "snappy").parquet(str(plain))
    assert file.stat().st_size > next(plain.glob("*.parquet")).stat().st_size
    assert pq.ParquetFile(file).metadata.num_rows == 200


def test_the_silver_job_with_an_index(spark, bronze, tmp_path):
    paths = str(tmp_path / "s"), str(tmp_path / "q")
    jobs.bronze_to_silver(bronze, *paths, "dev", "one", NOW, mode=jobs.REPLACE, index=str(tmp_path / "i"))
    for _ in range(2):
        jobs.bronze_to_silver(shifted(bronze, 1000), *paths, "dev", "two", NOW, mode=jobs.MERGE, index=str(tmp_path / "i"))
    wanted = silver_events(bronze.unionByName(shifted(bronze, 1000)), NOW)
    found = read_table(spark, paths[0])
    assert found.count() == wanted.count() == 815
    assert found.select(*wanted.columns).exceptAll(wanted).count() == 0
