"""A merge finds by narrow rows which rows lose, and shuffles whole rows once, to write them."""

from __future__ import annotations

import random

import pytest

from palisade.operators.latest import latest_per_key
from palisade.sinks import key_index, tables
from palisade.sinks.key_index import merge_by_index
from palisade.sinks.tables import merge_table
from palisade.sources.tables import read_table

SHAPE = "event_id string, day string, at int, other string"


def rows_of(pick: random.Random, count: int, keys: int):
    return [(pick.choice([None, *[f"k{i}" for i in range(keys)]]), f"d{pick.randrange(3)}", pick.choice([None, 1, 2, 3]), f"o{pick.randrange(99)}") for _ in range(count)]


def shown(rows, *names):
    return sorted(map(str, rows.select(*names).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_the_latest_of_both_equals_the_latest_of_the_union(spark, tmp_path, seed):
    """Also with keys that are held several times, exact copies, NULL keys and NULL order."""
    pick = random.Random(seed)
    held = spark.createDataFrame(rows_of(pick, 60, 20) * 2, SHAPE)
    arrived = latest_per_key(spark.createDataFrame(rows_of(pick, 25, 30), SHAPE).drop("other"), order=["at"])
    held.write.parquet(str(tmp_path / "held"))
    arrived.write.parquet(str(tmp_path / "arrived"))
    held, arrived = spark.read.parquet(str(tmp_path / "held")), spark.read.parquet(str(tmp_path / "arrived"))
    found = tables._latest_of_both(tables._located(held, 0), tables._located(arrived, 1), ["event_id"], ["at"])
    wanted = latest_per_key(held.unionByName(arrived, allowMissingColumns=True), order=["at"])
    assert found.columns == wanted.columns
    assert shown(found, "event_id", "at") == shown(wanted, "event_id", "at")


@pytest.mark.parametrize("indexed", [False, True])
def test_no_whole_row_is_settled_but_the_delivery(spark, tmp_path, monkeypatch, indexed):
    path, seen = f"{tmp_path}/t", []

    def merge(rows):
        new = spark.createDataFrame(rows, SHAPE)
        if indexed:
            return merge_by_index(new, path, f"{tmp_path}/index", ["day"], order=["at"], buckets=2)
        return merge_table(new, path, ["day"], order=["at"])

    merge([("a", "1", 1, "x"), ("b", "1", 5, "y"), ("c", "2", 1, "z")])
    real = tables.settle
    for module in (tables, key_index):
        monkeypatch.setattr(module, "settle", lambda df, purpose: seen.append((purpose, df.columns)) or real(df, purpose))
    merge([("a", "2", 2, "x2"), ("b", "1", 4, "old"), ("d", "1", 1, "w")])
    assert [purpose for purpose, columns in seen if "other" in columns] == ["arrived"]
    assert shown(read_table(spark, path), "event_id", "day", "at", "other") == [
        f"Row(event_id='{k}', day={d}, at={n}, other='{o}')" for k, d, n, o in (("a", 2, 2, "x2"), ("b", 1, 5, "y"), ("c", 2, 1, "z"), ("d", 1, 1, "w"))
    ]
