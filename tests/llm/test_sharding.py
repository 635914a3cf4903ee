from __future__ import annotations

from collections import Counter

import pytest
from helpers import odd_docs
from pyspark.sql import functions as F

from palisade.llm import sharding


def placed(rows, shards=16):
    return sharding.shard_rows(rows, shards).collect()


@pytest.mark.parametrize("count", [1, 2, 3, 15, 16, 17, 100, 4097, 20_000])
def test_counts_differ_by_one_and_slots_have_no_gap(spark, count):
    rows = placed(spark.range(count))
    sizes = Counter(r.shard for r in rows)
    assert sorted(r.global_row for r in rows) == list(range(count))
    assert max(sizes.values()) - min([sizes[s] for s in range(16)]) <= 1
    for shard, size in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(size))


def test_the_order_is_a_shuffle(spark):
    rows = sorted(placed(spark.range(10_000), 1), key=lambda r: r.global_row)
    follows = sum(abs(a.slot - b.slot) == 1 for a, b in zip(rows, rows[1:], strict=False))
    assert follows < 20


def test_partitions_do_not_matter(spark):
    docs = odd_docs(spark).select("doc_id", "text", "hash", "shard")
    assert sorted(map(str, placed(docs))) == sorted(map(str, placed(docs.repartition(7, "text"))))


def test_place_needs_no_other_row(spark):
    rows = sharding.shard_rows(spark.range(1000), 8, seed=5)
    shard, slot = sharding.place(F.col("global_row"), 1000, 8, seed=5)
    assert rows.filter((shard != F.col("shard")) | (slot != F.col("slot"))).count() == 0


def test_repeated_rows_and_nulls(spark):
    rows = spark.range(9000).selectExpr("CASE WHEN id < 5000 THEN NULL ELSE id % 3 END AS doc_id", "CAST(NULL AS string) AS slot")
    found = placed(rows)
    assert len(found) == 9000
    assert Counter(r.doc_id for r in found)[None] == 5000
    assert sorted(r.global_row for r in found) == list(range(9000))


def test_empty_table(spark):
    assert placed(spark.range(0)) == []


def test_no_python(spark, plan):
    shown = plan(sharding.shard_rows(odd_docs(spark).select("doc_id", "text")))
    assert not any(node in shown for node in ("InArrow", "EvalPython", "InPandas"))
