"""Work that a few large row groups would leave to a few tasks is dealt over all of them."""

from __future__ import annotations

import pytest
from conftest import SMALL

from verification import registry
from verification.derived import bronze_from_events


@pytest.fixture
def small_tasks(spark):
    """So that the small tables here aren't put together again."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_bronze_of_one_row_group_is_made_by_many_tasks(spark, small_tasks):
    plain, spread = bronze_from_events(spark, SMALL), registry._spread_bronze(spark, SMALL)
    assert len(plain.inputFiles()) == 1 and len(spread.inputFiles()) > 1
    assert spread.exceptAll(plain).count() == 0 and spread.count() == 1050


def test_the_topic_comes_in_several_files(spark, tmp_path, monkeypatch, small_tasks):
    monkeypatch.setattr(registry, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    root = registry._ingested(spark, SMALL)
    assert len(list((tmp_path / "topic" / "topic").glob("*.parquet"))) > 1
    assert spark.read.parquet(f"{root}/bronze").count() == 969


def test_a_batch_of_medium_size_comes_in_several_files():
    assert registry._files_per_batch(66 << 20, 4) >= 4
