from __future__ import annotations

import pytest
from conftest import NOW
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.plans import jobs
from palisade.plans.silver import silver_events
from palisade.sinks import evolution
from palisade.sinks.tables import merge_table
from palisade.sources.tables import read_table

ORDER = ("at",)


def rows(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


def merge(df, path, **more):
    return merge_table(df, path, ["day"], keys=("id",), order=ORDER, schema_change=True, **more)


@pytest.mark.parametrize(
    ("one", "other", "both"),
    [
        ("int", "bigint", "bigint"),
        ("smallint", "tinyint", "smallint"),
        ("int", "float", "double"),
        ("bigint", "double", None),
        ("decimal(10,2)", "decimal(12,1)", "decimal(13,2)"),
        ("decimal(38,0)", "decimal(38,10)", None),
        ("string", "int", None),
        ("array<int>", "array<int>", "array<int>"),
    ],
)
def test_widths(spark, one, other, both):
    kinds = [T.StructType.fromDDL(f"c {name}")["c"].dataType for name in (one, other)]
    for pair in (kinds, kinds[::-1]):
        found = evolution.wider(*pair)
        assert (found and found.simpleString()) == both


def test_old_files_stay_and_are_read_with_new_columns_and_types(spark, tmp_path):
    path, name = str(tmp_path / "it's"), "check_evolved"
    merge(rows(spark, "id int, at int, v int, w float, day string", (1, 1, 7, 0.5, "a"), (2, 1, 8, 1.5, "b")), path, table=name)
    kept = {f for f in (tmp_path / "it's" / "day=a").glob("*.parquet")}
    for _ in range(2):
        merge(rows(spark, "id int, at int, V bigint, w int, more string, day string", (2, 2, 2**40, 3, "new", "b"), (3, 1, 1, 2, None, "c")), path, table=name)
    want = [(1, 1, 7, 0.5, None, "a"), (2, 2, 2**40, 3.0, "new", "b"), (3, 1, 1, 2.0, None, "c")]
    for table in (spark.table(name), read_table(spark, path)):
        assert table.columns == ["id", "at", "v", "w", "more", "day"]
        assert [t for _, t in table.dtypes[2:5]] == ["bigint", "double", "string"]
        assert sorted(map(tuple, table.collect())) == want
    assert {f for f in (tmp_path / "it's" / "day=a").glob("*.parquet")} == kept
    # A delivery of the old shape is widened, and takes nothing away; one more column alone alters the entry.
    merge(rows(spark, "id int, at int, v int, extra date, day string", (4, 1, 5, None, "b")), path, table=name)
    assert spark.table(name).columns == ["id", "at", "v", "w", "more", "extra", "day"]
    assert sorted(tuple(r)[:5] for r in spark.table(name).collect()) == [tuple(r[:5]) for r in want] + [(4, 1, 5, None, None)]
    assert spark.table(name).where("v > 1000000 AND extra IS NULL").count() == 1
    spark.sql(f"DROP TABLE {name}")


def test_refused_before_anything_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(rows(spark, "id int, at int, v int, day int", (1, 1, 7, 1)), path)
    before = sorted(tmp_path.rglob("*"))
    with pytest.raises(ValueError, match="v: int and string; day: int and bigint"):
        merge(rows(spark, "id int, at int, v string, day bigint", (1, 2, "x", 1)), path)
    assert sorted(tmp_path.rglob("*")) == before


def test_a_table_without_kept_schema_takes_it_from_all_its_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, "id int, at int, day string", (1, 1, "a")).write.partitionBy("day").parquet(path)
    rows(spark, "id int, at int, late string, day string", (2, 1, "x", "b")).write.mode("append").partitionBy("day").parquet(path)
    merge(rows(spark, "id int, at int, day string", (3, 1, "b")), path)
    assert sorted((r.id, r.late) for r in read_table(spark, path).collect()) == [(1, None), (2, "x"), (3, None)]


@pytest.mark.parametrize("index", [False, True])
def test_silver_takes_up_a_column_of_a_delivery(spark, bronze, tmp_path, index):
    path, name = str(tmp_path / "silver"), f"check_silver_{index}".lower()
    late = F.col("kafka_offset") % 3 == 0
    for batch, part in (("one", bronze.where(~late)), ("two", bronze.where(late).withColumn("sensor", F.lit("s1")))):
        jobs.bronze_to_silver(
            part, path, str(tmp_path / "q"), "dev", batch, NOW, mode=jobs.MERGE, table=name, schema_change=True,
            index=str(tmp_path / "index") if index else None,
        )
    want = {(r.event_id, "s1" if r.late else None) for r in silver_events(bronze, NOW).select("event_id", late.alias("late")).collect()}
    assert {(r.event_id, r.sensor) for r in spark.table(name).collect()} == want
    spark.sql(f"DROP TABLE {name}")
