from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from palisade.sources import aligned_csv

FILES = {
    "a.csv": 'id,name,amt\n1,ann,1.5\n2,"bo, ""b""",2\n\n',
    "b.csv": "amt,id\n3.5,3\nx,4\n",
    "deep/c.csv": "name\ncc\ndd\nname\n",
    "d.csv": "id,amt,id,extra\n5,5.5,55,zz\n6,6.5,66,yy,surplus\n7\n",
    "e.csv": "",
    "f.csv": '"id", name \n9,no line end',
    "g.csv": "id,name\n",
    "notes.txt": "id\n404\n",
}
COLUMNS = ["id", "name", "amt", "extra"]
TYPES = {"id": "bigint", "amt": "double"}
ROWS = {
    (1, "ann", 1.5, None, False),
    (2, 'bo, "b"', 2.0, None, False),
    (3, None, 3.5, None, False),
    (4, None, None, None, False),
    (None, "cc", None, None, False),
    (None, "dd", None, None, False),
    (5, None, 5.5, "zz", False),
    (6, None, 6.5, "yy", True),
    (7, None, None, None, False),
    (9, "no line end", None, None, False),
}


def write(folder, files):
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return str(folder)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return write(tmp_path_factory.mktemp("csv"), FILES)


@pytest.fixture(scope="module")
def headers(spark, folder):
    return aligned_csv.file_headers(aligned_csv.read_lines(spark, folder))


def rows_of(df):
    return [tuple(row) for row in df.drop("file", "modified").collect()]


def test_aligned_by_name(spark, folder, headers):
    found = rows_of(aligned_csv.align(aligned_csv.read_lines(spark, folder), headers, COLUMNS, TYPES))
    assert set(found) == ROWS and len(found) == len(ROWS)


def test_extra_keeps_what_the_columns_leave_out(spark, folder, headers):
    rows = aligned_csv.align(aligned_csv.read_lines(spark, folder), headers, ["id", "name", "amt"], TYPES, keep_extra=True)
    assert {row.extra for row in rows.collect()} == {None, "5,5.5,55,zz", "6,6.5,66,yy,surplus", "7"}


def test_all_columns_when_none_are_named(spark, folder):
    assert aligned_csv.read_aligned(spark, folder).columns == ["amt", "extra", "id", "name", "surplus", "file", "modified"]


def test_header_report(headers):
    report = {row.file.rsplit("/", 1)[1]: row for row in aligned_csv.header_report(headers, ["id", "name", "amt"]).collect()}
    assert sorted(report) == ["a.csv", "b.csv", "c.csv", "d.csv", "f.csv", "g.csv"]
    assert (report["d.csv"].column_count, report["d.csv"].repeated, report["d.csv"].unknown) == (4, ["id"], ["extra"])
    assert report["c.csv"].missing == ["amt", "id"] and report["f.csv"].missing == ["amt"]


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    """Blocks after the first hold no header; the hot file is most of the data."""
    count = 20_000
    large = "b,a\n" + "".join(f"v{number},{number}\n" for number in range(count))
    write(tmp_path, {"large.csv": large, "small.csv": "a,b\n-1,only\n"})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        aligned = aligned_csv.read_aligned(spark, str(tmp_path), ["a", "b"], {"a": "bigint"})
        assert aligned.rdd.getNumPartitions() > 4
        assert aligned.count() == count + 1
        assert aligned.where("b <> concat('v', a)").count() == 1
        assert aligned.agg(F.sum("a")).first()[0] == count * (count - 1) // 2 - 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_values_over_several_lines(spark, tmp_path):
    write(tmp_path, {"a.csv": 'id,note\n1,"two\nlines"\n2,plain\n', "b.csv": "note,id\nx,3\n"})
    aligned = aligned_csv.read_aligned(spark, str(tmp_path), ["id", "note"], {"id": "int"}, multi_line=True)
    assert sorted(rows_of(aligned)) == [(1, "two\nlines", False), (2, "plain", False), (3, "x", False)]


@pytest.mark.parametrize("multi_line", [False, True])
def test_blank_first_line_byte_order_mark_and_windows_line_ends(spark, tmp_path, multi_line):
    write(tmp_path, {"blank.csv": "\n\nid,note\n1,x\n"})
    (tmp_path / "mark.csv").write_bytes(b"\xef\xbb\xbfid,note\r\n2,y\r\n")
    aligned = aligned_csv.read_aligned(spark, str(tmp_path), ["id", "note"], {"id": "int"}, multi_line=multi_line)
    assert sorted(rows_of(aligned)) == [(1, "x", False), (2, "y", False)]


def test_hundred_columns(spark, tmp_path):
    names = [f"col{number}" for number in range(100)]
    write(tmp_path, {
        "wide.csv": ",".join(names) + "\n" + ",".join(str(number) for number in range(100)) + "\n",
        "back.csv": ",".join(reversed(names)) + "\n" + ",".join(str(number) for number in range(100)) + "\n",
    })
    found = aligned_csv.read_aligned(spark, str(tmp_path), names, {name: "int" for name in names})
    assert sorted(rows_of(found)) == [(*range(100), False), (*reversed(range(100)), False)]


def test_data_lines_are_scanned_and_parsed_once(spark, folder, headers, plan):
    text = plan(aligned_csv.align(aligned_csv.read_lines(spark, folder), headers, COLUMNS))
    scans = [line for line in text.splitlines() if line.startswith("Location:") and "csv" in line and "csv-heads" not in line]
    assert len(scans) == 1
    parsed = [line for line in text.splitlines() if "from_csv(" in line]
    assert len(parsed) == 2 and all(line.count("from_csv(") == 1 for line in parsed)  # the header's names, and the line


def test_torn_records_never_come_out_in_halves(spark, tmp_path):
    folder = write(tmp_path, {"a.csv": 'id,note\n1,"two\nlines"\n2,plain\n', "b.csv": "note,id\nx,3\n"})
    headers = aligned_csv.file_headers(aligned_csv.read_lines(spark, folder))
    assert [row.file.rsplit("/", 1)[1] for row in aligned_csv.torn_files(headers).collect()] == ["a.csv"]
    assert rows_of(aligned_csv.align(aligned_csv.read_lines(spark, folder), headers, ["id", "note"], {"id": "int"})) == [(3, "x", False)]
    aligned = aligned_csv.read_aligned(spark, folder, ["id", "note"], {"id": "int"})
    assert sorted(rows_of(aligned)) == [(1, "two\nlines", False), (2, "plain", False), (3, "x", False)]


def test_blank_blocks_before_the_header(spark, tmp_path):
    write(tmp_path, {"late.csv": "\n" * 5000 + "id,note\n1,x\n2,y\n"})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert sorted(rows_of(aligned_csv.read_aligned(spark, str(tmp_path), ["id", "note"], {"id": "int"}))) == [(1, "x", False), (2, "y", False)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_too_many_names_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(aligned_csv, "MAX_COLUMNS", 3)
    write(tmp_path, {"a.csv": "a,b\n1,2\n", "b.csv": "c,d\n1,2\n"})
    with pytest.raises(ValueError):
        aligned_csv.read_aligned(spark, str(tmp_path))


def test_lake_partitions(spark, folder, tmp_path):
    aligned = aligned_csv.read_aligned(spark, folder, ["id"], TYPES).withColumn("on", F.lit("2024-02-03"))
    aligned_csv.write_lake(aligned, str(tmp_path / "named"), "one", "on")
    assert (tmp_path / "named/year=2024/month=2/day=3/load=one").is_dir()
    aligned_csv.write_lake(aligned, str(tmp_path / "modified"), "one")
    lake = spark.read.parquet(str(tmp_path / "modified"))
    assert lake.where("make_date(year, month, day) = to_date(modified)").count() == len(ROWS)


def test_no_files(spark, tmp_path):
    write(tmp_path, {"e.csv": ""})
    assert aligned_csv.read_aligned(spark, str(tmp_path), ["id"]).count() == 0


def test_loads_of_one_day_stay_and_a_repeated_one_replaces_itself(spark, tmp_path):
    lake = str(tmp_path / "lake")
    load = lambda rows: spark.createDataFrame(rows, "id int, on string")
    aligned_csv.write_lake(load([(1, "2024-01-02"), (2, "2024-01-02")]), lake, "one", "on")
    aligned_csv.write_lake(load([(3, "2024-01-02"), (4, "2024-01-03")]), lake, "two", "on")
    assert spark.read.parquet(lake).count() == 4
    aligned_csv.write_lake(load([(3, "2024-01-02")]), lake, "two", "on")
    assert sorted(row.id for row in spark.read.parquet(lake).collect()) == [1, 2, 3]
