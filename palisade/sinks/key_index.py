"""An index from keys to the partitions of a table that may hold them, kept by every merge.

The index is a Parquet table with one folder for each bucket of keys. A row says that a partition may hold a key of some
64-bit hash; rows are only added, and before the table itself changes. So the index never misses a row of the table, also
after a failure at any point, and an entry that is out of date, or a hash that two keys share, costs the reading of one more
partition. A merge opens the buckets of the keys that it brings and the partitions these point to, however long the history.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.operators.latest import ARRIVAL_ORDER, latest_per_key
from palisade.session import scratch, settle
from palisade.sinks import folders
from palisade.sinks.evolution import read_known
from palisade.sinks.compaction import compact
from palisade.sinks.tables import replace_partitions

# Such that a bucket holds some 100 MB of entries of 10 to 20 bytes when the history is long.
BUCKETS = 64
# So few keys go to the scan one by one, where the Bloom filters of the index skip row groups without them.
FEW_KEYS = 64
# A bucket with more files than this is compacted by the merge that finds it.
BUCKET_FILES = 16

BUCKET, HASH = "bucket", "key_hash"


class Merge(NamedTuple):
    """What a merge touched: partitions, files of the index that it opened, files of the table that it opened."""

    partitions: list[dict[str, str]]
    index_files: int
    table_files: int


def _hashed(rows: DataFrame, keys, buckets: int) -> DataFrame:
    number = F.xxhash64(*[F.col(name) for name in keys])
    return rows.withColumns({HASH: number, BUCKET: F.pmod(number, F.lit(buckets)).cast("int")})


def _bucket_count(spark: SparkSession, index: str) -> int | None:
    """The number of buckets that the index was made with, None if there is no whole index."""
    found = [name for name in folders.names(spark, index) if name.startswith("buckets=") and folders.exists(spark, f"{index}/{name}/_SUCCESS")]
    return int(found[0].partition("=")[2]) if found else None


def add_entries(entries: DataFrame, index: str, buckets: int, partition_by, expected: int) -> None:
    """Add rows of ``HASH``, ``BUCKET`` and partition values; one file for each bucket, sorted by hash. Bloom filters are sized
    for ``expected`` rows in all."""
    rows = entries.select(BUCKET, HASH, *partition_by).distinct().repartition(BUCKET).sortWithinPartitions(BUCKET, HASH)
    writer = rows.write.mode("append").option("compression", "snappy").partitionBy(BUCKET)
    writer.options(**_bloom(expected, buckets)).parquet(f"{index}/buckets={buckets}")


def _bloom(expected: int, buckets: int) -> dict[str, str]:
    ndv = max(64, 2 * expected // buckets)
    return {f"parquet.bloom.filter.enabled#{HASH}": "true", f"parquet.bloom.filter.expected.ndv#{HASH}": str(ndv)}


def build_index(spark: SparkSession, path: str, index: str, partition_by, keys=("event_id",), buckets: int = BUCKETS) -> None:
    """Index a table that has none yet: one pass over its keys."""
    folders.delete(spark, index)
    held = read_known(spark, path)
    add_entries(_hashed(held, keys, buckets), index, buckets, partition_by, held.count())


def merge_by_index(
    new: DataFrame,
    path: str,
    index: str,
    partition_by,
    keys=("event_id",),
    order=ARRIVAL_ORDER,
    cluster_by=(),
    sort_by=(),
    table: str | None = None,
    buckets: int = BUCKETS,
) -> Merge:
    """``merge_table`` with an index: the same rows, but neither all keys of the table are read nor all its folders listed.

    A table without an index is indexed first. What is listed and opened follows the delivery: the buckets of its keys, of
    which there are as many as keys at most, and the partitions that its keys have or had. Doing it again changes nothing.
    """
    spark = new.sparkSession
    with scratch(spark):
        made = _bucket_count(spark, index)
        if made is None and folders.exists(spark, path):
            build_index(spark, path, index, partition_by, keys, buckets)
        buckets = made or buckets
        arrived = settle(_hashed(latest_per_key(new, keys, order), keys, buckets), "arrived")
        entries = arrived.select(BUCKET, HASH, *partition_by)
        wanted = sorted(row[BUCKET] for row in entries.select(BUCKET).distinct().collect())  # as many as buckets at most
        if not wanted:
            return Merge([], 0, 0)
        held, opened = _entries_of(spark, f"{index}/buckets={buckets}", wanted, entries)
        if held is not None:
            known = settle(held.join(entries.select(BUCKET, HASH), [BUCKET, HASH], "left_semi"), "known")
            same = [F.col(f"n.{name}").eqNullSafe(F.col(f"k.{name}")) for name in (BUCKET, HASH, *partition_by)]
            fresh = entries.alias("n").join(known.alias("k"), reduce(lambda a, b: a & b, same), "left_anti")
            places = entries.select(*partition_by).unionAll(known.select(*partition_by))
        else:
            fresh, places = entries, entries.select(*partition_by)
        touched = places.distinct().collect()  # as many as the delivery's keys have dates
        expected = arrived.count()
        add_entries(fresh, index, buckets, partition_by, expected)
        written, files = replace_partitions(arrived.drop(BUCKET, HASH), path, touched, partition_by, keys, order, cluster_by, sort_by, table)
        full = [b for b in wanted if opened.get(b, 0) >= BUCKET_FILES]
        if full:
            bloom = _bloom(BUCKET_FILES * expected, buckets)
            compact(spark, f"{index}/buckets={buckets}", [BUCKET], only=[{BUCKET: str(b)} for b in full], sort_by=[HASH], options=bloom)
    return Merge(written, sum(opened.values()), files)


def _entries_of(spark: SparkSession, root: str, wanted: list[int], entries: DataFrame) -> tuple[DataFrame | None, dict[int, int]]:
    """The index rows of the wanted buckets, and the number of files of each."""
    parts = folders.some_partitions(spark, root, [{BUCKET: str(b)} for b in wanted])
    opened = {int(part.values[BUCKET]): len(part.files) for part in parts if part.files}
    if not opened:
        return None, {}
    held = spark.read.option("basePath", root).parquet(*[f"{root}/{BUCKET}={b}" for b in sorted(opened)])
    few = entries.select(HASH).distinct().limit(FEW_KEYS + 1).collect()
    if len(few) <= FEW_KEYS:
        held = held.where(_any_of(HASH, [row[HASH] for row in few]))
    return held, opened


def _any_of(name: str, values: list[int]) -> Column:
    """Equalities rather than a list: they reach the Bloom filters, also when there are more than ten."""
    return reduce(or_, [F.col(name) == value for value in values])
