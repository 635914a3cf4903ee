"""Parquet tables with a chosen physical layout."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palisade.operators.latest import ARRIVAL_ORDER, latest_per_key
from palisade.operators.metrics import observed
from palisade.session import scratch, settle
from palisade.sinks import evolution, folders

TURN = "_turn"
# Where a row lies: in the table or the delivery, in which file, at which place.
SIDE, FILE, ROW = "_side", "_file", "_row"


def laid_out(df: DataFrame, cluster_by=(), sort_by=()) -> DataFrame:
    """Rows with equal ``cluster_by`` together, sorted inside each partition.

    The rebalance is sized by AQE: small groups share a partition and a hot one is split over several.
    """
    spread = df.hint("rebalance", *[F.col(name) for name in cluster_by])
    return spread.sortWithinPartitions(*sort_by) if sort_by else spread


def write_table(
    df: DataFrame,
    path: str,
    partition_by=(),
    cluster_by=(),
    sort_by=(),
    whole: bool = False,
    stale: Callable[[dict[str, str]], bool] = lambda values: False,
    table: str | None = None,
    most_rows: int | None = None,
) -> int:
    """Replace the partitions that ``df`` touches, and return the number of rows written. A re-run is harmless.

    With ``whole``, or without partitions, the table is replaced altogether. ``stale`` sees the values (as text) of every
    partition that is there already and not touched; those it names are removed. Rows are clustered by partition and
    ``cluster_by`` together. ``table`` is a catalog name to keep up to date. The count is taken above the exchange, in
    the stage that writes, so that map tasks which run again after a lost executor don't count twice. With ``most_rows`` a
    partition of more rows is dealt over several tasks and files, however few or well compressed the blocks are that it
    comes in; ``df`` is settled and counted for that.
    """
    spark = df.sparkSession
    if partition_by and most_rows:
        with scratch(spark):
            dealt = _dealt(settle(df, "dealt"), partition_by, most_rows)
            return _write(dealt, path, partition_by, [*cluster_by, TURN], sort_by, whole, stale, table)
    return _write(df, path, partition_by, cluster_by, sort_by, whole, stale, table)


def _dealt(rows: DataFrame, partition_by, most_rows: int) -> DataFrame:
    """Adds ``TURN``, which gives the rows of a large partition as many values as it needs tasks; 0 elsewhere. ``rows`` are
    settled, so that the numbering comes out the same when a task runs again."""
    turns = F.ceil(F.count("*") / F.lit(most_rows)).alias("_turns")
    large = rows.groupBy(*partition_by).agg(turns).where("_turns > 1").withColumnsRenamed({name: f"_{name}" for name in partition_by})
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in partition_by])
    numbered = rows.withColumn(TURN, F.monotonically_increasing_id())
    # At most one for every ``most_rows`` rows.
    turn = F.coalesce(F.pmod(TURN, "_turns"), F.lit(0))
    return numbered.join(F.broadcast(large), same, "left").select(*rows.columns, turn.alias(TURN))


def _write(df: DataFrame, path: str, partition_by, cluster_by, sort_by, whole: bool, stale, table: str | None) -> int:
    spark = df.sparkSession
    order = [*partition_by, *[name for name in sort_by if name not in partition_by]]
    spread = [*partition_by, *[name for name in cluster_by if name not in partition_by]]
    counted, metrics = observed(laid_out(df, spread, order).drop(TURN), "written", rows=F.count(F.lit(1)))
    before = folders.partitions(spark, path, partition_by) if partition_by and not whole else []
    before = [part for part in before if stale(part.values)]
    writer = counted.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "static" if whole else "dynamic").partitionBy(*partition_by)
    writer.parquet(path)
    if before:
        now = {part.path: part.files for part in folders.partitions(spark, path, partition_by)}
        for part in before:
            # A replaced partition has none of its files left.
            if part.files & now.get(part.path, frozenset()):
                folders.delete(spark, part.path)
    if table:
        register_table(spark, table, path, partition_by)
    return metrics.get["rows"]


def merge_table(
    new: DataFrame, path: str, partition_by, keys=("event_id",), order=ARRIVAL_ORDER, cluster_by=(), sort_by=(), table: str | None = None,
    schema_change: bool = False,
) -> list[dict[str, str]]:
    """Bring rows into a partitioned table that has one row per key, the greatest by ``order``.

    Reads the partitions that hold a key of ``new`` or get one, unites, keeps the latest and replaces these partitions. A
    delivery that moves its key to another partition takes it out of the old one, which goes if it was the last. The
    search for keys reads key and partition columns of the table only, and the whole rows are shuffled once, to be written.
    Files that are read go when all new ones are written. Doing it again changes nothing. Returns the partitions concerned. With ``schema_change`` new columns and wider types of ``new`` become the table's, in the catalog
    too; types that can't be united are refused before anything is written.
    """
    spark = new.sparkSession
    there = folders.exists(spark, path)
    if schema_change:
        new = evolution.evolve(new, path, partition_by)
    with scratch(spark):
        arrived = settle(latest_per_key(new, keys, order), "arrived")
        if not there:
            touched = _values(arrived, partition_by)
            merged = arrived
        else:
            held = evolution.read_known(spark, path)
            known = held.join(arrived.select(*keys), list(keys), "left_semi").select(*partition_by)
            touched = _values(arrived.select(*partition_by).unionAll(known.select(*partition_by)), partition_by)
            chosen = spark.createDataFrame(touched, held.select(*partition_by).schema) if touched else None
            # Some dates: the list reaches the scan as a filter on its folders.
            merged = held.limit(0).unionByName(arrived, allowMissingColumns=True)
            if touched:
                kept = _located(held, 0).join(F.broadcast(chosen), list(partition_by), "left_semi")
                merged = _latest_of_both(kept, _located(arrived, 1), keys, order)
        names = {tuple(str(row[name]) for name in partition_by) for row in touched}
        write_table(
            merged, path, partition_by, cluster_by, sort_by, stale=lambda values: tuple(values[n] for n in partition_by) in names, table=table
        )
    return [{name: str(row[name]) for name in partition_by} for row in touched]


def _located(rows: DataFrame, side: int) -> DataFrame:
    """Rows of files with their places."""
    return rows.withColumns({SIDE: F.lit(side), FILE: F.xxhash64("_metadata.file_path"), ROW: F.col("_metadata.row_index")})


def _latest_of_both(held: DataFrame, arrived: DataFrame, keys, order) -> DataFrame:
    """``latest_per_key`` over the located rows of both, but only keys, order and places are shuffled and sorted for it.

    The rows that lose are found by that, and taken out of the whole rows where these lie: a few are broadcast, and a side
    that loses none isn't joined. Of rows equal by ``order`` the one held stays, so a delivery that comes again loses as a
    whole and what is held isn't moved. Inside ``scratch``.
    """
    spots = held.unionByName(arrived, allowMissingColumns=True).select(*keys, *[n for n in order if n not in keys], SIDE, FILE, ROW)
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(name).desc_nulls_last() for name in order], SIDE)
    lost = settle(spots.withColumn("_place", F.row_number().over(newest_first)).where("_place > 1").select(SIDE, FILE, ROW), "lost")
    losing = {row[SIDE] for row in lost.select(SIDE).distinct().collect()}
    kept = [
        rows.join(lost.where(F.col(SIDE) == side).select(FILE, ROW), [FILE, ROW], "left_anti") if side in losing else rows
        for side, rows in enumerate((held, arrived))
    ]
    return kept[0].unionByName(kept[1], allowMissingColumns=True).drop(SIDE, FILE, ROW)


def replace_partitions(
    arrived: DataFrame, path: str, touched: list, partition_by, keys, order, cluster_by=(), sort_by=(), table: str | None = None
) -> tuple[list[dict[str, str]], int]:
    """Unite ``arrived``, settled and with one row per key, with what the touched partitions hold, keep the latest of each key,
    and replace these partitions.

    Only their folders are listed and read. One that becomes empty goes. Returns the partitions, and how many files were
    read. Inside ``scratch``.
    """
    spark = arrived.sparkSession
    named = [{name: None if row[name] is None else str(row[name]) for name in partition_by} for row in touched]
    before = [part for part in folders.some_partitions(spark, path, named) if part.files]
    merged = arrived
    if before:
        held = _located(evolution.read_known(spark, path, *[part.path for part in before]), 0)
        types = {field.name: field.dataType for field in arrived.schema.fields}
        held = held.withColumns({name: F.col(name).cast(types[name]) for name in partition_by})
        merged = _latest_of_both(held, _located(arrived, 1), keys, order)
    spread = [*partition_by, *[name for name in cluster_by if name not in partition_by]]
    laid = laid_out(merged, spread, [*partition_by, *[name for name in sort_by if name not in partition_by]])
    writer = laid.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
    after = {part.path: part.files for part in folders.some_partitions(spark, path, named)}
    for part in before:
        # A replaced partition has none of its files left.
        if part.files & after.get(part.path, frozenset()):
            folders.delete(spark, part.path)
    if table:
        register_table(spark, table, path, partition_by)
    return named, sum(len(part.files) for part in before)


def _values(rows: DataFrame, partition_by) -> list:
    """The distinct partition values: as many as the table has dates."""
    return rows.select(*partition_by).distinct().collect()


def write_quarantine(rejected: DataFrame, path: str, batch: str) -> None:
    """Keep rejected rows per batch. A repeated batch replaces itself, and an empty one writes no file."""
    (
        rejected.withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("batch")
        .parquet(path)
    )


def register_table(spark: SparkSession, name: str, path: str, partition_by=()) -> DataFrame:
    """Make Parquet files queryable under a catalog name without copying them, with the partitions they have now.

    A name that already stands for another folder is refused. A table that keeps its schema has that in the catalog;
    ``partition_by`` are its partition columns.
    """
    if spark.catalog.tableExists(name):
        described = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        if folders.qualified(spark, described["Location"]) != folders.qualified(spark, path):
            raise ValueError(f"{name} stands for {described['Location']}, not for {path}")
        evolution.update_catalog(spark, name, path, partition_by)
    elif (schema := evolution.known_schema(spark, path)) is not None:
        evolution.create_table(spark, name, path, schema, partition_by)
    else:
        spark.catalog.createTable(name, path=path, source="parquet")
    if spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = '# Partition Information'").count():
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def write_bucketed(df: DataFrame, name: str, keys, buckets: int) -> None:
    """A catalog table whose rows lie in ``buckets`` files by hash of ``keys``, sorted by them.

    Tables with equal keys and number of buckets are joined and grouped by these keys without an exchange. A table of that
    name is replaced.
    """
    laid = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    laid.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(name)


def layout_report(table: DataFrame, partition_by, cluster_by, sort_by) -> DataFrame:
    """For each file of a table: rows, its partition, how many files hold each of its cluster keys at most, and whether its
    rows are in order."""
    spot = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    named = table.select("*", spot["file_path"].alias("file"), spot["row_index"].alias("place"))
    group = [*partition_by, *[name for name in cluster_by if name not in partition_by]]
    spread = named.groupBy(*group).agg(F.count_distinct("file").alias("files_per_key"))
    keyed = named.select(*partition_by, "file", *[name for name in group if name not in partition_by]).distinct()
    same = [F.col(f"k.{name}").eqNullSafe(F.col(f"s.{name}")) for name in group]
    most = keyed.alias("k").join(spread.alias("s"), same).groupBy("k.file").agg(F.max("files_per_key").alias("most_files_per_key"))
    in_order = F.array_sort(F.collect_list(F.struct(*sort_by, "place")))
    ordered = named.groupBy(*partition_by, "file").agg(
        F.count("*").alias("rows"), F.transform(in_order, lambda row: row["place"]).alias("places")
    )
    sorted_places = ordered.withColumn("in_order", F.col("places") == F.array_sort("places")).drop("places")
    return sorted_places.join(most, "file")
