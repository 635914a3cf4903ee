"""A reproducible shuffle into shards by a Feistel permutation of global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.session import settle

PRIME = 2**31 - 1
ROUNDS = 6
PREFIX = 3  # hexadecimal digits: 4096 ranges of the hash
BLOCK = 4096
WALK = 64


def shard_rows(rows: DataFrame, shards: int = 16, seed: int = 1) -> DataFrame:
    """All rows with ``global_row``, ``shard`` and ``slot``; shard sizes differ by one at most.

    Rows are numbered in the order of a hash of all their columns. A Feistel network over two residue classes permutes the
    numbers, and results outside 0..n-1 walk on along their cycle. The permuted number p gives shard ``p % shards`` and
    slot ``p // shards``, so slots of a shard are gapless from 0 and ``place`` computes both from a row number alone. The
    result depends on the rows, ``shards`` and ``seed``, not on files or partitions.

    Equal rows are counted before the shuffle and take neighbouring numbers, so a row that a third of the table repeats is
    one row on the way. NULLs are values like others. An empty table gives an empty result. Input columns called
    global_row, shard or slot are replaced. Columns of map type can't be grouped and aren't supported.
    """
    columns = [c for c in rows.columns if c not in ("global_row", "shard", "slot")]
    named = [F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]
    values = [f"c{i}" for i in range(len(columns))]
    distinct = rows.select(*named).groupBy(*values).agg(F.count("*").alias("copies"))
    text = F.concat_ws("|", *[F.coalesce(F.col(v).cast("string"), F.lit("-")) for v in values])
    distinct = settle(distinct.withColumn("hash", F.md5(text)).withColumn("range", F.substring("hash", 1, PREFIX)), "rows")

    # At most 4096 rows, whatever the input: one task may sum them up, and they may be broadcast.
    sizes = distinct.groupBy("range").agg(F.sum("copies").alias("size"))
    before = F.sum("size").over(Window.orderBy("range")) - F.col("size")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    starts = F.broadcast(sizes.select("range", before.alias("before")))

    order = Window.partitionBy("range").orderBy("hash", *values)
    earlier = F.col("before") + F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / BLOCK))).alias("block")
    numbered = (
        distinct.join(starts, "range")
        .withColumn("start", earlier)
        .select(*values, "start", "copies", block)
        .select(*values, "start", F.explode(F.sequence(F.col("block") * BLOCK, F.least(F.col("copies"), (F.col("block") + 1) * BLOCK) - 1)).alias("copy"))
        .select(*[F.col(v).alias(c) for v, c in zip(values, columns, strict=True)], (F.col("start") + F.col("copy")).alias("global_row"))
    )
    shard, slot = place(F.col("global_row"), total, shards, seed)
    return numbered.withColumns({"shard": shard, "slot": slot})


def place(row: Column, total: int, shards: int, seed: int = 1) -> tuple[Column, Column]:
    """Shard and slot of a row number below ``total``, without looking at any other row."""
    moved = permuted(row, total, seed)
    return (moved % shards).cast("int"), F.floor(moved / F.lit(shards).cast("decimal(20,0)")).cast("bigint")


def halves(total: int) -> tuple[int, int]:
    """Two moduli whose product is at least ``total`` and exceeds it by less than the first."""
    left = max(1, math.isqrt(max(0, total - 1)) + 1)
    return left, max(1, -(-total // left))


def round_keys(total: int, seed: int) -> list[tuple[int, int]]:
    """A number for each round, and the modulus of the half that the round changes."""
    left, right = halves(total)
    keys, state = [], seed % PRIME
    for i in range(ROUNDS):
        state = (state * 48271 + 11 * i + 7) % PRIME
        keys.append((state, left if i % 2 == 0 else right))
    return keys


def permuted(row: Column, total: int, seed: int) -> Column:
    """The Feistel network with cycle walking.

    Fewer numbers lie outside than ``halves(total)[0]``, and a walk meets each once at most. Up to 4096 rows the walk is
    therefore long enough for certain; with more, a step stays outside with a chance of 1/64 at most, and a walk that hasn't
    come back after 64 steps would stop the job instead of giving a wrong place.
    """
    left, right = halves(total)
    keys = F.array(*[F.struct(F.lit(k).cast("bigint").alias("key"), F.lit(m).cast("bigint").alias("modulus")) for k, m in round_keys(total, seed)])

    def network(x: Column) -> Column:
        start = F.struct(F.floor(x / F.lit(right).cast("decimal(20,0)")).cast("bigint").alias("l"), (x % right).cast("bigint").alias("r"))
        return F.aggregate(keys, start, _round, lambda s: s["l"] * right + s["r"])

    steps = min(left * right - total, WALK)
    moved = network(row)
    if steps > 0:
        moved = F.aggregate(F.array_repeat(F.lit(0), steps), moved, lambda x, _: F.when(x < total, x).otherwise(network(x)))
        moved = F.when(moved < total, moved).otherwise(F.raise_error(F.lit("the walk left the row numbers")).cast("bigint"))
    return moved


def _round(state: Column, key: Column) -> Column:
    """The halves change places after one has been shifted by a function of the other."""
    mixed = (state["r"] % PRIME * 16807 + key["key"]) % PRIME
    squared = (mixed * mixed) % PRIME
    shifted = (state["l"] + (squared * 39373 + mixed) % PRIME) % key["modulus"]
    return F.struct(state["r"].alias("l"), shifted.alias("r"))
