"""Connected components of links held as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.session import settle


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) for every node of the links ``a``, ``b``.

    Large and small stars in turn: each node's neighbours move to the smallest of them. All steps are minima by key and
    joins, so a node with very many links is folded before the shuffle and split in the join; nothing reaches the driver
    but a count and a checksum of each round. Rounds are written to the shared folder. Links with a NULL end are left out;
    without links the result is empty.
    """
    edges = settle(_oriented(links), "links")
    state = _state(edges)
    while True:
        edges = settle(_small_star(_large_star(edges)), "links")
        state, before = _state(edges), state
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _oriented(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a > b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(smallest.select("a", F.col("m").alias("b"))).filter("a > b").distinct()
