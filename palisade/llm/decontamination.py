"""Benchmark decontamination by size-partitioned MinHash containment search. DataFrame functions only.

The share of a short item's shingles that a long document holds is estimated from the item's side: a sketch keeps the
smallest hashes of the item, and the share of the sketch found in the document estimates the containment, however long
the document is.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.session import settle

# Chance that an item contained just at the threshold is missed by its sketch.
MISS = 1e-6


def words(text: Column) -> Column:
    """Letters and digits in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(text: Column, size: int = 5, lengths: Iterable[int] = ()) -> Column:
    """Distinct 64-bit hashes of the runs of ``size`` words, and of those of each of the ``lengths``.

    A text with fewer words has its whole sequence as only shingle of ``size``; one without words, or NULL, has none.
    """
    none = F.array().cast("array<bigint>")

    def runs(w: Column, length: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - length + 1), lambda i: F.xxhash64(F.slice(w, i, length)))

    def hashes(w: Column) -> Column:
        whole = F.when(F.size(w) == 0, none).when(F.size(w) < size, F.array(F.xxhash64(w))).otherwise(runs(w, size))
        return F.array_distinct(F.concat(whole, *[F.when(F.size(w) >= n, runs(w, n)).otherwise(none) for n in lengths]))

    return F.transform(F.array(words(text)), hashes)[0]


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    size: int = 5,
    share: float = 0.8,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    short_runs: bool = False,
) -> DataFrame:
    """Pairs of a document and an item of which it holds at least ``share`` of the shingles.

    Columns: ``key``, ``item_key``, n_item_shingles, n_shared, containment. Items are partitioned by the power of two of
    their number of shingles; larger ones get larger sketches, and the number of hits that makes a candidate follows the
    sketch: all items of up to 16 shingles are looked up whole, others are missed with a chance of ``MISS`` at most.
    Candidates are confirmed on the whole sets of shingles.

    An item of fewer than ``size`` words has one shingle, its whole sequence. With ``short_runs`` it is found in every text
    that holds its words in a row; without, as in the SQL, only in texts that consist of nothing else.

    Rows without key, and texts without words, are in no pair. Rows with equal key stand for one document, and so do items:
    the pair comes once, with the text of either that gives the highest containment. Empty tables give an empty result.
    """
    sets = (
        items.filter(F.col(item_key).isNotNull())
        .select(
            F.col(item_key).alias("item"),
            F.array_sort(shingles(F.col(item_text), size)).alias("set"),
            F.least(F.size(words(F.col(item_text))), F.lit(size)).alias("length"),
        )
        .filter(F.size("set") > 0)
        .dropDuplicates(["item", "set"])
        .withColumn("wording", F.monotonically_increasing_id())
        .withColumn("n", F.size("set"))
        .withColumn("partition", F.floor(F.log2("n")).cast("int"))
        .withColumn("m", F.least("n", 4 * (F.col("partition") + 1)))
    )
    sets = settle(sets, "items")
    # At most size - 1 numbers.
    lengths = sorted(row["length"] for row in sets.filter(F.col("length") < size).select("length").distinct().collect()) if short_runs else []
    margin = F.sqrt(F.lit(math.log(1 / MISS)) / (2 * F.col("m")))
    hits = F.when(F.col("m") == F.col("n"), F.ceil(F.col("n") * F.lit(share) - 1e-9)).otherwise(F.floor(F.col("m") * (F.lit(share) - margin)) + 1)
    index = settle(sets.select("wording", F.greatest(hits, F.lit(1)).alias("hits"), F.explode(F.slice("set", F.lit(1), F.col("m"))).alias("hash")), "sketches")

    texts = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.col(text).alias("text"))
    spread = texts.select("doc", F.explode(shingles(F.col("text"), size, lengths)).alias("hash"))
    # Spark broadcasts the index while its files are below the session's threshold and shuffles beyond.
    found = spread.join(index, "hash").groupBy("doc", "wording").agg(F.count_distinct("hash").alias("held"), F.first("hits").alias("hits"))
    candidates = settle(found.filter(F.col("held") >= F.col("hits")).select("doc", "wording"), "candidates")

    whole = texts.join(candidates.select("doc").distinct(), "doc", "left_semi").select("doc", shingles(F.col("text"), size, lengths).alias("held"))
    shared = F.size(F.array_intersect("held", "set"))
    texts_of_items = sets.select("item", "wording", "set", F.col("n").cast("bigint").alias("n_item_shingles"))
    pairs = whole.join(candidates, "doc").join(texts_of_items, "wording").select("doc", "item", "n_item_shingles", shared.cast("bigint").alias("n_shared"))
    pairs = pairs.withColumn("containment", F.col("n_shared") / F.col("n_item_shingles")).filter(F.col("containment") >= share)
    best = F.max(F.struct("containment", "n_item_shingles", "n_shared")).alias("best")
    return (
        pairs.groupBy("doc", "item")
        .agg(best)
        .select(F.col("doc").alias(key), F.col("item").alias(item_key), "best.n_item_shingles", "best.n_shared", "best.containment")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that hold no item, with all columns; rows without key stay."""
    pairs = contaminated(docs, items, key=key, text=text, **options)
    return docs.join(pairs.select(F.col(key)).distinct(), key, "left_anti").select(*docs.columns)
