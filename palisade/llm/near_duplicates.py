"""Near duplicates by min-max hashing, confirmed on whole shingle sets.

Each hash function gives two values of a set, its smallest and its largest hash: 64 evaluations for a signature of 128.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.arrays import mix, read_words, shingle_sets
from palisade.llm.components import components
from palisade.session import settle

FUNCTIONS = 64
VALUES = 2 * FUNCTIONS
# Chances that a link at the threshold shares no band, and that its sketches differ in too many bits; for both, signature
# values count as independent.
BANDS_MISS = 1e-7
SKETCH_MISS = 1e-8

SIGNED = "id bigint, n_shingles bigint, print binary, copy bigint, bands array<bigint>, low bigint, high bigint"


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: ``key``, n_shingles, component_id (smallest key reachable over links) and kept.

    Words are runs other than space and 0x09 to 0x0D with A-Z in lower case. Two documents are linked if 100 times the
    intersection of their sets of ``shingle``-word shingles is at least ``percent`` times the union. A document with fewer
    words has its whole sequence as only shingle; one without words is linked with nothing.

    1. Documents with equal sets form a class; only its smallest key goes on.
    2. Classes meet in bands of min-max signatures, as wide as ``BANDS_MISS`` allows: at 0.8 a link escapes all 32 bands with
       a probability of 5e-8. In each bucket every class is compared with the smallest key only, and components are formed.
    3. Classes of buckets that still hold several components are compared across components wherever they share one of
       their rarest shingles, as all linked sets do, so that no link between components is lost. The smaller set of a pair
       needs about half as many of them as the larger. Of the classes that share such a shingle, the largest component is
       never paired with itself. Texts made from one template, each with words of its own, have their own shingles first;
       they meet only if these are few enough for a link.

    Pairs whose sketches differ in more bits than a link's do, but for a chance of ``SKETCH_MISS``, are left out before. At
    0.8 a link is missed with a chance of 6e-8 in all. Bands and sketch follow ``percent``; below 12 single values are too few
    for ``BANDS_MISS``.

    Every link is confirmed on the texts' whole sets. NULL keys take part in no link: component_id is NULL, kept is true.
    Rows with equal key and text share a class, so both are kept or both are not. Rows with equal key and different texts are
    linked text by text, each with its own size; classes whose smallest key is the same are one node. An empty table gives
    an empty result.
    """
    signed = settle(_signed(docs, shingle, percent, key, text), "signatures")
    classes = (
        signed.filter("n_shingles > 0 and id is not null")
        .groupBy("print", "n_shingles")
        .agg(F.min("id").alias("node"), *[F.first(c).alias(c) for c in ("copy", "bands", "low", "high")])
    )
    classes = settle(classes, "classes")
    members = classes.select("node", "copy", F.col("n_shingles").alias("n"), "low", "high", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("size")).filter("size > 1")
    members = settle(members.join(buckets.select("bucket", "leader"), "bucket"), "buckets")

    leaders = members.filter("node = leader").select(
        "bucket", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "low", "high")]
    )
    starred = members.filter("node <> leader").join(leaders, "bucket").filter(_may_link(percent))
    first = settle(starred.select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct(), "pairs")

    texts = settle(_texts(docs, members, key, text), "texts")
    links = settle(_confirmed(first, texts, shingle, percent), "links")
    parts = settle(components(links), "components")

    placed = members.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
    nodes = _split(placed).dropDuplicates(["node", "copy"]).select("node", "copy", "n", "low", "high", "part")
    nodes = settle(nodes, "nodes")
    rare = settle(_split(_rare_shingles(texts, nodes, shingle, percent)), "rare")
    across = _across(rare, percent)
    second = across.select(F.greatest("node", "node_b").alias("a"), F.least("node", "node_b").alias("b")).distinct()
    second = settle(second.join(first, ["a", "b"], "left_anti"), "pairs")
    late = _confirmed(second, texts, shingle, percent)
    for end in ("a", "b"):
        named = parts.select(F.col("node").alias(end), F.col("component").alias("part"))
        late = late.join(named, end, "left").withColumn(end, F.coalesce("part", end)).drop("part")
    merged = components(late)

    roots = (
        classes.select("print", "n_shingles", "node")
        .join(parts, "node", "left")
        .withColumn("part", F.coalesce("component", "node"))
        .join(merged.select(F.col("node").alias("part"), F.col("component").alias("root")), "part", "left")
        .select("print", "n_shingles", F.coalesce("root", "part").alias("root"))
    )
    found = signed.select("id", "n_shingles", "print").join(roots, ["print", "n_shingles"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return found.select(
        F.col("id").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that ``near_duplicates`` doesn't keep; all columns, repeated rows stay."""
    found = near_duplicates(docs, shingle, percent, key, text)
    gone = found.filter("not kept").select(F.col(key)).distinct()
    return docs.join(gone, key, "left_anti")


def _band_rows(percent: int) -> int:
    """The most signature values in a band, of four, two and one, that keep the chance of a missed link at ``BANDS_MISS``."""
    fitting = [rows for rows in (4, 2) if (1 - (percent / 100) ** rows) ** (VALUES // rows) <= BANDS_MISS]
    return max(fitting, default=1)


def _sketch_differences(percent: int) -> int:
    """The fewest bits of which a link's sketches differ in more with a chance of ``SKETCH_MISS`` at most.

    Each signature value gives one bit, which differs with half the chance that the value does.
    """
    differs = max(0.0, (1 - percent / 100) / 2)
    beyond, most = 0.0, VALUES
    while most and (beyond := beyond + math.comb(VALUES, most) * differs**most * (1 - differs) ** (VALUES - most)) <= SKETCH_MISS:
        most -= 1
    return most


def _may_link(percent: int):
    """What two sets that are linked fulfil by their sizes, and by their sketches but for a chance of ``SKETCH_MISS``."""
    sizes = F.least("n", "n_b") * 100 >= F.greatest("n", "n_b") * percent
    bits = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_b"))) for c in ("low", "high"))
    return sizes & (bits <= _sketch_differences(percent))


def _split(placed: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components, with the component of most of a bucket's nodes."""
    split = (
        placed.groupBy("bucket", "part").agg(F.count("*").alias("size"))
        .groupBy("bucket").agg(F.max_by("part", F.struct("size", "part")).alias("largest"), F.count("*").alias("parts"))
        .filter("parts > 1")
    )
    return placed.join(split.select("bucket", "largest"), "bucket")


def _enough_left(percent: int):
    """Whether the sets can share enough if this is the first shingle that they share: both are in one order."""
    least = F.ceil(F.lit(percent) * (F.col("n") + F.col("n_b")) / (100 + percent))
    return F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b")) >= least


def _across(rare: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of different components that share a rare shingle and may be linked; the smaller set comes first."""
    larger = rare.select("bucket", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "low", "high", "part", "place", "largest")])
    smaller = rare.filter("short")
    met = (
        smaller.filter("part <> largest").join(larger, "bucket")
        .unionAll(smaller.filter("part = largest").join(larger.filter("part_b <> largest_b"), "bucket"))
    )
    ordered = (F.col("n") < F.col("n_b")) | ((F.col("n") == F.col("n_b")) & (F.col("node") < F.col("node_b")))
    return met.filter((F.col("part") != F.col("part_b")) & ordered & _may_link(percent) & _enough_left(percent))


def _rare_shingles(texts: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The rarest shingles of each node as ``bucket``, with their place in the order from rare to frequent.

    Two sets that are linked share at least ``percent`` of either one. So if all shingles are put in one order, linked sets
    share one of the first shingles of both, as many as may be missing and one more. From rare to frequent these are mostly
    what edits have brought in, which few copies have in common. The smaller of two linked sets shares more of its own: of a
    set of n at least 2 * percent / (100 + percent) * n with any that is not smaller. ``short`` marks the shingles that are
    left for it then.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                values, places = shingle_sets(read_words(part.column(1), lower=True), shingle)
                counts = np.diff(places)
                copies = np.zeros(len(counts), np.uint64)
                copies[counts > 0] = np.add.reduceat(mix(values), places[:-1][counts > 0]) if len(values) else 0
                owners = np.repeat(part.column(0).to_numpy(zero_copy_only=False), counts)
                yield pa.record_batch(
                    [pa.array(owners, pa.int64()), pa.array(np.repeat(copies, counts).view(np.int64)), pa.array(values.view(np.int64))],
                    names=["node", "copy", "bucket"],
                )

    wanted = texts.join(nodes.select("node").distinct(), "node", "left_semi").select("node", "text")
    # Listed twice, to be counted with partial sums and to be joined: a shingle that very many nodes share is split by AQE.
    rows = wanted.mapInArrow(listed, "node bigint, copy bigint, bucket bigint")
    frequent = rows.join(rows.groupBy("bucket").agg(F.count("*").alias("held")), "bucket")
    # A node may have several texts, also some with equal sets; those have equal places.
    order = Window.partitionBy("node", "copy").orderBy("held", "bucket")
    ranked = frequent.withColumn("place", F.dense_rank().over(order) - 1).join(nodes, ["node", "copy"])
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    short = F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent)) + 1
    marked = ranked.withColumn("short", F.col("place") < short)
    return marked.filter((F.col("place") < first) & (F.col("held") > 1)).drop("held", "copy")


def _signed(docs: DataFrame, shingle: int, percent: int, key: str, text: str) -> DataFrame:
    rng = np.random.Generator(np.random.PCG64(20240229))
    factors = rng.integers(0, 1 << 64, FUNCTIONS, np.uint64, endpoint=False) | np.uint64(1)
    offsets = rng.integers(0, 1 << 64, FUNCTIONS, np.uint64, endpoint=False)
    rows = _band_rows(percent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield signed(batch.slice(at, 1000))

    def signed(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, places = shingle_sets(read_words(batch.column(1), lower=True), shingle)
        counts = np.diff(places)
        some = np.flatnonzero(counts)
        prints, bands, sketch = _signatures(values, places[:-1][some], factors, offsets, rows)
        row = np.full(len(counts), -1)
        row[some] = np.arange(len(some))
        take = pa.array(np.where(row < 0, None, row), pa.int64())
        return pa.record_batch(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array([p.tobytes() for p in prints], pa.binary()).take(take),
                pa.array(np.ascontiguousarray(prints[:, 0]).view(np.int64), pa.int64()).take(take),
                pa.array(list(bands), pa.list_(pa.int64())).take(take),
                pa.array(sketch[:, 0], pa.int64()).take(take),
                pa.array(sketch[:, 1], pa.int64()).take(take),
            ],
            names=["id", "n_shingles", "print", "copy", "bands", "low", "high"],
        )

    return docs.select(F.col(key).cast("bigint").alias("id"), F.col(text)).mapInArrow(sign, SIGNED)


def _signatures(values: np.ndarray, starts: np.ndarray, factors: np.ndarray, offsets: np.ndarray, rows: int):
    """Of each set: a fingerprint of 128 bits, a key for each band, and the bits of the sketch in two words."""
    count = VALUES // rows
    if not len(starts):
        return np.zeros((0, 2), np.uint64), np.zeros((0, count), np.int64), np.zeros((0, 2), np.int64)
    seal = np.uint64(0xA0761D6478BD642F)
    prints = np.stack([np.add.reduceat(mix(values), starts), np.add.reduceat(mix(values ^ seal), starts)], axis=1)
    signature = np.empty((len(starts), VALUES), np.uint64)
    for i in range(FUNCTIONS):
        hashed = (values ^ offsets[i]) * factors[i]
        signature[:, 2 * i] = np.minimum.reduceat(hashed, starts)
        signature[:, 2 * i + 1] = np.maximum.reduceat(hashed, starts)
    bands = np.zeros((len(starts), count), np.uint64) + np.arange(count, dtype=np.uint64)
    for row in range(rows):
        bands = mix(bands ^ signature[:, row::rows])
    bits = (mix(signature) >> np.uint64(63)).astype(np.uint8)
    sketch = np.packbits(bits, axis=1).view(np.int64)
    return prints, bands.view(np.int64), sketch


def _texts(docs: DataFrame, members: DataFrame, key: str, text: str) -> DataFrame:
    """The texts of the classes that share a bucket. A key that has several texts brings all of them."""
    wanted = members.select("node").distinct()
    named = docs.select(F.col(key).cast("bigint").alias("node"), F.col(text).alias("text"))
    return named.join(wanted, "node", "left_semi").dropDuplicates(["node", "text"])


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield part.select(["a", "b"]).filter(pa.array(linked(part)))

    def linked(part: pa.RecordBatch) -> np.ndarray:
        (left, at_left), (right, at_right) = (shingle_sets(read_words(part.column(c), lower=True), shingle) for c in ("text_a", "text_b"))
        same = np.empty(part.num_rows, np.int64)
        for i in range(part.num_rows):
            one, other = left[at_left[i] : at_left[i + 1]], right[at_right[i] : at_right[i + 1]]
            same[i] = len(np.intersect1d(one, other, assume_unique=True))
        union = np.diff(at_left) + np.diff(at_right) - same
        return (100 * same >= percent * union) & (same > 0)

    for end in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("node").alias(end), F.col("text").alias(f"text_{end}")), end)
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(confirm, "a bigint, b bigint")
