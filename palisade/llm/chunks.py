"""Questions that chunks of a corpus ask about fixed-size keys, answered by one task for each range of keys.

Texts are dealt into chunks of some megabytes by a hash of identity and text. A chunk asks about its distinct keys only,
so a key that a third of all texts hold reaches the answering task once for each chunk. Requests and replies are packed
arrays: a request costs the keys' bytes, a reply about a bit for each. Replies refer to keys by their sorted order, so a
chunk that runs again after a lost executor reads them alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
ASKED = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("payload", pa.binary())])
ASKED_DDL = "chunk bigint, bucket bigint, payload binary"


class Layout(NamedTuple):
    """How many chunks, buckets of keys and partitions; all follow the size of the input."""

    chunks: int
    buckets: int
    partitions: int


def layout(docs: DataFrame, text: str, key_bytes_per_text_byte: float) -> Layout:
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Chunks times buckets is the number of requests; larger ones for a larger corpus keep requests from becoming tiny.
    scale = min(8.0, max(1.0, (total / (64 << 30)) ** 0.5))
    chunks = max(least, int(total / (CHUNK_BYTES * scale)))
    return Layout(
        chunks=chunks,
        buckets=max(least, int(total * key_bytes_per_text_byte / (BUCKET_BYTES * scale))),
        partitions=max(least, chunks // 8),
    )


def dealt(docs: DataFrame, key: str, text: str, plan: Layout) -> DataFrame:
    """Columns ``chunk``, ``text`` and the struct ``row`` of all other columns."""
    return docs.select(
        F.pmod(F.xxhash64(F.col(key).cast("string"), F.col(text)), F.lit(plan.chunks)).alias("chunk"),
        F.col(text).alias("text"),
        F.struct(F.lit(0).alias("no column"), *[F.col(c) for c in docs.columns if c != text]).alias("row"),
    ).repartition(plan.partitions, "chunk")


def slices(sorted_keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """Bucket, start and end of each part of sorted 64-bit keys; equal ranges of the key space."""
    of_key = ((sorted_keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = np.flatnonzero(np.diff(of_key)) + 1
    bounds = np.concatenate([[0], edges, [len(sorted_keys)]])
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end > start:
            yield int(of_key[start]), start, end


def rows(chunk: int, parts: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table(
        [pa.array([chunk] * len(parts), pa.int64()), pa.array([b for b, _ in parts], pa.int64()), pa.array([p for _, p in parts], pa.binary())],
        schema=ASKED,
    )


def ask(chunked: DataFrame, question: Callable[[pa.Table], list[tuple[int, bytes]]]) -> DataFrame:
    """One row for each chunk and bucket with the packed keys."""

    def asked(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return rows(key[0].as_py(), question(table))

    return chunked.groupBy("chunk").applyInArrow(asked, ASKED_DDL)


def answer(requests: DataFrame, reply: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """The same rows with the reply to each as payload; ``reply`` sees all requests about one range of keys."""

    def answered(table: pa.Table) -> pa.Table:
        replies = pa.array(reply(table.column("payload").to_pylist()), pa.binary())
        return pa.table([table.column("chunk"), table.column("bucket"), replies], schema=ASKED)

    return requests.groupBy("bucket").applyInArrow(answered, ASKED_DDL)


def joined(replies: pa.Table) -> list[bytes]:
    """A chunk's replies in the order of its sorted keys."""
    order = np.argsort(replies.column("bucket").to_numpy(), kind="stable")
    payloads = replies.column("payload").to_pylist()
    return [payloads[i] for i in order]


# Keys that are 64-bit hashes: which of them occur at least twice?


def ask_repeated(hashes: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    """Distinct hashes of a chunk by bucket, each part followed by a bit for each that says: twice in here already."""
    keys, counts = np.unique(hashes, return_counts=True)
    twice = counts > 1
    return [(bucket, keys[a:b].tobytes() + np.packbits(twice[a:b]).tobytes()) for bucket, a, b in slices(keys, buckets)]


def reply_repeated(payloads: list[bytes]) -> list[bytes]:
    """For each request a bit for each hash: two occurrences or more in all."""
    keys, twice = [], []
    for payload in payloads:
        # n keys of 8 bytes and n bits: n is the only count that gives this length.
        n = 8 * len(payload) // 65
        while 8 * n + (n + 7) // 8 < len(payload):
            n += 1
        keys.append(np.frombuffer(payload, np.uint64, n))
        twice.append(np.unpackbits(np.frombuffer(payload, np.uint8, offset=8 * n), count=n))
    weights = np.concatenate(twice).astype(np.float64) + 1
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    repeated = np.bincount(place, weights)[place] > 1
    bounds = np.cumsum([0] + [len(k) for k in keys])
    return [np.packbits(repeated[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def read_repeated(hashes: np.ndarray, replies: pa.Table, buckets: int) -> np.ndarray:
    """For each hash of a chunk whether it occurs at least twice."""
    if not len(hashes):
        return np.zeros(0, bool)
    keys, place = np.unique(hashes, return_inverse=True)
    bits = [
        np.unpackbits(np.frombuffer(payload, np.uint8), count=b - a)
        for payload, (_, a, b) in zip(joined(replies), slices(keys, buckets), strict=True)
    ]
    return np.concatenate(bits).astype(bool)[place]
