"""Repeated passages by sparse suffix arrays over content-selected positions."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.llm import chunks
from palisade.llm.arrays import covered, read_words, runs, window_hashes, window_places, word_hashes
from palisade.session import settle

GRAM = 8  # words by which positions are selected
PLACE_BITS = 24
# More different suffixes than this behind one gram within a chunk are sent as one that stands for many.
MANY = 8
KEY_SHARE = 1.0


class Suffixes(NamedTuple):
    """What a chunk knows of its texts."""

    first: np.ndarray  # of the words of each text
    starts: np.ndarray  # windows, by their first word
    hashes: np.ndarray  # of the windows
    owners: np.ndarray  # for each window the place in ``keys`` of its minimiser's suffix
    offsets: np.ndarray  # of the minimiser within the window
    keys: np.ndarray  # distinct suffixes in order: hash of the gram, then packed words
    twice: np.ndarray  # whether a suffix occurs more than once in the chunk
    sent: np.ndarray  # which of the keys are sent
    many: np.ndarray  # whether a suffix is one of many behind its gram


def repeated_passages(docs: DataFrame, length: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_words, start and end (in words, counted from 0) of every maximal run of words that is covered by windows
    of ``length`` words whose sequence also starts elsewhere, same document included; documents without any don't appear.

    1. In every window of ``length`` words the run of ``GRAM`` words with the smallest hash is its minimiser. Equal windows
       have it at the same place, so only suffixes that start at minimisers are kept, about one in 22.
    2. Suffixes meet by their gram and are sorted; the longer of the matches with both neighbours is the longest match that
       a suffix has anywhere. A window whose part right of the minimiser is longer than that can't be repeated.
    3. Matches are extended to the left: the windows that are left are compared whole. They merge into maximal runs.

    Sorted keys hold 16 bits of each word; they only exclude, and step 3 decides by 64-bit hashes of all ``length`` words.
    A passage that a third of all texts hold reaches a sorting task a few times for each chunk: within a chunk equal
    suffixes are sent once, and more than ``MANY`` behind one gram as one that lets all pass to step 3.

    NULL, empty and shorter texts have no windows. A repeated row repeats all its windows. Rows without key are found like
    others. An empty table gives an empty result.
    """
    plan = chunks.layout(docs, text, 96 / 22 / 6 + KEY_SHARE)
    chunked = chunks.dealt(docs.select(key, text), key, text, plan)
    buckets = plan.buckets
    row_type = chunked.schema["row"].dataType

    def suffixes(table: pa.Table) -> Suffixes:
        return _suffixes(table, length)

    def question(table: pa.Table) -> list[tuple[int, bytes]]:
        found = suffixes(table)
        keys, flags = found.keys[found.sent], (found.twice + 2 * found.many)[found.sent].astype(np.uint8)
        return [(b, keys[i:j].tobytes() + flags[i:j].tobytes()) for b, i, j in chunks.slices(keys[:, 0], buckets)]

    def reply(payloads: list[bytes]) -> list[bytes]:
        return _matches(payloads, length)

    def candidates(found: Suffixes, replies: pa.Table) -> np.ndarray:
        """Windows whose part from the minimiser on is matched somewhere."""
        longest = np.full(len(found.keys), length)
        if found.sent.any():
            answers = np.concatenate([np.frombuffer(p, np.uint8) for p in chunks.joined(replies)])
            longest[found.sent] = answers
            longest[found.many] = length
        return longest[found.owners] + found.offsets >= length

    def second(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        found = suffixes(table)
        return chunks.rows(key[0].as_py(), chunks.ask_repeated(found.hashes[candidates(found, replies)], buckets))

    def spans(table: pa.Table, replies: pa.Table) -> pa.Table:
        found = suffixes(table)
        rounds = replies.column("round").to_numpy()
        maybe = candidates(found, replies.filter(pa.array(rounds == 1)))
        repeated = chunks.read_repeated(found.hashes[maybe], replies.filter(pa.array(rounds == 2)), buckets)
        held = covered(int(found.first[-1]), found.starts[maybe][repeated], length)
        held = np.insert(held, found.first[1:-1], False)  # runs end with their text
        begins, ends = runs(held)
        shifted = found.first[:-1] + np.arange(len(found.first) - 1)
        text_of = np.searchsorted(shifted, begins, "right") - 1
        take = pa.array(text_of)
        return pa.table(
            {
                "row": table.column("row").combine_chunks().take(take),
                "n_words": pa.array(np.diff(found.first)[text_of], pa.int64()),
                "start": pa.array(begins - shifted[text_of], pa.int64()),
                "end": pa.array(ends - shifted[text_of], pa.int64()),
            }
        )

    first = settle(chunks.answer(chunks.ask(chunked, question), reply), "suffixes")
    asked = chunked.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(second, chunks.ASKED_DDL)
    replies = chunks.answer(asked, chunks.reply_repeated)
    replies = first.withColumn("round", F.lit(1)).unionAll(replies.withColumn("round", F.lit(2)))
    schema = T.StructType([T.StructField("row", row_type), *[T.StructField(n, T.LongType()) for n in ("n_words", "start", "end")]])
    done = chunked.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(spans, schema)
    return done.select(F.col("row")[key].alias(key), "n_words", "start", "end")


def _suffixes(table: pa.Table, length: int) -> Suffixes:
    batch = read_words(table.column("text"))
    words = word_hashes(batch)
    starts = window_places(batch.first, length)
    if not len(starts):
        none = np.zeros(0, bool)
        return Suffixes(batch.first, starts, np.zeros(0, np.uint64), starts, starts, np.zeros((0, 2), np.uint64), none, none, none)
    hashes = window_hashes(words, length)[starts]
    grams = window_hashes(words, GRAM)
    low = np.uint64((1 << PLACE_BITS) - 1)
    marked = (grams & ~low) | (np.arange(len(grams), dtype=np.uint64) & low)
    smallest = _sliding_minimum(marked, length - GRAM + 1)[starts]
    offsets = ((smallest & low).astype(np.int64) - starts) & int(low)
    minimisers, owners = np.unique(starts + offsets, return_inverse=True)

    tail = length - GRAM
    ends = batch.first[1:][np.searchsorted(batch.first[1:], minimisers, "right")]
    places = minimisers[:, None] + GRAM + np.arange(tail)
    short = (words >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
    packed = np.zeros((len(minimisers), -(-tail // 4) * 4), np.uint16)
    packed[:, :tail] = np.where(places < ends[:, None], short[np.minimum(places, len(short) - 1)], 0)
    columns = packed.astype(">u2").view(">u8").astype(np.uint64)
    keys = np.column_stack([grams[minimisers], columns])

    order = np.lexsort(keys.T[::-1])
    keys = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]).any(1)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(fresh) - 1
    twice = np.bincount(np.cumsum(fresh) - 1) > 1
    keys = keys[fresh]
    opens = np.ones(len(keys), bool)
    opens[1:] = keys[1:, 0] != keys[:-1, 0]
    many = (np.bincount(np.cumsum(opens) - 1) > MANY)[np.cumsum(opens) - 1]
    return Suffixes(batch.first, starts, hashes, number[owners], offsets, keys, twice, ~many | opens, many)


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    reach, least = 1, values
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    return np.minimum(least[: len(least) - (width - reach)], least[width - reach :])


def _matches(payloads: list[bytes], length: int) -> list[bytes]:
    """For each suffix of each request the number of words, up to ``length``, of its longest match with any other."""
    columns = 1 + -(-(length - GRAM) // 4)
    size = 8 * columns + 1
    counts = [len(p) // size for p in payloads]
    keys = np.concatenate([np.frombuffer(p, np.uint64, n * columns).reshape(n, columns) for p, n in zip(payloads, counts, strict=True)])
    flags = np.concatenate([np.frombuffer(p, np.uint8, offset=8 * n * columns) for p, n in zip(payloads, counts, strict=True)])
    order = np.lexsort(keys.T[::-1])
    keys, marks = keys[order], flags[order]
    words = keys[:, 1:].astype(">u8").view(">u2")
    same = keys[1:, 0] == keys[:-1, 0]
    differs = words[1:] != words[:-1]
    common = np.where(differs.any(1), differs.argmax(1), length - GRAM)
    shared = np.where(same, np.minimum(GRAM + common, length), 0)
    longest = np.maximum(np.concatenate([[0], shared]), np.concatenate([shared, [0]]))
    longest[(marks & 1) > 0] = length
    group = np.cumsum(np.concatenate([[True], ~same])) - 1
    longest[(np.bincount(group, marks & 2) > 0)[group]] = length
    out = np.empty(len(keys), np.uint8)
    out[order] = longest
    bounds = np.cumsum([0, *counts])
    return [out[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
