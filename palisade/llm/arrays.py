"""Words of a batch of texts as numpy arrays.

A word is a longest run of bytes other than space and 0x09 to 0x0D. Texts stay UTF-8 bytes in one Arrow buffer; words
and windows of words are represented by 64-bit polynomial hashes, computed for a whole batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Odd, so that they have an inverse modulo 2**64.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
BLOCK = 1 << 20

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i below ``count``; kept between calls."""
    known = _powers.get(base)
    if known is None or len(known[0]) < count:
        size = max(count, BLOCK + 1)
        pair = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            pair.append(np.cumprod(steps, dtype=np.uint64))
        known = (pair[0], pair[1])
        if size <= 4 * BLOCK:
            _powers[base] = known
    return known[0][:count], known[1][:count]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others (a bijection)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Batch(NamedTuple):
    """Texts as one byte array, with the words of all texts in order."""

    data: np.ndarray
    offsets: np.ndarray  # of the texts; one more than there are texts
    starts: np.ndarray  # of the words
    ends: np.ndarray
    first: np.ndarray  # each text's first word; one more than there are texts

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    column = column if wide or pa.types.is_string(column.type) else column.cast(pa.string())
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows whose texts take about ``size`` bytes; a longer text is a piece of its own."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def read_words(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Batch:
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    solid = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1] | edge[1:-1]
    closes[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(opens)
    return Batch(data, offsets, starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets))


def word_hashes(batch: Batch) -> np.ndarray:
    """A 64-bit hash of every word's bytes, computed in blocks of about a megabyte."""
    hashes = np.empty(len(batch.starts), np.uint64)
    at = 0
    while at < len(hashes):
        low = batch.starts[at]
        to = max(at + 1, int(np.searchsorted(batch.ends, low + BLOCK, "right")))
        high = batch.ends[to - 1]
        forward, back = powers(BYTE_BASE, int(high - low))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((batch.data[low:high].astype(np.uint64) + np.uint64(1)) * forward, out=sums[1:])
        begin, end = batch.starts[at:to] - low, batch.ends[at:to] - low
        hashes[at:to] = mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))
        at = to
    return hashes


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of the ``size`` words from each position on, over all texts of a batch.

    Positions whose window leaves its text mean nothing: see ``window_places``.
    """
    count = max(0, len(words) - size + 1)
    if not count:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    hashes = np.empty(count, np.uint64)
    forward, back = powers(WORD_BASE, len(words))
    np.cumsum(words * forward, out=sums[1:])
    np.multiply(sums[size:] - sums[:count], back[:count], out=hashes)
    return mix(hashes)


def window_places(first: np.ndarray, size: int) -> np.ndarray:
    """The positions at which a window of ``size`` words lies within one text."""
    if first[-1] < size:
        return np.zeros(0, np.int64)
    inside = np.zeros(first[-1] + 1, np.int32)
    counts = np.diff(first)
    full = counts >= size
    np.add.at(inside, first[:-1][full], 1)
    np.add.at(inside, first[1:][full] - size + 1, -1)
    return np.flatnonzero(np.cumsum(inside[:-1]))


def shingle_sets(batch: Batch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, one text after the other, and each text's place among them.

    A text with fewer words than ``size`` has its whole sequence as only shingle; a text without words has none.
    """
    words = word_hashes(batch)
    hashes, places = window_hashes(words, size), window_places(batch.first, size)
    values = hashes[places]
    owners = np.searchsorted(batch.first, places, "right") - 1
    counts = batch.counts()
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = np.array([_sequence(words[batch.first[i] : batch.first[i + 1]]) for i in short], np.uint64)
        values, owners = np.concatenate([values, whole]), np.concatenate([owners, short])
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[fresh], owners[fresh]
    return values, np.searchsorted(owners, np.arange(len(counts) + 1))


def _sequence(words: np.ndarray) -> int:
    """Hash of a short whole sequence; its length keeps it apart from longer ones."""
    return int(mix(window_hashes(words, len(words)) + np.uint64(len(words)))[0])


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of True."""
    steps = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def covered(length: int, starts: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """Which of ``length`` positions lie in one of the windows."""
    steps = np.zeros(length + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + size, -1)
    return np.cumsum(steps[:-1]) > 0
