"""Spelling variants of a corpus's words, found by bidirectional FM-index search schemes.

Words are counted over all texts. Two words are near if one inserted, deleted or replaced code point makes them equal; a
word whose most frequent near word is much more frequent is taken for a variant of it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm.arrays import LOWER, pieces, text_bytes
from palisade.session import settle

# Symbols of an index; its two rank tables take about 400 bytes for each.
INDEX_SYMBOLS = 200_000
# Extensions by every symbol that are looked at together.
BRANCHES = 20_000

# UTF-8 writes U+00C0 to U+00FF as this byte and one more.
LATIN = 0xC3
PLAIN = np.zeros(256, bool)
PLAIN[ord("A") : ord("Z") + 1] = PLAIN[ord("a") : ord("z") + 1] = True
# The CRC of longer words is finished one by one.
CRC_BYTES = 48

NEAREST = "word string, n bigint, n_near bigint, near string, near_n bigint"


def word_counts(docs: DataFrame, least_length: int = 6, noise: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` of every word of at least ``least_length`` code points in the whole texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case. With ``noise``, a run loses its code
    point number ``h % length`` (from 0) if ``noise`` divides h, the CRC-32 of ``<key>:<run>``; a NULL key counts as an
    empty one. NULL texts have no words; an empty table gives an empty result. A repeated row counts again. Only words and
    counts are shuffled, after each batch has summed its own.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                counted = _words(piece, least_length, noise).value_counts()
                yield pa.record_batch([counted.field("values"), counted.field("counts")], names=["word", "n"])

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(text))
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _words(piece: pa.RecordBatch, least_length: int, noise: int | None) -> pa.StringArray:
    """The words of some texts, repeated as often as they occur."""
    data, offsets = text_bytes(piece.column(1))
    lead = data == LATIN
    inside = PLAIN[data] | lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    wide = np.concatenate([[0], np.cumsum(lead)])
    long = ends - starts - (wide[ends] - wide[starts]) >= least_length
    starts, ends = starts[long], ends[long]
    data = LOWER[data]
    shorter: list[str] = []
    if noise is not None and len(starts):
        hashes = _keyed_crc(data, starts, ends, np.searchsorted(offsets, starts, "right") - 1, piece.column(0).to_pylist())
        hit = hashes % noise == 0
        for start, end, h in zip(starts[hit].tolist(), ends[hit].tolist(), hashes[hit].tolist(), strict=True):
            run = data[start:end].tobytes().decode()
            if len(run) > least_length:
                shorter.append(run[: h % len(run)] + run[h % len(run) + 1 :])
        starts, ends = starts[~hit], ends[~hit]
    sizes = ends - starts
    places = np.concatenate([[0], np.cumsum(sizes)])
    taken = data[np.arange(places[-1]) + np.repeat(starts - places[:-1], sizes)]
    whole = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(taken)).cast(pa.string())
    return pa.concat_arrays([whole, pa.array(shorter, pa.string())])


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


CRC = _crc_table()


def _keyed_crc(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owners: np.ndarray, keys: list[str]) -> np.ndarray:
    """CRC-32 of ``<key>:<word>`` for each word, a byte of all words at a time."""
    begun = np.array([zlib.crc32(f"{key}:".encode()) for key in keys], np.uint32)
    sizes = ends - starts
    order = np.argsort(-np.minimum(sizes, CRC_BYTES + 1).astype(np.int8), kind="stable")
    at = starts[order]
    state = ~begun[owners[order]]
    reach = np.searchsorted(-sizes[order].clip(max=CRC_BYTES + 1), -np.arange(1, CRC_BYTES + 1), "right")
    for i, active in enumerate(reach.tolist()):
        if not active:
            break
        now = state[:active]
        state[:active] = CRC[(now ^ data[at[:active] + i]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty(len(starts), np.int64)
    out[order] = ~state
    for i in np.flatnonzero(sizes > CRC_BYTES).tolist():
        out[i] = zlib.crc32(data[starts[i] + CRC_BYTES : ends[i]].tobytes(), int(out[i]))
    return out


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """One row for each word of ``word`` and ``n`` (distinct words): n_near, ``form`` and ``root``.

    n_near is the number of near words. The form is the near word of largest n, of equal ones the first in code-point
    order, if its n is at least ``ratio`` times the word's n, else NULL; ``form_n`` is its n. The root is the last word
    reached by following forms, the word itself if it has none. NULL words are left out; an empty table gives an empty
    result; words of one code point or none have no near words.

    1. One edit leaves one half of a word as it is, so near words share the first or the last half of either one. Each word
       goes to the indexes of the halves under which words of its own length, one less and one more look for it: four.
    2. An index is a bidirectional FM-index over some of the words, each closed by a delimiter. A query matches one half
       exactly, towards its end of the word and the delimiter, then extends across the other with one edit.
    3. What the two searches of a word find is disjoint, so counts are summed and the best of both is taken.

    Halves are dealt to indexes of at most about ``INDEX_SYMBOLS`` by hash. A half that alone holds more has indexes of its
    own, each with a part of its words, and its queries visit all of them.
    """
    halves = settle(_halves(words.filter(F.col("word").isNotNull()).select("word", "n")), "halves")
    symbols = F.length("word") + 1
    total = halves.agg(F.sum(symbols)).first()[0] or 0
    spread = max(1, -(-total // INDEX_SYMBOLS))
    hot = halves.groupBy("side", "half").agg(F.sum(symbols).alias("held")).filter(F.col("held") > INDEX_SYMBOLS)
    hot = hot.select("side", "half", F.ceil(F.col("held") / INDEX_SYMBOLS).cast("int").alias("parts"))
    placed = halves.join(hot, ["side", "half"], "left")
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    visited = F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    sent = placed.select(
        F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("side", "half"), F.lit(spread))).otherwise(-1).alias("shard"),
        F.when(F.col("parts").isNotNull(), F.concat(F.col("side").cast("string"), "half")).otherwise("").alias("hot"),
        F.explode(visited).alias("part"),
        F.coalesce(own, F.lit(0)).alias("own"),
        "side",
        "word",
        "n",
        "asks",
    )
    asked = sent.withColumn("held", F.col("part") == F.col("own")).drop("own")
    # Rows are few bytes but much work, so tasks are dealt by indexes rather than by size.
    found = asked.repartition(spread, "shard", "hot", "part").groupBy("shard", "hot", "part").applyInArrow(_searched, NEAREST)
    nearest = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near")))
    best = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), nearest.alias("best"))
    enough = -F.col("best.less") >= F.col("n") * ratio
    formed = settle(
        best.select("word", "n", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "forms"
    )
    roots = _roots(formed.filter("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _halves(words: DataFrame) -> DataFrame:
    """The halves under which a word is looked for; ``asks`` marks the two under which it looks itself."""
    size = F.length("word")
    split = F.floor(size / 2).cast("int")
    rest = size - split
    other_left = F.when(size % 2 == 0, split - 1).otherwise(split + 1)
    other_right = F.when(size % 2 == 0, rest + 1).otherwise(rest - 1)

    def half(side: int, length: Column, asks: bool) -> Column:
        part = F.when(length < 1, F.lit("")).otherwise(F.col("word").substr(F.lit(1) if side == 0 else size - length + 1, length))
        return F.struct(F.lit(side).alias("side"), part.alias("half"), F.lit(asks).alias("asks"))

    all_four = F.array(half(0, split, True), half(0, other_left, False), half(1, rest, True), half(1, other_right, False))
    return words.withColumn("h", F.explode(all_four)).select("word", "n", "h.side", "h.half", "h.asks")


def _roots(links: DataFrame) -> DataFrame:
    """Follow forms to the last word: every round doubles the steps. Along a chain n grows by a factor, so chains are short."""
    roots = settle(links, "roots")
    while True:
        beyond = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        stepped = roots.join(beyond, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        stepped = settle(stepped, "roots")
        roots = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            return roots


class Index:
    """A bidirectional FM-index over distinct words, each read in a circle with a delimiter (symbol 0) before its start.

    An interval of a pattern is its first place among the sorted circular readings, the same among the backward readings,
    and its size. Rank tables hold for each place and symbol how many of the readings before it follow a symbol up to that.
    """

    def __init__(self, words: list[str]):
        points = _points("".join(f"{word}\0" for word in words))
        self.letters, self.symbols = np.unique(points, return_inverse=True)
        ends = np.flatnonzero(points == 0)
        begins = np.concatenate([[0], ends[:-1] + 1])
        count = len(points)
        after, before = np.arange(1, count + 1), np.arange(-1, count - 1)
        after[ends], before[begins] = begins, ends
        self.word_at = np.searchsorted(ends, np.arange(count))
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(self.symbols, minlength=len(self.letters)))])
        self.places = _order(self.symbols, after)
        self.tables = [self._ranks(self.places, before), self._ranks(_order(self.symbols, before), after)]

    def _ranks(self, order: np.ndarray, before: np.ndarray) -> np.ndarray:
        table = np.zeros((len(order) + 1, len(self.letters) + 1), np.int32)
        table[np.arange(1, len(order) + 1), self.symbols[before[order]] + 1] = 1
        np.cumsum(table, axis=0, out=table)
        return np.cumsum(table, axis=1, out=table)

    def coded(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points, -1 for those that no word here holds."""
        at = np.searchsorted(self.letters, points).clip(max=len(self.letters) - 1)
        return np.where(self.letters[at] == points, at, -1)

    def extended(self, found: Intervals, symbols: np.ndarray, side: int) -> Intervals:
        """The intervals with one symbol before (side 0) or after (side 1) the pattern; they may be empty."""
        table, start = self.tables[side], found.start[side]
        low, high = table[start, symbols], table[start + found.size, symbols]
        low_next, high_next = table[start, symbols + 1], table[start + found.size, symbols + 1]
        moved, kept = self.smaller[symbols] + low_next - low, found.start[1 - side] + high - low
        return Intervals((moved, kept) if side == 0 else (kept, moved), high_next - low_next - (high - low))

    def branches(self, found: Intervals, side: int) -> tuple[np.ndarray, np.ndarray, Intervals]:
        """All extensions by a letter that occur: number of the interval, letter, new interval."""
        table, start = self.tables[side], found.start[side]
        low, below = table[start], table[start + found.size] - table[start]
        sizes = np.diff(below, axis=1)
        of, symbol = np.nonzero(sizes[:, 1:])
        symbol += 1
        moved, kept = self.smaller[symbol] + low[of, symbol + 1] - low[of, symbol], found.start[1 - side][of] + below[of, symbol]
        return of, symbol, Intervals((moved, kept) if side == 0 else (kept, moved), sizes[of, symbol])


class Intervals(NamedTuple):
    start: tuple[np.ndarray, np.ndarray]
    size: np.ndarray

    def at(self, which: np.ndarray) -> Intervals:
        return Intervals((self.start[0][which], self.start[1][which]), self.size[which])

    @staticmethod
    def joined(parts: list[Intervals]) -> Intervals:
        return Intervals(
            (np.concatenate([p.start[0] for p in parts]), np.concatenate([p.start[1] for p in parts])), np.concatenate([p.size for p in parts])
        )


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)


def _order(symbols: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Places in the order of what is read from them on by ``step``, by doubling the symbols compared."""
    rank, count = symbols.astype(np.int64), len(symbols)
    while True:
        keys = rank * count + rank[step]
        order = np.argsort(keys, kind="stable")
        fresh = np.diff(keys[order]) > 0
        rank = np.empty(count, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(fresh)])
        if fresh.all():
            return order
        step = step[step]


def _searched(table: pa.Table) -> pa.Table:
    """What the queries of one index find: for each its number of near words and the best of them."""
    held = table.filter(table.column("held"))
    counts = dict(zip(held.column("word").to_pylist(), held.column("n").to_pylist(), strict=True))
    words = sorted(counts)
    asking = table.filter(table.column("asks"))
    names, sides = asking.column("word").to_pylist(), asking.column("side").to_numpy()
    n = asking.column("n").to_numpy()
    near, best = np.zeros(len(names), np.int64), np.full(len(names), -1)
    if words and names:
        index = Index(words)
        frequent = np.array([counts[word] for word in words], np.int64)
        place = {word: i for i, word in enumerate(words)}
        for side in (0, 1):
            rows = np.flatnonzero(sides == side)
            queries = Queries(index, [names[i] for i in rows], [place.get(names[i], -1) for i in rows])
            of, word = queries.search(side)
            order = np.lexsort((word, -frequent[word], of))
            of, word = of[order], word[order]
            near[rows] = np.bincount(of, minlength=len(rows))
            first = np.concatenate([[True], of[1:] != of[:-1]])[: len(of)]
            best[rows[of[first]]] = word[first]
    some = best >= 0
    return pa.table(
        {
            "word": pa.array(names, pa.string()),
            "n": pa.array(n, pa.int64()),
            "n_near": pa.array(near),
            "near": pa.array([words[i] if i >= 0 else None for i in best.tolist()], pa.string()),
            "near_n": pa.array([counts[words[i]] if i >= 0 else None for i in best.tolist()], pa.int64()),
        }
    )


class Queries:
    """Words looked for in an index. A search matches the half of its side exactly and allows one edit in the other."""

    def __init__(self, index: Index, words: list[str], own: list[int]):
        self.index, self.own = index, np.array(own, np.int64)
        self.symbols = index.coded(_points("".join(words)))
        self.sizes = np.array([len(word) for word in words], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64) if words else np.zeros(0, np.int64)
        self.split = self.sizes // 2

    def symbol(self, of: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The queries' symbols at a place, -2 outside the word."""
        inside = (place >= 0) & (place < self.sizes[of])
        at = np.where(inside, self.starts[of] + place, 0)
        return np.where(inside, self.symbols[at], -2)

    def search(self, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Query and word of all near words with the same first half (side 0) or last half (side 1).

        A word that several edits give comes out once: an inserted letter differs from the one behind it, and of equal
        letters in a row the last is deleted. An insertion between the halves belongs to side 0.
        """
        of, found = self._exact(side)
        place = self.split[of]  # of the letter to read next on side 0, of the last one read on side 1
        queries, words = [], []
        edited: tuple[np.ndarray, np.ndarray, Intervals] | None = None
        while len(of) or (edited is not None and len(edited[0])):
            parts = [] if edited is None else [edited]
            if len(of):
                # Nothing near lies in an interval that holds the query alone.
                alone = (found.size == 1) & (self.index.word_at[self.index.places[found.start[0]]] == self.own[of])
                of, place, found = of[~alone], place[~alone], found.at(~alone)
                for at in range(0, len(of), BRANCHES):
                    block = slice(at, at + BRANCHES)
                    parts += self._edits(of[block], place[block], found.at(block), side)
            edited = None
            if parts:
                new_of, new_place = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                new = Intervals.joined([p[2] for p in parts])
                done = new_place >= self.sizes[new_of] if side == 0 else new_place <= 0
                closed = self.index.extended(new.at(done), np.zeros(int(done.sum()), np.int64), 1 - side)
                whole = closed.size > 0
                queries.append(new_of[done][whole])
                words.append(self.index.word_at[self.index.places[closed.start[0][whole]]])
                edited = self._read(new_of[~done], new_place[~done], new.at(~done), side)
            more = place < self.sizes[of] if side == 0 else place > 0
            of, place, found = self._read(of[more], place[more], found.at(more), side)
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *queries]), np.concatenate([none, *words])

    def _exact(self, side: int) -> tuple[np.ndarray, Intervals]:
        """The intervals of the halves with the delimiter at their end of the word, for queries that have one."""
        of = np.arange(len(self.sizes))
        place = self.split[of]
        everything = np.zeros(len(of), np.int64)
        found = Intervals((everything, everything), np.full(len(of), len(self.index.symbols)))
        while True:
            # Side 0 reads its half backwards from the middle, side 1 forwards.
            more = place > 0 if side == 0 else place < self.sizes[of]
            if not more.any():
                break
            reading = self._read(of[more], place[more], found.at(more), 1 - side)
            kept = ~more
            of, place = np.concatenate([of[kept], reading[0]]), np.concatenate([place[kept], reading[1]])
            found = Intervals.joined([found.at(kept), reading[2]])
        closed = self.index.extended(found, np.zeros(len(of), np.int64), side)
        some = closed.size > 0
        return of[some], closed.at(some)

    def _read(self, of: np.ndarray, place: np.ndarray, found: Intervals, side: int) -> tuple[np.ndarray, np.ndarray, Intervals]:
        """Read the next letter of each query: to the right on side 0, to the left on side 1."""
        symbol = self.symbol(of, place if side == 0 else place - 1)
        known = symbol > 0
        of, place, symbol = of[known], place[known], symbol[known]
        new = self.index.extended(found.at(known), symbol, 1 - side)
        some = new.size > 0
        return of[some], place[some] + (1 if side == 0 else -1), new.at(some)

    def _edits(self, of: np.ndarray, place: np.ndarray, found: Intervals, side: int) -> list[tuple[np.ndarray, np.ndarray, Intervals]]:
        """The states one edit away: one letter deleted, replaced or inserted at ``place``."""
        step = 1 if side == 0 else -1
        target = place if side == 0 else place - 1  # the letter that may go or change
        there, behind = self.symbol(of, target), self.symbol(of, target + 1)
        exists = there != -2
        gone = exists & (there != behind)
        parts = [(of[gone], place[gone] + step, found.at(gone))]
        branch, letter, new = self.index.branches(found, 1 - side)
        swap = exists[branch] & (letter != there[branch])
        parts.append((of[branch][swap], place[branch][swap] + step, new.at(swap)))
        # Inserted before the letter at ``place``; on side 1 not at the middle.
        ahead = self.symbol(of, place)
        put = letter != ahead[branch]
        if side == 1:
            put &= place[branch] < self.split[of[branch]]
        parts.append((of[branch][put], place[branch][put], new.at(put)))
        return parts
