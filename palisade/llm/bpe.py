"""Byte-level BPE by a pair occurrence index, and its inverse.

A batch's distinct pieces are merged together: an index maps each pair of neighbouring symbols to all its positions in the
batch, ranks are taken in ascending order, and each merge updates the lists of the pairs it makes. All places of a pair are
merged at once.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A space next to other white space; every other space within a text begins a token.
TIGHT = re.compile(r" \s"), re.compile(r"[^\S ] ")

KEPT_PIECES = 500_000
TEXT_BYTES = 2 << 20


class Vocabulary(NamedTuple):
    pairs: np.ndarray  # left * size + right of every merge, ascending
    ranks: np.ndarray  # of these pairs
    merges: np.ndarray  # left, right and result, by rank
    bytes_of: list[bytes]  # by id
    byte_ids: np.ndarray  # symbol of each byte
    special: dict[str, int]


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b not in hidden else chr(256 + hidden.index(b)) for b in range(256)]


@lru_cache(maxsize=2)
def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    steps = content["pre_tokenizer"]
    if content["normalizer"] or steps["type"] != "ByteLevel" or steps["add_prefix_space"] or not steps["use_regex"]:
        raise ValueError(f"{path}: only byte-level BPE without normaliser and prefix space is supported")
    added = content["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError(f"{path}: added tokens that look at their surroundings aren't supported")
    ids = content["model"]["vocab"]
    characters = byte_characters()
    byte_of = {c: b for b, c in enumerate(characters)}
    special = {t["content"]: t["id"] for t in added}
    bytes_of = [b""] * (1 + max([*ids.values(), *special.values()]))
    for token, i in ids.items():
        bytes_of[i] = bytes(byte_of[c] for c in token)
    for token, i in special.items():
        bytes_of[i] = token.encode()
    steps = [tuple(pair) if isinstance(pair, list) else tuple(pair.split(" ")) for pair in content["model"]["merges"]]
    merges = np.array([(ids[left], ids[right], ids[left + right]) for left, right in steps], np.int64).reshape(-1, 3)
    _check_order(path, merges)
    codes = merges[:, 0] * len(bytes_of) + merges[:, 1]
    order = np.argsort(codes)
    return Vocabulary(codes[order], order, merges, bytes_of, np.array([ids[c] for c in characters]), special)


def _check_order(path: str, merges: np.ndarray) -> None:
    """Every symbol comes from one merge at most, which ranks before all merges that use it."""
    made = {symbol: rank for rank, symbol in enumerate(merges[:, 2].tolist())}
    if len(made) < len(merges) or any(made.get(part, -1) >= rank for rank, pair in enumerate(merges[:, :2].tolist()) for part in pair):
        raise ValueError(f"{path}: ranks out of order")


def ranks_of(left: np.ndarray, right: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Rank of each pair of symbols, -1 for none; negative symbols are in no pair."""
    codes = left * len(vocabulary.bytes_of) + right
    place = np.minimum(np.searchsorted(vocabulary.pairs, codes), len(vocabulary.pairs) - 1)
    return np.where((vocabulary.pairs[place] == codes) & (left >= 0) & (right >= 0), vocabulary.ranks[place], -1)


def merge_all(tokens: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all tokens in a row after all merges, and where each token's begin, by one index over all tokens.

    A symbol comes from one merge and pairs with it rank after that merge, so no pair of a rank already taken appears
    again, and taking ranks in ascending order equals merging token by token.
    """
    data = np.frombuffer(b"".join(tokens), np.uint8)
    ends = np.cumsum([len(t) for t in tokens], dtype=np.int64)
    symbols = np.insert(vocabulary.byte_ids[data], ends, -1) if len(tokens) else np.zeros(0, np.int64)  # -1 ends a token
    after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def note(ranks: np.ndarray, places: np.ndarray) -> None:
        """Add the places to the lists of their ranks."""
        known = ranks >= 0
        ranks, places = ranks[known], places[known]
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist() if len(ranks) else [], np.split(places, cuts), strict=False):
            if rank not in index:
                index[rank] = []
                heapq.heappush(active, rank)
            index[rank].append(part)

    if len(symbols):
        note(ranks_of(symbols[:-1], symbols[1:], vocabulary), np.arange(len(symbols) - 1))
    while active:
        rank = heapq.heappop(active)
        left, right, merged = vocabulary.merges[rank].tolist()
        at = np.concatenate(index.pop(rank))  # a place that is there twice does no harm
        at = at[(symbols[at] == left) & (symbols[after[at]] == right)]  # others lost a part to an earlier merge
        if left == right and len(at) > 1:
            at = np.unique(at)
            # In a run of equal symbols every other pair is merged, from the left.
            follows = np.concatenate([[False], after[at[:-1]] == at[1:]])
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(follows, 0, place))) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        rest = after[gone]
        symbols[at], symbols[gone] = merged, -2
        after[at], before[rest] = rest, at
        ahead = before[at]
        ahead = ahead[ahead >= 0]
        places = np.concatenate([ahead, at])
        note(ranks_of(symbols[places], symbols[after[places]], vocabulary), places)
    kept = symbols != -2
    symbols = symbols[kept]
    bounds = np.flatnonzero(symbols == -1)
    starts = np.concatenate([[0], bounds - np.arange(len(bounds))])
    return symbols[symbols >= 0], starts


class Flat:
    """Lists of numbers by name, in one array; names are numbered in the order in which they came."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.values, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def add(self, names: list[str], values: np.ndarray, starts: np.ndarray) -> None:
        self.number.update(zip(names, range(len(self.number), len(self.number) + len(names)), strict=True))
        self.values = np.concatenate([self.values, values])
        self.starts = np.concatenate([self.starts, self.starts[-1] + starts[1:]])

    def numbers(self, names: list[str]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, names), np.int64, len(names))

    def unknown(self, names: list[str]) -> list[str]:
        return [n for n in set(names) if n not in self.number]


class Encoder:
    """Encodes and decodes; remembers ``KEPT_PIECES`` pieces and those of one batch at most."""

    def __init__(self, path: str):
        self.vocabulary = read_vocabulary(path)
        self.pattern = regex.compile(PATTERN)
        special = self.vocabulary.special
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        lengths = np.array([len(b) for b in self.vocabulary.bytes_of], np.int64)
        self.token_bytes = np.frombuffer(b"".join(self.vocabulary.bytes_of), np.uint8)
        self.token_starts = np.concatenate([[0], np.cumsum(lengths)])
        self._forget()

    def _forget(self) -> None:
        self.tokens, self.known = Flat(), Flat()

    def pieces(self, text: str) -> list[str]:
        """Parts of a text that are encoded apart from each other; special tokens stand alone."""
        if self.special and (parts := self.special.split(text)) and len(parts) > 1:
            return [p for n, part in enumerate(parts) for p in ([part] if n % 2 else self.pieces(part))]
        if not text:
            return []
        if text[0] == " " or text[-1] == " " or "\0" in text or any(pair.search(text) for pair in TIGHT):
            return self.pattern.findall(text)
        return text.replace(" ", "\0 ").split("\0")

    def split(self, piece: str) -> list[str]:
        if piece in self.vocabulary.special or (piece[1:] if piece[0] == " " else piece).isalpha():
            return [piece]
        return self.pattern.findall(piece)

    def learn(self, new: list[str]) -> None:
        """Ids of pieces that aren't known yet."""
        special = self.vocabulary.special
        split = list(map(self.split, new))
        tokens = self.tokens.unknown([t for one in split for t in one])
        named = [t for t in tokens if t in special]
        self.tokens.add(named, np.array([special[t] for t in named], np.int64), np.arange(len(named) + 1))
        tokens = [t for t in tokens if t not in special]
        self.tokens.add(tokens, *merge_all([t.encode() for t in tokens], self.vocabulary))
        ids, bounds = gathered(self.tokens.values, self.tokens.starts, self.tokens.numbers([t for one in split for t in one]))
        self.known.add(new, ids, bounds[np.concatenate([[0], np.cumsum([len(one) for one in split], dtype=np.int64)])])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin."""
        if len(self.known.number) > KEPT_PIECES:
            self._forget()
        pieces = [self.pieces(text) for text in texts]
        flat = [p for one in pieces for p in one]
        self.learn(self.known.unknown(flat))
        ids, bounds = gathered(self.known.values, self.known.starts, self.known.numbers(flat))
        return ids, bounds[np.concatenate([[0], np.cumsum([len(one) for one in pieces], dtype=np.int64)])]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """Texts of the ids; bytes that aren't UTF-8 become replacement characters."""
        data, places = gathered(self.token_bytes, self.token_starts, ids)
        offsets = pa.array(places[bounds], pa.int64())
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets.buffers()[1], pa.py_buffer(data)])
        try:
            return found.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in found.to_pylist()], pa.string())


def gathered(values: np.ndarray, starts: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The wanted parts of ``values`` one after the other, and their bounds."""
    lengths = starts[wanted + 1] - starts[wanted]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return values[np.repeat(starts[wanted] - bounds[:-1], lengths) + np.arange(bounds[-1])], bounds


def portions(batch: pa.RecordBatch, sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of some megabytes, or of one longer text."""
    at = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > TEXT_BYTES:
            yield at, i
            at, total = i, 0
        total += size
    if at < batch.num_rows:
        yield at, batch.num_rows


def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = False, keep_text: bool = True) -> DataFrame:
    """All columns, with ``ids`` (array of int) and ``n_tokens``; with ``decoded`` also the text of the ids. Without
    ``keep_text`` the column ``text`` is left out, so that the Python workers needn't send it back.

    Equals the tokenizers library with the file at ``path`` and add_special_tokens=False: special tokens that stand in a
    text become their own ids. The file must lie at this path on every executor. NULL and empty texts have no ids, and an
    empty table gives an empty result. Texts are encoded whole; very long ones alone. Input columns called ids, n_tokens
    or decoded are replaced.
    """
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    added += [T.StructField("decoded", T.StringType())] if decoded else []
    kept = [f for f in docs.schema.fields if f.name not in {a.name for a in added} and (keep_text or f.name != text)]
    names = [f.name for f in kept]
    # A text that is among the columns anyway is sent once.
    sent = [*names] if text in names else [*names, F.col(text).alias("text to encode")]
    place = names.index(text) if text in names else len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            texts = batch.column(place)
            for a, b in portions(batch, [len(t.as_buffer()) if t.is_valid else 0 for t in texts]):
                ids, bounds = encoder.encode([t or "" for t in texts.slice(a, b - a).to_pylist()])
                columns = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())), pa.array(np.diff(bounds), pa.int64())]
                columns += [encoder.decode(ids, bounds)] if decoded else []
                part = batch.slice(a, b - a)
                yield pa.record_batch([*part.columns[: len(names)], *columns], names=[*names, *(f.name for f in added)])

    return docs.select(*sent).mapInArrow(run, T.StructType([*kept, *added]))


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """All columns, with ``decoded``: the text of the ids, special tokens included. NULL counts as no ids."""
    kept = [f for f in rows.schema.fields if f.name != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            lists = [np.array(x or [], np.int64) for x in batch.column(batch.num_columns - 1).to_pylist()]
            bounds = np.cumsum([0, *map(len, lists)])
            texts = encoder.decode(np.concatenate([np.zeros(0, np.int64), *lists]), bounds)
            yield pa.record_batch([*batch.columns[:-1], texts], names=[*(f.name for f in kept), "decoded"])

    schema = T.StructType([*kept, T.StructField("decoded", T.StringType())])
    return rows.select(*[f.name for f in kept], F.col(ids).alias("ids to decode")).mapInArrow(run, schema)
