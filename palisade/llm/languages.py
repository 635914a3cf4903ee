"""Language identification by hyperdimensional profiles.

Every letter has a random vector of -1 and 1. An n-gram is the product of its letters' vectors, each rotated by its place;
a text is the sum of its n-grams, a language the sum of its texts. The language whose sum has the greatest cosine wins.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.llm.arrays import mix, pieces, text_bytes

DIMENSIONS = 1024
GRAM = 3
UNKNOWN = "und"

# Distinct n-grams of a text that are added at a time.
BLOCK = 8_192
# A task hands on its sums when it holds so many languages.
HELD_LANGUAGES = 256


@dataclass
class Profiles:
    """Languages in order of their names, and one vector of unit length for each."""

    names: list[str] = field(default_factory=list)
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMENSIONS)))


def fit(docs: DataFrame, language: str = "lang", text: str = "text") -> Profiles:
    """The sums of all n-grams of each language's whole texts. Rows without language or text take no part.

    Each task adds up its texts; the sums of tasks are added by Spark, so a language that holds most rows is spread like any
    other. The driver gets one vector for each language.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch, 1):
                names, number = np.unique(np.array(piece.column(0).to_pylist(), object), return_inverse=True)
                grams, owners, counts, _ = reader.grams(piece.column(1))
                distinct, place = np.unique(grams, return_inverse=True)
                for i, name in enumerate(names.tolist()):
                    own = number[owners] == i
                    weights = np.bincount(place[own], counts[own], minlength=len(distinct))
                    total = np.zeros(DIMENSIONS)
                    for at in range(0, len(distinct), BLOCK):
                        total += weights[at : at + BLOCK] @ reader.vectors(distinct[at : at + BLOCK]).astype(float)
                    held[name] = held.get(name, 0) + total
                if len(held) > HELD_LANGUAGES:
                    yield from sums(held)
                    held = {}
        yield from sums(held)

    def sums(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, total in held.items():
            columns = [pa.array([name] * DIMENSIONS), pa.array(range(DIMENSIONS), pa.int32()), pa.array(np.rint(total).astype(np.int64))]
            yield pa.record_batch(columns, names=["lang", "place", "total"])

    known = docs.filter(F.col(language).isNotNull() & F.col(text).isNotNull()).select(F.col(language).cast("string"), F.col(text))
    partial = known.mapInArrow(bundle, "lang string, place int, total bigint")
    summed = partial.groupBy("lang", "place").agg(F.sum("total").alias("total"))
    rows = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "total")))["total"].alias("totals")).orderBy("lang").collect()
    rows = [row for row in rows if any(row.totals)]
    if not rows:
        return Profiles()
    vectors = np.array([row.totals for row in rows], float)
    return Profiles([row.lang for row in rows], vectors / np.linalg.norm(vectors, axis=1, keepdims=True))


def predict(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """All columns, ``lang_pred`` and ``score`` (the cosine with the language's profile, 0 at least) by the whole text.

    A text that is NULL or has no letter gets ``und`` and 0, and so do all without any profile. Of equal cosines the first
    language by name counts. Input columns of the two names are replaced. An empty table gives an empty result.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    names, vectors = profiles.names, profiles.vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            for piece in pieces(batch, batch.num_columns - 1):
                found, scores = _compared(reader, piece.column(piece.num_columns - 1), names, vectors)
                yield pa.record_batch([*piece.columns[:-1], pa.array(found, pa.string()), pa.array(scores)], names=[*(f.name for f in kept), "lang_pred", "score"])

    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(*[f.name for f in kept], F.col(text).alias("text to read")).mapInArrow(run, schema)


def _compared(reader: Reader, texts: pa.Array, names: list[str], vectors: np.ndarray) -> tuple[list[str], np.ndarray]:
    grams, owners, counts, lettered = reader.grams(texts)
    found, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not names or not len(grams):
        return found, scores
    distinct, place = np.unique(grams, return_inverse=True)
    table = reader.vectors(distinct)
    first = np.searchsorted(owners, np.arange(len(texts) + 1))
    counts = counts.astype(np.float32)
    for i in np.flatnonzero(lettered).tolist():
        a, b = first[i], first[i + 1]
        whole = np.zeros(DIMENSIONS, np.float32)
        for at in range(a, b, BLOCK):
            to = min(at + BLOCK, b)
            whole += counts[at:to] @ table[place[at:to]]
        length = np.linalg.norm(whole.astype(float))
        if length > 0:
            cosines = vectors @ whole.astype(float) / length
            best = int(cosines.argmax())
            found[i], scores[i] = names[best], min(1.0, max(0.0, float(cosines[best])))
    return found, scores


class Reader:
    """Turns texts into n-grams. A letter or mark is in lower case, anything else is a gap, and every text is between two.

    Symbols are numbered as they come, so numbers and n-grams are those of this reader; vectors follow from the letters.
    """

    def __init__(self) -> None:
        self.letters = [0]  # code point of each symbol; the first is the gap
        self.number = {0: 0}
        self.symbol = np.full(0x110000, -1, np.int32)  # of each code point; -1 not looked at yet
        self.letter = np.zeros(0x110000, bool)
        self.rotated: list[np.ndarray] = []

    def _look_up(self, points: np.ndarray) -> np.ndarray:
        symbols = self.symbol[points]
        if len(symbols) and symbols.min() < 0:
            for point in np.unique(points[symbols < 0]).tolist():
                kind = unicodedata.category(chr(point))[0]
                lower = ord(chr(point).lower()[0]) if kind in "LM" else 0
                if lower not in self.number:
                    self.number[lower] = len(self.letters)
                    self.letters.append(lower)
                self.letter[point] = kind == "L"
                self.symbol[point] = self.number[lower]
            symbols = self.symbol[points]
        return symbols

    def grams(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct n-grams of each text, ordered by text: n-gram, text, how often; and which texts hold a letter."""
        data, offsets = text_bytes(texts)
        # Counted in code points.
        begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        sizes = np.diff(begins)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        symbols = self._look_up(points)
        held = np.concatenate([[0], np.cumsum(self.letter[points])])
        lettered = held[begins[1:]] > held[begins[:-1]]
        # A gap before and after each text, and one for each run of gaps in it.
        number = np.arange(len(sizes), dtype=np.int32)
        owners = np.repeat(number, sizes + 2)
        line = np.zeros(len(owners), np.int32)
        between = np.ones(len(owners), bool)
        between[begins[:-1] + 2 * number] = between[begins[1:] + 2 * number + 1] = False
        line[between] = symbols
        solid = line > 0
        solid[1:] |= line[:-1] > 0
        solid[begins[:-1] + 2 * number] = True
        line, owners = line[solid], owners[solid]
        bits = self._bits()
        count = max(0, len(line) - GRAM + 1)
        grams = np.zeros(count, np.int64)
        for i in range(GRAM):
            grams = (grams << bits) | line[i : i + count]
        same = owners[:count] == owners[len(owners) - count :]
        grams, owners = grams[same], owners[:count][same].astype(np.int64)
        if GRAM * bits + len(sizes).bit_length() > 62:  # too wide for one key
            distinct, place = np.unique(grams, return_inverse=True)
            keys, counts = np.unique(owners * len(distinct) + place, return_counts=True)
            return distinct[keys % max(1, len(distinct))], keys // max(1, len(distinct)), counts, lettered
        keys = np.sort((owners << (GRAM * bits)) | grams)
        fresh = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        counts = np.diff(np.concatenate([fresh, [len(keys)]]))
        keys = keys[fresh]
        return keys & ((1 << (GRAM * bits)) - 1), keys >> (GRAM * bits), counts, lettered

    def _bits(self) -> int:
        return max(8, len(self.letters).bit_length())

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        """The vectors of n-grams as rows of -1 and 1: the product of the letters' vectors, the first rotated furthest."""
        if not self.rotated or len(self.rotated[0]) < len(self.letters):
            table = _letter_vectors(np.array(self.letters))
            self.rotated = [np.roll(table, GRAM - 1 - i, axis=1) for i in range(GRAM)]
        bits = self._bits()
        out = np.ones((len(grams), DIMENSIONS), np.int8)
        for i, table in enumerate(self.rotated):
            out *= table[(grams >> (bits * (GRAM - 1 - i))) & ((1 << bits) - 1)]
        return out.astype(np.float32)


def _letter_vectors(letters: np.ndarray) -> np.ndarray:
    words = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    bits = mix(mix(letters.astype(np.uint64) + np.uint64(1))[:, None] + words * np.uint64(0x9E3779B97F4A7C15))
    return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1
