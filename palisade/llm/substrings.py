"""Substring dedup by Rabin-Karp hashes of every fixed-length window of words."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from palisade.llm import chunks
from palisade.llm.arrays import Batch, covered, read_words, runs, window_hashes, window_places, word_hashes

# A word of running text takes about six bytes and starts one window of eight.
KEY_SHARE = 8 / 6


def remove_repeats(docs: DataFrame, window: int = 35, key: str = "doc_id", text: str = "text", layout: str = "words") -> DataFrame:
    """Remove every word covered by a window of ``window`` words whose sequence also starts anywhere else.

    Windows are judged on the input: all copies go, also those within one document. The result has all columns of
    ``docs``; ``text`` holds what is kept, and ``n_words``, ``n_removed`` and ``removed_spans`` (maximal runs of removed
    words as start and end, counted from 0) come on top and replace input columns of these names. With
    ``layout="words"`` the kept words are joined by one space; with ``"original"`` a text that loses nothing stays as it
    is and others lose the bytes of the removed runs and the blanks after them.

    NULL and empty texts have no words: the result is an empty text (with "original" NULL stays NULL). A repeated row is
    a repetition like any other, so its windows go from all its copies. Texts shorter than a window lose nothing. An
    empty table gives an empty table.
    """
    plan = chunks.layout(docs, text, KEY_SHARE)
    chunked = chunks.dealt(docs, key, text, plan)
    buckets = plan.buckets

    def hashes_of(table: pa.Table) -> tuple[Batch, np.ndarray, np.ndarray]:
        batch = read_words(table.column("text"))
        places = window_places(batch.first, window)
        return batch, places, window_hashes(word_hashes(batch), window)[places] if len(places) else np.zeros(0, np.uint64)

    def question(table: pa.Table) -> list[tuple[int, bytes]]:
        return chunks.ask_repeated(hashes_of(table)[2], buckets)

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        batch, places, hashes = hashes_of(table)
        repeated = chunks.read_repeated(hashes, replies, buckets)
        gone = covered(int(batch.first[-1]), places[repeated], window)
        kept, spans, counts = [], [], []
        valid = table.column("text").is_valid().to_numpy()
        for i in range(len(table)):
            a, b = batch.first[i], batch.first[i + 1]
            lost = gone[a:b]
            begins, ends = runs(lost)
            counts.append(int(lost.sum()))
            spans.append([{"start": s, "end": e} for s, e in zip(begins.tolist(), ends.tolist(), strict=True)])
            kept.append((_words if layout == "words" else _original)(batch, i, lost, begins, ends) if valid[i] or layout == "words" else None)
        return pa.table(
            {
                "row": table.column("row"),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                "n_words": pa.array(batch.counts(), pa.int64()),
                "n_removed": pa.array(counts, pa.int64()),
                "removed_spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            }
        )

    replies = chunks.answer(chunks.ask(chunked, question), chunks.reply_repeated)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType(
        [
            T.StructField("row", chunked.schema["row"].dataType),
            T.StructField("kept", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("removed_spans", T.ArrayType(span)),
        ]
    )
    done = chunked.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(cut, schema)
    added = ["n_words", "n_removed", "removed_spans"]
    return done.select(
        *[done["kept"].alias(text) if name == text else done["row"][name].alias(name) for name in docs.columns if name not in added],
        *added,
    )


def _words(batch: Batch, i: int, lost: np.ndarray, begins, ends) -> bytes:
    words = batch.text(i).split()
    return b" ".join(compress(words, ~lost) if len(begins) else words)


def _original(batch: Batch, i: int, lost: np.ndarray, begins, ends) -> bytes:
    """The text without the removed runs; a run takes the blanks after it along."""
    low, high = batch.offsets[i], batch.offsets[i + 1]
    first = batch.first[i]
    parts, at = [], low
    for begin, end in zip(begins, ends, strict=True):
        parts.append(batch.data[at : batch.starts[first + begin]].tobytes())
        at = batch.starts[first + end] if first + end < batch.first[i + 1] else high
    return b"".join([*parts, batch.data[at:high].tobytes()])
