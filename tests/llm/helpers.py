"""Inputs with every oddity that the operators define a result for, and plain Python versions of what they compute."""

from __future__ import annotations

import random
import re

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, chunk string, row int, bucket int, hash string, "
    "node bigint, score double, kept boolean, ids array<int>, n_words int, n_removed string, verdict int, shard string, n_shingles int"
)
EXTRA = ["x", 1, 2, "h", 5, 0.5, False, [1], 7, "z", 3, "s", 9]

WORDS = [a + b for a in "ka lo mi ru te sa no vi pe du".split() for b in "ran tel mos kip dun lar fen zu".split()]


def prose(seed: int, count: int) -> str:
    pick = random.Random(seed)
    return " ".join(f"{pick.choice(WORDS)}{pick.choice(WORDS)}" for _ in range(count))


def odd_rows() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, short ones, a very long one, repeated rows, ties, all blanks, copies and near copies."""
    base, passage = prose(1, 120), prose(2, 60)
    near = base.split()
    near[50] = "changed"
    words = prose(3, 200).split()
    return [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n\r\x0b\x0c "), (7, "one"), (8, "One"), (9, "two words"),
        (10, " ".join(words[:100]) + "\n\n" + passage + "\t" + " ".join(words[100:])), (11, prose(4, 30) + "  " + passage.upper().lower() + " . "),
        (None, base), (None, None), (12, prose(5, 60_000)), (13, "same " * 300), (14, "ünïcödé   ß 漢字 \U0001f600 " * 9), (15, prose(6, 34)), (16, prose(6, 35)),
        (17, prose(7, 80) + " " + prose(7, 80)), (18, prose(6, 35).upper()), (19, passage),
    ]


def odd_docs(spark, rows=None):
    rows = odd_rows() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *EXTRA) for i, t in rows], SCHEMA)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(sequence: list[str], size: int) -> set:
    if len(sequence) < size:
        return {tuple(sequence)} if sequence else set()
    return {tuple(sequence[i : i + size]) for i in range(len(sequence) - size + 1)}


def repeated_places(texts: list[str | None], size: int) -> list[set[int]]:
    """For each text the places of words covered by a window that occurs at least twice."""
    seen: dict = {}
    split = [words(t) for t in texts]
    for n, one in enumerate(split):
        for i in range(len(one) - size + 1):
            seen.setdefault(tuple(one[i : i + size]), []).append((n, i))
    places: list[set[int]] = [set() for _ in texts]
    for found in seen.values():
        if len(found) > 1:
            for n, i in found:
                places[n].update(range(i, i + size))
    return places


def components(sets: list[set], percent: int) -> list[int]:
    """For each set the first set that it reaches over links."""
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]
