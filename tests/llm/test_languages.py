from __future__ import annotations

import unicodedata

import numpy as np
import pytest
from conftest import SMALL
from helpers import SCHEMA, odd_docs, odd_rows

from palisade.llm import languages
from palisade.llm.queries import QUERIES

ENGLISH = "the quick brown fox and the lazy dog that was there with them when they had this thing"
GERMAN = "der schnelle braune fuchs und der faule hund die nicht schlafen konnten weil es schön war"
GREEK = "η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και τρέχει μακριά"


def plain_vector(text):
    """Letter by letter and n-gram by n-gram."""
    line = [0]
    for c in text:
        kind = unicodedata.category(c)[0]
        symbol = ord(c.lower()[0]) if kind in "LM" else 0
        if symbol or line[-1]:
            line.append(symbol)
    if line[-1]:
        line.append(0)
    elif len(line) == 1:
        line.append(0)
    total = np.zeros(languages.DIMENSIONS)
    for i in range(len(line) - 2):
        gram = np.ones(languages.DIMENSIONS)
        for k in range(3):
            gram *= np.roll(languages._letter_vectors(np.array([line[i + k]]))[0].astype(float), 2 - k)
        total += gram
    return total


def plain_predictions(train, texts):
    profiles = {}
    for lang, text in train:
        if lang is not None and text is not None:
            profiles[lang] = profiles.get(lang, 0) + plain_vector(text)
    profiles = {k: v for k, v in profiles.items() if np.any(v)}
    out = []
    for text in texts:
        if text is None or not any(unicodedata.category(c)[0] == "L" for c in text) or not profiles:
            out.append(("und", 0.0))
            continue
        own = plain_vector(text)
        cosines = {k: float(own @ v / np.linalg.norm(own) / np.linalg.norm(v)) for k, v in profiles.items()}
        best = max(sorted(cosines), key=lambda k: cosines[k])
        out.append((best, min(1.0, max(0.0, cosines[best]))))
    return out


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, "c", 1, 1, "h", 1, 0.5, True, [1], 1, "r", 1, "sh", 1) for i, lang, t in rows], SCHEMA)


def test_equals_plain_sums_and_cosines(spark):
    train = [(1, "en", ENGLISH), (2, "de", GERMAN), (3, "el", GREEK), (4, None, GERMAN), (5, "en", None), (6, "en", ENGLISH.upper()), (7, "de", "")]
    profiles = languages.fit(docs(spark, train))
    assert profiles.names == ["de", "el", "en"]
    texts = [ENGLISH[:40], GERMAN[10:60], GREEK[5:30], None, "", " \n", "12 34 !", "x", "É", "漢字かな", "a" * 5000, "the " * 3000, "नमस्ते दुनिया", "\0the\0dog\0", "ΟΔΟΣ"]
    found = languages.predict(docs(spark, [(i, "zz", t) for i, t in enumerate(texts)]), profiles).orderBy("doc_id").collect()
    for row, (lang, score) in zip(found, plain_predictions([(lang, t) for _, lang, t in train], texts), strict=True):
        assert row.lang_pred == lang
        assert row.score == pytest.approx(score, abs=1e-5)


def test_odd_rows_each_get_an_answer(spark):
    profiles = languages.fit(docs(spark, [(1, "en", ENGLISH), (2, "de", GERMAN)]))
    given = odd_docs(spark)
    found = languages.predict(given, profiles)
    assert set(found.columns) == set(given.columns) | {"lang_pred"}
    rows = found.collect()
    assert len(rows) == len(odd_rows())
    for row in rows:
        letters = any(unicodedata.category(c)[0] == "L" for c in row.text or "")
        assert (row.lang_pred == "und") == (not letters)
        assert 0 <= row.score <= 1


def test_nothing_to_learn_from_and_empty_tables(spark):
    empty = docs(spark, [])
    assert languages.fit(empty).names == []
    assert languages.fit(docs(spark, [(1, "en", "12 !"), (2, None, ENGLISH)])).names != ["de"]
    found = languages.predict(docs(spark, [(1, "en", ENGLISH)]), languages.fit(empty)).first()
    assert (found.lang_pred, found.score) == ("und", 0.0)
    assert languages.predict(empty, languages.fit(empty)).count() == 0


def test_equal_profiles_go_to_the_first_name(spark):
    profiles = languages.fit(docs(spark, [(1, "b", ENGLISH), (2, "a", ENGLISH)]))
    assert languages.predict(docs(spark, [(3, "", ENGLISH[:30])]), profiles).first().lang_pred == "a"


def test_scripts_with_very_many_letters(spark):
    """More symbols than fit one key with the texts' numbers."""
    reader = languages.Reader()
    import pyarrow as pa

    everything = "".join(chr(c) for c in range(0x20, 0x30000) if unicodedata.category(chr(c))[0] == "L")
    reader.grams(pa.array([everything]))
    texts = [ENGLISH, GREEK, None, "漢字 かな", everything[50_000:50_400]] * 3000
    grams, owners, counts, lettered = reader.grams(pa.array(texts))
    small = languages.Reader()
    for i in (0, 1, 3, 4):
        own = owners == i
        expected = plain_vector(texts[i])
        assert np.array_equal(counts[own] @ reader.vectors(grams[own]).astype(float), expected)
        g, _, c, _ = small.grams(pa.array([texts[i]]))
        assert np.array_equal(c @ small.vectors(g).astype(float), expected)
    assert lettered.tolist() == [True, True, False, True, True] * 3000


def test_accuracy_on_held_out_documents(spark):
    folder = SMALL.replace("sf0.001", "sf0.1")
    known = {row.doc_id: row.lang for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op12_language"](spark, folder).collect()
    assert len(rows) == len(known)
    held = [row for row in rows if row.held_out and known[row.doc_id] is not None]
    assert len(held) > 2000
    assert sum(row.lang_pred == known[row.doc_id] for row in held) / len(held) > 0.995
