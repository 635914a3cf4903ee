from __future__ import annotations

import random

import public_tokenizers
import pytest
from helpers import odd_docs, odd_rows
from tokenizers import Tokenizer

from palisade.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "a b  \n\t'sé<|endoftext|>1٣\x1c\x85 　 😀漢\0 'll don't  x"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(library, texts):
    encoder = bpe.Encoder(PATH)
    ids, bounds = encoder.encode(texts)
    back = encoder.decode(ids, bounds).to_pylist()
    for n, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[bounds[n] : bounds[n + 1]].tolist() == want, text
        assert back[n] == library.decode(want, skip_special_tokens=False)


def test_random_texts_equal_the_library(library):
    pick = random.Random(1)
    same(library, ["".join(pick.choice(ALPHABET) for _ in range(pick.randrange(30))) for _ in range(5000)])


def test_special_and_odd_texts_equal_the_library(library):
    same(library, ["", " ", "  a ", "<|endoftext|>", "x<|endoftext|> y  <|endoftext|>", "a" * 5000, "ab" * 3000, "\n" * 50, "aaa aaaa aaaaa " * 40])


def test_every_character_equals_the_library(library):
    same(library, [f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in [*range(0xD800), *range(0xE000, 0x11000), *range(0x1F000, 0x20000)]])


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    encoder = bpe.Encoder(PATH)
    for text in ("one two three four", "five six", "one seven", ""):
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_oddities_and_round_trip(spark, library):
    rows = bpe.encode(odd_docs(spark), PATH, decoded=True)
    assert rows.columns.count("ids") == 1
    found = sorted((str(r.doc_id), r.decoded, r.n_tokens, len(r.ids)) for r in rows.collect())
    want = [(str(i), t or "", n := len(library.encode(t or "", add_special_tokens=False).ids), n) for i, t in odd_rows()]
    assert found == sorted(want)
    again = bpe.decode(rows.select("doc_id", "ids"), PATH)
    assert sorted(r.decoded for r in again.collect()) == sorted(t or "" for _, t in odd_rows())


def test_invalid_bytes_decode_as_in_the_library(spark, library):
    lists = [[i] for i in range(256)] + [[100, 200, 50], [], None]
    rows = spark.createDataFrame([(n, x) for n, x in enumerate(lists)], "n int, ids array<int>")
    for row in bpe.decode(rows, PATH).collect():
        assert row.decoded == library.decode(row.ids or [], skip_special_tokens=False)


def test_empty_table(spark):
    assert bpe.encode(odd_docs(spark, []), PATH).count() == 0


def test_text_left_out_or_under_another_name(spark):
    docs = odd_docs(spark)
    whole = bpe.encode(docs, PATH, decoded=True)
    short = bpe.encode(docs, PATH, decoded=True, keep_text=False)
    assert short.columns == [c for c in whole.columns if c != "text"]
    assert sorted(map(str, short.collect())) == sorted(map(str, whole.drop("text").collect()))
    # Texts in a column that the result replaces.
    named = bpe.encode(docs.select("doc_id", docs["text"].alias("decoded")), PATH, text="decoded", decoded=True)
    assert named.columns == ["doc_id", "ids", "n_tokens", "decoded"]
    assert sorted(map(str, named.select("doc_id", "ids").collect())) == sorted(map(str, whole.select("doc_id", "ids").collect()))
