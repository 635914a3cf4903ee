"""The registered queries: against their SQL on the smallest tables, and where there is none against brute force."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from check_oracle import compare, connect
from conftest import SMALL
from tokenizers import Tokenizer

import __spark_entry__ as entry
from palisade.llm.queries import QUERIES
from palisade.llm.sql import SQL


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, connection, name):
    rows, difference = compare(spark, connection, name, SMALL)
    assert difference is None
    assert rows > 0


def test_bpe_equals_the_tokenizers_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = {row.doc_id: row for row in QUERIES["op8_bpe"](spark, SMALL).collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == digest(",".join(map(str, ids)))
        assert found[i].decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False))


def test_toxicity_on_held_out_labels(spark):
    folder = SMALL.replace("sf0.001", "sf0.1")
    labels = {row.doc_id: row.toxic for row in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op4_toxicity"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in rows)
    held = [(row.predicted, labels[row.doc_id]) for row in rows if row.held_out and row.doc_id in labels]
    hits = sum(p and t for p, t in held)
    assert len(held) > 500
    # Some labels of this table stand on texts that hold no sign of toxicity.
    assert hits / sum(t for _, t in held) > 0.85
    assert hits / sum(p for p, _ in held) > 0.9
