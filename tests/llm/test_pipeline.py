from __future__ import annotations

import random
import re

import public_tokenizers
from conftest import SMALL
from helpers import components, lower, prose, repeated_places, shingles, words
from tokenizers import Tokenizer

import corpus_pipeline

RUDE = ["blockhead", "numskull", "nincompoop"]


def normal(text):
    return [w for w in re.split(r"[^\w]+|_", text.lower()) if w]


def make(spark, folder):
    pick = random.Random(3)
    item, passage = prose(500, 40), prose(501, 70)
    rows = []
    for n in range(240):
        text = prose(n, 100)
        if n % 6 == 0:
            place = pick.randrange(90)
            text = " ".join([*text.split()[:place], *pick.choices(RUDE, k=3), *text.split()[place:]])
        elif n % 20 == 1:
            text = f"{prose(n, 30)} {item} {prose(n + 1000, 30)}"
        elif n % 20 == 3:
            text = f"{prose(n, 40)}\n{passage}\n{prose(n + 1000, 40)}"
        elif n % 20 == 5:
            text = prose(n - 4, 60)  # a second text
        rows.append((n, text, "en", "s", len(text)))
    rows += [(300 + n, rows[n + 7][1].replace(" ", "  ", 1), "en", "s", 1) for n in (0, 60, 120)]
    rows += [(400, "", "en", "s", 0), (401, None, "en", "s", None), (400, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    labels = [(n, int(n % 6 == 0)) for n in range(240) if n % 4]
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, prose(999, 30))], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return [(i, t) for i, t, *_ in rows], item


def test_equals_brute_force(spark, tmp_path):
    rows, item = make(spark, str(tmp_path))
    rows = [(i, t) for i, t in rows if not set(words(t)) & set(RUDE)]
    rows.sort(key=lambda row: row[0])
    roots = components([shingles(words(lower(t)), 5) for _, t in rows], 80)
    rows = [row for n, row in enumerate(rows) if rows[roots[n]][0] == row[0]]
    cut = []
    for (i, t), gone in zip(rows, repeated_places([t for _, t in rows], 50), strict=True):
        cut.append((i, " ".join(w for n, w in enumerate(words(t)) if n not in gone) if gone else t))
    sought = shingles(normal(item), 5)
    cut = [(i, t) for i, t in cut if len(shingles(normal(t or ""), 5) & sought) < 0.8 * len(sought)]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, " ".join(words(r.decoded))) for r in found) == sorted((i, " ".join(words(t))) for i, t in cut)
    assert all(r.ids == library.encode(r.decoded, add_special_tokens=False).ids and r.n_tokens == len(r.ids) for r in found)
    assert 100 < len(found) < 200


def test_all_but_the_last_stage_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0
