from __future__ import annotations

import re

from helpers import odd_docs, odd_rows, prose, shingles

import corpus_pipeline
from palisade.llm.decontamination import contaminated, drop_contaminated
from palisade.llm.queries import QUERIES


def normal(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def items_of(spark):
    base = prose(1, 120).split()
    part = prose(3, 200).split()[20:60]
    edited = list(part)
    edited[20] = "other"
    rows = [
        (1, " ".join(base[10:40])), (2, " ".join(part).upper() + "!"), (3, " ".join(edited)), (4, prose(99, 40)), (5, None), (6, ""), (7, "one"), (8, "two, words"),
        (9, prose(2, 60)), (9, prose(2, 60)), (None, prose(2, 60)), (10, prose(5, 60_000)), (11, "same same same same same"), (12, prose(7, 3)),
    ]
    return rows, spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id bigint, text string, hash string, n int")


def test_every_oddity_equals_brute_force(spark):
    items, table = items_of(spark)
    want = set()
    for i, text in odd_rows():
        held = shingles(normal(text), 5)
        for item, asked in items:
            sought = shingles(normal(asked), 5)
            if i is not None and item is not None and sought and len(held & sought) >= 0.8 * len(sought):
                want.add((i, item, len(sought), len(held & sought)))
    found = contaminated(odd_docs(spark), table).collect()
    assert sorted((r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in found) == sorted(want)
    assert len(want) > 8


def test_dropping_keeps_clean_documents_and_columns(spark):
    _, table = items_of(spark)
    docs = odd_docs(spark)
    gone = {r.doc_id for r in contaminated(docs, table).collect()}
    kept = drop_contaminated(docs, table)
    assert set(kept.columns) == set(docs.columns)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in odd_rows() if i not in gone)


def test_empty_tables(spark):
    _, table = items_of(spark)
    assert contaminated(odd_docs(spark, []), table).count() == 0
    assert contaminated(odd_docs(spark), table.limit(0)).count() == 0


def test_no_python(spark, plan):
    _, table = items_of(spark)
    shown = plan(contaminated(odd_docs(spark), table))
    assert not any(node in shown for node in ("InArrow", "EvalPython", "InPandas"))


def test_short_items_are_found_inside_longer_documents(spark, tmp_path):
    docs = [
        (1, prose(1, 50) + " alpha Beta\ngamma, DELTA! " + prose(2, 50)), (2, "alpha beta"), (3, "x Alpha"), (4, prose(3, 50)), (5, None), (6, "x alpha beta gamma"),
        (7, "alpha beta gamma delta epsilon"), (8, "beta alpha beta alpha beta"), (9, "alphabeta gamma"),
    ]
    items = [(1, "Alpha beta gamma delta"), (2, "beta, gamma"), (3, "alpha"), (4, "beta alpha"), (5, prose(2, 20)), (6, ""), (7, "gamma beta alpha")]
    odd_docs(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = set()
    for i, text in docs:
        for item, asked in items[:4] + items[6:]:
            held, sought = normal(text), normal(asked)
            if any(held[at : at + len(sought)] == sought for at in range(len(held))):
                want.add((i, item, 1, 1))
    want.add((1, 5, 16, 16))
    found = QUERIES["op2_decontamination"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in found) == sorted(want)
    kept = corpus_pipeline.without_benchmark(spark, odd_docs(spark, docs), str(tmp_path)).collect()
    assert sorted(r.doc_id for r in kept) == [4, 5, 9]


def test_each_text_of_an_item_counts_by_itself(spark):
    short, long = prose(11, 10), prose(12, 60)
    items = spark.createDataFrame([(1, short), (1, long), (1, short), (2, long), (2, "")], "item_id bigint, text string")
    found = contaminated(odd_docs(spark, [(1, short + " " + prose(13, 30)), (2, long), (3, prose(13, 30))]), items).collect()
    assert sorted((r.doc_id, r.item_id, r.n_item_shingles, r.n_shared, r.containment) for r in found) == [(1, 1, 6, 6, 1.0), (2, 1, 56, 56, 1.0), (2, 2, 56, 56, 1.0)]
