from __future__ import annotations

import random

import numpy as np
import pytest

from palisade.llm import vectors


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string")


def wanted(rows, k):
    whole = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            whole.setdefault(len(v), []).append((i, [max(-(2**56), min(2**56, int(np.floor(1024 * float(np.float32(x)))))) for x in v]))
    out = []
    for same in whole.values():
        for q in {(i, tuple(v)) for i, v in same if i % 100 == 0}:
            found = sorted((-sum(a * b for a, b in zip(q[1], v, strict=True)), i) for i, v in same if i != q[0])[:k]
            out += [(q[0], n, i, -s) for n, (s, i) in enumerate(found, 1)]
    return sorted(out)


def found(spark, rows, k=10):
    whole = vectors.quantised(table(spark, rows))
    return sorted((q, r, i, int(s)) for q, r, i, s in vectors.top_k(whole, whole.filter("vec_id % 100 = 0"), k).collect())


def test_random_and_clustered_vectors_equal_brute_force(spark):
    pick = np.random.default_rng(3)
    centres = pick.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.1 * pick.normal(size=16)).tolist() if i % 3 else pick.normal(size=16).tolist(), "x") for i in range(6000)]
    assert found(spark, rows) == wanted(rows, 10)


def test_ties_repeats_and_invalid_rows(spark):
    pick = random.Random(2)
    same = [0.5, -0.25, 1.0]
    rows = [(i, same if i < 700 else [pick.choice([-0.5, 0.5]) for _ in range(3)], "x") for i in range(1000)]
    rows += [(2000, None, "x"), (2100, [1.0, None, 0.0], "x"), (2200, [float("nan"), 0.0, 0.0], "x"), (2300, [float("inf"), 0.0, 0.0], "x"), (None, same, "x")]
    rows += [(200, same, "x"), (3000, [], "x"), (3001, [], "x"), (4000, [1.0, 2.0], "x"), (4001, [2.0, 1.0], "x"), (5, same, "x")]
    assert found(spark, rows) == wanted(rows, 10)


@pytest.mark.parametrize("rows", [[], [(100, [1.0, 2.0], "x")], [(1, [1.0], "x")], [(100, [0.0, 0.0], "x"), (101, [0.0, 0.0], "x")]])
def test_small_tables(spark, rows):
    assert found(spark, rows) == wanted(rows, 10)


def test_nodes_hold_what_the_bounds_need(spark):
    pick = np.random.default_rng(4)
    rows = [(i, pick.normal(size=8).tolist(), "x") for i in range(3000)]
    pages = [r.asDict() for r in vectors.tree_pages(vectors.quantised(table(spark, rows))).collect()]
    assert sorted(i for p in pages for i in p["ids"]) == list(range(3000))
    by = {(p["tree"], p["page"]): p for p in pages}
    for p in pages:
        assert len(p["ids"]) <= vectors.PAGE
        assert not p["leaf"] or max(p["distances"]) <= p["radius"]
        if p["parent"] >= 0:
            above = by[p["tree"], p["parent"]]
            assert p["parent_distance"] == pytest.approx(float(np.linalg.norm(np.array(p["router"]) - np.array(above["router"]))))


def test_bounds_avoid_pages(monkeypatch):
    """On clustered data best-first search opens few leaves."""
    import pyarrow as pa

    pick = np.random.default_rng(5)
    centres = 1000 * pick.normal(size=(40, 8))
    whole = np.floor(centres[np.arange(8000) % 40] + pick.normal(size=(8000, 8))).astype(np.int64)
    rows = pa.table({"vec_id": pa.array(range(8000)), "vector": pa.array(whole.tolist(), pa.list_(pa.int64()))})
    pages = vectors._grown(0, 8, rows)
    tree = vectors._Tree(pages)
    opened = []
    tree.entries = type("Counted", (dict,), {"__getitem__": lambda self, k: opened.append(k) or dict.__getitem__(self, k)})(tree.entries)
    best = tree.nearest(-1, whole[7], 10)
    scores = whole @ whole[7]
    assert [s for s, _ in best] == sorted(scores.tolist(), reverse=True)[:10]
    assert len(opened) < len(tree.entries) / 4


def test_vectors_of_any_length_are_scored_exactly(spark):
    """Norms from 1 to 2**127 in one table; ties of huge scores differ in their last digits only."""
    pick = np.random.default_rng(6)
    rows = [(i, (pick.normal(size=5) * 2.0 ** (i % 50)).tolist(), "x") for i in range(900)]
    rows += [(1000 + i, [70000.0, 1.0, 0.0, float(i % 3), 0.0], "x") for i in range(20)]
    rows += [(2000 + i, [3e38 if i % 2 else -3e38, 2.0**40, float(i), 0.0, 1.0], "x") for i in range(20)]
    assert found(spark, rows) == wanted(rows, 10)


def test_query_of_a_table_with_long_vectors(spark, tmp_path):
    import duckdb

    from palisade.llm.queries import QUERIES
    from palisade.llm.sql import SQL

    pick = np.random.default_rng(7)
    rows = [(i, (pick.normal(size=3) * 2.0 ** pick.integers(0, 30)).tolist(), "x") for i in range(300)] + [(400, [70000.0, 1.0, 0.5], "x"), (401, [2.0**40] * 3, "x")]
    table(spark, rows).coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted(map(tuple, QUERIES["op10_top_k"](spark, str(tmp_path)).collect()))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert got == sorted(connection.execute(SQL["op10_top_k"]).fetchall())
    assert any(row[3] is None for row in got)
