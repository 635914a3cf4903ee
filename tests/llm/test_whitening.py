from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import SMALL

from palisade.llm import whitening
from palisade.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, component string, width int, place int, x string, n string, deviation int, weight int"
EXTRA = ["c", 1, 2, "x", "n", 3, 4]


def table(spark, rows):
    return spark.createDataFrame([(i, v, *EXTRA) for i, v in rows], SCHEMA)


def whole(vector):
    return tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector)


def valid(vector):
    return vector is not None and all(c is not None and np.isfinite(np.float32(c)) for c in vector)


def reference(vectors, weights, components):
    """Mean, covariance and components of whole-number vectors in plain steps: sums as Python integers."""
    n = sum(weights)
    sums = [sum(w * v[d] for v, w in zip(vectors, weights, strict=True)) for d in range(len(vectors[0]))]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in vectors])
    covariance = (centred * np.array(weights, float)[:, None]).T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in vectors]
    return n, centred, covariance, values[order], directions[:, order], deviations


def check(spark, rows, weights="one", components=16):
    found = whitening.whiten(whitening.whole_vectors(table(spark, rows)), weights, components).collect()
    by_width = {}
    for i, v in rows:
        if valid(v) and len(v):
            by_width.setdefault(len(v), []).append((i, whole(v)))
    assert len(found) == sum(len(own) * min(components, width) for width, own in by_width.items())
    for width, own in by_width.items():
        counts = {}
        for _, x in own:
            counts[x] = counts.get(x, 0) + 1
        distinct = list(counts)
        n, centred, covariance, values, directions, deviations = reference(distinct, [counts[x] if weights == "counts" else 1 for x in distinct], components)
        place = {x: k for k, x in enumerate(distinct)}
        got = {}
        for row in found:
            if len(row.x) == width:
                got.setdefault((row.vec_id, tuple(row.x)), []).append(row)
        assert got.keys() == set(own)
        trace = float(np.trace(covariance))
        for (i, x), lines in got.items():
            repeats = own.count((i, x))
            assert sorted(row.component for row in lines) == sorted(list(range(1, min(components, width) + 1)) * repeats)
            for row in lines:
                k = row.component - 1
                assert row.n == n and int(row.deviation) == deviations[place[x]]
                assert row.explained == pytest.approx(values[k] / trace if trace else 0.0, rel=1e-4, abs=1e-9)
                wanted = centred[place[x]] @ directions[:, k] / math.sqrt(values[k]) if values[k] > 1e-9 * max(trace, 1e-300) else 0.0
                assert abs(abs(row.whitened) - abs(wanted)) < 1e-6
                assert row.identity_error < 1e-6
                assert row.embedding is not None and row.weight == 4
    return found


def oddities(seed, count, width):
    pick = np.random.default_rng(seed)
    rows = [(i, (pick.normal(size=width) * (1 + np.arange(width))).astype(np.float32).tolist()) for i in range(count)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(3, rows[3][1])] * 2 + [(None, rows[4][1])]
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * (width - 2)), (2002, [float("nan")] * width), (2003, [float("inf")] + [0.0] * (width - 1)), (2004, [])]
    return rows + [(3000 + i, [float(i), float(-i * i)]) for i in range(5)] + [(3100, [7.0])]


@pytest.mark.parametrize("weights", ["one", "counts"])
def test_equals_brute_force(spark, weights):
    check(spark, oddities(1, 300, 6), weights, 4)


def test_sixteen_components_of_more_dimensions(spark):
    check(spark, oddities(2, 400, 20))


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 1.0])], [(1, [0.5, 1.0]), (2, [0.5, 1.0])], [(1, []), (2, None)], [(1, [1.0, 2.0]), (2, [3.0, 6.0])]])
def test_small_and_flat_tables(spark, rows):
    check(spark, rows)


def test_huge_entries_stay_exact(spark):
    rows = [(i, [float(2**40 * i), float(i)]) for i in range(6)] + [(9, [3e38, -3e38])]
    found = whitening.whiten(whitening.whole_vectors(table(spark, rows))).collect()
    assert len(found) == 14
    xs = [list(r.x) for r in found if r.component == 1]
    assert max(abs(c) for x in xs for c in x) <= 1 << 62
    sums = [sum(x[d] for x in xs) for d in (0, 1)]
    for row in found:
        exact = sum((7 * c - s) ** 2 for c, s in zip(row.x, sums, strict=True))
        assert (row.deviation is None) == (exact >= 10**38)
        assert row.deviation is None or int(row.deviation) == exact


def test_query_whitens_the_whole_table(spark):
    rows = QUERIES["op11_whitening"](spark, SMALL).collect()
    vectors = {r.vec_id: whole(r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect() if valid(r.embedding)}
    assert len(rows) == 16 * len(vectors)
    distinct = list(dict.fromkeys(vectors.values()))
    n, centred, covariance, values, directions, deviations = reference(distinct, [1] * len(distinct), 16)
    place = {x: k for k, x in enumerate(distinct)}
    projected = centred @ directions / np.sqrt(values)
    signs = {}
    for row in rows:
        k, at = row.component - 1, place[vectors[row.vec_id]]
        assert (row.n, row.deviation, int(row.deviation_exact)) == (n, deviations[at], deviations[at])
        assert row.explained == pytest.approx(values[k] / np.trace(covariance), rel=1e-4)
        if abs(projected[at, k]) > 0.01:
            signs.setdefault(k, set()).add(np.sign(row.whitened * projected[at, k]))
        assert abs(row.whitened) == pytest.approx(abs(projected[at, k]), abs=1e-6)
        assert row.identity_error < 1e-4
    assert all(len(s) == 1 for s in signs.values())


def test_a_vector_that_many_rows_hold_is_whitened_once(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(5000)] + [(9000 + i, [float(i % 7), float(i % 5), float(i)]) for i in range(200)]
    distinct = whitening.distinct_vectors(whitening.whole_vectors(table(spark, rows)), "counts")
    assert sorted(r.weight for r in distinct.collect())[-1] == 5000
    assert distinct.count() <= 201
    check(spark, rows, "counts")
