from __future__ import annotations

import math
import random

import pytest
from helpers import components, lower, odd_docs, odd_rows, prose, shingles, words

from palisade.llm import near_duplicates as near
from palisade.llm.components import components as connected
from palisade.llm.near_duplicates import drop_near_duplicates, near_duplicates


def wanted(rows, size, percent):
    known = [(i, t) for i, t in rows if i is not None]
    known.sort(key=lambda row: row[0])
    sets = [shingles(words(lower(t)), size) for _, t in known]
    roots = components(sets, percent)
    found = [(i, len(s), known[r][0], known[r][0] == i) for (i, _), s, r in zip(known, sets, roots, strict=True)]
    return sorted(found + [(None, len(shingles(words(lower(t)), size)), None, True) for i, t in rows if i is None], key=str)


def test_every_oddity_equals_brute_force(spark):
    found = near_duplicates(odd_docs(spark), shingle=4).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found], key=str) == wanted(odd_rows(), 4, 80)


def test_chains_of_edits_equal_brute_force(spark):
    """Families whose members lie on both sides of the threshold, in one order and another."""
    pick = random.Random(5)
    rows = []
    for family in range(6):
        base = prose(family, 150).split()
        for _ in range(40):
            text = list(base)
            for _ in range(pick.randrange(0, 9)):
                text[pick.randrange(len(text))] = prose(pick.randrange(10**6), 1)
            rows.append((pick.randrange(10**9), " ".join(text)))
    found = near_duplicates(odd_docs(spark, rows), shingle=4).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found], key=str) == wanted(rows, 4, 80)


def test_dropping_keeps_one_of_each_group_and_all_columns(spark):
    docs = odd_docs(spark)
    kept = drop_near_duplicates(docs, shingle=5)
    assert set(kept.columns) == set(docs.columns)
    assert {r.doc_id for r in kept.collect()} == {i for i, _, _, keep in wanted(odd_rows(), 5, 80) if keep}


def test_empty_table(spark):
    assert near_duplicates(odd_docs(spark, [])).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.range(1, 200).selectExpr("id AS a", "id - 1 AS b").unionAll(spark.createDataFrame([(500, 400), (400, 500), (7, 7), (None, 3)], "a bigint, b bigint"))
    found = {r.node: r.component for r in connected(links).collect()}
    assert found == {**{n: 0 for n in range(200)}, 400: 400, 500: 400}


@pytest.mark.parametrize("percent", [20, 50, 80, 95])
def test_sketch_and_bands_keep_their_stated_chances(percent):
    differs = (1 - percent / 100) / 2
    most = near._sketch_differences(percent)
    tail = sum(math.comb(128, i) * differs**i * (1 - differs) ** (128 - i) for i in range(most + 1, 129))
    assert tail <= 1e-8
    rows = near._band_rows(percent)
    assert (1 - (percent / 100) ** rows) ** (128 // rows) <= 1e-7


def test_low_thresholds_lose_no_links(spark):
    # Two sets of 60 and 60 words that share 42: a similarity of 42 in 78.
    rows = []
    for n in range(60):
        own = [f"w{n}x{i}" for i in range(78)]
        rows += [(2 * n, " ".join(own[:60])), (2 * n + 1, " ".join(own[18:]))]
    found = near.near_duplicates(odd_docs(spark, rows), shingle=1, percent=50).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i - i % 2 for i, _ in rows}


def test_texts_of_one_template_are_no_candidates_unless_linked(spark, monkeypatch):
    """Sixty words that all share and some of their own: 10 are too many for a link, and 7 make one."""
    counted = []
    whole = near._across
    monkeypatch.setattr(near, "_across", lambda *args: counted.append(whole(*args)) or counted[-1])
    frame = " ".join(f"t{i}" for i in range(60))
    for size in (400, 1600):
        far = [(n, frame + "".join(f" own{n}x{i}" for i in range(10))) for n in range(size)]
        found = near_duplicates(odd_docs(spark, far)).collect()
        assert all(r.component_id == r.doc_id for r in found) and counted[-1].count() < size
    close = [(n, frame + "".join(f" own{n}x{i}" for i in range(7))) for n in range(60)]
    assert {r.component_id for r in near_duplicates(odd_docs(spark, close)).collect()} == {0}


def test_keys_with_several_texts_lose_no_link(spark):
    """A key with a long and a short text, and copies of either with some words changed; also texts with equal sets."""
    pick = random.Random(11)
    rows = []
    for family in range(12):
        for part, length in enumerate((40, 170)):
            base = prose(50 * family + part, length).split()
            rows.append((1000 * family, " ".join(base)))
            rows.append((1000 * family, "  ".join(base)))
            for copy in range(12):
                text = list(base)
                for _ in range(pick.randrange(0, 5)):
                    text[pick.randrange(len(text))] = prose(pick.randrange(10**6), 1)
                rows.append((1000 * family + 100 * (part + 1) + copy, " ".join(text)))
    nodes = sorted({i for i, _ in rows})
    sets = [(i, shingles(words(lower(t)), 4)) for i, t in rows]
    root = {i: i for i in nodes}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, one in sets:
        for j, other in sets:
            if i != j and 100 * len(one & other) >= 80 * len(one | other):
                low, high = sorted((top(i), top(j)))
                root[high] = low
    found = near_duplicates(odd_docs(spark, rows), shingle=4).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(i, top(i)) for i in nodes}
