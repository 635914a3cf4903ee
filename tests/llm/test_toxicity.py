from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from helpers import odd_docs, odd_rows, prose

from palisade.llm import toxicity

RUDE = ["blockhead", "numskull", "nincompoop", "dunderhead"]


def corpus(count=600):
    pick = random.Random(7)
    rows = []
    for n in range(count):
        text = prose(n, 60).split()
        if n % 5 == 0:
            for _ in range(pick.randrange(1, 4)):
                text.insert(pick.randrange(len(text)), pick.choice(RUDE) if n % 2 else "zornig" + prose(pick.randrange(10**6), 1))
        rows.append((n, " ".join(text)))
    return rows


def trained(spark, rows):
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows if i % 3], "doc_id bigint, toxic int")
    return toxicity.fit(odd_docs(spark, rows), labels)


def test_held_out_rows(spark):
    rows = corpus()
    found = toxicity.score(odd_docs(spark, rows), trained(spark, rows)).collect()
    wrong = [r.doc_id for r in found if r.doc_id % 3 == 0 and (r.score >= 0.3) != (r.doc_id % 5 == 0)]
    assert len(found) == len(rows) and len(wrong) <= 2


def test_one_word_at_the_end_of_a_long_text_counts(spark):
    model = trained(spark, corpus())
    docs = odd_docs(spark, [(1, prose(900, 50_000) + " You numskull!"), (2, prose(900, 50_000)), (3, "ZORNIGWORT")])
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert scores[1] > 0.3 and scores[2] < 0.3 and scores[3] > 0.3


def test_voters_that_repeat_each_other_count_once():
    rng = np.random.default_rng(1)
    toxic = rng.random(4000) < 0.2
    one = np.where(toxic, rng.random(4000) < 0.6, rng.random(4000) < 0.1)
    other = np.where(toxic, rng.random(4000) < 0.6, rng.random(4000) < 0.1)
    model, posterior = toxicity.label_model(np.column_stack([one, one, one, other]), toxic)
    assert sorted(model.parents[:3].tolist()).count(-1) <= 1
    assert abs(model.rates[1, 0, 3] - 0.6) < 0.1 and abs(model.rates[0, 0, 3] - 0.1) < 0.05
    assert posterior[toxic].mean() > 0.9 > 0.1 > posterior[~toxic].mean()


def test_oddities_and_empty_tables(spark):
    model = trained(spark, corpus())
    found = toxicity.score(odd_docs(spark), model)
    assert found.columns.count("score") == 1 and found.count() == len(odd_rows())
    assert all(0 <= r.score <= 1 for r in found.collect())
    assert toxicity.score(odd_docs(spark, []), model).count() == 0


def test_labels_that_teach_nothing(spark):
    rows = corpus(20)
    docs = odd_docs(spark, rows)
    for labels in ([], [(1, 0)], [(1, 1)], [(None, 1), (2, None)], [(1, 1), (1, 0), (10**9, 1)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        assert len({r.score for r in toxicity.score(docs, model).collect()}) == 1


def test_a_labelled_id_that_very_many_rows_have_is_one_of_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "settle", lambda df, purpose, real=toxicity.settle: seen.append((purpose, real(df, purpose))) or seen[-1][1])
    rows = [(1, f"vile text {i}") for i in range(3000)] + [(1, None), (2, "fine words"), (2, "fine words"), (3, "vile again"), (4, "good")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id bigint, toxic int")
    toxicity.fit(docs, labels)
    assert dict(seen)["sample"].count() == 4


def test_words_of_any_length_can_be_voters(spark):
    long = "x" * 100
    rows = [(i, f"{long} {prose(i, 10)}" if i % 2 else prose(i, 10)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, toxic int"))
    assert long in model.patterns
    assert toxicity.Votes(model.patterns)(f"a {long} b") >= {model.patterns.index(long)}


def plain_scores(rows, labels):
    """The whole method in plain loops: patterns, evidence, voters, label model with dependencies, classifier."""

    def patterns_of(text):
        words = set(re.findall(r"\w+", (text or "").lower()))
        return words | {f"{w[:n]}*" for w in words for n in range(3, 9) if n < len(w)}

    def odds(p, q):
        return math.log(p / q)

    texts = {i: t for i, t in rows}
    train = sorted(labels, key=lambda i: i)
    held, given = [patterns_of(texts[i]) for i in train], [labels[i] == 1 for i in train]
    toxic, clean = sum(given), len(given) - sum(given)
    counts = {}
    for patterns, bad in zip(held, given, strict=True):
        for p in patterns:
            counts.setdefault(p, [0, 0])[0 if bad else 1] += 1
    counts = {p: c for p, c in counts.items() if c[0] >= 2}
    least = max(toxicity.EVIDENCE, 2 * math.log(max(1, (len(counts) + 1) / toxicity.CHANCE)))

    def evidence(p, n):
        whole = toxic + clean
        return 2 * (p * math.log(p * whole / ((p + n) * toxic)) + (n * math.log(n * whole / ((p + n) * clean)) if n else 0.0))

    standing = {p: evidence(*c) for p, c in counts.items() if c[0] * clean > c[1] * toxic * 4}
    standing = sorted((p for p, e in standing.items() if e >= least), key=lambda p: (-standing[p], p))[: 20 * toxicity.VOTERS]
    covered = {f"{p.rstrip('*')[:n]}*" for p in standing for n in range(3, 9) if n < len(p.rstrip("*"))}
    covered = {b for b in covered if any(b != p and p.startswith(b[:-1]) and counts[p] == counts.get(b) for p in standing)} & set(standing)
    voters = [p for p in standing if p not in covered][: toxicity.VOTERS]
    sure = [evidence(*counts[p]) >= 2 * math.log(20 * toxicity.VOTERS) and counts[p][0] * clean > 20 * counts[p][1] * toxic for p in voters]
    votes = [[p in patterns for p in voters] for patterns in held]
    posterior = [0.95 if g else 0.05 for g in given]

    def information(a, b):
        total = 0.0
        for weights in ([1 - p for p in posterior], posterior):
            mass = sum(weights) + 1e-9
            cells = {(x, y): sum(w for w, v in zip(weights, votes, strict=True) if v[a] == x and v[b] == y) for x in (True, False) for y in (True, False)}
            one, other = cells[True, True] + cells[True, False], cells[True, True] + cells[False, True]
            for (x, y), joint in cells.items():
                sides = (one if x else mass - one) * (other if y else mass - other)
                if joint > 1e-9 and sides > 0:
                    total += joint * math.log(joint * mass / sides)
        return total

    parent, best, waiting, at = [-1] * len(voters), [-math.inf] * len(voters), set(range(len(voters))), 0
    while True:
        waiting.discard(at)
        if not waiting:
            break
        for v in waiting:
            if (shared := information(at, v)) > best[v]:
                best[v], parent[v] = shared, at
        at = max(sorted(waiting), key=lambda v: best[v])
    parent = [p if 2 * b >= toxicity.EVIDENCE else -1 for p, b in zip(parent, best, strict=True)]

    for _ in range(8):
        above = [[v[p] if p >= 0 else False for p in parent] for v in votes]
        rate, label_rate = {}, {}
        for kind in (False, True):
            weights = [p if kind else 1 - p for p in posterior]
            label_rate[kind] = (sum(w for w, g in zip(weights, given, strict=True) if g) + 0.1) / (sum(weights) + 0.2)
            for k in range(len(voters)):
                for vote in (False, True):
                    own = [(w, v[k]) for w, v, u in zip(weights, votes, above, strict=True) if u[k] == vote]
                    rate[kind, vote, k] = (sum(w for w, fired in own if fired) + 0.1) / (sum(w for w, _ in own) + 0.2)
        share = (sum(posterior) + 0.5) / (len(given) + 1)
        posterior = []
        for v, u, g in zip(votes, above, given, strict=True):
            total = odds(share, 1 - share) + (odds(label_rate[True], label_rate[False]) if g else odds(1 - label_rate[True], 1 - label_rate[False]))
            for k in range(len(voters)):
                one, zero = rate[True, u[k], k], rate[False, u[k], k]
                total += odds(one, zero) if v[k] else odds(1 - one, 1 - zero)
            posterior.append(1 / (1 + math.exp(-max(-50, min(50, total)))))

    def features(fired):
        certain = sum(f and s for f, s in zip(fired, sure, strict=True))
        return [*map(float, fired), float(certain > 0), float(certain > 1), 1.0]

    def plain_solve(matrix, vector):
        rows_ = [[*line, v] for line, v in zip(matrix, vector, strict=True)]
        for i in range(len(rows_)):
            top = max(range(i, len(rows_)), key=lambda r: abs(rows_[r][i]))
            rows_[i], rows_[top] = rows_[top], rows_[i]
            for r in range(len(rows_)):
                if r != i:
                    factor = rows_[r][i] / rows_[i][i]
                    rows_[r] = [x - factor * y for x, y in zip(rows_[r], rows_[i], strict=True)]
        return [line[-1] / line[i] for i, line in enumerate(rows_)]

    table = [features(v) for v in votes]
    width = len(table[0])
    weights, ridge = [0.0] * width, [0.05] * (width - 1) + [1e-6]
    for _ in range(25):
        chance = [1 / (1 + math.exp(-max(-30, min(30, sum(w * x for w, x in zip(weights, line, strict=True)))))) for line in table]
        slope = [sum(line[j] * (t - c) for line, t, c in zip(table, posterior, chance, strict=True)) - ridge[j] * weights[j] for j in range(width)]
        curve = [[sum(line[i] * line[j] * max(c * (1 - c), 1e-6) for line, c in zip(table, chance, strict=True)) + (ridge[i] if i == j else 0.0) for j in range(width)] for i in range(width)]
        change = plain_solve(curve, slope)
        most = max(map(abs, change))
        weights = [w + c * min(1.0, 4 / max(1e-9, most)) for w, c in zip(weights, change, strict=True)]
        if most < 1e-6:
            break
    found = {}
    for i, text in rows:
        patterns = patterns_of(text)
        total = sum(w * x for w, x in zip(weights, features([p in patterns for p in voters]), strict=True))
        found[i] = 1 / (1 + math.exp(-max(-500, min(500, total))))
    return voters, found


def test_scores_equal_plain_loops(spark):
    pick = random.Random(11)
    rows, labels = [], {}
    for i in range(160):
        bad = i % 3 == 0
        words = prose(i, 12).split()
        if bad and pick.random() < 0.9:
            words[pick.randrange(12)] = pick.choice(["vilest", "vilely", "nasty", "odious"])
            if pick.random() < 0.5:
                words[pick.randrange(12)] = "nasty"
        elif pick.random() < 0.05:
            words[0] = "nasty"
        rows.append((i, " ".join(words)))
        if i < 130:
            labels[i] = int(bad)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame(list(labels.items()), "doc_id bigint, toxic int"))
    voters, wanted = plain_scores(rows, labels)
    assert model.patterns == voters and len(voters) >= 3
    for row in toxicity.score(docs, model).collect():
        assert row.score == pytest.approx(wanted[row.doc_id], abs=1e-6)
