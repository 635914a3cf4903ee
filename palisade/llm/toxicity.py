"""Toxicity by weak supervision.

Voters are words and word beginnings. A generative model of their votes and of the labels estimates how often each voter
fires on toxic and on clean text and which voters depend on each other; a linear classifier is trained on its posterior.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.session import settle

# Bounds of the training sample, in rows of each label, and of the model.
TOXIC_ROWS = 4_000
CLEAN_ROWS = 8_000
VOTERS = 300
PREFIXES = range(3, 9)
# Least of twice the log-likelihood ratio of a pattern against none (chance of 0.001 for one pattern); with more patterns
# the bound rises so that about ``CHANCE`` of them pass without meaning anything.
EVIDENCE = 10.8
CHANCE = 5

# A task hands on what it has counted when it holds so many patterns.
HELD_PATTERNS = 300_000

WORD = re.compile(r"\w+")


@dataclass
class LabelModel:
    """Share of toxic texts, and for each voter how often it fires by class and by the vote of the voter it depends on."""

    share: float
    parents: np.ndarray  # of each voter, -1 for none
    rates: np.ndarray  # [class, vote of the parent, voter]
    label_rates: np.ndarray  # how often the given label is 1, by class


@dataclass
class Model:
    """Patterns (a trailing * marks a beginning) and the classifier's weights: one each, then any, several, constant."""

    patterns: list[str] = field(default_factory=list)
    strong: list[bool] = field(default_factory=list)
    weights: list[float] = field(default_factory=lambda: [0.0, 0.0, 0.0])
    labels: LabelModel | None = None


class Votes:
    """Finds a model's patterns in a text."""

    def __init__(self, patterns: list[str]):
        self.words = {p: i for i, p in enumerate(patterns) if not p.endswith("*")}
        self.beginnings = {p[:-1]: i for i, p in enumerate(patterns) if p.endswith("*")}
        self.lengths = sorted({len(b) for b in self.beginnings})
        self.heads = {p[: min(PREFIXES)] for p in patterns}
        self.head = min(PREFIXES)

    def __call__(self, text: str) -> set[int]:
        found = set()
        heads, head = self.heads, self.head
        for word in {w for w in set(WORD.findall(text.lower())) if w[:head] in heads}:
            if word in self.words:
                found.add(self.words[word])
            for length in self.lengths:
                if length < len(word) and word[:length] in self.beginnings:
                    found.add(self.beginnings[word[:length]])
        return found


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Train on the labelled rows given, of which at most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` are used, in the order of a hash.

    Rows without key or label are left out; a key that is labelled more than once counts as toxic if one label says so. Of a
    key that several documents have, one text counts, the first by hash, so the bounds hold for the rows of the sample too.
    NULL texts count as empty. Without toxic or without clean rows the model knows no pattern and scores all texts alike.
    """
    marked = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(label).alias("toxic"))
    order = F.md5(F.col("id").cast("string"))
    chosen = [marked.filter(F.col("toxic") == value).orderBy(order).limit(rows) for value, rows in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))]
    chosen = F.broadcast(chosen[0].unionAll(chosen[1]))  # bounded by the two limits
    texts = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    one = texts.join(chosen, "id").groupBy("id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    sample = settle(one.select("id", "text", "toxic"), "sample")

    toxic, clean, counts = _pattern_counts(sample)
    if not toxic or not clean:
        rate = math.log((toxic + 0.5) / (clean + 0.5))
        return Model(weights=[0.0, 0.0, rate])
    patterns, strong = _voters(counts, toxic, clean)
    fires, given = _votes(sample, patterns)
    labelled, posterior = label_model(fires, given)
    weights = _classifier(_features(fires, np.array(strong, bool)), posterior)
    return Model(patterns, strong, weights.tolist(), labelled)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """All columns and ``name``: the probability that the whole text is toxic. NULL counts as empty. A column called
    ``name`` is replaced."""
    kept = [f for f in docs.schema.fields if f.name != name]
    patterns, strong, weights = model.patterns, np.array(model.strong, bool), np.array(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = Votes(patterns)
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for i, value in enumerate(batch.column(batch.num_columns - 1)):
                hits = list(votes(value.as_py() or ""))
                sure = int(strong[hits].sum()) if hits else 0
                total = weights[hits].sum() + weights[-3] * (sure > 0) + weights[-2] * (sure > 1) + weights[-1]
                scores[i] = 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))
            yield pa.record_batch([*batch.columns[:-1], pa.array(scores)], names=[*(f.name for f in kept), name])

    schema = T.StructType([*kept, T.StructField(name, T.DoubleType())])
    return docs.select(*[f.name for f in kept], F.col(text).alias("text to score")).mapInArrow(run, schema)


def _pattern_counts(sample: DataFrame) -> tuple[int, int, list]:
    """Numbers of toxic and clean rows, and the patterns that stand out with the rows of either kind that hold them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                seen = {""}
                for word in set(WORD.findall(text.lower())):
                    seen.add(word)
                    seen.update(f"{word[:length]}*" for length in PREFIXES if length < len(word))
                found[int(toxic == 1)].update(seen)
                if len(found[0]) + len(found[1]) > HELD_PATTERNS:
                    yield from counts(found)
                    found = (Counter(), Counter())
        yield from counts(found)

    def counts(found: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
        patterns = list(found[1].keys() | found[0].keys())
        for at in range(0, len(patterns), 50_000):
            part = patterns[at : at + 50_000]
            yield pa.record_batch([pa.array(part), *[pa.array([found[kind][p] for p in part], pa.int64()) for kind in (1, 0)]], names=["pattern", "toxic", "clean"])

    counted = sample.mapInArrow(count, "pattern string, toxic bigint, clean bigint").groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = settle(counted.filter("toxic >= 2 OR pattern = ''"), "patterns")
    tested = counted.count()
    whole = counted.filter("pattern = ''").first()
    toxic, clean = (whole["toxic"], whole["clean"]) if whole else (0, 0)
    if not toxic or not clean:
        return toxic, clean, []
    p, n, all_rows = F.col("toxic"), F.col("clean"), float(toxic + clean)
    evidence = 2 * (p * F.log(p * all_rows / ((p + n) * toxic)) + F.when(n > 0, n * F.log(n * all_rows / ((p + n) * clean))).otherwise(0.0))
    least = max(EVIDENCE, 2 * math.log(max(1, tested / CHANCE)))
    standing = counted.filter((p >= 2) & (p * clean > n * toxic * 4)).withColumn("evidence", evidence).filter(F.col("evidence") >= least)
    return toxic, clean, standing.orderBy(F.desc("evidence"), "pattern").limit(20 * VOTERS).collect()


def _voters(counts: list, toxic: int, clean: int) -> tuple[list[str], list[bool]]:
    """The patterns with the most evidence. Of beginnings held by the same rows the longest stands for all."""
    held = {row["pattern"]: (row["toxic"], row["clean"]) for row in counts}
    longer = set()
    for pattern, rows in held.items():
        word = pattern.rstrip("*")
        for length in range(min(PREFIXES), len(word) + (pattern[-1] != "*")):
            if length < len(word) and held.get(f"{word[:length]}*") == rows:
                longer.add(f"{word[:length]}*")
    best = [row for row in counts if row["pattern"] not in longer][:VOTERS]
    sure = 2 * math.log(max(2, 20 * VOTERS))
    return [row["pattern"] for row in best], [row["evidence"] >= sure and row["toxic"] * clean > 20 * row["clean"] * toxic for row in best]


def _votes(sample: DataFrame, patterns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Votes of the sample's rows (at most ``TOXIC_ROWS + CLEAN_ROWS`` by ``VOTERS``) and their labels."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = Votes(patterns)
        for batch in batches:
            hits = [sorted(votes(text)) for text in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(hits, pa.list_(pa.int32())), batch.column(2).cast(pa.int32())], names=["id", "hits", "toxic"])

    rows = sample.mapInArrow(vote, "id bigint, hits array<int>, toxic int").collect()
    rows.sort(key=lambda row: (row["id"], row["hits"]))
    fires = np.zeros((len(rows), len(patterns)), bool)
    for i, row in enumerate(rows):
        fires[i, row["hits"]] = True
    return fires, np.array([row["toxic"] == 1 for row in rows], bool)


def label_model(fires: np.ndarray, given: np.ndarray, rounds: int = 8) -> tuple[LabelModel, np.ndarray]:
    """Fit the generative model by expectation maximisation; the given label is one more, imperfect voter.

    Each voter may depend on one other: the edges are those of the heaviest tree by mutual information given the class, as
    the labels have it, that pass a test, so that voters who repeat each other aren't counted twice. Returns the model and
    each row's probability of being toxic.
    """
    rows, voters = fires.shape
    votes = fires.astype(np.float64)
    posterior = np.where(given, 0.95, 0.05)
    parents = _dependencies(votes, posterior)
    for _ in range(rounds):
        above = np.where(parents >= 0, votes[:, parents], 0.0)
        rates = np.empty((2, 2, voters))
        label_rates = np.empty(2)
        for kind, weight in ((0, 1 - posterior), (1, posterior)):
            for vote in (0, 1):
                base = weight[:, None] * (above if vote else 1 - above)
                rates[kind, vote] = ((base * votes).sum(0) + 0.1) / (base.sum(0) + 0.2)
            label_rates[kind] = ((weight * given).sum() + 0.1) / (weight.sum() + 0.2)
        share = (posterior.sum() + 0.5) / (rows + 1)
        odds = np.full(rows, math.log(share / (1 - share)))
        odds += np.where(given, math.log(label_rates[1] / label_rates[0]), math.log((1 - label_rates[1]) / (1 - label_rates[0])))
        for vote in (0, 1):
            held = above if vote else 1 - above
            fire, rest = np.log(rates[1, vote] / rates[0, vote]), np.log((1 - rates[1, vote]) / (1 - rates[0, vote]))
            odds += (held * np.where(fires, fire, rest)).sum(1)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return LabelModel(float(share), parents, rates, label_rates), posterior


def _dependencies(votes: np.ndarray, posterior: np.ndarray) -> np.ndarray:
    """The voter each voter depends on, or -1. Without voters there is none."""
    rows, voters = votes.shape
    information = np.zeros((voters, voters))
    for weight in (1 - posterior, posterior):
        total = weight.sum() + 1e-9
        both = (votes * weight[:, None]).T @ votes
        single = (votes * weight[:, None]).sum(0)
        for x in (0, 1):
            for y in (0, 1):
                a, b = (single if x else total - single)[:, None], (single if y else total - single)[None, :]
                joint = both if x and y else single[:, None] - both if x else single[None, :] - both if y else total - single[:, None] - single[None, :] + both
                joint = np.clip(joint, 0, None)
                with np.errstate(divide="ignore", invalid="ignore"):
                    information += np.where(joint > 1e-9, joint * np.log(joint * total / (a * b)), 0.0)
    information[~np.isfinite(information)] = 0
    parents, best = np.full(voters, -1), np.full(voters, -np.inf)
    waiting = np.ones(voters, bool)
    at = 0
    while waiting.any():
        waiting[at] = False
        closer = waiting & (information[at] > best)
        best[closer], parents[closer] = information[at][closer], at
        if waiting.any():
            at = int(np.flatnonzero(waiting)[np.argmax(best[waiting])])
    parents[2 * best < EVIDENCE] = -1
    return parents


def _features(fires: np.ndarray, strong: np.ndarray) -> np.ndarray:
    sure = fires[:, strong].sum(1)
    return np.column_stack([fires, sure > 0, sure > 1, np.ones(len(fires))]).astype(np.float64)


def _classifier(features: np.ndarray, target: np.ndarray, penalty: float = 0.05, steps: int = 25) -> np.ndarray:
    """Logistic regression on the posterior, by Newton steps with a small ridge (none on the constant)."""
    weights = np.zeros(features.shape[1])
    ridge = np.full(features.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (target - p) - ridge * weights
        curve = (features * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ features + np.diag(ridge)
        change = np.linalg.solve(curve, slope)
        weights += change * min(1.0, 4 / max(1e-9, float(np.abs(change).max())))
        if np.abs(change).max() < 1e-6:
            break
    return weights
