"""Whitening of embeddings by a covariance weighted with the multiplicity of equal vectors.

Equal vectors are grouped. The covariance is fitted on the distinct ones, each with its count or one as weight, and every
distinct vector is whitened once; the rows get the results back by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.session import settle

# Entries beyond this are set to it, so that they stay whole numbers of 64 bits.
LARGEST = 1 << 62
# Vectors of a product of matrices.
BLOCK = 4_096


@dataclass
class Whitening:
    """What is fitted on the vectors of one length: weight of all, exact sums, unit components as rows, their eigenvalues."""

    weight: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def scales(self) -> np.ndarray:
        """What projections are multiplied by; nothing is left of a direction without variance."""
        least = len(self.sums) * np.finfo(float).eps * max(self.eigenvalues.max(initial=0.0), 0.0)
        some = self.eigenvalues > least
        return np.where(some, 1 / np.sqrt(np.where(some, self.eigenvalues, 1.0)), 0.0)


def whole_vectors(vectors: DataFrame, vector: str = "embedding", scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """All columns and ``x``: floor of ``scale`` times each entry, plus ``offset``. Rows without vector, or with an entry that
    is NULL, infinite or undefined, are left out. A column ``x`` of the input is replaced. Entries beyond ``LARGEST`` become
    that."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    bound = F.lit(float(LARGEST - 2 * abs(offset)))
    entry = lambda c: F.floor(F.greatest(-bound, F.least(bound, F.lit(float(scale)) * c.cast("double")))) + F.lit(offset)
    return vectors.filter(F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))).withColumn("x", F.transform(vector, entry))


def distinct_vectors(rows: DataFrame, weights: str = "one") -> DataFrame:
    """``x`` once with ``weight``: one, or with "counts" how many rows hold it; summed before the shuffle, so that a vector
    that very many rows hold costs a row for each task. Written to the shared folder."""
    if weights not in ("one", "counts"):
        raise ValueError(f"weights {weights}")
    counted = rows.groupBy("x").agg(F.count("*").alias("weight"))
    return settle(counted if weights == "counts" else counted.withColumn("weight", F.lit(1).cast("bigint")), "distinct vectors")


def fit(distinct: DataFrame, components: int = 16) -> dict[int, Whitening]:
    """A whitening for each length of vector, of the first ``components`` principal components.

    Sums are exact; the covariance has the sum of weights as divisor and is centred before multiplying, in blocks of each
    task. To the driver go one matrix for each length, whose size doesn't depend on the number of rows. Eigenvectors are
    numbered by falling eigenvalue; their largest entry by amount is positive.
    """
    sums = _sums(distinct)
    means = {width: (weight, totals) for width, (weight, totals) in sums.items()}
    fitted = {}
    for width, matrix in _covariances(distinct, means).items():
        weight, totals = sums[width]
        values, vectors = np.linalg.eigh(matrix / weight)
        order = np.argsort(-values, kind="stable")[:components]
        chosen = vectors[:, order].T
        signs = np.sign(chosen[np.arange(len(order)), np.abs(chosen).argmax(1)])
        fitted[width] = Whitening(weight, totals, chosen * signs[:, None], np.maximum(values[order], 0.0), float(np.trace(matrix) / weight))
    return fitted


def whiten(rows: DataFrame, weights: str = "one", components: int = 16) -> DataFrame:
    """Every row of ``rows`` (from ``whole_vectors``) once for each component.

    All columns, and ``component`` (from 1), ``n`` (sum of weights of the vectors of this length), ``deviation`` (sum over
    the dimensions of the squares of n*x - S, S being the weighted sums; exact, as decimal(38, 0), NULL beyond),
    ``whitened`` (the centred vector projected on the component, divided by the root of its eigenvalue), ``explained`` (the
    component's share of the variance) and ``identity_error`` (largest absolute entry of the whitened vectors' covariance
    less the identity, over the components with variance). These replace columns of the same names.

    Vectors of different lengths are fitted apart; one without entries gives no row, and of a shorter one than ``components``
    all components come. A direction without variance, as all are of a single vector, gives 0 for whitened and explained.
    Repeated rows each come back. An empty table gives an empty result. A vector that many rows hold is whitened once; the
    join splits its rows (AQE).
    """
    distinct = distinct_vectors(rows, weights)
    fitted = fit(distinct, components)
    done = settle(_whitened(distinct, fitted), "whitened")
    for width, error in _identity_errors(done, fitted).items():
        fitted[width].identity_error = error
    added = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    kept = [c for c in rows.columns if c not in added]
    constants = rows.sparkSession.createDataFrame(
        [
            (width, number + 1, one.weight, float(value / one.trace) if one.trace > 0 else 0.0, one.identity_error)
            for width, one in fitted.items()
            for number, value in enumerate(one.eigenvalues.tolist())
        ],
        "`fit width` int, component int, n bigint, explained double, identity_error double",
    )
    back = rows.select(*kept).join(done.select("x", F.col("deviation").alias("whole deviation"), F.col("whitened").alias("all whitened")), "x")
    spread = back.select(*kept, "whole deviation", F.size("x").alias("vector width"), F.posexplode("all whitened").alias("vector place", "whitened"))
    # A row for each length and component.
    constants = F.broadcast(constants)
    joined = spread.join(constants, (F.col("vector width") == F.col("fit width")) & (F.col("vector place") + 1 == F.col("component")))
    return joined.select(*kept, "component", "n", F.col("whole deviation").alias("deviation"), "whitened", "explained", "identity_error")


def _matrix(batch: pa.RecordBatch | pa.Table, name: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length of vector in a batch: length, places of its rows, the vectors as a matrix."""
    column = batch.column(name)
    widths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield int(width), rows, flat.reshape(len(rows), int(width))


def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Sum of weights, and exact weighted sums by dimension, for each length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for width, rows, x in _matrix(batch, "x"):
                w = weights[rows]
                most = int(np.abs(x).max(initial=0)) * int(w.sum())
                totals = (w @ x if most < LARGEST else w.astype(object) @ x.astype(object)).tolist()
                weight, before = held.get(width, (0, [0] * width))
                held[width] = weight + int(w.sum()), [a + int(b) for a, b in zip(before, totals, strict=True)]
        for width, (weight, totals) in held.items():
            # The sum of weights goes before the first dimension.
            values = [Decimal(v) for v in (weight, *totals)]
            yield pa.record_batch(
                [pa.array([width] * len(values), pa.int32()), pa.array(range(len(values)), pa.int32()), pa.array(values, pa.decimal128(38))], names=["width", "place", "total"]
            )

    partial = distinct.mapInArrow(add, "width int, place int, total decimal(38,0)")
    out: dict[int, tuple[int, list[int]]] = {}
    for row in partial.groupBy("width", "place").agg(F.sum("total").alias("total")).orderBy("width", "place").collect():
        if row.place == 0:
            out[row.width] = int(row.total), []
        else:
            out[row.width][1].append(int(row.total))
    return out


def _deviations(x: np.ndarray, weight: int, totals: list[int]) -> np.ndarray:
    """n*x - S, in 64 bits where that is exact, else in whole numbers of any size."""
    most = weight * int(np.abs(x).max(initial=0)) + max((abs(t) for t in totals), default=0)
    kind = np.int64 if most < LARGEST else object
    return weight * x.astype(kind) - np.array(totals, kind)


def _covariances(rows: DataFrame, means: dict[int, tuple[int, list]], vector: str = "x") -> dict[int, np.ndarray]:
    """For each length the sum of weighted products of centred vectors."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for width, places, x in _matrix(batch, vector):
                weight, totals = means[width]
                for at in range(0, len(x), BLOCK):
                    w = weights[places[at : at + BLOCK]].astype(float)
                    if x.dtype == np.int64:
                        centred = _deviations(x[at : at + BLOCK], weight, totals).astype(float) / weight
                    else:
                        centred = x[at : at + BLOCK] - np.array(totals) / weight
                    product = (centred * w[:, None]).T @ centred
                    held[width] = held[width] + product if width in held else product
        for width, product in held.items():
            i, j = np.triu_indices(width)
            yield pa.record_batch([pa.array(np.full(len(i), width), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(product[i, j])], names=["width", "i", "j", "v"])

    partial = rows.select(vector, "weight").mapInArrow(multiply, "width int, i int, j int, v double")
    summed = partial.groupBy("width", "i", "j").agg(F.sum("v").alias("v"))
    lines = summed.groupBy("width", "i").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("line")).collect()
    out = {width: np.zeros((width, width)) for width in {row.width for row in lines}}
    for row in lines:
        for j, v in row.line:
            out[row.width][row.i, j] = out[row.width][j, row.i] = v
    return out


def _whitened(distinct: DataFrame, fitted: dict[int, Whitening]) -> DataFrame:
    """Each distinct vector with ``weight``, ``deviation`` and ``whitened``."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, rows, x in _matrix(batch, "x"):
                if width not in fitted:  # vectors without entries
                    continue
                one = fitted[width]
                distance = _deviations(x, one.weight, one.sums)
                most = int(np.abs(distance).max(initial=0))
                exact = distance if most * most * width < LARGEST else distance.astype(object)
                squares = (exact * exact).sum(1).tolist()
                scores = (distance.astype(float) / one.weight) @ one.components.T * one.scales()
                flat = pa.array(scores.ravel())
                yield pa.record_batch(
                    [
                        *[batch.column(name).take(pa.array(rows)) for name in ("x", "weight")],
                        pa.array([Decimal(s) if s < 10**38 else None for s in squares], pa.decimal128(38)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * scores.shape[1], pa.int32()), flat),
                    ],
                    names=["x", "weight", "deviation", "whitened"],
                )

    return distinct.mapInArrow(project, "x array<bigint>, weight bigint, deviation decimal(38,0), whitened array<double>")


def _identity_errors(done: DataFrame, fitted: dict[int, Whitening]) -> dict[int, float]:
    """Measured on the whitened vectors themselves, centred first."""
    errors = {}
    narrow = done.select(F.size("x").alias("width"), "weight", "whitened")
    for width, one in fitted.items():
        own = narrow.filter(F.col("width") == width)
        sums = own.select("weight", F.posexplode("whitened")).groupBy("pos").agg(F.sum(F.col("weight") * F.col("col")).alias("total")).orderBy("pos").collect()
        kept = one.scales() > 0
        matrix = next(iter(_covariances(own, {len(sums): (one.weight, [row.total for row in sums])}, "whitened").values())) / one.weight
        errors[width] = float(np.abs(matrix - np.eye(len(matrix)))[np.ix_(kept, kept)].max(initial=0.0))
    return errors
