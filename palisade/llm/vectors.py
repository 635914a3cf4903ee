"""Exact top-k search by inner product with best-first search in M-trees of paged metric nodes.

An inner product becomes a distance by one more dimension: with M the largest norm, the vector (x, sqrt(M^2 - |x|^2)) lies
at the squared distance |q|^2 + M^2 - 2qx from (q, 0), so nearest is highest.
"""

from __future__ import annotations

import heapq
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.session import settle

PAGE = 128
FANOUT = 16
TREE_ROWS = 100_000
QUERY_ROWS = 4_096
# Entries beyond this count as it, so that inner products of thousands of entries fit 38 digits.
LARGEST = 2**56
# Inner products below the first are exact in floating point, below the second in 64 bits; by the product of the squared norms.
FLOAT_EXACT, WHOLE_EXACT = 2.0**104, 2.0**124
# Share of the distance by which bounds may err from rounding.
SLACK = 1e-6

PAGES = (
    "tree bigint, width int, sphere double, page int, parent int, leaf boolean, router array<double>, radius double, parent_distance double, "
    "ids array<bigint>, vectors array<bigint>, distances array<double>"
)
FOUND = "query_id bigint, vec_id bigint, score decimal(38,0)"


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """``vec_id``, ``vector`` (floor of ``scale`` times each component) and ``norm`` (squared length, about).

    Rows whose key or vector is NULL, or that hold a NULL, infinite or undefined component, are left out. Results beyond
    ``LARGEST`` become that.
    """
    whole = F.col(vector).isNotNull() & F.col(key).isNotNull()
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    bound = F.lit(float(LARGEST))
    parts = F.transform(vector, lambda x: F.floor(F.greatest(-bound, F.least(bound, x.cast("double") * scale))).cast("bigint"))
    rows = vectors.filter(whole & F.coalesce(finite, F.lit(False))).select(F.col(key).cast("bigint").alias("vec_id"), parts.alias("vector"))
    return rows.withColumn("norm", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """For each query the ``k`` vectors of highest inner product: query_id, rank (from 1), vec_id, score (decimal(38, 0)).

    Both inputs come from ``quantised``. Ties go to the smaller vec_id; a query never finds rows of its own id; vectors of
    another length don't meet it. Scores are exact whole numbers however long the vectors are: trees are searched by bounds
    in floating point with a margin, and where a product could be inexact there, it is computed in 64 bits or in whole
    numbers of any size. Vectors of very different length lie in different trees, so that a few long ones don't loosen the
    bounds of the others.
    With fewer rows than ``k`` all are returned; empty inputs give an empty result. A repeated query counts once, a
    repeated vector is found as often as it is there.

    Vectors are dealt into trees by a hash, at most about ``TREE_ROWS`` each, so equal vectors spread too. Every block of
    queries visits every tree; each pair of block and tree is one group of bounded size.
    """
    pages = settle(tree_pages(vectors), "pages")
    return best_first(pages, queries, k)


def tree_pages(vectors: DataFrame) -> DataFrame:
    """The nodes of M-trees over all vectors, one row each: routing object, covering radius, distance from the parent's
    routing object, and for leaves the entries with their distances from the routing object."""
    spark = vectors.sparkSession
    rows = vectors.count()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trees = max(1, -(-rows // TREE_ROWS), min(least, 24, rows // 2_000))
    # One band up to a norm of 2**26, then one for each factor of 16.
    band = F.floor(F.greatest(F.lit(0.0), F.log2(F.greatest(F.lit(1.0), F.col("norm"))) - 44) / 8)
    number = band * trees + F.pmod(F.xxhash64("vec_id", "vector"), F.lit(trees))
    dealt = vectors.withColumn("tree", number.cast("bigint")).withColumn("width", F.size("vector"))

    def grow(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _grown(key[0].as_py(), key[1].as_py(), table)

    return dealt.groupBy("tree", "width").applyInArrow(grow, PAGES)


def _grown(tree: int, width: int, table: pa.Table) -> pa.Table:
    ids = table.column("vec_id").to_numpy()
    whole = pc.list_flatten(table.column("vector")).to_numpy().reshape(len(ids), width)
    order = np.argsort(ids, kind="stable")
    ids, whole = ids[order], whole[order]
    norms = (whole.astype(np.float64) ** 2).sum(1)
    largest = float(norms.max())
    points = np.column_stack([whole.astype(np.float64), np.sqrt(np.maximum(0, largest - norms))])
    pages: list[dict] = []

    def distances(rows: np.ndarray, router: np.ndarray) -> np.ndarray:
        return np.sqrt(((points[rows] - router) ** 2).sum(1))

    todo = [(np.arange(len(ids)), -1, points.mean(0))]
    while todo:
        rows, parent, router = todo.pop()
        far = distances(rows, router)
        page = len(pages)
        above = pages[parent]["router"] if parent >= 0 else None
        leaf = len(rows) <= PAGE
        pages.append(
            {
                "tree": tree,
                "width": width,
                "sphere": largest,
                "page": page,
                "parent": parent,
                "leaf": leaf,
                "router": router,
                "radius": float(far.max()),
                "parent_distance": float(np.sqrt(((router - above) ** 2).sum())) if above is not None else 0.0,
                "ids": ids[rows] if leaf else [],
                "vectors": whole[rows].ravel() if leaf else [],
                "distances": far if leaf else [],
            }
        )
        if leaf:
            continue
        routers = _routers(points[rows[:: max(1, len(rows) // 512)]], min(FANOUT, -(-len(rows) // PAGE)))
        nearest = np.stack([distances(rows, r) for r in routers]).argmin(0)
        groups = [(rows[nearest == i], r) for i, r in enumerate(routers) if (nearest == i).any()]
        if len(groups) == 1:  # equal vectors: any halves will do
            groups = [(half, points[half[0]]) for half in np.array_split(rows, 2)]
        todo += [(group, page, r) for group, r in groups]
    double, long = pa.list_(pa.float64()), pa.list_(pa.int64())
    types = {
        "tree": pa.int64(), "width": pa.int32(), "sphere": pa.float64(), "page": pa.int32(), "parent": pa.int32(), "leaf": pa.bool_(), "router": double,
        "radius": pa.float64(), "parent_distance": pa.float64(), "ids": long, "vectors": long, "distances": double,
    }
    return pa.table({name: pa.array([p[name] for p in pages], kind) for name, kind in types.items()})


def _routers(sample: np.ndarray, count: int) -> np.ndarray:
    """Points of the sample far from each other: each next one is the farthest from those taken."""
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < count and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def best_first(pages: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Search the trees for each query; see ``top_k``."""
    queries = queries.select(F.col("vec_id").alias("query_id"), "vector").distinct()
    blocks = -(-max(1, queries.count()) // QUERY_ROWS)
    block = F.pmod(F.xxhash64("query_id", "vector"), F.lit(blocks))
    trees = pages.filter("parent = -1").groupBy("width").agg(F.collect_list("tree").alias("trees"))
    asked = queries.withColumn("block", block).withColumn("width", F.size("vector")).join(trees, "width").withColumn("tree", F.explode("trees"))
    spread = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))

    def search(nodes: pa.Table, wanted: pa.Table) -> pa.Table:
        return _searched(nodes, wanted, k)

    group = ["tree", "width", "block"]
    found = spread.groupBy(*group).cogroup(asked.select(*group, "query_id", "vector").groupBy(*group)).applyInArrow(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searched(nodes: pa.Table, wanted: pa.Table, k: int) -> pa.Table:
    out: list[tuple[int, int, int]] = []
    if nodes.num_rows and wanted.num_rows:
        tree = _Tree(nodes)
        for query, vector in zip(wanted.column("query_id").to_pylist(), wanted.column("vector").to_pylist(), strict=True):
            out += [(query, i, Decimal(s)) for s, i in tree.nearest(query, np.array(vector, np.int64), k)]
    columns = list(zip(*out, strict=True)) or [[], [], []]
    types = (pa.int64(), pa.int64(), pa.decimal128(38))
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "vec_id", "score"])


class _Tree:
    def __init__(self, nodes: pa.Table):
        nodes = nodes.sort_by("page")
        leaf, parent = nodes.column("leaf").to_pylist(), nodes.column("parent").to_numpy()
        routers = np.array(nodes.column("router").to_pylist())
        radius, above = nodes.column("radius").to_numpy(), nodes.column("parent_distance").to_numpy()
        self.sphere = nodes.column("sphere")[0].as_py()
        self.root = routers[0]
        self.children = {}
        for page, own in enumerate(leaf):
            if not own:
                below = np.flatnonzero(parent == page)
                self.children[page] = below, routers[below], radius[below], above[below]
        self.entries, self.whole = {}, {}
        for page, own in enumerate(leaf):
            if own:
                ids, flat, far = (nodes.column(c)[page].values.to_numpy() for c in ("ids", "vectors", "distances"))
                self.whole[page] = flat.reshape(len(ids), -1 if len(flat) else 0)
                self.entries[page] = ids, self.whole[page].astype(np.float64), far

    def nearest(self, query: int, whole: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The best ``k`` entries as score and id, best first.

        Pages wait by the least distance that their balls allow. Stored distances give bounds by the triangle inequality
        before a distance is computed: |d(q, parent) - d(parent, x)| - radius. A page or an entry is left out only if it
        lies farther than the k-th best so far, with a margin for rounding, so that ties are all seen.
        """
        vector = whole.astype(np.float64)
        length = float(vector @ vector)
        size = length * self.sphere
        kind = np.float64 if size < FLOAT_EXACT else np.int64 if size < WHOLE_EXACT else object
        exactly = whole.astype(kind)
        margin = SLACK * np.sqrt(length + self.sphere) + 1e-9

        def distance(routers: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(0.0, length + (routers**2).sum(-1) - 2 * (routers[..., :-1] @ vector)))

        ids, scores = np.zeros(0, np.int64), np.zeros(0, kind)
        reach = np.inf
        waiting = [(0.0, 0, float(distance(self.root)))]
        while waiting:
            bound, page, far = heapq.heappop(waiting)
            if bound > reach:
                break
            if page in self.children:
                below, routers, radius, above = self.children[page]
                near = np.flatnonzero(np.abs(far - above) - radius <= reach)
                exact = distance(routers[near])
                for child, d, r in zip(below[near].tolist(), exact.tolist(), radius[near].tolist(), strict=True):
                    if d - r <= reach:
                        heapq.heappush(waiting, (max(0.0, d - r), child, d))
                continue
            own, entries, away = self.entries[page]
            near = (np.abs(far - away) <= reach) & (own != query)
            found = (entries[near] if kind is np.float64 else self.whole[page][near].astype(kind)) @ exactly
            ids, scores = np.concatenate([ids, own[near]]), np.concatenate([scores, found])
            if len(ids) > k:
                best = _best(ids, scores)[:k]
                ids, scores = ids[best], scores[best]
            if len(ids) == k:
                reach = np.sqrt(max(0.0, length + self.sphere - 2 * float(scores.min()))) + margin
        return [(int(scores[i]), int(ids[i])) for i in _best(ids, scores)]


def _best(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Places by falling score, then by id."""
    by_id = np.argsort(ids, kind="stable")
    return by_id[np.argsort(-scores[by_id], kind="stable")]
