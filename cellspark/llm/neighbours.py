"""Approximate nearest neighbours from a low-dimensional stable projection.

Vectors are projected to a few dimensions with Gaussian (2-stable) directions: a squared distance in
the projection, over the true one, follows a chi-square law. Points are indexed by the projection
in kd-trees and met in the order of projected distance; each is verified on its full vector. A query
stops once a point as near as its worst kept neighbour would have been met already with probability
``confidence``: when chi-square(next projected distance / worst kept distance) reaches it.

The largest inner product is the nearest neighbour after one more coordinate, sqrt(M^2 - |x|^2) with
M the largest norm, is added to the points and 0 to the queries.

Distribution: a kd-tree over a bounded sample (``sample`` rows) cuts the projected space into blocks
of about ``block_rows`` rows; ties with a cut go to either side by the row's hash, so a vector that a
third of all rows share is spread. Every row is indexed. A query first searches its own block, then
goes to only those other blocks whose box could still hold a neighbour by the same test; queries and
rows meet in blocks, never all with all. Each block returns at most ``k`` rows of a query.

Vectors that are null, zero, or hold null or non-finite components take no part. Scores are exact
inner products in double precision; ties go to the smaller id. Rows that repeat an id are rows of
their own, but a query never finds its own id. A query row that repeats is searched once, and each
repeat gets the whole answer.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellspark.session import materialize

DIMENSIONS, LEAF = 8, 32
#: Scores held at a time in a task, 8 bytes each: queries that search together times rows of the block.
TOGETHER = 1 << 20


def chi_square(x: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Distribution function for an even number of dimensions."""
    half = np.minimum(np.asarray(x, float) / 2, 700)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, dimensions // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_at(confidence: float) -> float:
    """Where the distribution function reaches ``confidence``, by bisection."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(np.array(mid)) < confidence else (low, mid)
    return high


def directions(size: int, seed: int = 5) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(size, DIMENSIONS))


@dataclass
class Cuts:
    """A kd-tree over the sample: for each inner node its dimension and cut; leaves are blocks."""

    dims: np.ndarray
    cuts: np.ndarray
    levels: int

    @staticmethod
    def of(points: np.ndarray, levels: int) -> Cuts:
        dims, cuts = np.zeros(1 << levels, np.int64), np.zeros(1 << levels)
        parts = {1: points}
        for node in range(1, 1 << levels):
            own = parts.pop(node)
            if len(own):
                dims[node] = own.var(axis=0).argmax()
                cuts[node] = np.median(own[:, dims[node]])
            side = own[:, dims[node]] > cuts[node]
            tie = own[:, dims[node]] == cuts[node]
            side |= tie & (np.arange(len(own)) % 2 == 0)
            parts[2 * node], parts[2 * node + 1] = own[~side], own[side]
        return Cuts(dims, cuts, levels)

    def place(self, points: np.ndarray, coins: np.ndarray) -> np.ndarray:
        """Block of each point; bit i of a point's coin decides a tie at level i."""
        node = np.ones(len(points), np.int64)
        for level in range(self.levels):
            value, cut = points[np.arange(len(points)), self.dims[node]], self.cuts[node]
            side = (value > cut) | ((value == cut) & ((coins >> level) & 1 == 1))
            node = 2 * node + side
        return node - (1 << self.levels)


class Tree:
    """Leaves of a kd-tree over a block's projected points, with their boxes."""

    def __init__(self, points: np.ndarray):
        self.leaves, stack = [], [np.arange(len(points))]
        while stack:
            own = stack.pop()
            if len(own) <= LEAF:
                self.leaves.append(own)
                continue
            d = points[own].var(axis=0).argmax()
            order = own[np.argsort(points[own, d], kind="stable")]
            stack += [order[: len(order) // 2], order[len(order) // 2 :]]
        self.low = np.array([points[x].min(axis=0) for x in self.leaves])
        self.high = np.array([points[x].max(axis=0) for x in self.leaves])

    def near(self, asked: np.ndarray) -> np.ndarray:
        """Squared distance of every query to every leaf's box."""
        out = np.zeros((len(asked), len(self.leaves)))
        for d in range(asked.shape[1]):
            q = asked[:, d, None]
            out += np.maximum(np.maximum(self.low[:, d] - q, q - self.high[:, d]), 0) ** 2
        return out


def search(tree: Tree, vectors: np.ndarray, ids: np.ndarray, top: float, asked: np.ndarray, own: np.ndarray, projected: np.ndarray,
           k: int, stop: float, worst: np.ndarray) -> list[list[tuple[float, int]]]:
    """For each query the block's up to ``k`` best (score, id) that aren't worse than its ``worst`` squared distance.

    Each query opens leaves in the order of its distance to their boxes, at each turn twice as many
    as before, and verifies all rows in them; so every point nearer than the next box was met. It
    stops when the test holds for that box. The queries take their turns together, so that a leaf is
    multiplied once with all queries that open it in a turn.
    """
    boxes = tree.near(projected)
    order = np.argsort(boxes, axis=1, kind="stable")
    norms = (asked * asked).sum(axis=1) + top
    scores = np.full((len(asked), len(ids)), -np.inf)
    best = np.full((len(asked), k), -np.inf)
    active, at, width = np.arange(len(asked)), 0, 1
    while len(active) and at < order.shape[1]:
        turn = order[active, at : at + width]
        new = np.full((len(active), turn.shape[1] * LEAF), -np.inf)
        by_leaf = np.argsort(turn, axis=None, kind="stable")
        leaves, first = np.unique(turn.ravel()[by_leaf], return_index=True)
        for leaf, pairs in zip(leaves, np.split(by_leaf, first[1:])):
            who, slot = np.divmod(pairs, turn.shape[1])
            rows = tree.leaves[leaf]
            found = asked[active[who]] @ vectors[rows].T
            found[own[active[who], None] == ids[rows]] = -np.inf
            scores[active[who, None], rows] = found
            new[who[:, None], slot[:, None] * LEAF + np.arange(len(rows))] = found
        best[active] = np.partition(np.concatenate([best[active], new], axis=1), -k, axis=1)[:, -k:]
        at, width = at + width, 2 * width
        if at < order.shape[1]:
            limit = np.maximum(0, np.minimum(worst[active], norms[active] - 2 * best[active].min(axis=1)))
            active = active[boxes[active, order[active, at]] <= stop * limit]
    out = []
    for i, q in enumerate(asked):  # a hair below the last place, then in full precision
        rows = np.flatnonzero((scores[i] >= best[i].min() - 1e-9 * norms[i]) & (scores[i] > -np.inf))
        exact = (vectors[rows] * q).sum(axis=1)
        keep = np.lexsort((ids[rows], -exact))[:k]
        out.append([(s, j) for s, j in zip(exact[keep].tolist(), ids[rows][keep].tolist()) if norms[i] - 2 * s <= worst[i] + 1e-9 * norms[i]])
    return out


def matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


FOUND = "query_id long, query_key long, vec_id long, score double"


def block_search(k: int, stop: float, top: float, axes: np.ndarray, first: bool):
    """A block's queries, found by its tree. In the first round the worst distance is open."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = {c: [] for c in ("query_id", "query_key", "vec_id", "score")}
        if queries.num_rows and rows.num_rows:
            vectors, ids = matrix(rows.column("vec")), rows.column("vec_id").to_numpy()
            lift = np.sqrt(np.maximum(top - (vectors * vectors).sum(axis=1), 0))
            tree = Tree(np.c_[vectors, lift] @ axes)
            asked = matrix(queries.column("vec"))
            placed = np.c_[asked, np.zeros(len(asked))] @ axes
            worst = np.full(len(asked), math.inf) if first else queries.column("worst").to_numpy()
            own, keys = queries.column("vec_id").to_numpy(), queries.column("key").to_numpy()
            step = max(1, TOGETHER // len(ids))
            for s in range(0, len(asked), step):
                part = slice(s, s + step)
                for i, key, hits in zip(own[part], keys[part], search(
                        tree, vectors, ids, top, asked[part], own[part], placed[part], k, stop, worst[part])):
                    for score, j in hits:
                        for c, v in zip(out, (i, key, j, score)):
                            out[c].append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds)})

    return run


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vec as doubles) of rows that take part."""
    value = F.col(vector).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = df.select(F.col(key).cast("long").alias("vec_id"), value.alias("vec")).filter("vec_id IS NOT NULL AND vec IS NOT NULL")
    return rows.filter(~F.exists("vec", bad) & F.exists("vec", lambda x: x != 0))


def nearest(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20, confidence: float = 0.98,
    block_rows: int = 4096, sample: int = 65536,
) -> DataFrame:
    """For each row whose id ``every`` divides: query_id, rank, vec_id and score of the ``k`` nearest found."""
    spark = df.sparkSession
    rows = usable(df, key, vector).withColumn("key", F.xxhash64("vec_id", "vec"))
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    facts = rows.agg(F.count("*").alias("n"), F.max(square).alias("top"), F.max(F.size("vec")).alias("size")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not facts["n"]:
        return spark.createDataFrame([], schema)
    n, top, size = facts["n"], facts["top"] * (1 + 1e-12), facts["size"]
    axes, stop = directions(size + 1), chi_square_at(confidence)
    levels = max(0, math.ceil(math.log2(n / block_rows))) if n > block_rows else 0
    share = min(1.0, sample / n)
    coin = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    some = rows.filter(coin < share).limit(2 * sample).select("vec").toArrow()
    known = matrix(some.column("vec"))
    lift = np.sqrt(np.maximum(top - (known * known).sum(axis=1), 0))
    cuts = Cuts.of(np.c_[known, lift] @ axes, levels)

    def assign(batches):
        for b in batches:
            vectors = matrix(b.column(1)).reshape(b.num_rows, -1)
            coins = b.column(2).to_numpy()
            if b.num_rows:
                up = np.sqrt(np.maximum(top - (vectors * vectors).sum(axis=1), 0))
                place = cuts.place(np.c_[vectors, up] @ axes, coins)
                ask = cuts.place(np.c_[vectors, np.zeros(len(vectors))] @ axes, coins)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place.astype(np.int32)), pa.array(ask.astype(np.int32))],
                                                 names=["vec_id", "vec", "key", "block", "home"])

    placed = materialize(rows.mapInArrow(assign, "vec_id long, vec array<double>, key long, block int, home int"), "vectors")
    asking = placed.filter(F.col("vec_id") % every == 0)
    queries = asking.dropDuplicates(["vec_id", "key"])  # repeats have the same answer; they get it at the end

    def box(batches):
        """Each task's box of every block it has: at most a row per block."""
        low, high = {}, {}
        for b in batches:
            if not b.num_rows:
                continue
            vectors, block = matrix(b.column(0)), b.column(1).to_numpy()
            points = np.c_[vectors, np.sqrt(np.maximum(top - (vectors * vectors).sum(axis=1), 0))] @ axes
            for i in np.unique(block).tolist():
                own = points[block == i]
                low[i] = np.minimum(low.get(i, np.inf), own.min(axis=0))
                high[i] = np.maximum(high.get(i, -np.inf), own.max(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(low), pa.int32())] + [pa.array([list(v) for v in x.values()], pa.list_(pa.float64())) for x in (low, high)],
            names=["block", "low", "high"])

    parts = placed.select("vec", "block").mapInArrow(box, "block int, low array<double>, high array<double>")
    extent = parts.groupBy("block").agg(
        *[F.min(F.col("low")[d]).alias(f"l{d}") for d in range(DIMENSIONS)], *[F.max(F.col("high")[d]).alias(f"h{d}") for d in range(DIMENSIONS)])
    boxes = extent.collect()  # at most 2 ** levels rows, about n / block_rows
    numbers = np.array([r["block"] for r in boxes])
    lows = np.array([[r[f"l{d}"] for d in range(DIMENSIONS)] for r in boxes])
    highs = np.array([[r[f"h{d}"] for d in range(DIMENSIONS)] for r in boxes])

    def home(batches):
        """A query starts in the block whose box is nearest."""
        for b in batches:
            if b.num_rows:
                p = np.c_[matrix(b.column(1)), np.zeros(b.num_rows)] @ axes
                near = [numbers[(np.maximum(np.maximum(lows - x, x - highs), 0) ** 2).sum(axis=1).argmin()] for x in p]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.int32())], names=["vec_id", "vec", "key", "block"])

    started = queries.select("vec_id", "vec", "key").mapInArrow(home, "vec_id long, vec array<double>, key long, block int")
    by_block = placed.select("vec_id", "vec", "block").groupBy("block")
    one = materialize(started.groupBy("block").cogroup(by_block).applyInArrow(block_search(k, stop, top, axes, True), FOUND), "nearest")
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x) + top
    so_far = one.groupBy("query_key").agg(F.min("score").alias("least"), F.count("*").alias("n_found"))
    limits = started.join(so_far, F.col("key") == F.col("query_key"), "left").select(
        "vec_id", "vec", "key", F.col("block").alias("done"),
        F.when(F.col("n_found") >= k, F.greatest(F.lit(0.0), norm - 2 * F.col("least"))).otherwise(F.lit(math.inf)).alias("worst"))

    def others(batches):
        """A copy of the query for each further block whose box passes the test."""
        for b in batches:
            if not b.num_rows:
                continue
            p = np.c_[matrix(b.column(1)), np.zeros(b.num_rows)] @ axes
            worst, done = b.column(4).to_pylist(), b.column(3).to_pylist()
            row, block = [], []
            for i, x in enumerate(p):
                gap = (np.maximum(np.maximum(lows - x, x - highs), 0) ** 2).sum(axis=1)
                go = numbers[(gap <= stop * worst[i]) & (numbers != done[i])].tolist()
                row += [i] * len(go)
                block += go
            for s in range(0, len(row), 4096):
                part = b.take(pa.array(row[s : s + 4096], pa.int64())).select([0, 1, 2, 4])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(block[s : s + 4096], pa.int32())],
                                                 names=["vec_id", "vec", "key", "worst", "block"])

    sent = limits.mapInArrow(others, "vec_id long, vec array<double>, key long, worst double, block int")
    two = sent.groupBy("block").cogroup(by_block).applyInArrow(block_search(k, stop, top, axes, False), FOUND)
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = one.union(two).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    again = asking.select(F.col("vec_id").alias("query_id"), F.col("key").alias("query_key"))
    return again.join(ranked, ["query_id", "query_key"]).select("query_id", "rank", "vec_id", "score")
