"""Exact top-k inner-product search by ball trees with branch and bound.

Every task builds a ball tree over each batch of its rows, its shards. A node's ball
(centre c, radius r) bounds the product with a query q by q.c + |q| r. A query takes a
shard's leaves in the order of that bound and stops at the first that cannot beat its
kth score so far; equal scores go to the smaller id, so a leaf whose bound only equals
the kth score is taken only if it holds a smaller id. The kth scores carry over from
shard to shard of a task, and all tasks start from those that a bounded set of rows
gives, worked out first. A node whose bound fails for all queries drops its leaves.

Queries go in blocks of ``BLOCK`` rows, each broadcast (a bounded size) and held
against all rows. A task returns k rows for each query; those meet in a ranking.

Cases: vectors that are null, or hold null or non-finite parts, take no part; vectors
of different lengths are not compared; rows without an id are no queries and no
candidates; rows of the query's id are its own; equal queries are asked once;
candidates that repeat are each ranked; vectors so large that a product may leave 64 bits
are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.columns import batch_of

K, SCALE = 5, 256
BLOCK = 8192
LEAF = 64
SEEDS = 2048
NOTHING = np.iinfo(np.int64).min


def scaled(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector): whole parts of SCALE times each part, of the rows that take part."""
    inf = F.lit(float("inf"))
    vector = F.col(vector_column).cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    rows = rows.where(F.col(id_column).isNotNull() & sound & (F.size(vector) > 0))
    return rows.select(F.col(id_column).cast("long").alias("vec_id"), F.transform(vector, lambda x: F.floor(x * SCALE)).alias("vector"))


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; by floating point where that is exact.

    Products that could leave 64 bits are an error, not a wrong score.
    """
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if most < 2**52:
        return (queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    if most >= 2**63:
        raise OverflowError("inner products of these vectors may leave 64 bits; scale them down")
    return queries @ vectors.T


class Tree:
    """A ball tree: nodes as (centre, radius, smallest id, children or leaf rows)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.nodes: list[tuple[np.ndarray, float, int, tuple[int, int] | None, np.ndarray]] = []
        self._build(np.arange(len(ids)))

    def _build(self, rows: np.ndarray) -> int:
        points = self.vectors[rows].astype(float)
        centre = points.mean(axis=0)
        away = np.linalg.norm(points - centre, axis=1)
        number = len(self.nodes)
        self.nodes.append((centre, float(away.max()), int(self.ids[rows].min()), None, rows))
        if len(rows) > LEAF:
            one = points[int(np.argmax(away))]
            other = points[int(np.argmax(np.linalg.norm(points - one, axis=1)))]
            order = np.argsort(points @ (other - one), kind="stable")
            left = self._build(rows[order[: len(rows) // 2]])
            right = self._build(rows[order[len(rows) // 2 :]])
            self.nodes[number] = (*self.nodes[number][:3], (left, right), rows[:0])
        return number

    def bounds(self, queries: np.ndarray, norms: np.ndarray, best: Best) -> tuple[list[int], np.ndarray]:
        """Leaves that some query may need, and the largest whole product each allows each query."""
        leaves, limits, waiting = [], [], [0]
        plain = queries.astype(float)
        while waiting:
            centre, radius, least, children, _ = self.nodes[waiting[-1]]
            number = waiting.pop()
            bound = plain @ centre + norms * radius
            limit = np.floor(bound + 1e-9 * np.abs(bound) + 1e-6)
            if not best.may_gain(limit, least).any():
                continue
            if children:
                waiting.extend(children)
            else:
                leaves.append(number)
                limits.append(limit)
        return leaves, np.column_stack(limits) if limits else np.empty((len(queries), 0))

    def search(self, ids: np.ndarray, queries: np.ndarray, best: Best) -> None:
        norms = np.linalg.norm(queries.astype(float), axis=1) * (1 + 1e-12)
        leaves, limits = self.bounds(queries, norms, best)
        order = np.argsort(-limits, axis=1, kind="stable")
        open_ = np.arange(len(queries))
        for turn in range(len(leaves)):
            column = order[open_, turn]
            limit = limits[open_, column]
            open_, column, limit = (x[limit >= best.kth()[open_]] for x in (open_, column, limit))
            if not len(open_):
                break
            by_leaf = np.argsort(column, kind="stable")
            for part in np.split(by_leaf, np.flatnonzero(np.diff(column[by_leaf])) + 1):
                _, _, least, _, rows = self.nodes[leaves[column[part[0]]]]
                gain = best.may_gain(limit[part], least, open_[part])
                asked = open_[part[gain]]
                if len(asked):
                    best.add(asked, products(queries[asked], self.vectors[rows]), self.ids[rows], ids[asked])


class Best:
    """The k best (score, id) of each query so far, and a score that other rows already give."""

    def __init__(self, n: int, k: int, known: np.ndarray | None = None):
        self.scores = np.full((n, k), NOTHING)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.known = np.full(n, NOTHING) if known is None else known

    def kth(self) -> np.ndarray:
        return np.maximum(self.scores[:, -1], self.known)

    def may_gain(self, limit: np.ndarray, least: int, rows=slice(None)) -> np.ndarray:
        """Whether a product of at most ``limit`` with an id of at least ``least`` could enter."""
        kth = self.kth()[rows]
        tied = (self.scores[rows, -1] == kth) & (self.ids[rows, -1] < least)
        return (limit > kth) | ((limit == kth) & ~tied) | (kth == NOTHING)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        many = np.broadcast_to(ids, scores.shape)
        scores = np.where(many == own[:, None], NOTHING, scores)
        many = np.where(scores == NOTHING, np.iinfo(np.int64).max, many)
        scores, many = np.hstack([self.scores[rows], scores]), np.hstack([self.ids[rows], many])
        order = np.lexsort((many, -(scores + 1)), axis=-1)[:, : self.scores.shape[1]]
        self.scores[rows] = np.take_along_axis(scores, order, axis=1)
        self.ids[rows] = np.take_along_axis(many, order, axis=1)


def _by_length(ids: np.ndarray, vectors: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and a matrix for each vector length."""
    sizes = np.array([len(v) for v in vectors])
    return {int(n): (ids[sizes == n], np.stack([v for v in vectors if len(v) == n])) for n in np.unique(sizes)}


def _matrices(batch: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    lists = batch.column(1)
    flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return _by_length(batch.column(0).to_numpy(), [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])


def _search_block(rows: DataFrame, block: list, seeds: dict, k: int) -> DataFrame:
    """The k best rows of every task for each query of a block."""
    asked = _by_length(np.array([r.vec_id for r in block], np.int64), [np.array(r.vector, np.int64) for r in block])
    known = {}
    for n, (ids, queries) in asked.items():
        first = Best(len(ids), k)
        if n in seeds:
            Tree(*seeds[n]).search(ids, queries, first)
        known[n] = first.scores[:, -1]
    sent = rows.sparkSession.sparkContext.broadcast((asked, known))

    def found(batches):
        asked, known = sent.value
        best = {n: Best(len(ids), k, known[n]) for n, (ids, _) in asked.items()}
        for batch in batches:
            for n, shard in _matrices(batch).items():
                if n in asked:
                    Tree(*shard).search(*asked[n], best[n])
        for n, (ids, _) in asked.items():
            row, place = np.nonzero(best[n].scores > NOTHING)
            yield batch_of(query_id=pa.array(ids[row]), vec_id=pa.array(best[n].ids[row, place]), score=pa.array(best[n].scores[row, place]))

    return rows.mapInArrow(found, "query_id long, vec_id long, score long")


def top_inner_products(
    rows: DataFrame, queries: DataFrame, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows, or all if there are fewer."""
    candidates = scaled(rows, id_column, vector_column)
    asked = scaled(queries, id_column, vector_column).distinct().orderBy("vec_id", "vector")
    sample = candidates.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEEDS).collect()
    seeds = _by_length(np.array([r.vec_id for r in sample], np.int64), [np.array(r.vector, np.int64) for r in sample])
    result = rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    block: list = []
    for row in asked.toLocalIterator():
        block.append(row)
        if len(block) == BLOCK:
            result, block = result.unionAll(_search_block(candidates, block, seeds, k)), []
    if block:
        result = result.unionAll(_search_block(candidates, block, seeds, k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = result.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
