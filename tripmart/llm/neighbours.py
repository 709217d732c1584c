"""Nearest vectors by cosine with a vantage-point tree per shard.

Vectors are scaled to length one, where the distance of two points falls as their cosine rises. A tree splits the
points of a shard again and again by their distance from one of them, the vantage point. A search skips a branch if,
by the triangle inequality, none of its points is nearer than the k-th found so far. With a relax factor above one
the bound is stretched by it: more branches are skipped, and some neighbours may be missed. Factor one is exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.tables import written

#: Vectors to a shard, points to a leaf, queries to a block.
SHARD, LEAF, QUERIES = 8192, 256, 2048
#: Distances and cosines within this of a bound are looked at, so that rounding skips no tie.
SLACK = 1e-9


def even(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two that brings their largest component near one, so that no square of it is lost to
    nothing or infinity. Other components, and so the cosines, stay what they are."""
    _, power = np.frexp(np.abs(vectors).max(axis=-1, keepdims=True))
    return np.ldexp(vectors, -power)


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = even(vectors)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine of a query with each vector in double precision; equal vectors have equal cosines wherever they stand."""
    query, vectors = even(query), even(vectors)
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    return (vectors * query).sum(axis=1) / (np.sqrt((query * query).sum()) * lengths)


class VantageTree:
    """Points in tree order, and nodes of (begin, end, radius, left, right); a leaf has left -1.

    The first point of an inner node is its vantage point; the left child has the nearer half of the others.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, nodes: np.ndarray | None = None):
        self.ids, self.vectors = ids, vectors
        if nodes is None:
            nodes = self._build()
        self.nodes, self.points = nodes, unit(self.vectors.astype(np.float64))

    def _build(self) -> np.ndarray:
        points, order, nodes = unit(self.vectors.astype(np.float64)), np.arange(len(self.ids)), []
        todo = [(0, len(order), -1, 0)]
        while todo:
            begin, end, parent, side = todo.pop()
            number = len(nodes)
            nodes.append([begin, end, 0.0, -1, -1])
            if parent >= 0:
                nodes[parent][3 + side] = number
            if end - begin <= LEAF:
                continue
            rest = order[begin + 1 : end]
            away = np.sqrt(((points[rest] - points[order[begin]]) ** 2).sum(axis=1))
            half = len(rest) // 2
            split = np.argpartition(away, half)
            order[begin + 1 : end] = rest[split]
            nodes[number][2] = away[split[half]]
            middle = begin + 1 + half
            todo += [(begin + 1, middle, number, 0), (middle, end, number, 1)]
        self.ids, self.vectors = self.ids[order], self.vectors[order]
        return np.array(nodes)

    def to_bytes(self) -> dict:
        return {"ids": self.ids.tobytes(), "vectors": self.vectors.tobytes(), "nodes": self.nodes.tobytes(), "kind": self.vectors.dtype.str}

    @classmethod
    def from_bytes(cls, row: dict, dim: int) -> VantageTree:
        vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(-1, dim)
        return cls(np.frombuffer(row["ids"], np.int64), vectors, np.frombuffer(row["nodes"]).reshape(-1, 5))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: none) and cosines of the k nearest of each query but those of its own id; ties to lower ids."""
        n = len(queries)
        at = unit(queries)
        best = np.full((n, k), -np.inf)
        found = np.full((n, k), -1, np.int64)

        def offer(who: np.ndarray, begin: int, end: int, rough: np.ndarray) -> None:
            """Take in points whose cosines are ``rough`` but for rounding; those that may count are worked out."""
            may = rough >= best[who, k - 1][:, None] - SLACK
            for row in np.flatnonzero(may.any(axis=1)):
                q, columns = who[row], begin + np.flatnonzero(may[row])
                columns = columns[self.ids[columns] != query_ids[q]]
                scores = np.concatenate([best[q], cosines(queries[q], self.vectors[columns].astype(np.float64))])
                names = np.concatenate([found[q], self.ids[columns]])
                first = np.lexsort((names, -scores))[:k]
                best[q], found[q] = scores[first], names[first]

        def visit(number: int, who: np.ndarray) -> None:
            if not len(who):
                return
            begin, end, radius, left, right = self.nodes[number]
            begin, end = int(begin), int(end)
            if left < 0:
                offer(who, begin, end, at[who] @ self.points[begin:end].T)
                return
            rough = at[who] @ self.points[begin]
            offer(who, begin, begin + 1, rough[:, None])
            away = np.sqrt(np.maximum(0.0, 2 - 2 * rough))
            near = away < radius
            for child, first in ((int(left), near), (int(right), ~near)):
                visit(child, who[first])
            reach = np.sqrt(np.maximum(0.0, 2 - 2 * best[who, k - 1])) / factor + SLACK
            visit(int(right), who[near & (radius - away <= reach)])
            visit(int(left), who[~near & (away - radius <= reach)])

        if n:
            visit(0, np.arange(n))
        return found, best


def usable(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Rows id (long, not null) and vector with finite components, not all zero."""
    vector = df[vector_column]
    df = df.select(df[id_column].cast("long").alias("id"), vector.cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a batch, by the number of components."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        flat = batch.column(1).take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield ids[rows], flat.reshape(len(rows), dim)


def build(vectors: DataFrame) -> DataFrame:
    """Trees over rows of id and vector: shard, dim, ids, vectors, nodes, kind. No shuffle: a task makes trees of the
    rows it reads, at most SHARD to a tree. Vectors are kept in single precision if that loses nothing."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}

        def tree(dim: int) -> pa.RecordBatch:
            ids, vectors = (np.concatenate(x) for x in zip(*waiting.pop(dim)))
            single = vectors.astype(np.float32)
            vectors = single if (single == vectors).all() else vectors
            row = {"shard": uuid.uuid4().hex, "dim": dim, **VantageTree(ids, vectors).to_bytes()}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, SHARD):
                for ids, vectors in _matrices(batch.slice(at, SHARD)):
                    dim = vectors.shape[1]
                    held = sum(len(x) for x, _ in waiting.get(dim, []))
                    room = SHARD - held
                    waiting.setdefault(dim, []).append((ids[:room], vectors[:room]))
                    if len(ids) >= room:
                        yield tree(dim)
                        if len(ids) > room:
                            waiting[dim] = [(ids[room:], vectors[room:])]
        for dim in list(waiting):
            yield tree(dim)

    schema = pa.schema([("shard", pa.string()), ("dim", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("nodes", pa.binary()), ("kind", pa.string())])
    return vectors.select("id", "vector").mapInArrow(trees, "shard string, dim int, ids binary, vectors binary, nodes binary, kind string")


def search(trees: DataFrame, queries: DataFrame, k: int = 5, factor: float = 1.0) -> DataFrame:
    """The k nearest vectors of each query (id, vector): query_id, rank from 1, vec_id, score.

    ``trees`` comes from ``build``, written. Candidates are all rows with as many components but those with the
    query's own id; of several queries with one id the one with the lowest vector is asked. Repeated rows are
    candidates each. Queries meet trees in blocks of bounded size: each pair of a tree and a block is a group.
    """
    if factor < 1:
        raise ValueError("the relax factor is one or more")
    queries = queries.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    n_trees = max(1, trees.count())
    n_blocks = max(1, -(-queries.count() // QUERIES))

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        if right.num_rows:
            ids = right.column("id").to_numpy()
            vectors = np.array(right.column("vector").to_pylist(), np.float64)
            for row in left.to_pylist():
                found, score = VantageTree.from_bytes(row, row["dim"]).search(ids, vectors, k, factor)
                kept = score > -np.inf
                out[0].append(np.repeat(ids, kept.sum(axis=1)))
                out[1].append(found[kept])
                out[2].append(score[kept])
        merged = [np.concatenate(x) if x else np.empty(0) for x in out]
        return pa.table({"query_id": pa.array(merged[0], pa.int64()), "vec_id": pa.array(merged[1], pa.int64()), "score": pa.array(merged[2], pa.float64())})

    left = trees.withColumn("part", F.pmod(F.xxhash64("shard"), F.lit(n_trees)))
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    right = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"))
    right = right.withColumn("part", F.explode(F.expr(f"sequence(0L, {n_trees - 1}L)")))
    keys = ("part", "block", "dim")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(nearest, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_of(df: DataFrame, every: int = 50, k: int = 5, factor: float = 1.0) -> DataFrame:
    """Search ``df`` (vec_id, embedding): queries are the rows whose vec_id is divisible by ``every``."""
    vectors = usable(df)
    return search(written(build(vectors)), vectors.filter(F.col("id") % every == 0), k, factor)
