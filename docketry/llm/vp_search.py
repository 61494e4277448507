"""Nearest neighbours by inner product over vantage-point trees, one tree a shard.

Largest inner product becomes smallest distance by one more coordinate: with R the length of the longest vector, x is
lengthened by sqrt(R^2 - |x|^2) and a query by 0, and the squared distance is |q|^2 + R^2 - 2 q.x. In that space the
triangle inequality bounds the distance to everything below a node by the distance to its vantage point.

A bound is multiplied by `relax` before it is held against the distance of the worst neighbour so far. Factor one
prunes only what cannot matter and is exact; a greater one prunes more and may miss some.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.sources.workspace import new_folder, ship_package, stored

# Vectors of a shard, queries of a block, distinct vectors of a leaf, rows whose scores give the first bounds.
SHARD = 4_096
BLOCK = 1_024
LEAF = 96
SEED_ROWS = 4_096
RELAX = 1.3
# A product made by the matrix library may differ from the exact one by this share of the lengths.
SLACK = 1e-9
NOBODY = np.iinfo(np.int64).min


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, in double precision and in order of the coordinates, so equal rows give equal scores."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


@dataclass
class Best:
    """For each query the k best (score, id) so far: score down, id up."""

    k: int
    score: np.ndarray
    name: np.ndarray

    @classmethod
    def empty(cls, queries: int, k: int) -> Best:
        return cls(k, np.full((queries, k), -np.inf), np.full((queries, k), np.iinfo(np.int64).max))

    def add(self, query: np.ndarray, score: np.ndarray, name: np.ndarray) -> None:
        """Merge candidates, which come in order of their query."""
        if not len(query):
            return
        some, counts = np.unique(query, return_counts=True)
        width = int(counts.max())
        first = np.repeat(np.cumsum(counts) - counts, counts)
        row, column = np.repeat(np.arange(len(some)), counts), np.arange(len(query)) - first
        more_score = np.full((len(some), width), -np.inf)
        more_name = np.full((len(some), width), np.iinfo(np.int64).max)
        more_score[row, column], more_name[row, column] = score, name
        both_score = np.concatenate([self.score[some], more_score], axis=1)
        both_name = np.concatenate([self.name[some], more_name], axis=1)
        order = np.lexsort((both_name, -both_score), axis=1)[:, : self.k]
        self.score[some] = np.take_along_axis(both_score, order, axis=1)
        self.name[some] = np.take_along_axis(both_name, order, axis=1)


@dataclass
class Node:
    vantage: np.ndarray
    near: object
    far: object
    # Least and greatest distance from the vantage point to what lies below either side.
    bounds: tuple[float, float, float, float]


class Tree:
    """A vantage-point tree over the different vectors of a shard; copies of a vector are kept as one point."""

    def __init__(self, names: np.ndarray, vectors: np.ndarray, longest: float, keep: int) -> None:
        order = np.argsort(names, kind="stable")
        names, vectors = names[order], vectors[order] + 0.0
        points, at = np.unique(vectors, axis=0, return_inverse=True)
        at = at.reshape(-1)
        by_point = np.argsort(at, kind="stable")
        begin = np.searchsorted(at[by_point], np.arange(len(points) + 1))
        # Of equal vectors the smallest ids come first: no query can need more than its neighbours and itself.
        self.names = [names[by_point[a : min(b, a + keep)]] for a, b in zip(begin, begin[1:], strict=False)]
        self.points = points
        self.longest = longest
        extra = np.sqrt(np.maximum(0.0, longest**2 - (points**2).sum(axis=1)))
        self.lifted = np.concatenate([points, extra[:, None]], axis=1)
        self.root = self._build(np.arange(len(points)), np.random.default_rng(1)) if len(points) else None

    def _build(self, members: np.ndarray, chance: np.random.Generator):
        if len(members) <= LEAF:
            return members
        vantage = self.lifted[members[chance.integers(len(members))]]
        away = np.sqrt(((self.lifted[members] - vantage) ** 2).sum(axis=1))
        order = np.argsort(away, kind="stable")
        members, away, half = members[order], away[order], len(order) // 2
        bounds = (away[0], away[half - 1], away[half], away[-1])
        return Node(vantage, self._build(members[:half], chance), self._build(members[half:], chance), bounds)

    def search(self, names: np.ndarray, queries: np.ndarray, best: Best, relax: float) -> None:
        """Improve the best neighbours of all queries together."""
        if self.root is None or not len(names):
            return
        # Scaled to the length of the longest vector: nearness is the same, and bounds are tighter.
        size = np.sqrt((queries**2).sum(axis=1))
        lifted = np.concatenate([queries * (self.longest / size)[:, None], np.zeros((len(queries), 1))], axis=1)
        self._names, self._queries, self._best, self._relax = names, queries, best, relax
        self._size, self._lifted = size, lifted
        self._visit(self.root, np.arange(len(names)))

    def _worst(self, some: np.ndarray) -> np.ndarray:
        """Distance of the last neighbour so far."""
        cosine = self._best.score[some, -1] / self._size[some]
        return np.sqrt(np.maximum(0.0, 2 * self.longest * (self.longest - cosine)))

    def _visit(self, node, some: np.ndarray) -> None:
        if isinstance(node, np.ndarray):
            self._leaf(node, some)
            return
        away = np.sqrt(((self._lifted[some] - node.vantage) ** 2).sum(axis=1))
        a, b, c, d = node.bounds
        to_near = np.maximum(0, np.maximum(a - away, away - b)) * self._relax
        to_far = np.maximum(0, np.maximum(c - away, away - d)) * self._relax
        slack = SLACK * max(1.0, self.longest)
        turns = [(node.near, to_near), (node.far, to_far)]
        # All queries go down together, first where most of them are nearer; for the other side they know more.
        if 2 * np.count_nonzero(to_near <= to_far) < len(some):
            turns.reverse()
        for child, bound in turns:
            go = some[bound <= self._worst(some) + slack]
            if len(go):
                self._visit(child, go)

    def _leaf(self, members: np.ndarray, some: np.ndarray) -> None:
        rough = self._queries[some] @ self.points[members].T
        margin = SLACK * (1.0 + self.longest * self._size[some])
        row, column = np.nonzero(rough >= (self._best.score[some, -1] - margin)[:, None])
        if not len(row):
            return
        query, point = some[row], members[column]
        exact = dot(self._queries[query], self.points[point])
        counts = np.array([len(self.names[p]) for p in point])
        name = np.concatenate([self.names[p] for p in point])
        query, exact = np.repeat(query, counts), np.repeat(exact, counts)
        other = name != self._names[query]
        self._best.add(query[other], exact[other], name[other])


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(vec_id, embedding array<double>) of the rows that take part: an id, and a vector that is neither null, empty nor
    zero, without null or non-finite components."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("embedding"), finite.alias("finite"))
    kept = rows.filter("finite AND vec_id IS NOT NULL").filter(F.exists("embedding", lambda x: x != 0))
    return kept.select("vec_id", "embedding")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _packed(rows: DataFrame, key: str) -> DataFrame:
    """One row a key with the ids and vectors of the key's rows as bytes; a key holds a bounded number of rows."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        vectors = _matrix(table.column("embedding").combine_chunks())
        names = table.column("vec_id").to_numpy()
        return pa.table({
            key: table.column(key)[:1], "names": pa.array([names.tobytes()], pa.binary()),
            "vectors": pa.array([np.ascontiguousarray(vectors).tobytes()], pa.binary()),
        })

    return rows.groupBy(key).applyInArrow(pack, f"{key} long, names binary, vectors binary")


def search(
    vectors: DataFrame, query_rows, k: int = 20, relax: float = RELAX, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, nearest first, ties to the smaller id.

    `query_rows` is a condition on the column vec_id. Nearness is the largest inner product in double precision, on the
    vectors as they are. A query's own id is no neighbour of it; a row of other id with an equal vector is. Rows without an id,
    and vectors that are null, empty, zero or hold null or non-finite components take no part, nor do vectors that have not as
    many components as most have (of two such numbers the larger one). Rows of one id stand for one row, the smallest by its components. With k or fewer candidates all are
    returned; no queries give no rows. Other columns do not matter.

    Every row is in a shard's tree; the first bounds come from a fixed number of rows, chosen by a digest.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = usable(vectors, id_column, vector).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    rows = stored(rows, new_folder(spark, "vectors"))
    size = F.sqrt(F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)))
    sizes = rows.groupBy(F.size("embedding").alias("width")).agg(F.count(F.lit(1)).alias("n"), size.alias("longest"))
    most = sizes.orderBy(F.desc("n"), F.desc("width")).head()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows, n, longest = rows.filter(F.size("embedding") == most["width"]), most["n"], float(most["longest"]) * (1 + 1e-12)
    shards = -(-n // SHARD)
    queries = rows.filter(query_rows)
    blocks = max(1, -(-queries.count() // BLOCK))
    mark = F.xxhash64("vec_id")
    seeds = rows.orderBy(mark, "vec_id").limit(SEED_ROWS).collect()
    # SEED_ROWS vectors at most.
    seed = spark.sparkContext.broadcast((np.array([r.vec_id for r in seeds]), np.array([r.embedding for r in seeds])))
    packed = _packed(rows.withColumn("shard", F.pmod(mark, F.lit(shards))), "shard")
    asked = _packed(queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))), "block")
    asked = asked.withColumnsRenamed({"names": "q_names", "vectors": "q_vectors"})

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed_names, seed_vectors = seed.value
        for batch in batches:
            known = []
            for names, raw in zip(batch.column("q_names").to_pylist(), batch.column("q_vectors").to_pylist(), strict=True):
                names = np.frombuffer(names, np.int64)
                known.append(_seeded(names, np.frombuffer(raw).reshape(len(names), -1), seed_names, seed_vectors, k, longest).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(known, pa.binary())], ["q_names", "q_vectors", "q_known"])

    # The first bounds of a block are found once, not for each shard.
    asked = asked.select("q_names", "q_vectors").mapInArrow(bound, "q_names binary, q_vectors binary, q_known binary")
    asked = stored(asked, new_folder(spark, "queries"))
    # The stated queries meet all rows, a block of them a shard at a time.
    pairs = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")))
    pairs = pairs.join(packed, "shard")
    keep = k + 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree = None, None
        for batch in batches:
            for row in batch.to_pylist():
                names = np.frombuffer(row["names"], np.int64)
                if row["shard"] != shard:
                    shard = row["shard"]
                    tree = Tree(names, np.frombuffer(row["vectors"]).reshape(len(names), -1), longest, keep)
                asked_names = np.frombuffer(row["q_names"], np.int64)
                asked_vectors = np.frombuffer(row["q_vectors"]).reshape(len(asked_names), -1)
                best = Best.empty(len(asked_names), k)
                best.score[:, -1] = np.frombuffer(row["q_known"])
                best.name[:, -1] = NOBODY
                tree.search(asked_names, asked_vectors, best, relax)
                yield _found(asked_names, best)

    found = pairs.select("shard", "names", "vectors", "q_names", "q_vectors", "q_known").mapInArrow(
        find, "query_id long, vec_id long, score double"
    )
    # At most k rows a query and shard.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _seeded(names, queries, seed_names, seed_vectors, k: int, longest: float) -> np.ndarray:
    """A score that k other rows are known to reach, or minus infinity."""
    known = queries @ seed_vectors.T
    known[names[:, None] == seed_names[None, :]] = -np.inf
    if known.shape[1] < k:
        return np.full(len(names), -np.inf)
    kth = -np.partition(-known, k - 1, axis=1)[:, k - 1]
    return kth - SLACK * (1.0 + longest * np.sqrt((queries**2).sum(axis=1)))


def _found(names: np.ndarray, best: Best) -> pa.RecordBatch:
    # The bound from the seeds holds a place under the id NOBODY.
    row, column = np.nonzero((best.score > -np.inf) & (best.name != NOBODY) & (best.name != np.iinfo(np.int64).max))
    return pa.RecordBatch.from_arrays(
        [pa.array(names[row]), pa.array(best.name[row, column]), pa.array(best.score[row, column])],
        ["query_id", "vec_id", "score"],
    )


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of the exact neighbours that were found, by score, so that ties do not count against it."""
    worst = exact.groupBy("query_id").agg(F.min("score").alias("worst"), F.count(F.lit(1)).alias("wanted"))
    hits = found.join(worst, "query_id").filter(F.col("score") >= F.col("worst") - 1e-9)
    good = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"))
    row = worst.join(good, "query_id", "left").agg(F.sum(F.coalesce("hits", F.lit(0))), F.sum("wanted")).head()
    return float(row[0]) / float(row[1]) if row[1] else 1.0
