"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are grown on a bounded sample: each split is the hyperplane between two random members,
at their median. Every distinct vector of the table is filed in one leaf of every tree. A query
walks all trees through one shared priority queue, nearest side first, until its budget of leaves
is used up; members of these leaves are candidates and are ranked by their exact inner product.
The budget is set by measurement: a bounded set of probe queries is answered exactly by a scan,
and the smallest number of leaves that would have found the wanted share of their neighbours is
taken. Inner products become distances by one more coordinate that gives all vectors one length.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerleaf.llm.tables import stored

LEAF = 40  # bits of a cell below the number of the tree


@dataclass
class Forest:
    """Split planes level by level; below ``depth`` levels, shared directions through each node's centre."""

    planes: np.ndarray  # trees x nodes x dimensions
    offsets: np.ndarray  # trees x nodes
    directions: np.ndarray  # trees x further levels x dimensions
    centres: np.ndarray  # trees x leaves of the sample x further levels
    length: float  # of every vector with its added coordinate

    @property
    def depth(self) -> int:
        return (self.planes.shape[1] + 1).bit_length() - 1

    @property
    def levels(self) -> int:
        return self.depth + self.directions.shape[1]

    @classmethod
    def grown(cls, sample: np.ndarray, length: float, trees: int, levels: int, seed: int) -> Forest:
        rng = np.random.default_rng(seed)
        points = lifted(sample, length)
        depth = max(min(levels, int(np.log2(max(len(points) // 8, 1)))), 0)
        width = points.shape[1]
        planes, offsets = np.zeros((trees, 2**depth - 1, width)), np.zeros((trees, 2**depth - 1))
        directions = rng.standard_normal((trees, levels - depth, width))
        centres = np.zeros((trees, 2**depth, levels - depth))
        for a in range(trees):
            node = np.zeros(len(points), np.int64)
            for level in range(depth):
                for n in range(2**level - 1, 2 ** (level + 1) - 1):
                    own = points[node == n]
                    across = rng.standard_normal(width)
                    if len(own) > 1:
                        i, j = rng.choice(len(own), 2, replace=False)
                        across = own[i] - own[j] if (own[i] != own[j]).any() else across
                    planes[a, n] = across / np.linalg.norm(across)
                    offsets[a, n] = np.median(own @ planes[a, n]) if len(own) else 0.0
                node = 2 * node + 1 + (np.einsum("nd,nd->n", points, planes[a, node]) > offsets[a, node])
            for n in range(2**depth):
                own = points[node == n + 2**depth - 1]
                if len(own):
                    centres[a, n] = directions[a] @ own.mean(axis=0)
        return cls(planes, offsets, directions, centres, length)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree, ``vectors x trees``."""
        points = lifted(vectors, self.length)
        out = np.empty((len(points), len(self.planes)), np.int64)
        for a in range(len(self.planes)):
            node = np.zeros(len(points), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (
                    np.einsum("nd,nd->n", points, self.planes[a, node]) > self.offsets[a, node]
                )
            leaf = top = node - (2**self.depth - 1)
            for level in range(self.directions.shape[1]):
                leaf = 2 * leaf + (points @ self.directions[a, level] > self.centres[a, top, level])
            out[:, a] = (a << LEAF) + leaf
        return out

    def visits(self, query: np.ndarray, budget: int) -> list[int]:
        """The first ``budget`` leaves for a query, over all trees, least distance beyond splits first."""
        point = np.append(query, 0.0)
        margins = self.planes @ point - self.offsets
        further = self.directions @ point if self.directions.shape[1] else None
        heap = [(0.0, a, 0, 0) for a in range(len(self.planes))]
        found: list[int] = []
        while heap and len(found) < budget:
            beyond, a, level, n = heapq.heappop(heap)
            if level == self.levels:
                found.append((a << LEAF) + n)
                continue
            if level < self.depth:
                m = margins[a, 2**level - 1 + n]
            else:
                m = further[a, level - self.depth] - self.centres[a, n >> (level - self.depth), level - self.depth]
            heapq.heappush(heap, (max(beyond, -m), a, level + 1, 2 * n + 1))
            heapq.heappush(heap, (max(beyond, m), a, level + 1, 2 * n))
        return found


def lifted(vectors: np.ndarray, length: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(length**2 - np.einsum("nd,nd->n", vectors, vectors), 0.0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, smaller ids first among equals."""
    return np.lexsort((ids, -scores))[:k]


def usable(vector: Column) -> Column:
    """No null or non-finite component, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def exact_neighbours(points: DataFrame, probes: np.ndarray, k: int, width: int) -> list[np.ndarray]:
    """The ``k`` nearest of all points for a bounded set of probes: one scan with running tops."""

    def scan(batches):
        top = [(np.zeros(0), np.zeros(0, np.int64), np.zeros((0, width))) for _ in probes]
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1), width)
            scores = probes @ x.T
            for i, s in enumerate(scores):
                near = np.argpartition(-s, k - 1)[:k] if len(s) > k else np.arange(len(s))
                joined = [np.concatenate(p) for p in zip(top[i], (s[near], ids[near], x[near]))]
                keep = best(joined[0], joined[1], k)
                top[i] = tuple(a[keep] for a in joined)
        yield pa.RecordBatch.from_pydict({
            "probe": pa.array([i for i, t in enumerate(top) for _ in t[0]], pa.int32()),
            "score": pa.array(np.concatenate([t[0] for t in top])),
            "rep": pa.array(np.concatenate([t[1] for t in top])),
            "x": pa.array([row for t in top for row in t[2].tolist()], pa.list_(pa.float64())),
        })

    found = points.select("rep", "x").mapInArrow(scan, "probe int, score double, rep long, x array<double>")
    order = W.partitionBy("probe").orderBy(F.desc("score"), "rep")
    rows = found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).collect()
    return [np.array([r["x"] for r in rows if r["probe"] == i]) for i in range(len(probes))]


def leaf_budget(forest: Forest, probes: np.ndarray, neighbours: list[np.ndarray], recall: float) -> int:
    """The smallest budget of leaves that finds the share ``recall`` of the probes' true neighbours."""
    needed = []
    for probe, near in zip(probes, neighbours):
        if not len(near):
            continue
        position = {cell: i + 1 for i, cell in enumerate(forest.visits(probe, 1 << 40))}
        needed += [min(position[c] for c in row) for row in forest.cells(near).tolist()]
    needed.sort()
    return needed[min(int(np.ceil(recall * len(needed))), len(needed)) - 1] if needed else 1


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    trees: int = 8, leaf_rows: int = 512, sample: int = 32_768, probes: int = 64, recall: float = 0.96, seed: int = 11,
) -> DataFrame:
    """``(query_id, rank, <key>, score)``: for each row where ``queries`` holds, its ``k`` nearest found others.

    Nearest is the largest inner product in double precision, ties to the smaller key; a row is never its
    own candidate. Rows without key, and vectors that are null, zero or hold a null or non-finite component,
    take no part, nor do vectors of another dimension than most rows have (the smaller among equals). Of
    several vectors of one key the smallest counts. Equal vectors are filed once and expanded again, so any
    number of copies is found. A query with fewer than ``k`` others gets them all; an empty table gives an
    empty result. Splits are fitted on ``sample`` vectors and the budget on ``probes`` queries; all rows
    are filed. Other columns are ignored.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    slim = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"), queries.alias("asks")
    )
    slim = slim.where(F.col("id").isNotNull() & usable(F.col("x")))
    sizes = slim.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if sizes is None:
        return spark.createDataFrame([], schema).withColumnRenamed("vec_id", key)
    width = sizes["width"]
    slim = slim.where(F.size("x") == width)
    slim = slim.groupBy("id").agg(F.min("x").alias("x"), F.max("asks").alias("asks"))
    slim = stored(slim, "vectors")

    # Of equal vectors the k + 1 smallest keys can be among the nearest; the smallest stands for them.
    by_vector = W.partitionBy("x").orderBy("id")
    members = slim.select("id", "x", F.row_number().over(by_vector).alias("place")).where(F.col("place") <= k + 1)
    members = stored(members.withColumn("rep", F.min("id").over(W.partitionBy("x"))), "members")
    points = members.where("place = 1").select("rep", "x")
    squares = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    stats = points.agg(F.count(F.lit(1)).alias("n"), F.max(squares).alias("square")).first()
    asked = stored(
        slim.where("asks").select(F.col("id").alias("query_id"), "x").join(points, "x").select("query_id", "rep"), "asked"
    )
    wanted = points.join(asked.select("rep").distinct(), "rep")

    by_hash = F.xxhash64("rep")
    fit = matrix(points.orderBy(by_hash).limit(sample).select("x").toArrow().column(0), width)
    levels = max(int(np.ceil(np.log2(max(stats["n"] / leaf_rows, 1)))), 3)
    # A hair above the largest, so that rounding leaves no negative rest.
    forest = Forest.grown(fit, np.sqrt(stats["square"]) * (1 + 1e-12), trees, levels, seed)
    probe = wanted.orderBy(by_hash).limit(probes).select("x").toArrow().column(0)
    probe = matrix(probe, width) if len(probe) else np.zeros((0, width))
    budget = leaf_budget(forest, probe, exact_neighbours(points, probe, k + 1, width), recall)
    # Plain arrays: a broadcast object of a class of this package would ask the workers for the package.
    shipped = spark.sparkContext.broadcast(
        (forest.planes, forest.offsets, forest.directions, forest.centres, forest.length)
    )

    def file(batches, chunks):
        own = Forest(*shipped.value)
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1), width)
            cells = own.cells(x)
            raw = [row.tobytes() for row in x]
            for chunk in range(chunks):
                yield pa.RecordBatch.from_pydict({
                    "cell": pa.array(cells.T.reshape(-1)), "chunk": pa.array(np.full(cells.size, chunk)),
                    "id": pa.array(np.tile(ids, trees)), "raw": pa.array(raw * trees, pa.binary()),
                })

    def ask(batches, budget, chunks):
        own = Forest(*shipped.value)
        for batch in batches:
            ids, x = batch.column(0).to_pylist(), matrix(batch.column(1), width)
            for start in range(0, len(ids), 256):
                rows = [
                    (c, i % chunks, i, q.tobytes())
                    for i, q in zip(ids[start : start + 256], x[start : start + 256])
                    for c in own.visits(q, budget)
                ]
                yield pa.RecordBatch.from_pydict(
                    {n: pa.array(v) for n, v in zip(("cell", "chunk", "id", "raw"), zip(*rows))}
                )

    def stacked(table: pa.Table) -> np.ndarray:
        return np.frombuffer(b"".join(table.column("raw").to_pylist()), np.float64).reshape(-1, width)

    def search(key, queries, rows):
        if not queries.num_rows or not rows.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "near": pa.array([], pa.binary())})
        ids, x, q = rows.column("id").to_numpy(), stacked(rows), stacked(queries)
        found = []
        for start in range(0, len(q), 512):
            scores = np.einsum("qd,nd->qn", q[start : start + 512], x)
            for s in scores:
                keep = best(s, ids, k + 1) if len(s) <= 4 * k else None
                if keep is None:
                    edge = np.partition(s, len(s) - k - 1)[len(s) - k - 1]
                    near = np.flatnonzero(s >= edge)
                    keep = near[best(s[near], ids[near], k + 1)]
                found.append(ids[keep].astype(np.int64).tobytes() + s[keep].tobytes())
        return pa.table({"id": queries.column("id"), "near": pa.array(found, pa.binary())})

    def merge(key, table):
        parts = [np.frombuffer(v, np.int64) for v in table.column("near").to_pylist()]
        ids = np.concatenate([p[: len(p) // 2] for p in parts])
        scores = np.concatenate([p[len(p) // 2 :].view(np.float64) for p in parts])
        ids, first = np.unique(ids, return_index=True)
        keep = best(scores[first], ids, k + 1)
        return pa.table({
            "query": pa.array(np.full(len(keep), key[0].as_py())), "rep": pa.array(ids[keep]),
            "score": pa.array(scores[first][keep]),
        })

    layout = "cell long, chunk long, id long, raw binary"

    def searched(asking: DataFrame, budget: int) -> DataFrame:
        per_leaf = asking.count() * budget / (trees * 2**levels)
        chunks = max(int(np.ceil(per_leaf / 16_384)), 1)  # a leaf that very many queries visit is searched in parts
        filed = points.select("rep", "x").mapInArrow(lambda b: file(b, chunks), layout).groupBy("cell", "chunk")
        asks = asking.select("rep", "x").mapInArrow(lambda b: ask(b, budget, chunks), layout).groupBy("cell", "chunk")
        found = asks.cogroup(filed).applyInArrow(search, "id long, near binary")
        return stored(found.groupBy("id").applyInArrow(merge, "query long, rep long, score double"), "found")

    # Where the leaves of the budget hold fewer rows than are wanted, a query goes on to more leaves.
    found, leaves, enough = searched(wanted, budget), trees * 2**levels, min(k + 1, stats["n"])
    while budget < leaves:
        full = found.groupBy("query").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= enough)
        short = wanted.join(full, F.col("rep") == F.col("query"), "left_anti")
        if short.isEmpty():
            break
        budget = min(4 * budget, leaves)
        again = searched(stored(short, "short"), budget)
        found = found.join(again.select("query").distinct(), "query", "left_anti").unionByName(again)
    # From classes of equal vectors to their rows, then from each class that asks to the queries in it.
    order = W.partitionBy("query").orderBy(F.desc("score"), "id")
    answers = found.join(members.select("rep", "id"), "rep").withColumn("_place", F.row_number().over(order))
    answers = answers.where(F.col("_place") <= k + 1).groupBy(F.col("query").alias("rep")).agg(
        F.array_sort(F.collect_list(F.struct("_place", "id", "score"))).alias("near")
    )
    others = F.slice(F.filter("near", lambda n: n["id"] != F.col("query_id")), 1, k)
    listed = asked.join(answers, "rep").select("query_id", F.posexplode(others).alias("_rank", "_near"))
    return listed.select(
        "query_id", (F.col("_rank") + 1).alias("rank"), F.col("_near.id").alias(key), F.col("_near.score").alias("score")
    )
