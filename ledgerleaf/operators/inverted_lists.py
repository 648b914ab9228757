"""A persisted vector index of inverted lists with product-quantised codes.

Vectors are filed in lists by their nearest coarse centroid, one Parquet folder per list. Each row
holds a short code of what is left after the centroid: one byte per group of dimensions, an entry
of that group's codebook. A search reads the lists of the centroids nearest to its queries only,
ranks their rows by distances to the codebooks' entries, and measures the best ones exactly.

Centroids and codebooks are fitted on a bounded sample by hash; every vector is filed. How many
lists a search visits is measured: the fewest that find the wanted share of the true neighbours
of a bounded set of stored vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerleaf.operators.search import nearest
from ledgerleaf.session import shared_dir
from ledgerleaf.sources.tables import overwrite_table

SAMPLE = 65_536  # vectors that centroids and codebooks are fitted on
PROBED = 64  # stored vectors that the number of visited lists is measured with
MOST_LISTS = 4096
CODES = 256  # entries of a codebook, one byte
ROWS = 65_536  # rows of a list that one task ranks; a larger list is ranked in parts


class Lists(NamedTuple):
    """An opened index: its rows, and the fitted arrays."""

    path: str
    rows: DataFrame  # vec_id, codes, vector, list
    centroids: np.ndarray  # lists x dimensions
    books: np.ndarray  # groups x codes x dimensions of a group, padded with zeros
    parts: dict[int, int]  # in how many parts a list is ranked


def clustered(points: np.ndarray, k: int, rounds: int = 15, seed: int = 5) -> np.ndarray:
    """Centres of a bounded sample, by Lloyd's rounds from distinct members; an empty one moves to the farthest point."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    k = min(k, len(distinct))
    centres = distinct[rng.choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        own, gap = closest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        counts = np.bincount(own, minlength=k)
        empty = np.flatnonzero(counts == 0)
        moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        moved[empty] = points[np.argsort(-gap, kind="stable")[: len(empty)]]
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def closest(points: np.ndarray, centres: np.ndarray, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of every point and its squared distance, from matrices of bounded area."""
    own, gap = np.empty(len(points), np.int64), np.empty(len(points))
    for i in range(0, len(points), block):
        part = points[i : i + block]
        squares = (part**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :] - 2 * part @ centres.T
        own[i : i + block] = squares.argmin(axis=1)
        gap[i : i + block] = np.maximum(squares.min(axis=1), 0)
    return own, gap


def split(points: np.ndarray, groups: int) -> np.ndarray:
    """``groups x points x dimensions of a group``, padded with zeros."""
    wide = -(-points.shape[1] // groups)
    padded = np.zeros((len(points), groups * wide))
    padded[:, : points.shape[1]] = points
    return padded.reshape(len(points), groups, wide).transpose(1, 0, 2)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def build_lists(
    corpus: DataFrame, id_column: str, path: str | None = None, lists: int | None = None, groups: int = 8, sample: int = SAMPLE
) -> Lists:
    """Write the index of ``id_column`` and ``vector`` at ``path`` and open it.

    Vectors that are null or not of the commonest width are left out. Without ``lists`` there are about as
    many as the root of the number of vectors, ``MOST_LISTS`` at most.
    """
    spark = corpus.sparkSession
    path = path or shared_dir(spark, "lists")
    slim = corpus.select(F.col(id_column).cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    slim = slim.where(F.col("vector").isNotNull())
    sizes = slim.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "width").first()
    width, total = (sizes["width"], sizes["n"]) if sizes else (1, 0)
    slim = slim.where(F.size("vector") == width)
    taken = slim.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow().column(0)
    points = _matrix(taken.combine_chunks()) if total else np.zeros((1, width))
    centroids = clustered(points, min(MOST_LISTS, lists or max(1, round(total**0.5))))
    groups = min(groups, width)
    # One codebook per group of dimensions, each fitted in a task of its own on the sample's residuals.
    left = split(points - centroids[closest(points, centroids)[0]], groups)
    rest = spark.sparkContext.broadcast(left)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in batch.column(0).to_pylist():
                book = clustered(rest.value[g], CODES)
                yield pa.RecordBatch.from_arrays([pa.array([g]), pa.array([book.tobytes()]), pa.array([len(book)])], ["g", "book", "codes"])

    fitted = spark.range(groups).repartition(groups, "id").mapInArrow(fit, "g long, book binary, codes long").collect()
    wide = left.shape[2]
    books = np.full((groups, CODES, wide), np.inf)
    for r in fitted:
        books[r["g"], : r["codes"]] = np.frombuffer(r["book"], np.float64).reshape(-1, wide)
    about = [(width, groups, centroids.tobytes(), books.tobytes())]
    overwrite_table(spark.createDataFrame(about, "width int, groups int, centroids binary, books binary"), f"{path}/about")
    shared = spark.sparkContext.broadcast((centroids, books))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, entries = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                x = _matrix(part.column(1))
                own, _ = closest(x, centres)
                codes = coded(x - centres[own], entries)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([row.tobytes() for row in codes], pa.binary()), part.column(1), pa.array(own.astype(np.int32))],
                    ["vec_id", "codes", "vector", "list"],
                )

    filed = slim.mapInArrow(file, "vec_id long, codes binary, vector array<double>, list int")
    # A list may hold most vectors: rebalancing splits its folder over tasks and files.
    filed.hint("rebalance", "list").write.partitionBy("list").parquet(f"{path}/rows")
    return open_lists(spark, path)


def coded(rest: np.ndarray, books: np.ndarray) -> np.ndarray:
    """One byte per group: the nearest entry of its codebook."""
    out = np.empty((len(rest), len(books)), np.uint8)
    for g, part in enumerate(split(rest, len(books))):
        entries = books[g][np.isfinite(books[g]).all(axis=1)]
        out[:, g] = closest(part, entries)[0]
    return out


def open_lists(spark: SparkSession, path: str) -> Lists:
    """The index that :func:`build_lists` wrote at ``path``."""
    about = spark.read.parquet(f"{path}/about").first()
    centroids = np.frombuffer(about["centroids"], np.float64).reshape(-1, about["width"])
    books = np.frombuffer(about["books"], np.float64).reshape(about["groups"], CODES, -1)
    rows = spark.read.schema("vec_id long, codes binary, vector array<double>, list int").parquet(f"{path}/rows")
    sizes = rows.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()
    return Lists(path, rows, centroids, books, {r["list"]: -(-r["n"] // ROWS) for r in sizes})


def visited(index: Lists, queries: DataFrame, probes: int) -> DataFrame:
    """``query_id, vector, list, part``: each query with the ``probes`` filled lists nearest to it, and their parts."""
    filled = np.array(sorted(index.parts), np.int64)
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast((index.centroids[filled], filled, np.array([index.parts[i] for i in filled], np.int64)))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, names, parts = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                x = _matrix(some.column(1))
                squares = ((x**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)) - 2 * x @ centres.T
                near = np.argsort(squares, axis=1, kind="stable")[:, :probes]
                at = np.repeat(np.arange(len(x)), near.shape[1])
                times = parts[near.ravel()]
                at, lists = np.repeat(at, times), np.repeat(names[near.ravel()], times)
                part = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(at), some.column(1).take(at), pa.array(lists.astype(np.int32)), pa.array(part.astype(np.int32))],
                    ["query_id", "vector", "list", "part"],
                )

    schema = queries.select("query_id", "vector").schema.add("list", "integer").add("part", "integer")
    return queries.select("query_id", "vector").mapInArrow(meet, schema)


def search_lists(
    index: Lists, queries: DataFrame, query_column: str, k: int, probes: int | None = None, rerank: int = 8, recall: float = 0.95
) -> DataFrame:
    """``query_id, vec_id, distance, rank``: the ``k`` nearest found, by squared L2 distance to six decimals, ties to
    the smaller id.

    Without ``probes`` their number is measured (see :func:`measured_probes`). Of every visited part the
    ``rerank * k`` best by code are measured exactly. Only the folders of visited lists are read.
    """
    asked = queries.select(F.col(query_column).alias("query_id"), F.col("vector").cast("array<double>").alias("vector"))
    if not index.parts:
        kind = asked.schema["query_id"].dataType.simpleString()
        return asked.sparkSession.createDataFrame([], f"query_id {kind}, vec_id long, distance double, rank int")
    probes = measured_probes(index, k, rerank, recall) if probes is None else probes
    met = overwrite_table(visited(index, asked, probes), shared_dir(asked.sparkSession, "visits"))
    candidates = _ranked(index, met, rerank * k)
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def lists_read(met: DataFrame) -> list[int]:
    """The lists that queries visit; there are ``MOST_LISTS`` at most."""
    return sorted(r["list"] for r in met.select("list").distinct().collect())


def _ranked(index: Lists, met: DataFrame, keep: int) -> DataFrame:
    """``query_id, vec_id, distance`` of the ``keep`` best rows by code, per query and visited part."""
    spark = met.sparkSession
    shared = spark.sparkContext.broadcast((index.centroids, index.books))
    rows = index.rows.where(F.col("list").isin(lists_read(met)))
    large = [F.lit(int(x)) for name, n in sorted(index.parts.items()) if n > 1 for x in (name, n)]
    parts = F.coalesce(F.element_at(F.create_map(*large), F.col("list")), F.lit(1)) if large else F.lit(1)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("vec_id"), parts).cast("int"))
    kind = met.schema["query_id"].dataType.simpleString()

    def rank(key, queries: pa.Table, held: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "distance"]
        if not queries.num_rows or not held.num_rows:
            return pa.table([queries.column("query_id").slice(0, 0), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        centroids, books = shared.value
        q, x = _matrix(queries.column("vector").combine_chunks()), _matrix(held.column("vector").combine_chunks())
        ids = held.column("vec_id").to_numpy()
        codes = np.frombuffer(b"".join(held.column("codes").to_pylist()), np.uint8).reshape(len(ids), -1)
        rest = split(q - centroids[key[0].as_py()], len(books))
        at, found, gaps = [], [], []
        for i in range(len(q)):
            # Squared distances from the query's residual to all entries, then one look-up per byte of a code.
            table = ((books - rest[:, i][:, None, :]) ** 2).sum(axis=2)
            guess = table[np.arange(len(books))[:, None], codes.T].sum(axis=0)
            near = np.arange(len(guess))
            if len(guess) > keep:
                border = np.partition(guess, keep - 1)[keep - 1]
                # Copies have equal codes: of those at the border the smaller ids stay.
                tied, closer = np.flatnonzero(guess == border), np.flatnonzero(guess < border)
                near = np.concatenate([closer, tied[np.argsort(ids[tied], kind="stable")[: keep - len(closer)]]])
            gap = np.round(((x[near] - q[i]) ** 2).sum(axis=1), 6)
            at += [i] * len(near)
            found.append(ids[near])
            gaps.append(gap)
        return pa.table([queries.column("query_id").take(pa.array(at)), pa.array(np.concatenate(found)), pa.array(np.concatenate(gaps))], names)

    groups = met.groupBy("list", "part").cogroup(rows.groupBy("list", "part"))
    return groups.applyInArrow(rank, f"query_id {kind}, vec_id long, distance double")


def measured_probes(index: Lists, k: int, rerank: int = 8, recall: float = 0.95) -> int:
    """The fewest lists that find the share ``recall`` of the exact neighbours of ``PROBED`` stored vectors.

    These are searched once by scanning; the place of each neighbour's list among the lists nearest to the query tells
    how many lists would have found it.
    """
    rows = index.rows.select("vec_id", "vector", "list")
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PROBED).select(F.col("vec_id").alias("query_id"), "vector")
    some = overwrite_table(some, shared_dir(rows.sparkSession, "probes"))
    true = nearest(rows.select("vec_id", "vector"), "vec_id", some, "query_id", k)
    homes = true.join(rows.select("vec_id", "list"), "vec_id").select("query_id", "list").collect()  # PROBED times k
    filled = np.array(sorted(index.parts))
    centres, place = index.centroids[filled], {}
    for r in some.collect():
        near = filled[np.argsort(((centres - np.array(r["vector"])) ** 2).sum(axis=1), kind="stable")]
        place[r["query_id"]] = {int(name): i + 1 for i, name in enumerate(near)}
    needed = sorted(place[r["query_id"]][r["list"]] for r in homes)
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))] if needed else 1
