"""Vectors of words and texts, learned from which words stand near one another.

Pairs of content words within a few places are counted over the corpus; their positive pointwise
mutual information is a sparse symmetric matrix. Its leading singular vectors come from a randomised
projection: products of the matrix with a narrow one.

Nearly every pair of a large corpus is rare, so that pairs are the bulk of the work. Words are
numbered by their hashes, and the pairs lie in cells: the words of a range of rows, met by a tile of
``TILE`` columns. A task counts the pairs of some texts by sorting and passes on each cell's numbers
as compressed differences, some two bytes a pair; a cell's parts then meet in one task. A product
reads the cells tile by tile, each with its own rows of the narrow matrix, and sums rows inside the
task, so that only rows as wide as the projection are shuffled. What reaches the driver at once is a tile of the
narrow matrix, and 16 bytes a word for the words' hashes and counts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from ledgerleaf.functions import text as tx
from ledgerleaf.functions.words import STOP_WORDS
from ledgerleaf.operators.corpus import smooth_idf
from ledgerleaf.session import checkpointed

#: Further directions beside those wanted, which make the projection more exact.
EXTRA = 8
#: Words whose rows of a narrow matrix travel to the tasks at a time.
TILE = 1 << 18
#: Pairs of a cell, about, and pairs that a task sorts at a time.
CELL_PAIRS, SORTED_PAIRS = 4_000_000, 8_000_000
#: Entries that meet their rows of the narrow matrix at a time.
STEP = 1 << 15


def content_of(text: Column) -> Column:
    return F.filter(tx.tokens(text), lambda w: ~w.isin(STOP_WORDS))


class Cells(NamedTuple):
    """Counted pairs: ``words`` (``token, a``), and ``cells`` (``cell, size, keys, counts``) of ``rows`` rows by ``width``
    columns each, ``tiles`` of them side by side. ``n`` words."""

    words: DataFrame
    cells: DataFrame
    n: int
    rows: int
    width: int
    tiles: int


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers by their bytes' places, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, 8 * size, asbytes=True), np.uint8).reshape(8, size)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and their counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    totals = np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first) if len(first) else counts
    return keys[first], totals


def hashed(word: Column, salt: int) -> Column:
    return F.xxhash64(word, F.lit(salt))


def numbered(vocabulary: DataFrame) -> tuple[DataFrame, np.ndarray, int]:
    """``token, a`` of the frequent words, their hashes in order (``a`` is the place there), and the hashes' salt.

    ``vocabulary`` has ``token`` and ``frequent``; no word shares the hash of a frequent one.
    """
    salt = 0
    while True:
        shared = vocabulary.groupBy(hashed(F.col("token"), salt)).agg(F.count(F.lit(1)).alias("k"), F.max("frequent").alias("f"))
        if shared.where("k > 1 AND f").isEmpty():
            break
        salt += 1
    known = vocabulary.where("frequent").select("token", hashed(F.col("token"), salt).alias("h"))
    hashes = np.sort(known.select("h").toArrow().column("h").to_numpy())
    shared = vocabulary.sparkSession.sparkContext.broadcast(hashes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(shared.value, batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.int64())], ["token", "a"])

    return checkpointed(known.mapInArrow(place, "token string, a long")), hashes, salt


def places_of(words: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row and the number of each word of a batch of hashed texts; -1 for words without a number."""
    sizes = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = words.flatten().to_numpy(zero_copy_only=False)
    at = np.searchsorted(hashes, flat)
    known = hashes[np.minimum(at, len(hashes) - 1)] == flat if len(hashes) else np.zeros(len(flat), bool)
    return np.repeat(np.arange(len(sizes)), sizes), np.where(known, at, -1)


def counted_pairs(docs: DataFrame, text: str = "text", near: int = 4, least: int = 5) -> Cells:
    """How often two words stand at most ``near`` places apart, in both orders.

    Words with fewer than ``least`` occurrences have no context to speak of and are left out; they keep their place.
    """
    words = docs.select(content_of(F.coalesce(F.col(text), F.lit(""))).alias("_w"))
    found = tx.unfolded(words, [], F.col("_w"), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    found = checkpointed(found.withColumn("frequent", F.col("n") >= least))
    vocabulary, hashes, salt = numbered(found.select("token", "frequent"))
    n = len(hashes)
    occurrences = found.where("frequent").agg(F.sum("n")).first()[0] or 0
    width = min(TILE, max(n, 1))
    tiles = max(1, -(-n // width))
    blocks = min(max(1, -(-2 * near * occurrences // (CELL_PAIRS * tiles))), max(n, 1))
    rows = -(-max(n, 1) // blocks)
    shared = docs.sparkSession.sparkContext.broadcast(hashes)
    area, chunk = rows * width, SORTED_PAIRS
    schema = "cell long, size long, keys binary, counts binary"

    def key_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a // rows * tiles + b // width) * rows + a % rows) * width + b % width

    def parts(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        cells = keys // area
        first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        ends = np.append(first[1:], len(keys))
        names = cells[first]
        steps = [packed(np.diff(keys[i:j] - c * area, prepend=0)) for i, j, c in zip(first, ends, names)]
        return pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array(ends - first), pa.array(steps, pa.binary()),
             pa.array([packed(counts[i:j]) for i, j in zip(first, ends)], pa.binary())],
            ["cell", "size", "keys", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        waiting = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                row, at = places_of(batch.column(0).slice(start, 256), shared.value)
                for d in range(1, near + 1):
                    a, b = at[:-d], at[d:]
                    met = (row[:-d] == row[d:]) & (a >= 0) & (b >= 0)
                    held += [key_of(a[met], b[met]), key_of(b[met], a[met])]
                    waiting += 2 * len(held[-1])
                if waiting >= chunk:
                    yield parts(*summed(np.concatenate(held)))
                    held, waiting = [], 0
        if waiting:
            yield parts(*summed(np.concatenate(held)))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, keys, counts, fresh = None, [], [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if r["cell"] != cell:
                    if keys:
                        yield parts(*_shifted(summed(np.concatenate(keys), np.concatenate(counts)), cell * area))
                    cell, keys, counts, fresh = r["cell"], [], [], 0
                keys.append(np.cumsum(unpacked(r["keys"], r["size"])))
                counts.append(unpacked(r["counts"], r["size"]))
                fresh += r["size"]
                if fresh >= chunk:
                    k, c = summed(np.concatenate(keys), np.concatenate(counts))
                    keys, counts, fresh = [k], [c], 0
        if keys:
            yield parts(*_shifted(summed(np.concatenate(keys), np.concatenate(counts)), cell * area))

    hashes_of = words.select(F.transform("_w", lambda w: hashed(w, salt)).alias("h"))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks * tiles // 4))
    met = hashes_of.mapInArrow(count, schema).repartition(tasks, "cell").sortWithinPartitions("cell")
    return Cells(vocabulary, checkpointed(met.mapInArrow(merge, schema)), n, rows, width, tiles)


def _shifted(found: tuple[np.ndarray, np.ndarray], by: int) -> tuple[np.ndarray, np.ndarray]:
    return found[0] + by, found[1]


def entries(pairs: Cells, cell: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row, column and count of each pair of a cell, by rows."""
    keys = np.cumsum(unpacked(cell["keys"], cell["size"]))
    # The keys are in order, so that a row's are a stretch of them.
    lengths = np.diff(np.searchsorted(keys, np.arange(pairs.rows + 1) * pairs.width))
    low = np.repeat(np.arange(pairs.rows), lengths)
    b = keys - low * pairs.width + cell["cell"] % pairs.tiles * pairs.width
    return cell["cell"] // pairs.tiles * pairs.rows + low, b, unpacked(cell["counts"], cell["size"])


def neighbouring_words(docs: DataFrame, text: str = "text", near: int = 4, least: int = 5) -> DataFrame:
    """``a, b, n``: the pairs of :func:`counted_pairs` by their words."""
    pairs = counted_pairs(docs, text, near, least)
    plain = pairs._replace(words=None, cells=None)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in entries(plain, cell)], ["_a", "_b", "n"])

    found = pairs.cells.mapInArrow(rows, "_a long, _b long, n long")
    for side in ("a", "b"):
        found = found.join(pairs.words.select(F.col("token").alias(side), F.col("a").alias(f"_{side}")), f"_{side}")
    return found.select("a", "b", "n")


def single_counts(pairs: Cells) -> np.ndarray:
    """How many pairs each word is part of."""
    plain = pairs._replace(words=None, cells=None)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.to_pylist():
                a, _b, n = entries(plain, cell)
                first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
                yield pa.RecordBatch.from_arrays([pa.array(a[first], pa.int64()), pa.array(np.add.reduceat(n, first))], ["a", "n"])

    rows = pairs.cells.mapInArrow(count, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(pairs.n, np.int64)
    out[rows.column("a").to_numpy()] = rows.column("n").to_numpy()
    return out


def tile_of(narrow: DataFrame, low: int, rows: int, width: int) -> np.ndarray:
    """The rows ``low`` to ``low + rows`` of a narrow matrix ``a, x``; zeros where it has none."""
    some = narrow.select("a", "x").where(F.col("a").between(low, low + rows - 1)).toArrow()
    x = np.zeros((rows, width))
    x[some.column("a").to_numpy() - low] = some.column("x").combine_chunks().flatten().to_numpy().reshape(-1, width)
    return x


def row_sums(x: np.ndarray, at: np.ndarray, by: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """``n`` sums over the rows ``at`` of ``x`` times ``by``; ``rows``, in order, says of which sum each is a part."""
    out = np.zeros((n, x.shape[1]))
    held = np.empty((min(STEP, len(at)), x.shape[1]))
    for i in range(0, len(at), STEP):
        r, weights = rows[i : i + STEP], by[i : i + STEP]
        met = np.take(x, at[i : i + STEP], axis=0, out=held[: len(r)], mode="clip")
        starts = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        if len(starts) * 16 > len(r):
            out[r[starts]] += np.add.reduceat(met * weights[:, None], starts, axis=0)
            continue
        # Long stretches are products of a row of weights and a matrix.
        for row, j, k in zip(r[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(r)]):
            out[row] += weights[j:k] @ met[j:k]
    return out


def listed(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), pa.float64()))


def summed_rows(parts: list[DataFrame], key: str, width: int) -> DataFrame:
    """``key, x``: the sum of each key's rows in the parts; in a single one a key has one row."""
    if len(parts) == 1:
        return parts[0]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    sums = whole.groupBy(key).agg(*[F.sum(F.col("x")[j]).alias(f"_{j}") for j in range(width)])
    return sums.select(key, F.array(*[F.col(f"_{j}") for j in range(width)]).alias("x"))


def information_product(pairs: Cells, single: np.ndarray, narrow: DataFrame, width: int) -> DataFrame:
    """``a, x``: the positive pointwise mutual information of counted pairs times rows ``a, x`` of a narrow matrix."""
    context = narrow.sparkSession.sparkContext
    plain = pairs._replace(words=None, cells=None)
    counts, total = context.broadcast(single), float(single.sum())
    parts, tiles = [], []
    for tile in range(pairs.tiles):
        low = tile * pairs.width
        tiles.append(context.broadcast(tile_of(narrow, low, pairs.width, width)))

        def times(batches: Iterator[pa.RecordBatch], low=low, shared=tiles[-1]) -> Iterator[pa.RecordBatch]:
            x, n_of = shared.value, counts.value
            for batch in batches:
                for cell in batch.to_pylist():
                    a, b, n = entries(plain, cell)
                    v = np.log(n * total / (n_of[a].astype(float) * n_of[b]))
                    a, b, v = a[v > 0], b[v > 0] - low, v[v > 0]
                    if len(a):
                        held = a[np.concatenate([[True], a[1:] != a[:-1]])]
                        y = row_sums(x, b, v, a - a[0], int(a[-1] - a[0]) + 1)[held - a[0]]
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), listed(y)], ["a", "x"])

        cells = pairs.cells.where(F.col("cell") % pairs.tiles == tile)
        parts.append(cells.mapInArrow(times, "a long, x array<double>"))
    result = checkpointed(summed_rows(parts, "a", width))
    for shared in (counts, *tiles):
        shared.destroy()
    return result


def information(pairs: DataFrame) -> DataFrame:
    """``a, b, v``: positive pointwise mutual information of counted pairs, which are symmetric."""
    pairs = checkpointed(pairs)
    single = pairs.groupBy("a").agg(F.sum("n").alias("_a"))
    total = single.agg(F.sum("_a")).first()[0] or 1
    met = pairs.join(single, "a").join(single.select(F.col("a").alias("b"), F.col("_a").alias("_b")), "b")
    v = F.ln(F.col("n") * F.lit(float(total)) / (F.col("_a") * F.col("_b")))
    return met.select("a", "b", v.alias("v")).where(F.col("v") > 0)


def product(matrix: DataFrame, narrow: DataFrame, width: int) -> DataFrame:
    """``a, x``: a sparse matrix ``a, b, v`` times rows ``a, x`` of a narrow one."""
    met = matrix.join(narrow.select(F.col("a").alias("b"), "x"), "b")
    sums = met.groupBy("a").agg(*[F.sum(F.col("v") * F.col("x")[j]).alias(f"_{j}") for j in range(width)])
    return sums.select("a", F.array(*[F.col(f"_{j}") for j in range(width)]).alias("x"))


def gram(narrow: DataFrame, width: int) -> np.ndarray:
    """The products of the columns of a narrow matrix: partial sums per batch, then one sum per cell."""

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(width * width)), pa.array(total.ravel())], ["i", "v"])

    cells = narrow.select("x").mapInArrow(squares, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(width * width)
    for r in cells:
        out[r["i"]] = r["v"]
    return out.reshape(width, width)


def turned(narrow: DataFrame, by: np.ndarray) -> DataFrame:
    """Each row times a small matrix."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, by.shape[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x @ by), pa.list_(pa.float64()))], ["a", "x"])

    return narrow.select("a", "x").mapInArrow(turn, f"a {narrow.schema['a'].dataType.simpleString()}, x array<double>")


def orthonormal(narrow: DataFrame, width: int) -> tuple[DataFrame, int]:
    """A basis of the columns' span and its width; directions without weight are left out. ``narrow`` is read anew."""
    for _ in range(2):  # the second round takes away the first one's rounding
        values, directions = np.linalg.eigh(gram(narrow, width))
        keep = values > 1e-12 * max(values.max(initial=0.0), 1e-300)
        narrow, width = turned(narrow, directions[:, keep] / np.sqrt(values[keep])), int(keep.sum())
    return narrow, width


def drawn(word: str, width: int) -> Column:
    """Normal numbers from the hash of a word and a number."""

    def normal(j: Column) -> Column:
        unit = lambda salt: (F.pmod(F.xxhash64(word, j, F.lit(salt)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        return F.sqrt(-2 * F.ln(unit(1))) * F.cos(2 * math.pi * unit(2))

    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), normal)


def leading(times: Callable[[DataFrame, int], DataFrame], start: DataFrame, rank: int, rounds: int) -> tuple[DataFrame, np.ndarray]:
    """The leading left singular vectors of a symmetric matrix and the singular values.

    ``times`` multiplies with a narrow matrix of a width and keeps the product. The projection's ``start`` depends on the words only, so the result does not depend on partitions but for rounding.
    """
    width = rank + EXTRA
    image = times(start, width)
    if image.isEmpty():
        return image, np.zeros(0)
    basis, width = orthonormal(image, width)
    for _ in range(rounds):
        basis, width = orthonormal(times(basis, width), width)
    image = times(basis, width)
    values, directions = np.linalg.eigh(gram(image, width))
    order = np.argsort(-values)[:rank]
    return turned(basis, directions[:, order]), np.sqrt(np.maximum(values[order], 0))


def singular_vectors(matrix: DataFrame, rank: int, rounds: int = 3) -> tuple[DataFrame, np.ndarray]:
    """``a, x`` with the leading left singular vectors of a symmetric sparse matrix ``a, b, v``, and the singular values."""
    matrix = checkpointed(matrix)
    start = matrix.select("a").distinct().select("a", drawn("a", rank + EXTRA).alias("x"))
    return leading(lambda narrow, width: checkpointed(product(matrix, narrow, width)), start, rank, rounds)


def word_vectors(docs: DataFrame, text: str = "text", size: int = 32, near: int = 4, least: int = 5) -> DataFrame:
    """``token, x``: a vector of ``size`` numbers for every word with contexts."""
    pairs = counted_pairs(docs, text, near, least)
    single = single_counts(pairs)
    start = pairs.words.select("a", drawn("token", size + EXTRA).alias("x"))
    vectors, values = leading(lambda narrow, width: information_product(pairs, single, narrow, width), start, size, 3)
    if len(values):
        vectors = turned(vectors, np.diag(np.sqrt(values)))
    return vectors.join(pairs.words, "a").select("token", "x")


def counted_words(docs: DataFrame, hashes: np.ndarray, salt: int, key: str, text: str) -> DataFrame:
    """``key, at, n``: the numbers of each key's words, each once, and how often they occur; texts of one key are one."""
    shared = docs.sparkSession.sparkContext.broadcast(hashes)
    words = F.transform(content_of(F.coalesce(F.col(text), F.lit(""))), lambda w: hashed(w, salt))
    schema = docs.select(key).schema.add("at", ArrayType(IntegerType())).add("n", ArrayType(IntegerType()))

    def rows(keys: list, found: list[tuple[np.ndarray, np.ndarray]], kind: pa.DataType) -> pa.RecordBatch:
        offsets = pa.array(np.cumsum([0, *(len(at) for at, _ in found)]), pa.int32())
        lists = [np.concatenate([f[i] for f in found]).astype(np.int32) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), *[pa.ListArray.from_arrays(offsets, pa.array(x)) for x in lists]], schema.names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                row, at = places_of(part.column(1), shared.value)
                ends = np.searchsorted(row, np.arange(part.num_rows + 1))
                found = [np.unique(at[i:j][at[i:j] >= 0], return_counts=True) for i, j in zip(ends, ends[1:])]
                yield rows(part.column(0).to_pylist(), found, part.schema.field(0).type)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            kind = batch.schema.field(0).type
            keys, found = [], []
            ends = [c.value_lengths().to_numpy().cumsum() for c in batch.columns[1:]][0]
            at, n = (c.flatten().to_numpy() for c in batch.columns[1:])
            for k, i, j in zip(batch.column(0).to_pylist(), [0, *ends], ends):
                own = (at[i:j], n[i:j])
                if last is not None and last[0] == k:
                    last = (k, summed(np.concatenate([last[1][0], own[0]]), np.concatenate([last[1][1], own[1]])), kind)
                    continue
                if last is not None:
                    keys.append(last[0])
                    found.append(last[1])
                last = (k, own, kind)
            if keys:
                yield rows(keys, found, kind)
        if last is not None:
            yield rows([last[0]], [last[1]], last[2])

    met = docs.select(key, words.alias("h")).mapInArrow(count, schema).repartition(F.col(key)).sortWithinPartitions(key)
    return checkpointed(met.mapInArrow(merge, schema))


def text_vectors(docs: DataFrame, words: DataFrame, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, vector`` of unit length: the words' vectors, each weighted by how rare its word is.

    Texts without any known word have none. Words are known by 64 bits of hash, which no two known ones share; the
    words' vectors travel to the tasks tile by tile.
    """
    context = docs.sparkSession.sparkContext
    numbers, hashes, salt = numbered(words.select("token", F.lit(True).alias("frequent")))
    narrow = checkpointed(words.join(numbers, "token").select("a", "x"))
    counted = counted_words(docs, hashes, salt, key, text)
    frequency = counted.select(F.explode("at").alias("a")).groupBy("a").agg(F.count(F.lit(1)).alias("df"))
    rare = frequency.select(F.col("a").cast("long").alias("a"), smooth_idf(F.col("df"), F.lit(docs.count())).alias("idf")).toArrow()
    idf = np.zeros(len(hashes))
    idf[rare.column("a").to_numpy()] = rare.column("idf").to_numpy()
    weights = context.broadcast(idf)
    schema = docs.select(key).schema.add("x", ArrayType(DoubleType()))
    parts, tiles = [], []
    for low in range(0, max(len(hashes), 1), TILE):
        rows = min(TILE, len(hashes) - low)
        tiles.append(context.broadcast(tile_of(narrow, low, rows, size)))

        def add(batches: Iterator[pa.RecordBatch], low=low, rows=rows, shared=tiles[-1]) -> Iterator[pa.RecordBatch]:
            x, idf = shared.value, weights.value
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    row = np.repeat(np.arange(part.num_rows), part.column(1).value_lengths().to_numpy())
                    at, n = (c.flatten().to_numpy() for c in part.columns[1:])
                    here = (at >= low) & (at < low + rows)
                    row, at, n = row[here], at[here], n[here]
                    held = np.unique(row)
                    y = row_sums(x, at - low, np.log1p(n) * idf[at], row, part.num_rows)[held]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(held)), listed(y)], schema.names)

        parts.append(counted.mapInArrow(add, schema))
    whole = checkpointed(summed_rows(parts, key, size))
    for shared in (weights, *tiles):
        shared.destroy()
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
    known = whole.withColumn("_norm", norm).where(F.col("_norm") > 0)
    return known.select(key, F.transform("x", lambda v: v / F.col("_norm")).alias("vector"))
