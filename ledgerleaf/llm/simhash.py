"""SimHash near-duplicates, linked through deletion-variant signatures.

Two 64-bit fingerprints that differ in at most four bits differ in at most one bit of one of
three segments. Each distinct fingerprint is therefore indexed under every segment with every
single bit of it left out; two that are close share such a key. Inside a key the distance is
verified, and links that span the same classes are passed on: not all pairs, but a forest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.llm.components import connected
from ledgerleaf.llm.tables import stored

BITS = 64


def segments(distance: int) -> list[tuple[int, int]]:
    """Bit ranges, so few that ``distance`` differing bits leave at most one in some of them."""
    parts = distance // 2 + 1
    edges = [BITS * i // parts for i in range(parts + 1)]
    return list(zip(edges, edges[1:]))


def fingerprint(text: str | None, shingle: int, seed: int = 42) -> int:
    """The SimHash of a text over its word shingles; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    size = min(shingle, len(words))
    starts, ends = (ends - lengths)[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends)), np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    set_bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(set_bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int, text: str = "text") -> DataFrame:
    """``docs`` with a column ``fingerprint_bits`` (``long``)."""

    def add(batches):
        for batch in batches:
            bits = [fingerprint(t, shingle) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bits, pa.int64())], [*batch.schema.names, "fingerprint_bits"]
            )

    schema = T.StructType([*docs.schema.fields, T.StructField("fingerprint_bits", T.LongType())])
    return docs.mapInArrow(add, schema)


def near(a: np.ndarray, b: np.ndarray, segment: int, bit: np.ndarray, first: np.ndarray, distance: int) -> np.ndarray:
    """Whether pairs are close and this key is the one of their keys that reports them."""
    differ = a ^ b
    inside = differ & np.uint64(segment)
    return (np.bitwise_count(differ) <= distance) & ((inside == bit) | ((inside == 0) & first))


def forest(values: np.ndarray, segment: int, bit: np.uint64, first: bool, distance: int):
    """Links between members of one large key that connect what is close, at most one per member."""
    left = np.arange(len(values))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            hit = near(values[left], values[i], segment, bit, np.bool_(first), distance)
            if hit.any():
                found = left[hit]
                left = left[~hit]
                queue.extend(found.tolist())
                yield np.full(len(found), values[i]), values[found]


def links_in(keys: np.ndarray, values: np.ndarray, distance: int, small: int = 24):
    """Verified links between fingerprints that share a key; keys are ``bit position * 2^32 + rest``."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    size = np.diff(np.append(begin, len(keys)))
    position = (keys >> 32).astype(np.uint64)
    bit = np.uint64(1) << position
    mask, first = np.zeros(len(keys), np.uint64), np.zeros(len(keys), bool)
    for low, high in segments(distance):
        inside = (position >= low) & (position < high)
        mask[inside] = ((1 << high) - 1) ^ ((1 << low) - 1)
        first |= position == low
    little = np.repeat(size <= small, size)
    for step in range(1, small):
        at = np.flatnonzero(little[:-step] & (keys[step:] == keys[:-step]))
        if not len(at):
            break
        a, b = values[at], values[at + step]
        differ = a ^ b
        inside = differ & mask[at]
        hit = (np.bitwise_count(differ) <= distance) & ((inside == bit[at]) | ((inside == 0) & first[at]))
        yield a[hit], b[hit]
    for start, count in zip(begin[size > small].tolist(), size[size > small].tolist()):
        own = values[start : start + count]
        yield from forest(own, int(mask[start]), bit[start], bool(first[start]), distance)


def close_links(distinct: DataFrame, distance: int) -> DataFrame:
    """``(a, b)`` links that connect all of ``distinct(bits)`` at ``distance`` or fewer differing bits."""
    spark = distinct.sparkSession
    keys = []
    for low, high in segments(distance):
        part = F.shiftrightunsigned("bits", low)
        part = part.bitwiseAND(F.lit((1 << (high - low)) - 1))
        keys += [
            part.bitwiseAND(F.lit(((1 << (high - low)) - 1) ^ (1 << i))) + F.lit((low + i) << 32)
            for i in range(high - low)
        ]
    # Keys of the segment values take up to 32 bits: segments are at most that wide.
    index = distinct.select("bits", F.explode(F.array(*keys)).alias("key"))
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def links(batches):
        parts = [(b.column("key").to_numpy(), b.column("bits").to_numpy()) for b in batches]
        if not parts:
            return
        keys = np.concatenate([p[0] for p in parts])
        values = np.concatenate([p[1] for p in parts]).view(np.uint64)
        for a, b in links_in(keys, values, distance):
            for i in range(0, len(a), 1 << 16):
                part = [pa.array(x[i : i + (1 << 16)].view(np.int64)) for x in (a, b)]
                yield pa.RecordBatch.from_arrays(part, ["a", "b"])

    return index.repartition(2 * wide, "key").mapInArrow(links, "a long, b long")


#: In how many parts the rows of a component are joined with its least key.
PARTS = 16


def components_of(marked: DataFrame, key: str, distance: int) -> DataFrame:
    """``(fingerprint_bits, root, component_id)`` for the fingerprints of ``marked``."""
    distinct = marked.groupBy(F.col("fingerprint_bits").alias("bits")).agg(F.min(key).alias("least"))
    roots = connected(close_links(distinct.select("bits"), distance))
    classes = distinct.join(roots.withColumnRenamed("node", "bits"), "bits", "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root")
    )
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    # One component may hold most fingerprints: its rows meet the least key in several parts.
    least = least.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    parts = classes.withColumn("_part", F.pmod(F.xxhash64("bits"), F.lit(PARTS)).cast("int"))
    return parts.join(least, ["root", "_part"]).select(F.col("bits").alias("fingerprint_bits"), "root", "component_id")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, distance: int = 4, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: the key, ``fingerprint_bits``, ``fingerprint`` (16 hex digits) and ``component_id``.

    Words are maximal runs of other characters than ASCII white space, A-Z in lower case; a text of
    fewer than ``shingle`` words is one shingle, one without words (or null) has fingerprint 0 and is
    linked like any other. ``component_id`` is the smallest key of the rows reachable over links of at
    most ``distance`` bits (null if none of them has a key). ``distance`` is at least 2. Rows are kept
    as they are, repeated ones too; other columns are ignored; an empty table gives an empty result.
    """
    slim = docs.select(F.col(key), F.col(text))
    marked = stored(fingerprints(slim, shingle, text).drop(text), "fingerprints")
    classes = components_of(marked, key, distance).drop("root")
    hexadecimal = F.lower(F.lpad(F.hex("fingerprint_bits"), 16, "0"))
    return marked.join(classes, "fingerprint_bits").select(
        key, "fingerprint_bits", hexadecimal.alias("fingerprint"), "component_id"
    )


def first_of_each(
    docs: DataFrame, shingle: int = 4, distance: int = 4, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each class of :func:`near_duplicates`, unchanged: the smallest key, a null key last.

    Among rows with that key the one with the smallest hash of its columns stays; equal rows count once. Null and
    empty texts are one class, like texts without words; an empty table stays empty.
    """
    whole = docs.select(F.struct("*").alias("_row"), F.xxhash64("*").alias("_hash"))
    slim = whole.select(F.col(f"_row.{key}").alias("_key"), F.col(f"_row.{text}").alias("_text"), "_hash")
    marked = stored(fingerprints(slim, shingle, "_text").drop("_text"), "fingerprints")
    classes = components_of(marked, "_key", distance)
    order = F.struct(F.col("_key").isNull().alias("absent"), F.col("_key").alias("least"), F.col("_hash").alias("hash"))
    best = marked.groupBy("fingerprint_bits").agg(F.min(order).alias("best"))
    best = best.join(classes, "fingerprint_bits").groupBy("root").agg(F.min("best").alias("best"))
    best = best.select(F.col("best.hash").alias("_hash"), F.col("best.least").alias("_least"))
    same = F.col(f"_row.{key}").eqNullSafe(F.col("_least"))
    # Equal rows are the only ones that can be found twice; they lie in one partition after the join.
    return whole.join(best, "_hash").where(same).dropDuplicates(["_least", "_hash"]).select("_row.*")
