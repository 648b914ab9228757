"""Packing token sequences, shortest pack first over the histogram of lengths.

Lengths are placed longest first. A length goes into the open patterns with the most room
left, the shortest packs; patterns are counted, not listed, so the work depends on the number
of different lengths only. Pieces of a length are then ranked, and rank intervals tell each
piece its sequence and offset.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerleaf.llm.tables import stored

#: How the tokenizer cuts Latin-1 texts, once lower-cased: runs of letters, single numerals, short endings, runs of signs.
LATIN = re.compile("[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|'(?:s|t|re|ve|m|ll|d)|"
                   "[^\\t-\\r \x85\xa00-9a-z\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+")


SPACE = re.compile("[\\t-\\r ]+")


class Known(dict):
    """What is known of parts; ``new`` lists the lookups that found nothing, in order."""

    new: list[str] = []

    def __missing__(self, part: str) -> None:
        self.new.append(part)


class PartIds:
    """The ids of parts of texts, as little-endian 32-bit bytes.

    A text of Latin-1 characters is cut into parts here, of which the tokenizer never joins two; parts not met
    before are tokenized as one text, which falls into parts again where a token ends a word. Of other texts
    the words between ASCII white space are the parts, tokenized one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.parts = Known()
        self.words: dict[str, bytes] = {}

    def learn(self, new: list[str]) -> None:
        for i in range(0, len(new), 4096):
            some = new[i : i + 4096]
            found = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            raw, cuts = ids.tobytes(), ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(cuts) != len(some):
                raise ValueError("the tokenizer joins parts")
            self.parts.update(zip(some, [raw[a:b] for a, b in zip([0, *cuts], cuts)]))

    def word(self, text: str) -> bytes:
        found = self.words.get(text)
        if found is None:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = self.words[text] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def encode(self, texts: list[str], most: int) -> list[bytes]:
        cut: list[list[str] | None] = []
        for text in texts:
            plain = "<|" not in text  # its special tokens are found in whole words
            if plain and not text.isascii():
                try:
                    text.encode("latin-1")
                except UnicodeEncodeError:
                    plain = False
            cut.append(LATIN.findall(text.lower()) if plain else None)
        parts = self.parts
        if len(parts) > most:  # forget the older half
            for old in list(parts)[: len(parts) // 2]:
                del parts[old]
        if len(self.words) > most // 4:
            self.words.clear()
        parts.new = []
        found = [list(map(parts.__getitem__, c)) if c is not None else None for c in cut]
        if parts.new:
            self.learn(list(dict.fromkeys(parts.new)))
            rest = map(parts.__getitem__, parts.new)
            found = [f and [next(rest) if raw is None else raw for raw in f] for f in found]
        return [
            b"".join(f) if f is not None else b"".join(map(self.word, SPACE.split(text)))
            for text, f in zip(texts, found)
        ]


def encoder(path: str, end: int, known: int = 1_000_000):
    """A function from texts to their ids as little-endian 32-bit bytes, ``end`` appended.

    Up to ``known`` parts are remembered beside those of the texts at hand. A worker keeps what it knows for
    its next task.
    """
    kept = sys.modules.setdefault("ledgerleaf_worker_words", types.ModuleType("ledgerleaf_worker_words"))
    if getattr(kept, "path", None) != path:
        kept.path, kept.ids = path, PartIds(path)
    ids, tail = kept.ids, struct.pack("<I", end)

    def encode(texts: list[str | None]) -> list[bytes]:
        clean = [(t or "").encode("utf-8", "replace").decode() for t in texts]
        return [raw + tail for raw in ids.encode(clean, known)]

    return encode


def runs(texts: list[str | None], most: int = 256, characters: int = 1_000_000):
    """``(place of the first, texts)`` of runs of texts that are encoded together; a long text may stand alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= characters or i + 1 - start == most or i + 1 == len(texts):
            yield start, texts[start : i + 1]
            start, size = i + 1, 0


def pieces_of(docs: DataFrame, tokenizer: str, end: int, longest: int, key: str, text: str) -> DataFrame:
    """One row per piece: the key, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` and ``ids``."""

    def cut(batches):
        encode = encoder(tokenizer, end)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for i, run in runs(texts):
                encoded = encode(run)
                rows = [
                    (i + j, start, raw[4 * start : 4 * (start + longest)], len(raw) // 4)
                    for j, raw in enumerate(encoded) for start in range(0, len(raw) // 4, longest)
                ]
                at, starts, parts, totals = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    keys.take(pa.array(at)), pa.array(starts, pa.int64()),
                    pa.array([len(p) // 4 for p in parts], pa.int64()),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(totals, pa.int64()),
                ], [key, "start", "length", "ids_crc32", "doc_tokens"])

    slim = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    schema = slim.select(key).schema
    for name in ("start", "length", "ids_crc32", "doc_tokens"):
        schema = schema.add(name, "long")
    return slim.mapInArrow(cut, schema)


def patterns(histogram: dict[int, int], room: int) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths of a pattern, how many sequences have it)`` for the counted lengths, shortest pack first.

    Lengths are placed longest first, each into the open patterns with the most room left; a new one is
    opened only where none has room.
    """
    open_: list[dict[tuple[int, ...], int]] = [{} for _ in range(room + 1)]  # by room left

    def put(pattern: tuple[int, ...], left: int, count: int) -> None:
        if count:
            open_[left][pattern] = open_[left].get(pattern, 0) + count

    most = 0  # no open pattern has more room left
    for length in sorted(histogram, reverse=True):
        todo, left = histogram[length], most
        while todo and left >= length:
            if not open_[left]:
                most = left - 1 if left == most else most
                left -= 1
                continue
            pattern, count = open_[left].popitem()
            used = min(count, todo)
            put(pattern, left, count - used)
            put(pattern + (length,), left - length, used)
            todo -= used
        if todo:
            fits = room // length
            put((length,) * fits, room - fits * length, todo // fits)
            put((length,) * (todo % fits), room - todo % fits * length, int(todo % fits > 0))
            most = room
    return [(p, c) for bins in open_ for p, c in bins.items()]


def rank_intervals(packed: list[tuple[tuple[int, ...], int]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """Per length ``(first rank, end, first sequence, offset)``: rank r is in sequence first + r - first rank."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern, count in packed:
        offset = 0
        for length in pattern:
            rank = ranks.get(length, 0)
            out.setdefault(length, []).append((rank, rank + count, sequence, offset))
            ranks[length] = rank + count
            offset += length
        sequence += count
    return out


def pack(
    docs: DataFrame, tokenizer: str, room: int = 4096, end: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece of a document: the key, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id`` and ``offset``.

    A document is its tokens and ``end``; one longer than ``room`` is cut into full sequences and a rest.
    Pieces in a sequence lie end to end from offset 0. A null text is empty and has the end token only.
    Rows with equal keys are documents of their own; other columns are ignored; an empty table gives an
    empty result. The histogram has at most ``room`` lengths and is the only thing the driver sees.
    """
    spark = docs.sparkSession
    names = [key, "start", "length", "ids_crc32", "doc_tokens"]
    pieces = stored(pieces_of(docs, tokenizer, end, room, key, text), "pieces")
    # Pieces of a length are ranked inside many parts, whose counts tell where each part begins.
    parts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = pieces.withColumn("_part", F.pmod(F.xxhash64(*names), F.lit(parts)))
    counts = stored(spread.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(
        list(rank_intervals(patterns(histogram, room)).items()),
        "length long, _places array<struct<rank:long,stop:long,sequence:long,offset:long>>",
    )
    before = W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(before), F.lit(0))
    bases = counts.withColumn("_base", base).join(F.broadcast(plan), "length")
    touched = F.filter("_places", lambda p: (p["rank"] < F.col("_base") + F.col("n")) & (p["stop"] > F.col("_base")))
    bases = bases.select("length", "_part", "_base", touched.alias("_places"))
    inside = W.partitionBy("length", "_part").orderBy(*names)
    ranked = spread.withColumn("_row", F.row_number().over(inside) - 1).join(bases, ["length", "_part"])
    rank = F.col("_row") + F.col("_base")
    place = F.filter("_places", lambda p: (p["rank"] <= rank) & (p["stop"] > rank))[0]
    return ranked.withColumn("_place", place).select(
        *names, (F.col("_place.sequence") + rank - F.col("_place.rank")).alias("sequence_id"),
        F.col("_place.offset").alias("offset"),
    )
