"""Byte-level BPE through sentencepiece, for vocabularies given as ranks of byte strings.

The vocabulary is written straight into a sentencepiece BPE model: every byte becomes one
character, a token the string of its bytes' characters, its score the negative rank; the
normaliser changes nothing. The highest score merges first, so the model merges as the ranks
say. Texts are cut into pre-tokens by a pattern, pre-tokens are encoded, and ids are decoded
through the inverse of the byte mapping.
"""

from __future__ import annotations

import base64
import struct
import sys
import types

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fields of the published model format: (message, field number).
PIECES, TRAINER, NORMALISER = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
BPE = 2
#: A text's pre-tokens are encoded in runs of so many, so that memory stays near the text's own size.
RUN = 200_000
FRAME = 4_000_000  # bytes of ids handed back at once


def varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def whole(number: int, value: int) -> bytes:
    """A whole-number field; negative ones as 64-bit complements."""
    return varint(number << 3) + varint(value % 2**64)


def block(number: int, content: bytes) -> bytes:
    """A length-delimited field."""
    return varint(number << 3 | 2) + varint(len(content)) + content


#: Every byte as the character 256 places above it, none of which sentencepiece treats in its own way.
LETTERS = {b: 256 + b for b in range(256)}


def letters(raw: bytes) -> str:
    return raw.decode("latin-1").translate(LETTERS)


def unlettered(text: str) -> bytes:
    return bytes(ord(c) - 256 for c in text)


def piece(text: str, score: float, kind: int) -> bytes:
    return block(PIECES, block(1, text.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score) + whole(3, kind))


def bpe_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model whose ids are the ranks 0 to n - 1; id n is the unknown piece.

    Every single byte must be a token, so nothing is unknown. Scores are 32-bit floats, exact up to
    16,777,216 tokens.
    """
    order = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in order] != list(range(len(order))) or len(order) > 2**24:
        raise ValueError("ranks must be 0 to n - 1")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every single byte must have a rank")
    n = len(order)
    pieces = [piece(letters(t), -float(i), NORMAL) for i, t in enumerate(order)]
    none = b"".join(whole(field, -1) for field in (41, 42, 43))  # no ids for begin, end and padding
    trainer = whole(3, BPE) + whole(4, n + 1) + whole(40, n) + none + block(45, b"?")
    identity = block(1, b"identity") + b"".join(whole(field, 0) for field in (3, 4, 5))  # no prefix, nothing trimmed
    return b"".join(pieces) + piece("?", 0.0, UNKNOWN) + block(TRAINER, trainer) + block(NORMALISER, identity)


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with one ``base64 rank`` a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PretokenIds:
    """Pre-tokens to ids, as little-endian unsigned 32-bit bytes; ``known`` holds what was met lately."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.known: dict[str, bytes] = {}
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.load_from_serialized_proto(model)
        self.pattern = regex.compile(pattern)
        # A pre-token that is a token is that token, whatever merges would make of it.
        n = self.model.get_piece_size() - 1
        self.tokens = [unlettered(self.model.id_to_piece(i)) for i in range(n)]
        self.ranks = {t: i for i, t in enumerate(self.tokens)}

    def learn(self, pretokens: set[str]) -> None:
        raw = [p.encode("utf-8", "replace") for p in pretokens]
        found = self.model.encode([letters(r) for r in raw], out_type=int, num_threads=1)
        for pretoken, r, ids in zip(pretokens, raw, found):
            if r in self.ranks:
                ids = [self.ranks[r]]
            self.known[pretoken] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str, most: int) -> bytes:
        parts, known = [], self.known
        matches = map(self.match, self.pattern.finditer(text)) if len(text) > RUN else self.pattern.findall(text)
        for run in runs(matches, RUN):
            different = set(run)
            new = different.difference(known)
            if len(known) + len(new) > most:  # forget the older half
                for old in list(known)[: len(known) // 2]:
                    del known[old]
                new = different.difference(known)
            if new:
                self.learn(new)
            parts.append(b"".join(map(known.__getitem__, run)))
        return b"".join(parts)

    @staticmethod
    def match(found) -> str:
        return found[0]


def runs(items, longest: int):
    """Lists of at most ``longest`` items."""
    if isinstance(items, list):
        if items:
            yield items
        return
    run = []
    for item in items:
        run.append(item)
        if len(run) == longest:
            yield run
            run = []
    if run:
        yield run


def worker_ids(model: bytes, pattern: str) -> PretokenIds:
    """What this worker knows of the model, kept for its next task."""
    kept = sys.modules.setdefault("ledgerleaf_worker_bpe", types.ModuleType("ledgerleaf_worker_bpe"))
    mark = (hash(model), pattern)
    if getattr(kept, "mark", None) != mark:
        kept.mark, kept.ids = mark, PretokenIds(model, pattern)
    return kept.ids


def shipped(spark: SparkSession, ranks: dict[bytes, int]) -> Broadcast:
    """The model on its way to the workers: about 15 bytes a token, a vocabulary's size and no more."""
    return spark.sparkContext.broadcast(bpe_model(ranks))


def frames(keep: list[int], made: list[bytes], columns: list[pa.Array], names: list[str]):
    """Record batches of the kept columns and the made bytes, each of a bounded size."""
    start, size = 0, 0
    for i, raw in enumerate(made):
        size += len(raw)
        if size > FRAME or i + 1 == len(made):
            rows = slice(start, i + 1)
            cut = [columns[k].slice(start, i + 1 - start) for k in keep]
            yield pa.RecordBatch.from_arrays([*cut, pa.array(made[rows], pa.binary())], names)
            start, size = i + 1, 0


def with_bytes(
    df: DataFrame, kept: list[str], source: Column, name: str, model: Broadcast, pattern: str, step
) -> DataFrame:
    """The columns ``kept`` and the binary column ``name`` that ``step(ids, bytes)`` makes of ``source``."""
    marked = [f"_{i}" for i in range(len(kept))]  # any names, clashing ones too, pass through

    def make(batches):
        ids = worker_ids(model.value, pattern)
        for batch in batches:
            columns = batch.columns
            for i in range(0, batch.num_rows, 256):
                part = [c.slice(i, 256) for c in columns]
                made = [step(ids, raw or b"") for raw in part[-1].to_pylist()]
                yield from frames(list(range(len(kept))), made, part, [*marked, "_made"])

    slim = df.select(*[F.col(f"`{c}`").alias(m) for c, m in zip(kept, marked)], source.alias("_raw"))
    schema = slim.drop("_raw").schema.add("_made", "binary")
    made = slim.mapInArrow(make, schema)
    return made.select(*[F.col(m).alias(c) for c, m in zip(kept, marked)], F.col("_made").alias(name))


def encode(
    docs: DataFrame, model: Broadcast, pattern: str, text: str = "text", ids: str = "ids", known: int = 300_000
) -> DataFrame:
    """``docs`` without its texts and with ``ids``: each text's token ids as little-endian unsigned 32-bit bytes.

    Every match of ``pattern`` is encoded by itself, without special tokens. A null or empty text has no
    ids; bytes that are not UTF-8 count as U+FFFD; rows with equal keys stay rows of their own; an empty table gives an
    empty result; a column named ``ids`` is replaced, others pass through. A text of any length is encoded whole.
    Each worker remembers up to ``known`` pre-tokens.
    """
    kept = [c for c in docs.columns if c not in (text, ids)]
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    return with_bytes(
        docs, kept, raw, ids, model, pattern, lambda own, b: own.encode(b.decode("utf-8", "replace"), known)
    )


def decode(df: DataFrame, model: Broadcast, pattern: str, ids: str = "ids", raw: str = "decoded") -> DataFrame:
    """``df`` with ``raw``: the bytes that the tokens in ``ids`` stand for. Null or no ids give no bytes."""

    def back(own: PretokenIds, b: bytes) -> bytes:
        return b"".join(map(own.tokens.__getitem__, struct.unpack(f"<{len(b) // 4}I", b)))

    return with_bytes(df, [c for c in df.columns if c != raw], F.col(f"`{ids}`"), raw, model, pattern, back)
