"""Find every run of ``width`` symbols that a corpus holds more than once.

Both exact repeat operators (bytes and words) share this exchange. No pair of
documents is ever formed; four steps pass compact rows:

1. *Anchors.* The smallest gram hash inside a window is a function of the window's
   content alone. Each block of documents sends its distinct anchors.
2. *Shared anchors.* Per range of hashes, anchors that occur once are told apart from
   those that recur; each block gets its recurring anchors back. Where repeats inside one
   text count, an anchor recurs if its gram stands at two positions, be it in one run.
3. *Segments.* A maximal run of windows with the same recurring anchor is one segment.
   A block sends each distinct segment once, so copies shrink before the shuffle. Equal
   windows have equal anchors, hence they meet in one place, where ``resolve`` (the
   operator's own method) finds the repeated ones. An anchor with very many occurrences
   is split further: its windows travel singly under the hash of their whole content.
4. *Answer.* Blocks get the repeated windows of their segments and apply them.

The text is shuffled once, into blocks; Spark reuses that exchange in all steps.

Rows whose key is null come after all others. A null or empty text has no windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAST = np.iinfo(np.int64).max  # the place of a row without key
FIRST = np.iinfo(np.int64).min  # smaller than the place of any row
CHUNK = 1 << 20  # bytes of text looked at in one go
PIECE = 1 << 22  # symbols of one text looked at in one go
MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


@dataclass(frozen=True)
class Windows:
    """What a window is: ``width`` bytes or words, anchored by a gram of ``gram`` of them."""

    words: bool
    width: int
    gram: int
    other_document: bool  # only windows of different rows count, not repeats inside one
    block_bytes: int = 24 << 20
    hot: int = 20_000  # occurrences from which the windows of an anchor travel singly

    def symbols(self, text: bytes) -> bytes | list[bytes]:
        return text.split() if self.words else text

    def content(self, symbols, start: int, end: int) -> bytes:
        return b" ".join(symbols[start:end]) if self.words else symbols[start:end]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; sorted unsigned 64-bit arrays as differences."""
    parts = []
    for a in arrays:
        flag = a.dtype == np.uint64 and len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        v = np.diff(a, prepend=a.dtype.type(0)) if flag else a
        planes = np.ascontiguousarray(v).view("u1").reshape(len(v), a.dtype.itemsize).T.tobytes()
        parts.append(np.array([len(a), ord(a.dtype.char), flag], "<i8").tobytes() + planes)
    return zstandard.compress(b"".join(parts), 3)


def unpack(value: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(value), 0, []
    while at < len(raw):
        n, kind, flag = np.frombuffer(raw, "<i8", 3, at).tolist()
        dtype = np.dtype(chr(kind))
        size = n * dtype.itemsize
        a = np.frombuffer(raw, "u1", size, at + 24).reshape(dtype.itemsize, n).T.copy().view(dtype).reshape(n)
        out.append(np.cumsum(a, dtype=dtype) if flag else a)
        at += 24 + size
    return out


def grouped(order: np.ndarray, keys: np.ndarray) -> Iterator[np.ndarray]:
    """``order`` cut where the sorted ``keys`` change."""
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield part


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * MIX[2]
    return h ^ (h >> np.uint64(32))


def gram_hashes(units: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive units (bytes by eights, or word hashes)."""
    n = len(units) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, size, np.uint64)
    if units.dtype == np.uint8 and size >= 8:
        raw = units.tobytes()
        offsets = [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]
        steps = [np.ndarray((n,), "<u8", raw, offset=j, strides=(1,)) for j in offsets]
    else:
        steps = [units[j : j + n].astype(np.uint64, copy=False) for j in range(size)]
    for j, step in enumerate(steps):
        h ^= step
        h *= MIX[j % 2]
        h ^= h >> np.uint64(32)
    return mixed(h)


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    if len(h) < width:
        return h[:0]
    m, done = h, 1
    while 2 * done <= width:
        m, done = np.minimum(m[:-done], m[done:]), 2 * done
    return np.minimum(m[: len(h) - width + 1], m[width - done :][: len(h) - width + 1])


@dataclass
class Runs:
    """Runs of windows with one anchor: hash, index of the document, first window, number of windows."""

    hashes: np.ndarray
    docs: np.ndarray
    starts: np.ndarray
    counts: np.ndarray


def runs_of(
    spec: Windows, texts: list[bytes], keep: np.ndarray | None = None, hot: np.ndarray | None = None,
    every_hot: bool = False, grams: bool = False,
):
    """Chunk by chunk, ``(symbols per document, Runs)``; only runs whose hash is in ``keep``, if given.

    Windows under an anchor of ``hot`` become runs of one window, under the hash of its content,
    all of them if ``every_hot``. With ``grams`` there is instead one entry per position at which
    an anchor's gram stands.
    """
    span = spec.width - spec.gram + 1  # grams of a window
    batch: list[tuple[int, int, object]] = []
    size = 0
    symbols: dict[int, object] = {}

    def flush():
        pieces = [p for _, _, p in batch]
        lengths = np.array([len(p) for p in pieces])
        if spec.words:
            digest = xxhash.xxh3_64_intdigest
            units = np.fromiter((digest(w) for p in pieces for w in p), np.uint64, int(lengths.sum()))
        else:
            units = np.frombuffer(b"".join(pieces), np.uint8)
        own = gram_hashes(units, spec.gram)
        least = sliding_min(own, span)
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        last = begin + lengths - spec.width
        fits = last >= begin
        marks = np.zeros(len(least) + 1, bool)
        if len(least):
            marks[1:-1] = least[1:] != least[:-1]
            marks[begin[fits]] = True
            marks[last[fits] + 1] = True
        at = np.flatnonzero(marks[:-1])
        piece = np.searchsorted(begin, at, "right") - 1
        ends = np.append(at[1:], len(least))
        good = at <= last[piece]
        at, ends, piece = at[good], ends[good], piece[good]
        if grams:
            # A gram is an anchor where the greatest of the anchors of the windows around it is itself.
            whole = np.zeros(len(least) + 2 * (span - 1), np.uint64)
            inside = np.repeat(at, ends - at) + ranges(ends - at)
            whole[inside + span - 1] = least[inside]
            at = np.flatnonzero(~sliding_min(~whole, span) == own) if len(least) else at
            piece = np.searchsorted(begin, at, "right") - 1
            return Runs(own[at], doc_of[piece], at - begin[piece] + base_of[piece], np.ones(len(at), np.int64))
        hashes, counts = least[at], ends - at
        if hot is not None and len(hot):
            burning = member(hashes, hot)
            if burning.any():
                whole = gram_hashes(units, spec.width)
                one = np.repeat(at[burning], counts[burning]) + ranges(counts[burning])
                owner = np.repeat(piece[burning], counts[burning])
                cold = ~burning
                picked = member(hashes[cold], keep) if keep is not None else slice(None)
                single = slice(None) if every_hot or keep is None else member(whole[one], keep)
                hashes = np.concatenate([hashes[cold][picked], whole[one][single]])
                piece = np.concatenate([piece[cold][picked], owner[single]])
                counts = np.concatenate([counts[cold][picked], np.ones(len(one), np.int64)[single]])
                at = np.concatenate([at[cold][picked], one[single]])
                return Runs(hashes, doc_of[piece], at - begin[piece] + base_of[piece], counts)
        if keep is not None:
            picked = member(hashes, keep)
            hashes, at, piece, counts = hashes[picked], at[picked], piece[picked], counts[picked]
        return Runs(hashes, doc_of[piece], at - begin[piece] + base_of[piece], counts)

    for i, text in enumerate([*texts, None]):
        if text is None or size >= CHUNK:
            if batch:
                doc_of = np.array([d for d, _, _ in batch], np.int64)
                base_of = np.array([b for _, b, _ in batch], np.int64)
                yield symbols, flush()
            batch, size, symbols = [], 0, {}
        if text is None:
            break
        symbols[i] = own = spec.symbols(text)
        size += len(text)
        for base in range(0, max(len(own) - spec.width + 1, 0), PIECE):
            batch.append((i, base, own[base : base + PIECE + spec.width - 1]))


def ranges(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count in turn."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``among``."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def places(table: pa.Table) -> np.ndarray:
    return table.column("place").fill_null(LAST).to_numpy()


def texts_of(table: pa.Table) -> list[bytes]:
    return [t or b"" for t in table.column("bytes").to_pylist()]


def bucket_rows(keys: np.ndarray, buckets: int, block: int, packed: Callable[[np.ndarray], bytes]) -> pa.Table:
    """Rows sorted by key, packed by bucket."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((keys, bucket))
    parts = list(grouped(order, bucket[order]))
    return pa.table({
        "bucket": pa.array([int(bucket[p[0]]) for p in parts], pa.int64()),
        "block": pa.array([block] * len(parts), pa.int64()),
        "payload": pa.array([packed(p) for p in parts], pa.binary()),
    })


def repeated(
    docs: DataFrame,
    spec: Windows,
    resolve: Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, ...]],
    finish: Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], dict],
    schema: str,
    key: str,
    text: str,
) -> DataFrame:
    """One row per row of ``docs``: its key and what ``finish`` makes of its symbols and repeated windows.

    ``resolve(segments, least place, occurrences)`` returns arrays ``(segment, first window, end, place)``:
    windows that are repeated for rows after ``place``. ``finish(texts, docs, starts, ends)`` gets the texts of
    a block and where repeated symbols lie, and returns columns.
    """
    spark = docs.sparkSession
    total = docs.select(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(wide, -(-total // spec.block_bytes))
    blocks = docs.select(
        F.col(key).cast("long").alias("place"), F.col(text).cast("string").cast("binary").alias("bytes")
    )
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("place", "bytes"), F.lit(n))).repartition(n, "block")
    buckets = 2 * n

    def anchors(key, table):
        hashes, holders = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        place = places(table)
        for _, runs in runs_of(spec, texts_of(table), grams=not spec.other_document):
            hashes.append(runs.hashes)
            holders.append(place[runs.docs])
        hashes, holders = np.concatenate(hashes), np.concatenate(holders)
        order = np.argsort(hashes, kind="stable")
        hashes, holders = hashes[order], holders[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
        counts = np.diff(np.append(first, len(hashes)))
        if spec.other_document and len(first):
            several = np.minimum.reduceat(holders, first) != np.maximum.reduceat(holders, first)
        else:
            several = counts > 1
        hashes, counts = hashes[first], np.minimum(counts, 2**31 - 1).astype(np.uint32)
        return bucket_rows(
            hashes, buckets, key[0].as_py(), lambda p: pack(hashes[p], counts[p], several[p].astype(np.uint8))
        )

    def shared(key, table):
        block_ids = table.column("block").to_pylist()
        parts = [unpack(v) for v in table.column("payload").to_pylist()]
        hashes = np.concatenate([p[0] for p in parts])
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.append(True, hashes[order][1:] != hashes[order][:-1]))
        counts = np.add.reduceat(np.concatenate([p[1] for p in parts])[order].astype(np.int64), first)
        several = np.maximum.reduceat(np.concatenate([p[2] for p in parts])[order], first) > 0
        holders = np.diff(np.append(first, len(hashes)))
        recurring = several | (holders > 1)
        hashes = hashes[order][first]
        hot = hashes[recurring & (counts >= spec.hot)]
        hashes = hashes[recurring]
        rows = [(b, p[0][member(p[0], hashes)]) for b, p in zip(block_ids, parts)]
        rows = [(b, pack(h), pack(h[member(h, hot)])) for b, h in rows if len(h)]
        return pa.table({
            "block": pa.array([r[0] for r in rows], pa.int64()),
            "payload": pa.array([r[1] for r in rows], pa.binary()),
            "hot": pa.array([r[2] for r in rows], pa.binary()),
        })

    def merged(values) -> np.ndarray:
        return np.sort(np.concatenate([np.zeros(0, np.uint64), *(unpack(v)[0] for v in values)]))

    def segments(key, table, answers):
        keep, hot = merged(answers.column("payload").to_pylist()), merged(answers.column("hot").to_pylist())
        found: dict[bytes, list] = {}
        if len(keep):
            place, texts = places(table), texts_of(table)
            for symbols, runs in runs_of(spec, texts, keep, hot, every_hot=True):
                rows = zip(*(a.tolist() for a in (runs.hashes, runs.docs, runs.starts, runs.counts)))
                for h, d, s, c in rows:
                    content = spec.content(symbols[d], s, s + c + spec.width - 1)
                    p = int(place[d])
                    old = found.get(content)
                    if old is None:
                        found[content] = [h, p, p, 1]
                    else:
                        old[1], old[2], old[3] = min(old[1], p), max(old[2], p), old[3] + 1
        contents = list(found)
        hashes = np.array([v[0] for v in found.values()], np.uint64)
        low, high, count = (np.array([v[i] for v in found.values()], np.int64) for i in (1, 2, 3))

        def packed(p):
            chosen = [contents[i] for i in p]
            sizes = np.array([len(c) for c in chosen], np.uint32)
            return pack(hashes[p], low[p], high[p] - low[p], count[p], sizes, np.frombuffer(b"".join(chosen), np.uint8))

        return bucket_rows(hashes, buckets, key[0].as_py(), packed)

    def resolved(key, table):
        found: dict[bytes, list[int]] = {}
        contents, hashes, low, count, rows = [], [], [], [], []
        for block, value in zip(table.column("block").to_pylist(), table.column("payload").to_pylist()):
            h, lo, span, c, sizes, raw = unpack(value)
            raw, ends = raw.tobytes(), np.cumsum(sizes.astype(np.int64)).tolist()
            start = 0
            for i, (end, hi, li, si, ci) in enumerate(zip(ends, h.tolist(), lo.tolist(), span.tolist(), c.tolist())):
                content = raw[start:end]
                start = end
                at = found.get(content)
                if at is None:
                    at = found[content] = len(contents)
                    contents.append(content)
                    hashes.append(hi)
                    low.append(li)
                    count.append(ci)
                else:
                    low[at] = min(low[at], li)
                    count[at] += ci
                rows.append((at, block, li + si))
        hashes, low, count = np.array(hashes, np.uint64), np.array(low, np.int64), np.array(count, np.int64)
        holder, block, high = (np.array(a, np.int64) for a in zip(*rows))
        order = np.argsort(holder, kind="stable")
        holder, block, high = holder[order], block[order], high[order]
        begin = np.searchsorted(holder, np.arange(len(contents)))
        held = np.diff(np.append(begin, len(holder)))
        digest = np.array([xxhash.xxh3_64_intdigest(c) for c in contents], np.uint64)
        out: dict[int, list] = {}
        by_hash = np.argsort(hashes, kind="stable")
        for part in slices(by_hash, hashes[by_hash], [len(contents[i]) for i in by_hash]):
            segment, first, end, place = resolve([contents[i] for i in part], low[part], count[part])
            segment = part[segment]
            each = held[segment]
            entry = np.repeat(begin[segment], each) + ranges(each)
            run = np.repeat(np.arange(len(segment)), each)
            useful = place[run] < high[entry]
            entry, run = entry[useful], run[useful]
            order = np.argsort(block[entry], kind="stable")
            for p in grouped(order, block[entry][order]):
                s, r = segment[run[p]], run[p]
                out.setdefault(int(block[entry[p[0]]]), []).append((hashes[s], digest[s], first[r], end[r], place[r]))
        return pa.table({
            "block": pa.array(list(out), pa.int64()),
            "payload": pa.array(
                [pack(*(np.concatenate([a[i] for a in v]) for i in range(5))) for v in out.values()], pa.binary()
            ),
            "hot": pa.array([None] * len(out), pa.binary()),
        })

    def answered(key, table, answers):
        values = [unpack(v) for v in answers.column("payload").to_pylist() if v is not None]
        hot = merged([v for v in answers.column("hot").to_pylist() if v is not None])
        place, texts = places(table), texts_of(table)
        spans: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if values:
            keys, digest, first, end, before = (np.concatenate([v[i] for v in values]) for i in range(5))
            order = np.argsort(digest, kind="stable")
            digest, first, end, before = digest[order], first[order], end[order], before[order]
            for symbols, runs in runs_of(spec, texts, np.unique(keys), hot):
                rows = list(zip(*(a.tolist() for a in (runs.docs, runs.starts, runs.counts))))
                own = np.fromiter(
                    (xxhash.xxh3_64_intdigest(spec.content(symbols[d], s, s + c + spec.width - 1)) for d, s, c in rows),
                    np.uint64, len(rows),
                )
                a, b = np.searchsorted(digest, own), np.searchsorted(digest, own, "right")
                run = np.repeat(np.arange(len(own)), b - a)
                hit = np.repeat(a, b - a) + ranges(b - a)
                good = before[hit] < place[runs.docs[run]]
                run, hit = run[good], hit[good]
                spans.append((
                    runs.docs[run], runs.starts[run] + first[hit], runs.starts[run] + end[hit] + spec.width - 1,
                ))
        joined = [np.concatenate([np.zeros(0, np.int64), *(s[i] for s in spans)]) for i in range(3)]
        columns = finish(texts, *joined)
        return pa.table({key_name: table.column("place"), **columns})

    key_name = key
    answer_schema = "block long, payload binary, hot binary"
    row_schema = "bucket long, block long, payload binary"
    anchor_rows = blocks.groupBy("block").applyInArrow(anchors, row_schema).repartition(n, "bucket")
    recurring = anchor_rows.groupBy("bucket").applyInArrow(shared, answer_schema).repartition(n, "block")
    segment_rows = blocks.groupBy("block").cogroup(recurring.groupBy("block")).applyInArrow(segments, row_schema)
    answers = segment_rows.repartition(n, "bucket").groupBy("bucket").applyInArrow(resolved, answer_schema)
    burning = recurring.select("block", F.lit(None).cast("binary").alias("payload"), "hot")
    answers = answers.unionByName(burning).repartition(n, "block")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(answered, f"{key} long, {schema}")


def slices(order: np.ndarray, hashes: np.ndarray, sizes: list[int], limit: int = 1 << 20) -> Iterator[np.ndarray]:
    """Consecutive parts of ``order`` of about ``limit`` bytes that never separate equal hashes."""
    start = size = 0
    for i, own in enumerate(sizes):
        if size >= limit and hashes[i] != hashes[i - 1]:
            yield order[start:i]
            start, size = i, 0
        size += own
    if len(order):
        yield order[start:]


def covered(lengths: np.ndarray, docs: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Per document a boolean array of the covered symbols; documents without any give None."""
    order = np.argsort(docs, kind="stable")
    docs, starts, ends = docs[order], starts[order], ends[order]
    begin = np.searchsorted(docs, np.arange(len(lengths) + 1))
    for i, length in enumerate(lengths):
        a, b = begin[i], begin[i + 1]
        if a == b:
            yield None
            continue
        edges = np.bincount(starts[a:b], minlength=length + 1) - np.bincount(ends[a:b], minlength=length + 1)
        yield np.cumsum(edges[:length]) > 0
