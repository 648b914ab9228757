"""Exact substring repeats across documents, by suffix arrays built with two-stage sorting.

Segments that may hold a repeat (see :mod:`shared_windows`) meet in one place and are
laid end to end. Of their suffixes only those smaller than their successors are sorted
directly. The others are induced: scanning the buckets of first bytes in ascending order,
each suffix found puts its predecessor next into that predecessor's bucket. Neighbours in
the finished array whose common prefix reaches the width hold the same string.

Order and prefixes are needed to the depth of the width only, so comparisons stop there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerleaf.llm.shared_windows import Windows, covered, ranges, repeated

SEPARATOR = 0xFF  # occurs in no UTF-8 text


def words_at(raw: np.ndarray, offset: int, at: np.ndarray) -> np.ndarray:
    """Eight bytes from ``at + offset`` on, as numbers that compare like the bytes."""
    view = np.ndarray((len(raw) - 7 - offset,), ">u8", raw, offset=offset, strides=(1,))
    return view[at].astype(np.uint64)


def smaller_than_successor(t: np.ndarray) -> np.ndarray:
    """For each position, whether its suffix is smaller than the next one."""
    change = np.flatnonzero(t[1:] != t[:-1])
    lengths = np.diff(np.concatenate([[-1], change, [len(t) - 1]]))
    return np.repeat(np.append(t[change] < t[change + 1], False), lengths)


def sorted_directly(t: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``at`` in the order of their first ``depth`` bytes (or a few more)."""
    first = words_at(t, 0, at)
    order = np.argsort(first, kind="stable")
    at, key = at[order], first[order]
    new = np.append(True, key[1:] != key[:-1])[: len(at)]
    for offset in range(8, depth, 8):
        tied = ~(new & np.append(new[1:], True)[: len(at)])
        where = np.flatnonzero(tied)
        if not len(where):
            break
        group = np.cumsum(new)[where]
        key = words_at(t, offset, at[where])
        order = np.lexsort((key, group))
        at[where] = at[where][order]
        key = key[order]
        new[where[1:]] |= (group[1:] == group[:-1]) & (key[1:] != key[:-1])
    return at


def two_stage_order(t: np.ndarray, needed: np.ndarray, depth: int) -> np.ndarray:
    """The needed positions in suffix order to ``depth`` bytes.

    ``needed`` must hold, with a position larger than its successor, that successor too.
    """
    small = smaller_than_successor(t)
    direct = sorted_directly(t, np.flatnonzero(needed & small), depth)
    large = needed & ~small
    heads = np.searchsorted(t[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    done = []
    for c in range(256):
        front = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        induced = [front]
        rounds = 0
        while len(front):
            before = front - 1
            before = before[(before >= 0) & large[before] & (t[before] == c)]
            rounds += 1
            if rounds > depth and len(before):  # equal to the depth: the rest of these runs in one go
                back = np.searchsorted(run_starts(t), before, "right") - 1
                count = before - run_starts(t)[back] + 1
                before = np.repeat(before, count) - ranges(count)
                induced.append(before[large[before]])
                break
            front = before
            induced.append(front)
        found = np.concatenate([*induced, direct[heads[c] : heads[c + 1]]])
        done.append(found)
        before = found - 1
        before = before[(before >= 0) & large[before]]
        before = before[t[before] > c]
        order = np.argsort(t[before], kind="stable")
        before = before[order]
        first = t[before]
        cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
        for part in np.split(before, cuts) if len(before) else []:
            waiting[t[part[0]]].append(part)
    return np.concatenate(done)


def run_starts(t: np.ndarray) -> np.ndarray:
    return np.append(0, np.flatnonzero(t[1:] != t[:-1]) + 1)


def common_prefixes(t: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix with the position before, at most ``depth``; 0 for the first."""
    lcp = np.zeros(len(order), np.int64)
    open_ = np.arange(1, len(order))
    for offset in range(0, depth, 8):
        if not len(open_):
            break
        differ = words_at(t, offset, order[open_]) ^ words_at(t, offset, order[open_ - 1])
        same = np.full(len(differ), 8)
        unequal = differ != 0
        bits = np.frexp(differ[unequal].astype(np.float64))[1]  # rounding up can only cross from 2^k - 1 to 2^k
        exact = differ[unequal] >> np.maximum(bits - 1, 0).astype(np.uint64) == 0
        same[unequal] = (64 - (bits - exact)) // 8
        lcp[open_] += same
        open_ = open_[same == 8]
    return np.minimum(lcp, depth)


def repeats_in(segments: list[bytes], low: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Windows of the segments and the least place at which each one's content starts anywhere."""
    lengths = np.array([len(s) for s in segments], np.int64)
    t = np.frombuffer(bytes([SEPARATOR]).join([*segments, bytes([SEPARATOR]) * (width + 16)]), np.uint8)
    begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    windows = lengths - width + 1
    starts = np.repeat(begin, windows) + ranges(windows)
    owner = np.repeat(np.arange(len(segments)), windows)
    valid = np.zeros(len(t), bool)
    valid[starts] = True
    # Beyond the last window of a segment: on to the next suffix that is sorted directly.
    small = np.flatnonzero(smaller_than_successor(t))
    last = begin + windows - 1
    reach = small[np.searchsorted(small, last)] - last
    needed = valid.copy()
    needed[np.repeat(last, reach) + ranges(reach) + 1] = True
    order = two_stage_order(t, needed, width)
    order = order[valid[order]]
    new = common_prefixes(t, order, width) < width
    first = np.flatnonzero(new)
    owner_at = np.zeros(len(t), np.int64)
    owner_at[starts] = owner
    least = np.minimum.reduceat(low[owner_at[order]], first)
    least_at = np.zeros(len(t), np.int64)
    least_at[order] = np.repeat(least, np.diff(np.append(first, len(order))))
    place = least_at[starts]
    cut = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])))
    end = np.append(cut[1:], len(starts))
    offset = starts - begin[owner]
    return owner[cut], offset[cut], offset[end - 1] + 1, place[cut]


def remove_repeated_substrings(
    docs: DataFrame, width: int = 50, gram: int = 24, key: str = "doc_id", text: str = "text", **limits: int
) -> DataFrame:
    """Remove each byte covered by a ``width``-byte string that also starts in a row with a smaller key.

    Returns per row: the key (``long``), ``n_bytes``, ``spans`` (maximal removed runs of bytes, as
    ``array<struct<start, end>>``) and ``kept`` (binary: the remaining bytes joined).

    Strings are judged on the input. A null text counts as empty; texts under ``width`` bytes lose
    nothing. Rows with equal keys do not shorten each other; a null key counts as the largest. Other
    columns are ignored. An empty table gives an empty result.
    """
    spec = Windows(words=False, width=width, gram=min(gram, width), other_document=True, **limits)

    def resolve(segments, low, count):
        return repeats_in(segments, low, width)

    def finish(texts, owners, starts, ends):
        spans, kept = [], []
        lengths = np.array([len(x) for x in texts], np.int64)
        for raw, mask in zip(texts, covered(lengths, owners, starts, ends)):
            if mask is None:
                spans.append([])
                kept.append(raw)
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]))).reshape(-1, 2)
            spans.append([{"start": a, "end": b} for a, b in edges.tolist()])
            kept.append(np.frombuffer(raw, np.uint8)[~mask].tobytes())
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return {
            "n_bytes": pa.array(lengths),
            "spans": pa.array(spans, pa.list_(span)),
            "kept": pa.array(kept, pa.binary()),
        }

    return repeated(
        docs, spec, resolve, finish, "n_bytes long, spans array<struct<start:long,end:long>>, kept binary", key, text
    )
