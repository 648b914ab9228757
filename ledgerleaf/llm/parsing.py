"""Repeated word windows, by relative Lempel-Ziv parsing.

Segments that may hold a repeat (see :mod:`shared_windows`) meet in one place and form a
reference block. The block is indexed by seeds of a few words: the places of each seed that
occurs twice or more, in the order of the seeds that follow, so that the places that agree
longest are neighbours. Each segment is factored greedily against the block: a factor is copied
from a neighbour of the place where it starts and reaches as far as both agree, word by word; a
word whose seed occurs nowhere else is a literal. All windows inside a factor are repeats.
Windows that start in a factor and end beyond it are looked up one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerleaf.llm.shared_windows import Windows, covered, gram_hashes, ranges, repeated


def numbered(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words of the segments as numbers, end to end, and the words per segment."""
    numbers: dict[bytes, int] = {}
    flat, lengths = [], []
    for s in segments:
        words = s.split(b" ")
        lengths.append(len(words))
        flat.extend([numbers.setdefault(w, len(numbers)) for w in words])
    return np.array(flat, np.uint64), np.array(lengths, np.int64)


class SeedIndex:
    """For each place of a reference block the two places whose words agree with its own longest."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, limit: np.ndarray, width: int, seed: int):
        self.words, self.limit = words, limit
        noise = (words + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        seeds = gram_hashes(noise ^ (noise >> np.uint64(31)), seed)
        order = starts[np.argsort(seeds[starts], kind="stable")]
        own = seeds[order]
        twice = np.zeros(len(order), bool)
        twice[1:] = own[1:] == own[:-1]
        twice[:-1] |= twice[1:]
        order = order[twice]
        # The seeds that follow, the last one ending with the window: places that share a window are neighbours.
        further = [*range(seed, width - seed, seed), width - seed] if width > seed else []
        order = order[np.lexsort([*[seeds[order + k] for k in reversed(further)], seeds[order]])]
        self.before, self.after = np.full(len(words), -1, np.int64), np.full(len(words), -1, np.int64)
        alike = np.flatnonzero(seeds[order[1:]] == seeds[order[:-1]]) if len(order) else np.zeros(0, np.int64)
        self.after[order[alike]] = order[alike + 1]
        self.before[order[alike + 1]] = order[alike]

    def known(self) -> np.ndarray:
        """Where a seed starts that occurs elsewhere too."""
        return (self.before >= 0) | (self.after >= 0)

    def longest(self, at: np.ndarray, most: int | None = None) -> np.ndarray:
        """How many words from ``at`` on agree with another place, ``most`` at most."""
        reach = np.zeros(len(at), np.int64)
        for other in (self.before, self.after):
            there = np.flatnonzero(other[at] >= 0)
            here, source = at[there], other[at[there]]
            bound = np.minimum(self.limit[here] - here, self.limit[source] - source)
            if most is not None:
                bound = np.minimum(bound, most)
            reach[there] = np.maximum(reach[there], agreeing(self.words, here, source, bound))
        return reach


def repeats_in(
    segments: list[bytes], count: np.ndarray, width: int, seed: int = 8
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(segment, first window, end)`` of windows that occur more than once, counting copies of segments."""
    words, lengths = numbered(segments)
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    end = begin + lengths
    windows = lengths - width + 1
    starts = np.repeat(begin, windows) + ranges(windows)
    owner = np.repeat(np.arange(len(segments)), windows)
    limit = np.repeat(end, lengths)  # end of the segment around each word
    index = SeedIndex(words, starts, limit, width, min(seed, width))
    known = index.known()

    repeated_at = np.zeros(len(words) + 1, bool)
    copied = np.flatnonzero(count > 1)  # such a segment stands elsewhere as a whole: one factor
    repeated_at[np.repeat(begin[copied], windows[copied]) + ranges(windows[copied])] = True
    single = np.flatnonzero(count <= 1)
    following = next_true(known)  # the next word at which a factor can start
    at, stop = following[begin[single]], end[single]
    going = at < stop
    at, stop = at[going], stop[going]
    while len(at):
        reach = index.longest(at)
        inner = np.maximum(reach - width + 1, 0)
        repeated_at[np.repeat(at, inner) + ranges(inner)] = True
        # The factor's boundary: windows that start inside it and end beyond.
        cross = np.maximum(np.minimum(reach, stop - width + 1 - at) - inner, 0)
        edge = np.repeat(at + inner, cross) + ranges(cross)
        edge = edge[known[edge]]
        repeated_at[edge[index.longest(edge, width) >= width]] = True
        after = at + np.maximum(reach, 1)
        going = after < stop
        at, stop = following[after[going]], stop[going]
        going = at < stop
        at, stop = at[going], stop[going]

    hit = repeated_at[starts]
    starts, owner = starts[hit], owner[hit]
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    cut = np.flatnonzero(np.append(True, (starts[1:] != starts[:-1] + 1) | (owner[1:] != owner[:-1])))
    last = np.append(cut[1:], len(starts)) - 1
    offset = starts - begin[owner]
    return owner[cut], offset[cut], offset[last] + 1


def next_true(flags: np.ndarray) -> np.ndarray:
    """For each place the next true one at or after it, or the length."""
    n = len(flags)
    at = np.where(flags, np.arange(n), n)
    return np.append(np.minimum.accumulate(at[::-1])[::-1], n)


def agreeing(words: np.ndarray, at: np.ndarray, source: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Words that agree from ``at`` and ``source`` on, up to ``bound`` of them."""
    reach = np.zeros(len(at), np.int64)
    going, step = np.flatnonzero(bound > 0), 0
    while len(going):
        same = words[at[going] + step] == words[source[going] + step]
        going = going[same]
        step += 1
        reach[going] = step
        going = going[bound[going] > step]
    return reach


def remove_repeated_windows(
    docs: DataFrame, width: int = 35, gram: int = 8, key: str = "doc_id", text: str = "text", **limits: int
) -> DataFrame:
    """Remove each word covered by a window of ``width`` words whose sequence starts anywhere else too.

    Words are maximal runs of other characters than space, tab, line feed, vertical tab, form feed
    and carriage return. Returns per row: the key (``long``), ``n_words``, ``spans`` (maximal removed
    runs of words, ``array<struct<start, end>>``) and ``kept`` (the remaining words joined by a space).

    Windows are judged on the input; all copies go, the first included, also within one text. A null
    text has no words. Equal rows count as two places. Null keys are kept as they are. Other columns
    are ignored. An empty table gives an empty result.
    """
    spec = Windows(words=True, width=width, gram=min(gram, width), other_document=False, **limits)

    def resolve(segments, low, count):
        segment, first, end = repeats_in(segments, count, width)
        return segment, first, end, np.full(len(segment), np.iinfo(np.int64).min)

    def finish(texts, owners, starts, ends):
        words = [x.split() for x in texts]
        lengths = np.array([len(w) for w in words], np.int64)
        spans, kept = [], []
        for own, mask in zip(words, covered(lengths, owners, starts, ends)):
            if mask is None:
                spans.append([])
                kept.append(b" ".join(own))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]))).reshape(-1, 2)
            spans.append([{"start": a, "end": b} for a, b in edges.tolist()])
            kept.append(b" ".join([w for w, gone in zip(own, mask.tolist()) if not gone]))
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return {
            "n_words": pa.array(lengths),
            "spans": pa.array(spans, pa.list_(span)),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
        }

    return repeated(
        docs, spec, resolve, finish, "n_words long, spans array<struct<start:long,end:long>>, kept string", key, text
    )
