"""Words, sentences and terms of many texts at once, and the sentences that sum a text up.

A batch of texts is one row of bytes. What the cleaning of ``text.KEEP_PUNCT`` leaves is plain letters, blanks and
three marks, so that tables of 256 entries find the ends of words and terms, and a term is a number: its
letters as digits of base 27 (the first 13, and the last two apart). All steps of a document run in one task and no
term is a row of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa

from ledgerleaf.functions.words import ABBREVIATIONS, STOP_WORDS

#: Bytes of texts that are taken apart at a time.
SLICE = 4_000_000
#: Lengths of terms, and the letters that their first number holds.
SHORTEST, LONGEST, FIRST = 2, 15, 13

LETTER = np.zeros(256, np.uint8)
LETTER[ord("a") : ord("z") + 1] = LETTER[ord("A") : ord("Z") + 1] = np.arange(1, 27)
BLANK = np.isin(np.arange(256), list(b" \t\r\n"))
KEPT = (LETTER > 0) | BLANK | np.isin(np.arange(256), list(b".,+"))
GUARDED = re.compile(rf"(^|[^A-Za-z])({'|'.join(ABBREVIATIONS)})\.")


class Texts(NamedTuple):
    """Cleaned texts: their bytes, where each begins, its words, and its terms (``letters`` has 0 for what is no letter)."""

    raw: np.ndarray
    begins: np.ndarray
    letters: np.ndarray
    word_start: np.ndarray
    word_end: np.ndarray
    word_row: np.ndarray
    term_start: np.ndarray
    term_length: np.ndarray


def _values(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts that are not null, and their offsets."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of true values start and end; the first value is false."""
    step = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(step) % 2:
        step = np.append(step, len(inside))
    return step[::2], step[1::2]


def cleaned(texts: pa.Array) -> Texts:
    """The words and terms of ``texts``, each of which begins with a line end and is not null."""
    raw, offsets = _values(texts)
    kept = KEPT[raw]
    begins = np.concatenate([[0], np.cumsum(kept)])[offsets]
    raw = raw[kept]
    word_start, word_end = _runs(~BLANK[raw])
    letters = LETTER[raw]
    start, end = _runs(letters > 0)
    length = end - start
    term = (length >= SHORTEST) & (length <= LONGEST)
    word_row = np.searchsorted(begins, word_start, "right") - 1
    return Texts(raw, begins, letters, word_start, word_end, word_row, start[term], length[term])


def numbers(letters: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers that name a term: its first letters, and those beyond (0 for none)."""
    code, rest = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    at = np.arange(len(start))
    for i in range(LONGEST):
        at = at[length[at] > i]
        if not len(at):
            break
        into = code if i < FIRST else rest
        into[at] = into[at] * 27 + letters[start[at] + i]
    return code, rest


def _numbers_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = _values(words)
    return numbers(LETTER[raw], offsets[:-1], np.diff(offsets))


class Terms(NamedTuple):
    """The terms of texts that are no stop words: which of the texts' terms they are, each one's number among those that
    differ, and the two numbers and first place of each of these."""

    at: np.ndarray
    of: np.ndarray
    code: np.ndarray
    rest: np.ndarray
    first: np.ndarray


def content(texts: Texts) -> Terms:
    code, rest = numbers(texts.letters, texts.term_start, texts.term_length)
    key, long = code, np.flatnonzero(rest)
    if len(long):
        key = code.copy()
        key[long] = 27**FIRST + np.unique(code[long], return_inverse=True)[1] * 27**2 + rest[long]
    of, differing = pd.factorize(key)
    first = np.zeros(len(differing), np.int64)
    first[of[::-1]] = np.arange(len(of))[::-1]
    stop = weights(pa.array([w for w in STOP_WORDS if w.isascii() and w.isalpha()]), None)
    keep = ~np.isfinite(stop.of(code[first], rest[first], np.nan))
    number = np.cumsum(keep) - 1
    at = np.flatnonzero(keep[of])
    return Terms(at, number[of[at]], code[first[keep]], rest[first[keep]], first[keep])


class Weights(NamedTuple):
    """Weights by term: of those whose first number is all, and of longer ones by both numbers."""

    short: np.ndarray
    short_weight: np.ndarray
    heads: np.ndarray
    long: np.ndarray
    long_weight: np.ndarray

    def of(self, code: np.ndarray, rest: np.ndarray, otherwise: float) -> np.ndarray:
        out = np.full(len(code), otherwise)
        for chosen, keys, known, values in (
            (np.flatnonzero(rest == 0), code, self.short, self.short_weight), (np.flatnonzero(rest), None, self.long, self.long_weight),
        ):
            if not len(known) or not len(chosen):
                continue
            if keys is None:
                head = np.searchsorted(self.heads, code[chosen])
                met = self.heads[np.minimum(head, len(self.heads) - 1)] == code[chosen]
                key = np.where(met, head * 27**2 + rest[chosen], -1)
            else:
                key = keys[chosen]
            place = np.minimum(np.searchsorted(known, key), len(known) - 1)
            found = known[place] == key
            out[chosen[found]] = values[place[found]]
        return out


def weights(words: pa.Array, values: np.ndarray | None) -> Weights:
    """The weights of ``words``, plain lower-case letters each; a word may come twice."""
    code, rest = _numbers_of(words)
    values = np.ones(len(words)) if values is None else values
    short, long = np.flatnonzero(rest == 0), np.flatnonzero(rest)
    heads = np.unique(code[long])
    a, i = np.unique(code[short], return_index=True)
    b, j = np.unique(np.searchsorted(heads, code[long]) * 27**2 + rest[long], return_index=True)
    return Weights(a, values[short[i]], heads, b, values[long[j]])


def _stretches(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places of stretches one after the other."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def _texts(data: np.ndarray, length: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


def _spelled(texts: Texts, terms: Terms, which: np.ndarray) -> pa.Array:
    at = terms.first[which]
    length = texts.term_length[at]
    return _texts(texts.letters[_stretches(texts.term_start[at], length)] + (ord("a") - 1), length)


def slices(batch: pa.RecordBatch, column: int, groups: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of whole groups with some ``SLICE`` bytes of texts; ``groups`` are where groups begin."""
    _, offsets = _values(batch.column(column))
    ends = np.append(groups[1:], batch.num_rows)
    start = 0
    while start < batch.num_rows:
        fits = int(np.searchsorted(offsets[ends], offsets[start] + SLICE, "right"))
        after = int(np.searchsorted(ends, start, "right"))
        stop = int(ends[min(max(fits - 1, after), len(ends) - 1)])
        yield start, stop
        start = stop


def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``token, n``: in how many of the texts (the only column) a term occurs, by parts."""
    for batch in batches:
        for start, stop in slices(batch, 0, np.arange(batch.num_rows)):
            texts = cleaned(batch.column(0).slice(start, stop - start))
            terms = content(texts)
            row = np.searchsorted(texts.begins, texts.term_start[terms.at], "right") - 1
            held = pd.unique(row * max(1, len(terms.code)) + terms.of) % max(1, len(terms.code))
            n = np.bincount(held, minlength=len(terms.code))
            yield pa.RecordBatch.from_arrays([_spelled(texts, terms, np.arange(len(n))), pa.array(n, pa.int64())], ["token", "n"])


def unweighted(batches: Iterable[pa.RecordBatch], known: Weights, names: list[str]) -> Iterator[pa.RecordBatch]:
    """``key, token`` of each term of a text that has no known weight, once a text."""
    for batch in batches:
        for start, stop in slices(batch, 1, np.arange(batch.num_rows)):
            part = batch.slice(start, stop - start)
            texts = cleaned(part.column(1))
            terms = content(texts)
            row = np.searchsorted(texts.begins, texts.term_start[terms.at], "right") - 1
            open_ = np.isnan(known.of(terms.code, terms.rest, np.nan))[terms.of]
            held = pd.unique(row[open_] * max(1, len(terms.code)) + terms.of[open_])
            which, row = held % max(1, len(terms.code)), held // max(1, len(terms.code))
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), _spelled(texts, terms, which)], names)


def whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list]]:
    """Stretches of rows with all rows of their keys, where keys begin, and the keys; rows of a key follow one another.

    Rows without a key belong to none, so each may come alone.
    """

    def begins(keys: list) -> np.ndarray:
        return np.array([i for i, k in enumerate(keys) if not i or k is None or k != keys[i - 1]], np.int64)

    def cut(batch: pa.RecordBatch, keys: list) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list]]:
        groups = begins(keys)
        for start, stop in slices(batch, 1, groups):
            own = groups[(groups >= start) & (groups < stop)]
            yield batch.slice(start, stop - start), own - start, keys[start:stop]

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        keys = batch.column(0).to_pylist()
        last = batch.num_rows if keys[-1] is None else int(begins(keys)[-1])
        if last:
            yield from cut(batch.slice(0, last), keys[:last])
        held = batch.slice(last) if last < batch.num_rows else None
    if held is not None:
        yield from cut(held, held.column(0).to_pylist())


def _ends(texts: Texts) -> np.ndarray:
    """Whether a sentence ends with each word: with a stop that belongs to no abbreviation."""
    raw, start, end = texts.raw, texts.word_start, texts.word_end
    ends = raw[end - 1] == ord(".")
    # Only a word whose last letters are as long as an abbreviation can be one.
    lengths = sorted({len(a) for a in ABBREVIATIONS})
    stops = np.flatnonzero(ends)
    text = raw.tobytes()
    known: dict[bytes, bool] = {}
    before = end[stops] - 1
    run = np.zeros(len(stops), np.int64)
    for i in range(1, lengths[-1] + 2):
        letter = texts.letters[np.maximum(before - i, 0)] > 0
        run += letter & (run == i - 1) & (before - i >= start[stops])
    for w in stops[np.isin(run, lengths)].tolist():
        word = text[start[w] : end[w]]
        if word not in known:
            known[word] = GUARDED.sub("\u0002", word.decode()).endswith("\u0002")
        ends[w] = not known[word]
    return ends


class Slots(NamedTuple):
    """Places of sentences in documents, in order: the document, the part of it and the number of words."""

    group: np.ndarray
    part: np.ndarray
    n_words: np.ndarray


def best(slots: Slots, term_slot: np.ndarray, term: np.ndarray, weight: np.ndarray, budget: int) -> np.ndarray:
    """Whether each place is kept: the best of each part, and the next ones as long as all have ``budget`` words.

    A sentence scores the mean of tf(document) · weight over its terms.
    """
    n = len(slots.group)
    if not n:
        return np.zeros(0, bool)
    of, differing = pd.factorize(slots.group[term_slot] * max(1, len(weight)) + term)
    tf = np.bincount(of, minlength=len(differing))[of] if len(of) else np.zeros(0)
    count = np.bincount(term_slot, minlength=n)
    score = np.bincount(term_slot, tf * weight[term], minlength=n) / np.maximum(count, 1)
    score = np.floor(score * 1e6 + 0.5) / 1e6
    whole = slots.group * (int(slots.part.max()) + 1) + slots.part
    order = np.lexsort((np.arange(n), -score, whole))
    first = np.concatenate([[True], whole[order][1:] != whole[order][:-1]])
    used = np.cumsum(slots.n_words[order])
    start = np.flatnonzero(first)
    used -= np.repeat((used - slots.n_words[order])[start], np.diff(np.append(start, n)))
    kept = np.zeros(n, bool)
    kept[order] = first | (used <= budget)
    return kept


def summarised(
    batch: pa.RecordBatch, groups: np.ndarray, keys: list, known: Weights, once: float, size: int, budget: int, fan_in: int | None
) -> pa.Array:
    """The summary of each text of whole documents; ``once`` is the weight of terms without one.

    Every ``size`` words are a part, which is reduced to its best sentences; with ``fan_in``, so many parts are joined
    and reduced again. Texts of one key are one document: the terms of sentences at the same place count together.
    """
    texts = cleaned(batch.column(1))
    terms = content(texts)
    weight = known.of(terms.code, terms.rest, np.nan)
    if batch.num_columns > 2:
        rare = batch.column(2).flatten()
        own = weights(rare.field(0), rare.field(1).to_numpy(zero_copy_only=False))
        weight = np.where(np.isnan(weight), own.of(terms.code, terms.rest, np.nan), weight)
    weight = np.where(np.isnan(weight), once, weight)

    row = texts.word_row
    n = len(row)
    place = np.arange(n) - np.searchsorted(row, row)
    part = place // size
    starts = np.zeros(n, bool)
    starts[1:] = _ends(texts)[:-1]
    starts |= place % size == 0
    sentence = np.cumsum(starts) - 1
    at = np.flatnonzero(starts)
    n_words = np.diff(np.append(at, n))
    s_row, s_part = row[at], part[at]
    group = np.searchsorted(groups, s_row, "right") - 1
    whole = s_row * (int(s_part.max(initial=0)) + 1) + s_part
    number = np.arange(len(at)) - np.searchsorted(whole, whole)
    slot = np.arange(len(at))
    slots = Slots(group, s_part, n_words)
    if len(groups) < batch.num_rows:
        parts, most = int(s_part.max(initial=0)) + 1, int(number.max(initial=0)) + 1
        named, slot = np.unique((group * parts + s_part) * most + number, return_inverse=True)
        longest = np.zeros(len(named), np.int64)
        np.maximum.at(longest, slot, n_words)
        slots = Slots(named // most // parts, named // most % parts, longest)
    term_word = np.searchsorted(texts.word_start, texts.term_start[terms.at], "right") - 1
    term_slot, term = slot[sentence[term_word]], terms.of
    kept = best(slots, term_slot, term, weight, budget)
    if fan_in is not None:
        again = np.flatnonzero(kept)
        number = np.cumsum(kept) - 1
        met = kept[term_slot]
        second = Slots(slots.group[again], slots.part[again] // fan_in, slots.n_words[again])
        kept[again] = best(second, number[term_slot[met]], term[met], weight, budget)

    missing = np.array([k is None for k in keys])
    word = np.flatnonzero(kept[slot][sentence] & ~missing[row])
    row, start, length = row[word], texts.word_start[word] - 1, texts.word_end[word] - texts.word_start[word] + 1
    # A blank leads every word; texts without any have a blank alone.
    none = np.setdiff1d(np.arange(batch.num_rows), row)
    row, start, length = np.append(row, none), np.append(start, texts.begins[none]), np.append(length, np.ones(len(none), np.int64))
    order = np.argsort(row, kind="stable")
    row, start, length = row[order], start[order], length[order]
    data = texts.raw[_stretches(start, length)]
    data[np.cumsum(length) - length] = ord(" ")
    return _texts(data, np.bincount(row, length, minlength=batch.num_rows).astype(np.int64))
