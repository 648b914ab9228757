"""Exact repeats of bytes and words against brute force."""

import collections
import random

import numpy as np
import pytest

from ledgerleaf.llm import parsing, suffixes
from ledgerleaf.llm.shared_windows import pack, unpack

LARGE = 2**63 - 1


def brute_bytes(rows, width):
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - width + 1):
            k = raw[i : i + width]
            first[k] = min(first.get(k, LARGE), LARGE if d is None else d)
    out = []
    for d, t in rows:
        raw, place = (t or "").encode(), LARGE if d is None else d
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - width + 1):
            if first[raw[i : i + width]] < place:
                gone[i : i + width] = True
        out.append((d, len(raw), int(gone.sum()), bytes(b for b, g in zip(raw, gone) if not g)))
    return sorted(out, key=str)


def brute_words(rows, width):
    count = collections.Counter()
    for _, t in rows:
        words = (t or "").encode().split()
        count.update(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    out = []
    for d, t in rows:
        words = (t or "").encode().split()
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - width + 1):
            if count[tuple(words[i : i + width])] > 1:
                gone[i : i + width] = True
        out.append((d, len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    letters = "abé "
    parts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(5, 200))) for _ in range(12)]
    parts += ["a" * 300, "ab" * 100, "c b a " * 40, "ba " * 70, "b" * 130 + "a" * 90]
    found = []
    for i in range(110):
        text = "".join(
            rnd.choice(parts)[rnd.randint(0, 30) : rnd.randint(30, 400)] if rnd.random() < 0.7
            else "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 90)))
            for _ in range(rnd.randint(0, 6))
        )
        found.append((i, text))
    # Null and empty texts, null keys, keys that stand twice, equal rows, and a long text of one run.
    found += [(110, None), (111, ""), (None, found[0][1]), (None, found[1][1]), (3, found[2][1]), (3, found[3][1])]
    found += [(4, found[4][1]), (112, "x" * 30_000 + " y" * 2_000)]
    rnd.shuffle(found)
    return found


def got_bytes(df):
    rows = df.collect()
    return sorted(((r[0], r.n_bytes, sum(s.end - s.start for s in r.spans), bytes(r.kept)) for r in rows), key=str)


def got_words(df):
    rows = df.collect()
    return sorted(((r[0], r.n_words, sum(s.end - s.start for s in r.spans), r.kept.encode()) for r in rows), key=str)


@pytest.mark.parametrize("hot", [10**9, 2])
@pytest.mark.parametrize("width, gram", [(50, 24), (12, 5)])
def test_bytes_equal_brute_force(spark, rows, width, gram, hot):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, block int, payload string")
    assert got_bytes(suffixes.remove_repeated_substrings(df, width, gram, hot=hot)) == brute_bytes(rows, width)


@pytest.mark.parametrize("hot", [10**9, 2])
@pytest.mark.parametrize("width, gram", [(35, 8), (5, 2)])
def test_words_equal_brute_force(spark, rows, width, gram, hot):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, bucket int, hot string")
    assert got_words(parsing.remove_repeated_windows(df, width, gram, hot=hot)) == brute_words(rows, width)


@pytest.mark.parametrize("hot", [10**9, 20])
def test_words_repeated_back_to_back_in_one_document(spark, hot):
    rows = [(0, " ".join(f"u{i}" for i in range(80)))]
    for period in (1, 2, 7, 9, 28, 29, 40):
        line = " ".join(f"p{period}w{i}" for i in range(period))
        rows.append((period, "\n".join(["head", *[line] * (90 // period + 2), "tail"])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = got_words(parsing.remove_repeated_windows(df, 35, 8, hot=hot))
    assert got == brute_words(rows, 35) and all((r[2] > 0) == (r[0] > 0) for r in got)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeated_substrings(empty).count() == 0
    assert parsing.remove_repeated_windows(empty).count() == 0


def test_spans_are_maximal_runs(spark):
    shared = "0123456789" * 6
    df = spark.createDataFrame([(1, shared + "abc" + shared[::-1]), (2, "z" + shared + "-" + shared[::-1])],
                               "doc_id long, text string")
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in suffixes.remove_repeated_substrings(df, 50).collect()}
    assert spans == {1: [], 2: [(1, 61), (62, 122)]}


def test_two_stage_order_is_the_suffix_order():
    rng = np.random.default_rng(1)
    for letters in (2, 3, 200):
        t = np.concatenate([rng.integers(0, letters, 400), np.zeros(90, int), np.full(30, 255)]).astype(np.uint8)
        needed = np.zeros(len(t), bool)
        needed[: len(t) - 30] = True
        order = suffixes.two_stage_order(t, needed, 16)
        raw = t.tobytes()
        keys = [raw[i : i + 16] for i in order]
        assert keys == sorted(keys) and sorted(order.tolist()) == list(range(len(t) - 30))
        lcp = suffixes.common_prefixes(t, order, 16)
        for i in range(1, len(order)):
            a, b = raw[order[i - 1] :], raw[order[i] :]
            n = next((j for j in range(16) if a[j : j + 1] != b[j : j + 1]), 16)
            assert lcp[i] == n


def test_packed_arrays_come_back():
    arrays = [np.array([3, 5, 2**64 - 1], np.uint64), np.array([7, 1], np.uint64), np.zeros(0, np.int64),
              np.array([-1, 4], np.int64), np.array([1], np.uint8)]
    for a, b in zip(arrays, unpack(pack(*arrays))):
        assert a.dtype == b.dtype and (a == b).all()
