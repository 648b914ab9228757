"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerleaf.llm import spelling


def brute_words(docs):
    counts = Counter()
    for key, text in docs:
        for raw in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs, factor=10):
    n = brute_words(docs)
    form, count = {}, {}
    for w in n:
        others = [o for o in n if abs(len(o) - len(w)) <= 1 and o != w and near(w, o)]
        count[w] = len(others)
        if others:
            top = min(others, key=lambda o: (-n[o], o))
            if n[top] >= factor * n[w]:
                form[w] = top
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], count[w], n[form[w]] if w in form else None))
    return out


def corpus(seed=2, size=160):
    rnd = random.Random(seed)
    letters = "abeéßñ×zÀ"
    stems = ["".join(rnd.choice(letters) for _ in range(rnd.randint(7, 11))) for _ in range(25)]
    docs = []
    for key in range(size):
        words = []
        for _ in range(rnd.randint(0, 60)):
            w = stems[min(len(stems) - 1, int(rnd.expovariate(0.3)))]
            for _ in range(rnd.choice([0, 0, 0, 0, 0, 0, 1, 1, 2])):
                i = rnd.randrange(len(w))
                w = rnd.choice([w[:i] + w[i + 1 :], w[:i] + rnd.choice(letters) + w[i:], w[:i] + rnd.choice(letters) + w[i + 1 :]])
            words.append(rnd.choice([w, w, w.title(), w.upper() if w.isascii() else w]))
        docs.append((key, rnd.choice([" ", "\n", "-", "1"]).join(words)))
    # a chain of forms: each ten times as frequent as the one before, one edit apart
    docs += [(1000 + i, " ".join(["chainedwordy"] * 3 + ["chainedwordyx"] * 40 + ["chainedwordyxz"] * 500)) for i in range(2)]
    return docs


def grouped(spark, docs):
    df = spark.createDataFrame([(k, t, "x", 3) for k, t in docs], "doc_id long, text string, word string, n int")
    got = spelling.group_variants(df).collect()
    out = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got}
    assert len(out) == len(got)
    return out


def test_groups_equal_brute_force(spark):
    docs = corpus() + [(None, "abeabeabe abeabeabe"), (5000, None), (5001, ""), (5002, "short words")]
    got = grouped(spark, docs)
    assert got == brute(docs)
    assert any(r[1] for r in got) and any(r[2] != (r[1] or r[0]) for r in got)


def test_vocabularies_over_several_filters(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCKS", 100)  # a shard has 64 blocks at least: passes cut through shards
    docs = corpus(7, 80)
    assert grouped(spark, docs) == brute(docs)


def test_very_long_runs(spark):
    rnd = random.Random(4)
    runs = ["".join(rnd.choice("abcdefghij") for _ in range(n)) for n in (255, 256, 257, 20_000)]
    docs = []
    for i, run in enumerate(runs):
        docs += [(i, f"{run} {run}"), (100 + i, f"{run[:100]}{run[101:]}, {run[:100]}{run[101:]}"),
                 (200 + i, f"{run[:50]}z{run[51:]} {run[:50]}z{run[51:]}")]
    assert grouped(spark, docs) == brute(docs)


def test_empty_table_and_a_single_word(spark):
    assert grouped(spark, []) == set()
    assert grouped(spark, [(1, "oneword " * 9)]) == brute([(1, "oneword " * 9)])


@pytest.mark.parametrize("length", [7, 8, 30])
def test_hashes_of_edits_are_those_of_the_edited_words(length):
    rnd = random.Random(length)
    word = "".join(rnd.choice("abcé") for _ in range(length))
    alphabet = sorted(map(ord, "abcdé"))
    made = {}
    for _, hashes, change in spelling.edits(spelling.code_points([word], length), np.array(alphabet, np.uint32)):
        made.setdefault(change, set()).update(hashes.tolist())
    want = {
        -1: {word[:i] + word[i + 1 :] for i in range(length)},
        0: {word[:i] + chr(c) + word[i + 1 :] for i in range(length) for c in alphabet if chr(c) > word[i]},
    }
    for change, words in want.items():
        assert made[change] == {int(spelling.word_hashes(spelling.code_points([w], length + change))[0]) for w in words}


def test_the_filter_holds_every_word():
    hashes = spelling.mixed(np.arange(10_000, dtype=np.uint64) * np.uint64(spelling.BASE))
    block, bits = spelling.places(hashes, 5, 2500)
    assert block.min() >= 5 and block.max() < 2505
    held = np.zeros(2505, np.uint64)
    np.bitwise_or.at(held, block, bits)
    assert ((held[block] & bits) == bits).all()
    block, bits = spelling.places(spelling.mixed(np.arange(10**6, 2 * 10**6, dtype=np.uint64)), 5, 2500)
    assert ((held[block] & bits) == bits).mean() < 0.02
