"""Packing against a plain packer, and parts of texts against whole texts."""

import collections
import random
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerleaf.llm import packing, queries

PLAIN = Tokenizer.from_file(queries.word_tokenizer())
IDS = packing.PartIds(queries.word_tokenizer())


def ids_of(texts, most=1000):
    return [list(struct.unpack(f"<{len(raw) // 4}I", raw)) for raw in IDS.encode(texts, most)]


def whole(texts):
    return [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]


def test_every_latin_character_in_every_place():
    texts = []
    for c in map(chr, range(256)):
        texts += [c, f"a{c}b", f"1{c}2", f"{c}{c}", f"'{c}s", f"x'{c}", f"it's{c}'ll", f"é{c}.", f".{c}!", f" {c} "]
    assert ids_of(texts) == whole(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=80), st.text(alphabet="aÉé'strevmld .!?1²\xa0\x85\x1cªµ÷", max_size=80)), max_size=6))
def test_any_texts_have_the_ids_of_whole_texts(texts):
    assert ids_of(texts, 20) == whole(texts)


def test_forgetting_changes_nothing():
    rnd = random.Random(3)
    texts = [" ".join("".join(rnd.choice("abcdé.,1") for _ in range(rnd.randint(1, 9))) for _ in range(200)) for _ in range(40)]
    parts = packing.PartIds(queries.word_tokenizer())
    got = [raw for i in range(0, 40, 4) for raw in parts.encode(texts[i : i + 4], 150)]
    assert [list(struct.unpack(f"<{len(raw) // 4}I", raw)) for raw in got] == whole(texts)
    assert len(parts.parts) < 150 + 4 * 200 * 3


def most_room_first(lengths, room):
    """One by one, longest first, into the open sequence with the most room left; its rooms left at the end."""
    left = []
    for length in sorted(lengths, reverse=True):
        best = max(range(len(left)), key=left.__getitem__, default=None)
        if best is None or left[best] < length:
            left.append(room - length)
        else:
            left[best] -= length
    return collections.Counter(left)


@pytest.mark.parametrize("seed", range(12))
def test_patterns_equal_a_plain_packer(seed):
    rng = np.random.default_rng(seed)
    room = int(rng.integers(5, 80))
    different = rng.permutation(room)[: rng.integers(1, room + 1)] + 1
    histogram = {int(k): int(rng.integers(1, 60)) for k in different}
    packed = packing.patterns(histogram, room)
    got = collections.Counter()
    placed = collections.Counter()
    for pattern, count in packed:
        got[room - sum(pattern)] += count
        for length in pattern:
            placed[length] += count
    assert placed == histogram
    assert got == most_room_first([k for k, n in histogram.items() for _ in range(n)], room)


def test_patterns_of_many_documents_are_counted_not_listed():
    histogram = {n: 10**9 // n for n in range(1, 4097)}
    packed = packing.patterns(histogram, 4096)
    used = sum(sum(p) * c for p, c in packed)
    assert used == sum(n * c for n, c in histogram.items())
    assert used / (4096 * sum(c for _, c in packed)) > 0.995
