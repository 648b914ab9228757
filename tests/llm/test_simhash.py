"""Fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import xxhash

from ledgerleaf.llm import simhash
from ledgerleaf.llm.components import connected


def brute_print(text, shingle=4):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(keys, prints, distance):
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, k in enumerate(keys):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return [least.get(find(i)) for i in range(len(keys))]


def rows():
    rnd = random.Random(3)
    words = ["Alpha", "beta", "été", "DELTA", "x", "y1", "zz"] + [f"w{i}" for i in range(60)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(3, 160))] for _ in range(25)]
    found = []
    for i in range(160):
        text = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 2)):
            text[rnd.randrange(len(text))] = rnd.choice(words)
        found.append((i, rnd.choice([" ", "\n", " \t "]).join(text)))
    found += [(160, None), (161, ""), (162, " \n"), (None, found[0][1]), (5, found[5][1]), (5, found[6][1])]
    rnd.shuffle(found)
    return found


def test_components_equal_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(d, t, 0, "r") for d, t in data], "doc_id long, text string, root long, bits string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    prints = [brute_print(t) for _, t in data]
    components = brute_components([d for d, _ in data], prints, 4)
    assert got == sorted(((d, f"{p:016x}", c) for (d, _), p, c in zip(data, prints, components)), key=str)


def test_first_of_each_keeps_one_row_and_all_columns(spark):
    data = rows() + [(None, "only without a key " * 9)] * 3
    df = spark.createDataFrame([(d, t, "a", None) for d, t in data], "doc_id long, text string, _hash string, _row int")
    kept = simhash.first_of_each(df).collect()
    prints = [brute_print(t) for _, t in data]
    classes = {}
    for (d, _), p, c in zip(data, prints, brute_components(range(len(data)), prints, 4)):
        classes.setdefault(c, []).append(d)
    want = [min((d for d in c if d is not None), default=None) for c in classes.values()]
    assert df.columns == ["doc_id", "text", "_hash", "_row"] and sorted(map(str, want)) == sorted(str(r.doc_id) for r in kept)


def test_links_connect_all_close_fingerprints_in_large_keys():
    """Many variants of one fingerprint share their keys: the forest still connects what is close."""
    rng = np.random.default_rng(0)
    centre = int(rng.integers(0, 2**63))
    values = {centre}
    while len(values) < 400:
        v = centre
        for b in rng.choice(64, rng.integers(0, 7), replace=False):
            v ^= 1 << int(b)
        values.add(v)
    values = np.array(sorted(values), np.uint64)
    keys, owners = [], []
    for low, high in simhash.segments(4):
        part = (values >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
        for i in range(high - low):
            keys.append(((low + i) << 32) + (part & ~np.uint64(1 << i)).astype(np.int64))
            owners.append(values)
    links = list(simhash.links_in(np.concatenate(keys), np.concatenate(owners), 4))
    root = {int(v): int(v) for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    total = 0
    for a, b in links:
        total += len(a)
        for x, y in zip(a.tolist(), b.tolist()):
            assert (x ^ y).bit_count() <= 4
            root[find(x)] = find(y)
    want = brute_components(values.tolist(), values.tolist(), 4)
    assert len({find(int(v)) for v in values}) == len(set(want))
    assert total < 64 * len(values)


def test_connected_finds_long_chains_and_ignores_loops(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(200, 100), (100, 150), (7, 7), (None, 3)]
    rnd = random.Random(1)
    rnd.shuffle(chain)
    got = dict(connected(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.first_of_each(empty).count() == 0
