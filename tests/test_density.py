"""Topics by density against a plain tree, learned vectors against numpy, inverted lists against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import density, inverted_lists, vectors

K, SIZE = 5, 12


def blobs(seed=4):
    rng = np.random.default_rng(seed)
    centres = np.array([[0, 0], [6, 0], [0, 7], [9, 8]])
    parts = [c + rng.normal(size=(n, 2)) * s for c, n, s in zip(centres, (130, 90, 60, 100), (0.7, 0.5, 0.6, 1.1))]
    return np.round(np.concatenate([*parts, rng.uniform(-4, 13, (120, 2))]), 4)


def plain_tree(x, k, size):
    """Topic per point (or -1), by taking away the longest links of a spanning tree one after the other."""
    d = np.sqrt(np.round(((x[:, None] - x[None]) ** 2).sum(-1), 6))
    core = np.sort(d, axis=1)[:, k - 1]
    w = np.maximum(np.maximum(d, core[:, None]), core[None])
    n = len(x)
    inside, best, link = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, int)
    best[0], edges = 0, []
    for step in range(n):
        i = int(np.argmin(np.where(inside, np.inf, best)))
        inside[i] = True
        if step:
            edges.append((w[i, link[i]], i, int(link[i])))
        closer = w[i] < best
        best[closer], link[closer] = w[i][closer], i
    near = {i: set() for i in range(n)}
    for _, a, b in edges:
        near[a].add(b)
        near[b].add(a)

    def reach(start):
        seen, stack = {start}, [start]
        while stack:
            for j in near[stack.pop()] - seen:
                seen.add(j)
                stack.append(j)
        return seen

    # Branches: (birth, points with the density at which they leave, children).
    def branch(points, birth, edges):
        leave, children, edges = {}, [], sorted(edges)
        while edges:
            length, a, b = edges.pop()
            near[a].discard(b)
            near[b].discard(a)
            one, two = reach(a), reach(b)
            if len(one) >= size and len(two) >= size:
                for side in (one, two):
                    children.append(branch(side, 1 / length, [e for e in edges if e[1] in side]))
                return birth, leave, children, 1 / length
            for side in (one, two):
                if len(side) < size:
                    for p in side:
                        leave.setdefault(p, 1 / length)
            edges = [e for e in edges if any(e[1] in side for side in (one, two) if len(side) >= size)]
        return birth, leave, children, None

    whole = branch(set(range(n)), 0.0, edges)

    def count(node):
        return len(node[1]) + sum(map(count, node[2]))

    def pick(node, top):
        birth, leave, children, end = node
        own = sum(v - birth for v in leave.values()) + sum(count(c) * (end - birth) for c in children)
        below = [pick(c, False) for c in children]
        total = sum(v for v, _ in below)
        if not top and own >= total:
            return own, [(node, birth)]
        return total, [t for _, ts in below for t in ts]

    topic, births = np.full(n, -1), {}

    def members(node):
        return set(node[1]) | {p for c in node[2] for p in members(c)}

    chosen = sorted(pick(whole, True)[1], key=lambda t: (-count(t[0]), min(members(t[0]))))
    for i, (node, birth) in enumerate(chosen):
        topic[list(members(node))] = i
        births[i] = birth
    return topic, births, core, sum(e[0] for e in edges)


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")


@pytest.mark.parametrize("band", [density.BAND, 50_000])
def test_topics_equal_a_plain_tree(spark, monkeypatch, band):
    """All points linked, so that both trees see the same distances, in one band and in three."""
    whole = band == density.BAND
    x = blobs()
    monkeypatch.setattr(density, "BAND", band)
    want, births, core, weight = plain_tree(x, K, SIZE)
    linked = len(x) - 1
    found, topics = density.fit_topics(frame(spark, x), K, SIZE, linked)
    got = {r.id: r.topic for r in found.collect()}
    assert len(set(want)) >= 4 and -1 in want
    assert [got[i] for i in range(len(x))] == want.tolist()
    if whole:
        points, links = density.neighbour_links(frame(spark, x), K, linked)
        _, _, chosen = density.density_tree(points, links, SIZE)
        assert chosen.count() == len(x) - 1
        assert chosen.agg(F.sum("w")).first()[0] == pytest.approx(weight, rel=1e-9)
        # New points: the same distance to the nearest known point decides.
        new = np.round(np.random.default_rng(8).uniform(-4, 13, (60, 2)), 4)
        placed = {r.id: r.topic for r in density.place_vectors(topics, frame(spark, new)).collect()}
        for i, p in enumerate(new):
            d = np.sqrt(np.round(((x - p) ** 2).sum(-1), 6))
            own = np.sort(d)[K - 2]
            w = np.maximum(np.maximum(d, core), own)
            near = np.lexsort((np.arange(len(x)), d))[: 2 * K]
            best = min(near, key=lambda j: (w[j], d[j], j))
            t = want[best]
            assert placed[i] == (t if t >= 0 and 1 / w[best] >= births[t] else -1)
        assert -1 in placed.values() and len(set(placed.values())) > 2


def test_copies_are_one_point_that_counts(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([np.zeros((40, 3)), np.ones((30, 3)) * 5, rng.uniform(20, 90, (8, 3))])
    df = frame(spark, x).unionByName(spark.createDataFrame([(999, None)], "id long, vector array<double>"))
    got = {r.id: r.topic for r in density.fit_topics(df, 4, 10)[0].collect()}
    assert {got[i] for i in range(40)} == {0} and {got[i] for i in range(40, 70)} == {1}
    assert got[999] == -1 and {got[i] for i in range(70, 78)} == {-1}


def test_empty_and_tiny_tables(spark):
    assert density.fit_topics(frame(spark, np.zeros((0, 2))))[0].count() == 0
    found, topics = density.fit_topics(frame(spark, np.arange(6.0).reshape(3, 2)))
    assert {r.topic for r in found.collect()} == {-1}
    assert {r.topic for r in density.place_vectors(topics, frame(spark, np.ones((2, 2)))).collect()} == {-1}


def test_singular_values_equal_numpy(spark):
    rnd = random.Random(4)
    themes = [[f"{a}{b}" for b in ("alo", "emi", "otu", "uva", "ire", "osa")] for a in "bdfgkmnp"]
    docs = [[w for _ in range(30) for w in rnd.sample(rnd.choice(themes[i % 8 : i % 8 + 2]), 2)] for i in range(60)] + [["once"]]
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)] + [(99, None)], "doc_id int, text string")
    words = sorted({w for d in docs for w in d} - {"once"})
    at = {w: i for i, w in enumerate(words)}
    n = np.zeros((len(words),) * 2)
    for d in docs:
        for i, a in enumerate(d):
            for b in d[i + 1 : i + 5]:
                if a in at and b in at:
                    n[at[a], at[b]] += 1
                    n[at[b], at[a]] += 1
    pairs = vectors.neighbouring_words(df)
    assert {(r.a, r.b): r.n for r in pairs.collect()} == {(a, b): n[at[a], at[b]] for a in words for b in words if n[at[a], at[b]]}
    with np.errstate(divide="ignore"):
        ppmi = np.maximum(np.log(n * n.sum() / np.outer(n.sum(1), n.sum(1))), 0)
    u, s, _ = np.linalg.svd(ppmi)
    got, values = vectors.singular_vectors(vectors.information(pairs), 10, rounds=8)
    assert np.allclose(values, s[:10], rtol=2e-3)
    rows = {r.a: r.x for r in got.collect()}
    x = np.array([rows[w] for w in words])
    assert np.allclose(x.T @ x, np.eye(10), atol=1e-6)
    assert np.linalg.norm(u[:, :6].T @ x) ** 2 == pytest.approx(6, abs=0.05)  # the leading directions are spanned


def test_texts_on_one_theme_lie_together(spark):
    rnd = random.Random(5)
    themes = [[f"{a}{b}{c}" for b in "aeiou" for c in ("lo", "mi", "tu", "ra", "se")] for a in "bdf"]
    docs = [(i, " ".join(rnd.choice(themes[i % 3]) for _ in range(60)), f"line{i % 2}") for i in range(120)] + [(500, "", "line0")]
    df = spark.createDataFrame(docs, "doc_id long, text string, line string")
    words = vectors.word_vectors(df, size=6)
    texts = vectors.text_vectors(df, words, 6)
    assert texts.count() == 120 and texts.where(F.abs(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v) - 1) > 1e-9).count() == 0
    found, topics = density.fit_topics(texts.withColumnRenamed("doc_id", "id"), 5, 10)
    got = {r.id: r.topic for r in found.collect()}
    assert len({got[i] for i in range(0, 120, 3)} - {-1}) == 1 and len(set(got.values()) - {-1}) == 3
    assert sum(t < 0 for t in got.values()) < 12


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 24)) * 3
    x = np.concatenate([c + rng.normal(size=(75, 24)) for c in centres])
    x[200:900] = x[200]  # a list that holds most copies
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>").repartition(6)


def test_inverted_lists_find_the_neighbours_from_few_lists(spark, corpus, tmp_path):
    x, df = corpus
    path = str(tmp_path / "lists")
    inverted_lists.build_lists(df.unionByName(spark.createDataFrame([(9000, None), (9001, [1.0])], df.schema)), "id", path, lists=50)
    index = inverted_lists.open_lists(spark, path)
    rng = np.random.default_rng(7)
    asked = x[rng.choice(len(x), 50, replace=False)] + 0.3 * rng.normal(size=(50, 24))
    queries = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(asked)], "q string, vector array<double>")
    probes = inverted_lists.measured_probes(index, 10)
    assert 1 <= probes <= 15
    found = {}
    for r in inverted_lists.search_lists(index, queries, "q", 10, probes).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.distance))
    hits = 0
    for i, q in enumerate(asked):
        d = np.round(((x - q) ** 2).sum(axis=1), 6)
        best = np.lexsort((np.arange(len(x)), d))[:10]
        got = found[f"q{i}"]
        assert [v for _, v in got] == sorted(v for _, v in got) and all(abs(d[j] - v) < 2e-6 for j, v in got)
        hits += len(set(best.tolist()) & {j for j, _ in got})
    assert hits >= 0.9 * 500
    few = inverted_lists.visited(index, queries.limit(2).select(F.col("q").alias("query_id"), "vector"), probes)
    lists = inverted_lists.lists_read(few)
    plan = index.rows.where(F.col("list").isin(lists))._jdf.queryExecution().executedPlan().toString()
    assert len(lists) <= 2 * probes < len(index.parts) and "PartitionFilters: [list" in plan


def test_large_lists_are_ranked_in_parts(spark, corpus, tmp_path, monkeypatch):
    x, df = corpus
    monkeypatch.setattr(inverted_lists, "ROWS", 100)
    index = inverted_lists.build_lists(df, "id", str(tmp_path / "lists"), lists=20)
    assert max(index.parts.values()) >= 7
    q = spark.createDataFrame([(1, x[200].tolist())], "q int, vector array<double>")
    got = [r.vec_id for r in inverted_lists.search_lists(index, q, "q", 20, probes=3).orderBy("rank").collect()]
    assert got == list(range(200, 220))


def test_lists_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, vector array<double>")
    index = inverted_lists.build_lists(empty, "id", str(tmp_path / "lists"))
    q = spark.createDataFrame([(1, [1.0])], "q int, vector array<double>")
    assert inverted_lists.search_lists(index, q, "q", 3).count() == 0
    assert math.isclose(inverted_lists.clustered(np.ones((5, 2)), 3).sum(), 2.0)


def test_word_vectors_from_cells_equal_those_from_rows(spark, monkeypatch):
    rnd = random.Random(11)
    words = ["".join(rnd.choice("aeilmnrst") for _ in range(5)) for _ in range(120)]
    docs = [(i % 50, " ".join(words[min(119, int(rnd.paretovariate(0.6)) - 1)] for _ in range(80))) for i in range(70)]
    docs += [(60, None), (61, "unknown"), (None, " ".join(words[:30])), (None, " ".join(words[10:50]))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    # Many tiles, cells and parts; rows that meet their vectors a few at a time.
    for name, value in (("TILE", 17), ("CELL_PAIRS", 400), ("SORTED_PAIRS", 3000), ("STEP", 7)):
        monkeypatch.setattr(vectors, name, value)
    pairs = vectors.counted_pairs(df)
    assert pairs.tiles > 3 and pairs.cells.count() > 20
    plain, values = vectors.singular_vectors(vectors.information(vectors.neighbouring_words(df)), 6)
    want = {r.a: np.array(r.x) * np.sqrt(values) for r in plain.collect()}
    table = vectors.word_vectors(df, size=6)
    got = {r.token: np.array(r.x) for r in table.collect()}
    assert set(got) == set(want) and len(got) > 60
    order = sorted(got)
    a, b = np.array([got[w] for w in order]), np.array([want[w] for w in order])
    assert np.allclose(a @ a.T, b @ b.T, atol=1e-6)

    # Texts of one key, null too, are one text.
    known = vectors.text_vectors(df, table, 6)
    lists = {}
    for key, text in docs:
        lists.setdefault(key, []).extend(w for w in (text or "").split() if w in got)
    df_of = {w: sum(w in ws for ws in lists.values()) for w in order}
    sums = {}
    for key, ws in lists.items():
        if ws:
            x = sum(np.log1p(ws.count(w)) * (np.log((1 + len(docs)) / (1 + df_of[w])) + 1) * got[w] for w in sorted(set(ws)))
            sums[key] = x / np.linalg.norm(x)
    found = {r.doc_id: np.array(r.vector) for r in known.collect()}
    assert set(found) == set(sums) and None in found and known.count() == len(found)
    assert all(np.allclose(found[k], sums[k], atol=1e-9) for k in sums)


def test_pairs_of_words_take_few_bytes(spark):
    """Most pairs are met once; what a task passes on and keeps of them stays far below their words' length."""
    import glob
    import os

    from ledgerleaf.session import shared_dir

    rng = np.random.default_rng(3)
    words = np.array([f"{a}{b}{c}" for a in ("bal", "dor", "fim", "gun", "hes") for b in ("tar", "lin", "mop", "ruk", "sev") for c in "aeiou" * 1] + ["x" * 9])
    words = np.array([f"{u}{v}" for u in words for v in ("ab", "ec", "id", "of", "ug", "an", "el", "ip", "or", "ut")])
    df = spark.createDataFrame([(i, " ".join(rng.choice(words, 400))) for i in range(400)], "doc_id int, text string")
    pairs = vectors.counted_pairs(df)
    n = pairs.cells.agg(F.sum("size")).first()[0]
    path = shared_dir(spark, "cells")
    pairs.cells.write.parquet(path)
    assert n > 500_000 and sum(os.path.getsize(f) for f in glob.glob(path + "/*.parquet")) < 3 * n


def test_a_topic_needs_no_share_of_all_points(spark):
    """Pairs of equal points are topics of two beside however many others."""
    pairs = np.repeat(np.arange(12.0)[:, None] * 50 + 500, 2, axis=0)
    many = spark.range(1000, 151_000).select("id", F.array(F.lit(0.0)).alias("vector"))
    found, topics = density.fit_topics(many.unionByName(frame(spark, pairs)), 2, 2, 3)
    got = {r.topic: r.n for r in found.groupBy("topic").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 150_000, **{i: 2 for i in range(1, 13)}}
    assert topics.branches.where("topic >= 0").count() >= 13


def test_topics_of_a_deep_tree_of_branches(spark):
    """The topmost picked ancestor counts, over a chain of any depth."""
    rnd = random.Random(2)
    rows, parent = [], {}
    for i in range(300):
        parent[i] = i - 1 if i % 50 else (None if not i else rnd.randrange(i))
        rows.append((None if parent[i] is None else str(parent[i]), str(i), float(i), rnd.random() < 0.05))
    picked = {i: r[3] for i, r in enumerate(rows)}
    want = {}
    for i in range(300):
        best, at = None, i
        while at is not None:
            best, at = (at if picked[at] else best), parent[at]
        want[str(i)] = (None, 0.0) if best is None else (str(best), float(best))
    forks = spark.createDataFrame(rows, "branch string, child string, born double, picked boolean")
    assert {r.branch: (r.name, r.born) for r in density.branch_topics(forks).collect()} == want and len(set(want.values())) > 3


def test_a_branch_that_ends_where_it_began_weighs_nothing():
    rnd = random.Random(4)
    for w in [rnd.uniform(1e-3, 2) for _ in range(400)]:
        grown = density.Branch("b", 0.0, 0.0, 0.0).with_points(7, w).with_points(3, w).with_points(1, w)
        assert grown.chosen(1 / w)[0] and not grown._replace(below=1e-6).chosen(1 / w)[0]
