import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerleaf.functions.words import STOP_WORDS
from ledgerleaf.operators import learn, models, postings, retrieval, search


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    corpus = rng.normal(size=(300, 8)).round(3)
    corpus[100:200] = corpus[0]  # a third of the vectors are copies
    queries = rng.normal(size=(7, 8)).round(3)
    to_df = lambda m: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id BIGINT, vector ARRAY<DOUBLE>")
    return corpus, queries, to_df(corpus).repartition(5), to_df(queries)


def brute(corpus, queries, k, metric):
    if metric == "cosine":
        unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
        distance = 1 - unit(queries) @ unit(corpus).T
    else:
        distance = ((queries[:, None] - corpus[None]) ** 2).sum(-1)
    distance = distance.round(6)
    return {(q, int(i)) for q in range(len(queries)) for i in np.lexsort((np.arange(len(corpus)), distance[q]))[:k]}


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("limit", [search.QUERY_VALUES, 16])
def test_nearest_both_ways(vectors, monkeypatch, metric, limit):
    """Broadcast queries and tiles find what brute force finds, copies included."""
    corpus, queries, c, q = vectors
    monkeypatch.setattr(search, "QUERY_VALUES", limit)
    found = search.nearest(c, "id", q, "id", 5, metric)
    got = {(r.query_id, r.vec_id) for r in found.collect()}
    assert got == brute(corpus, queries, 5, metric)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_many_queries_stay_in_their_tasks(spark, monkeypatch, metric):
    """Tiles of the corpus come to the queries: same neighbours, ties by id, and no pair of a tile is shuffled."""
    rng = np.random.default_rng(9)
    corpus = rng.normal(size=(400, 6)).round(3) + 5
    corpus[50:90] = corpus[0]
    schema = "id STRING, vector ARRAY<DOUBLE>"
    df = spark.createDataFrame([(f"{i:03d}", v.tolist()) for i, v in enumerate(corpus)], schema).repartition(3)
    for name, value in (("FEW_QUERIES", 20), ("QUERY_VALUES", 600), ("BLOCK_CELLS", 5000), ("TASK_CELLS", 40_000)):
        monkeypatch.setattr(search, name, value)
    found = search.nearest(df, "id", df, "id", 7, metric)
    got = {(int(r.query_id), int(r.vec_id)) for r in found.collect()}
    assert got == brute(corpus, corpus, 7, metric) and found.count() == 2800
    # A query that comes twice has its best seven all the same.
    twice = search.nearest(df, "id", df.unionByName(df), "id", 7, metric)
    assert twice.groupBy("query_id").count().where("count <> 7").isEmpty()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroups" not in plan


def test_approximate_is_a_subset_of_the_corpus(vectors):
    corpus, queries, c, q = vectors
    exact = brute(corpus, queries, 300, "l2")
    found = retrieval.approximate_nearest(c, "id", q, "id", 10, radius=4.0).collect()
    assert {(r.query_id, r.vec_id) for r in found} <= exact and found


def test_approximate_search_prunes_and_finds(spark):
    """On clustered vectors the measured radius leaves a few of all pairs, and nearly all neighbours are found."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16)) * 8
    corpus = (centres[:, None] + rng.normal(size=(20, 30, 16))).reshape(-1, 16)
    queries = centres + rng.normal(size=(20, 16))
    to_df = lambda m: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id BIGINT, vector ARRAY<DOUBLE>")
    c, q = to_df(corpus).repartition(4), to_df(queries)
    got = {(r.query_id, r.vec_id) for r in retrieval.approximate_nearest(c, "id", q, "id", 5).collect()}
    assert len(got & brute(corpus, queries, 5, "l2")) >= 90
    radius = retrieval.reach(c.withColumnRenamed("id", "vec_id"), q.withColumnRenamed("id", "query_id"), 5, 200)
    distance = np.sqrt(((queries[:, None] - corpus[None]) ** 2).sum(-1))
    assert (np.sort(distance, axis=1)[:, 4] <= radius).all() and (distance <= radius).mean() < 0.1


@pytest.fixture(scope="module")
def passages(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["apple", "pear", "plum", "river", "stone", "the", "of", "cloud", "green", "blue"]
    texts = [" ".join(rng.choice(vocabulary, size=rng.integers(0, 12))) for _ in range(120)]
    p = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "doc_id INT, passage_no INT, passage STRING")
    q = spark.createDataFrame([(1, "apple of the river"), (2, "green cloud, blue cloud"), (3, "unknown words")], "id INT, text STRING")
    return p.repartition(4), q


def bm25(texts, question, k):
    """Brute force over plain lists."""
    words = lambda s: [w for w in re.findall("[a-z]+", s.lower()) if len(w) > 1 and w not in STOP_WORDS]
    docs = [words(x) for x in texts]
    mean = sum(map(len, docs)) / len(docs)
    scores = []
    for i, d in enumerate(docs):
        total = 0.0
        for w in set(words(question)) & set(d):
            df = sum(w in x for x in docs)
            total += math.log(1 + (len(docs) - df + 0.5) / (df + 0.5)) * d.count(w) * 2.5 / (
                d.count(w) + 1.5 * (0.25 + 0.75 * len(d) / mean)
            )
        if total > 0:
            scores.append((-round(total, 6), i))
    return {(i, -s) for s, i in sorted(scores)[:k]}


@pytest.mark.parametrize("slot, first", [(postings.SLOT_PASSAGES, postings.FIRST_SLOTS), (4, 3), (40, 1), (1, 2)])
def test_ranked_passages_against_brute_force(passages, monkeypatch, slot, first):
    p, q = passages
    monkeypatch.setattr(postings, "SLOT_PASSAGES", slot)
    monkeypatch.setattr(postings, "FIRST_SLOTS", first)
    found = retrieval.ranked_passages(p, ["doc_id", "passage_no"], "passage", q, "id", "text", 4).collect()
    texts = [r.passage for r in p.orderBy("doc_id").collect()]
    for question in q.collect():
        got = {(r.doc_id, r.score) for r in found if r.question_id == question.id}
        want = bm25(texts, question.text, 4)
        assert {i for i, _ in got} == {i for i, _ in want}
        assert np.allclose(sorted(s for _, s in got), sorted(s for _, s in want), atol=2e-6)


def test_prompt(spark):
    df = spark.createDataFrame([("A {question} trap", "Who?")], "c STRING, q STRING")
    got = df.select(retrieval.filled_prompt(F.col("c"), F.col("q"), "{context}|{question}").alias("p")).first()["p"]
    assert got.endswith("|Who?")


def test_generated_text_is_trimmed(spark):
    df = spark.createDataFrame([("say hi", "say hi Hello<stop>more"), ("say hi", "other")], "p STRING, g STRING")
    got = df.select(models.cut_at_stop(models.without_prompt(F.col("g"), F.col("p")), ["<stop>"]).alias("r"))
    assert [r.r for r in got.collect()] == [" Hello", "other"]


def test_unknown_task(spark):
    with pytest.raises(ValueError):
        models.run_task("make-coffee", spark.range(1))


def test_classification_scores(spark):
    rows = [(0, 0, 5), (0, 1, 1), (1, 1, 3), (1, 0, 2), (2, 2, 4)]
    got = learn.classification_scores(spark.createDataFrame(rows, "label INT, predicted INT, n INT")).first()
    t = np.array([r[0] for r in rows for _ in range(r[2])])
    p = np.array([r[1] for r in rows for _ in range(r[2])])
    T, P = np.eye(3)[t], np.eye(3)[p]
    cov = lambda a, b: ((a - a.mean(0)) * (b - b.mean(0))).sum()
    assert np.isclose(got.mcc, cov(T, P) / np.sqrt(cov(T, T) * cov(P, P)))
    assert np.isclose(got.accuracy, (t == p).mean())
