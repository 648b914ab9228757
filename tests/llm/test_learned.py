"""Toxicity, mixing, nearest neighbours, packing and the pipeline."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerleaf.llm import mixing, neighbours, packing, queries, toxicity


def toxic_rows(n):
    rng = np.random.default_rng(2)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("la", "mo", "ten", "sir")]
    rows = []
    for i in range(n):
        text = list(rng.choice(words, rng.integers(5, 200)))
        toxic = int(rng.random() < 0.3)
        for _ in range(3 * toxic):
            text.insert(int(rng.integers(0, len(text))), "vex" + str(rng.choice(words)))
        rows.append((i, " ".join(text), toxic))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_rows(600)
    df = spark.createDataFrame([(i, t, "en") for i, t, _ in rows] + [(9000, None, "x"), (9001, "", "x"), (9001, "", "x")],
                               "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(None, 1), (700, None)], "doc_id long, toxic int")
    scored = toxicity.score_toxicity(df, toxicity.fitted(df, labels)).collect()
    truth = {i: x for i, _, x in rows}
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.doc_id in truth]
    right = np.mean([r.predicted == truth[r.doc_id] for r in held])
    assert len(scored) == 603 and right > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored)


def test_toxicity_without_labels(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score_toxicity(df, toxicity.fitted(df, none)).collect()] == [0.0, 0.0]
    assert toxicity.score_toxicity(df.limit(0), toxicity.fitted(df, none)).count() == 0


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    network = toxicity.Network.fresh(1)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    windows = toxicity.Windows(["one two three four five", "two " * 30, ""])
    feats, ids, mask = windows.batch(np.arange(len(windows.owner)))
    target, weight = np.array([1.0, 0.0, 1.0, 0.0])[: len(ids)], np.ones(len(ids))
    known = np.ones(len(feats[0]), bool)

    def loss():
        logit = network.logits(network.embedded(feats) @ network.p["inputs"] + network.p["bias"], ids, mask).astype(float)
        return np.mean(np.logaddexp(0, logit) - target * logit)

    grads = network.gradients(feats, ids, mask, target, weight, known)
    for name in ("forward", "backward", "attend", "query", "out", "inputs", "grams", "words"):
        flat, g = network.p[name].reshape(-1), np.asarray(grads[name]).reshape(-1)
        for i in rng.choice(np.argsort(-np.abs(g))[:20], 2, replace=False):
            keep, step = flat[i], 1e-2
            flat[i] = keep + step
            up = loss()
            flat[i] = keep - step
            down = loss()
            flat[i] = keep
            assert abs((up - down) / (2 * step) - g[i]) < 2e-3 + 0.05 * abs(g[i]), name


def test_every_window_is_scored():
    assert toxicity.window_starts(0) == [0] and toxicity.window_starts(24) == [0]
    for n in (25, 36, 37, 100, 1000):
        seen = {i for s in toxicity.window_starts(n) for i in range(s, s + toxicity.STEPS)}
        assert seen == set(range(n))


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(300):
        d = i % 3
        rows.append((i, " ".join(f"d{d}w{rng.integers(40)}" for _ in range(rng.integers(20, 90))), "x"))
        if i % 2:
            labels.append((i, int(d != 1), int(d == 2)))
    df = spark.createDataFrame([*rows, (300, None, "x"), (300, None, "x"), (None, "", "x")], "doc_id long, text string, _p string")
    targets = {"prime": 0.6, "rough": 0.3, "toxic": 0.1}
    out = mixing.mixed(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), targets).collect()
    tokens = np.array([r._tokens for r in out], float)
    p, rate = np.array([r._p for r in out]), np.array([r._rate for r in out])
    assert len(out) == 303 and (rate >= 0).all()
    share = (rate * tokens) @ p / tokens.sum()
    assert np.abs(share - list(targets.values())).max() < 0.01
    # The optimum: rates are 1 - (residual along the posterior) / pull, cut off at 0.
    best = np.maximum(1 - p @ (share - np.array(list(targets.values()))) / mixing.PULL, 0)
    assert np.abs(best - rate).max() < 0.1
    assert all(int(r._rate) <= r._copies <= int(r._rate) + 1 for r in out)
    assert out[0]._row.asDict().keys() == {"doc_id", "text", "_p"}


@pytest.mark.parametrize("total", ["all", "largest"])
def test_rare_domains_meet_their_targets_when_drawn(spark, tmp_path, total):
    rng = np.random.default_rng(8)
    names = ["prime", "rough", "toxic"]
    domain = np.repeat([0, 1, 2], [2000, 12, 1000])  # rough is rare, of toxic documents a small part is wanted
    rows = [(i, " ".join(f"d{d}w{rng.integers(40)}" for _ in range(rng.integers(20, 60)))) for i, d in enumerate(domain)]
    labels = [(i, int(d != 1), int(d == 2)) for i, d in enumerate(domain) if d == 1 or i % 4 == 0]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    targets = np.array(list(queries.MIXTURE.values()))
    out = mixing.mixed(df, labels, queries.MIXTURE, total=total).collect()
    tokens, own = np.array([r._tokens for r in out], float), domain[[r._row.doc_id for r in out]]
    p, rate = np.array([r._p for r in out]), np.array([r._rate for r in out])
    expected = (rate * tokens) @ p
    assert np.abs(expected / expected.sum() / targets - 1).max() < 0.03
    drawn = np.bincount(own, tokens * [r._copies for r in out], 3)
    assert np.abs(drawn / drawn.sum() / targets - 1).max() < 0.5
    if total == "largest":
        labels.write.parquet(str(tmp_path / "labels.parquet"))
        kept = collections.Counter(r.doc_id for r in corpus_pipeline.mixing_to_targets(spark, df, str(tmp_path)).collect())
        assert kept == {r._row.doc_id: r._copies for r in out if r._copies}


def test_mixing_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert mixing.mixed(df, none, {"prime": 0.5, "rough": 0.5}).count() == 2
    assert mixing.mixed(df.limit(0), none, {"prime": 1.0}).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 12)).astype(np.float32)
    x[100:700] = x[100]  # a fifth of the rows are copies
    x[5] *= 3
    rows = [(i, v.tolist(), "a") for i, v in enumerate(x)]
    odd = [(5000, None), (5020, [0.0] * 12), (5040, [float("nan")] + [1.0] * 11), (5060, [None] + [1.0] * 11), (None, [1.0] * 12),
           (5080, [1.0] * 3), (40, x[40].tolist())]
    df = spark.createDataFrame([*rows, *[(i, v, "b") for i, v in odd]], "vec_id long, embedding array<float>, rep string")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, 20, leaf_rows=64).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    assert set(got) == set(range(0, 3000, 20))
    for q, found in got.items():
        score = x.astype(float) @ x[q].astype(float)
        score[q] = -np.inf
        best = np.lexsort((np.arange(3000), -score))[:20]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in [v for _, v, _ in found]
        assert all(abs(score[v] - s) < 1e-9 for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        hits += len(set(best.tolist()) & {v for _, v, _ in found})
        total += 20
    assert hits / total > 0.9


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])], schema)
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


ODD = [None, "", " \n", "<|endoftext|> a<|startoftext|>b", "THE End.", "don't we'll", "é ́x İß ŒUVRE ÿ.", "x" * 9000, "a " * 9000,
       "1234 ½ ²", "a b c\x1cd", "😀!!! ***", "×÷ ª º"]


def test_packing_is_a_round_trip(spark, sf_dir):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, length int")
    rows = packing.pack(df, queries.word_tokenizer(), 512, 2).collect()
    tokenizer = Tokenizer.from_file(queries.word_tokenizer())
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += r.length
        assert at == len(ids)
    used = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
        used += at
    assert used / (512 * len(sequences)) > 0.97
    assert packing.pack(df.limit(0), queries.word_tokenizer()).count() == 0


@pytest.mark.parametrize("room", [7, 64])
def test_patterns_place_every_length(room):
    rng = np.random.default_rng(room)
    histogram = {int(k): int(v) for k, v in zip(rng.permutation(room)[: room // 2] + 1, rng.integers(1, 500, room))}
    packed = packing.patterns(histogram, room)
    placed = collections.Counter()
    for pattern, count in packed:
        assert sum(pattern) <= room and count > 0
        for length in pattern:
            placed[length] += count
    assert placed == histogram


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        after = {r.doc_id for r in docs.collect()}
        assert after and after <= before, name
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == before


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_pipeline_stages_on_odd_tables(spark, sf_dir, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row int, key string"
    odd = [(None, None, None, None, None, None, None), (1, "", "en", None, 0, 1, "k"), (1, "", "en", None, 0, 1, "k"),
           (2, "word " * 4000, "en", "s", 20000, None, None)]
    df = spark.createDataFrame(odd, schema)
    out = stage(spark, df, sf_dir)
    assert stage is corpus_pipeline.packing or out.columns == df.columns
    out.collect()
    assert stage(spark, df.limit(0), sf_dir).count() == 0
