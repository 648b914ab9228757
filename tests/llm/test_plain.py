"""The toxicity network by plain loops, and mixing rates by a dense solver."""

import math
import zlib

import numpy as np

from ledgerleaf.llm import mixing, toxicity


def plain_score(parameters, text):
    """One text's score, word by word and window by window, with the hashes written out again."""
    p = {k: np.asarray(v, float) for k, v in parameters.items()}
    size, hidden = toxicity.SIZE, toxicity.HIDDEN
    words = (text or "").lower().encode().split() or [b""]

    def gram(values):
        h = 0
        for v in values:
            h = (h * 31 + v) % 2**32
        return (h + (0x9E3779B9 if len(values) == 4 else 0)) % 2**32 * 0x85EBCA6B % 2**32 // 2**15 % toxicity.GRAMS

    def gates(word):
        raw = b"\x02" + word + b"\x03"
        cells = [gram(raw[i : i + n]) for n in (3, 4) for i in range(len(raw) - n + 1)]
        mean = sum((p["grams"][c] for c in cells), np.zeros(size)) / max(1, len(cells))
        return np.concatenate([p["words"][zlib.crc32(word) % toxicity.WORDS], mean]) @ p["inputs"] + p["bias"]

    def sigma(x):
        return 1 / (1 + np.exp(-x))

    def run(inputs, u):
        h, out = np.zeros(hidden), []
        for g in inputs:
            z = sigma(g[:hidden] + h @ u[:, :hidden])
            r = sigma(g[hidden : 2 * hidden] + h @ u[:, hidden : 2 * hidden])
            h = h + z * (np.tanh(g[2 * hidden :] + (r * h) @ u[:, 2 * hidden :]) - h)
            out.append(h)
        return out

    best = -math.inf
    last = max(0, len(words) - toxicity.STEPS)
    for start in sorted({*range(0, last, toxicity.STRIDE), last}):
        inputs = [gates(w) for w in words[start : start + toxicity.STEPS]]
        forward = run([g[: 3 * hidden] for g in inputs], p["forward"])
        backward = run([g[3 * hidden :] for g in inputs[::-1]], p["backward"])[::-1]
        states = [np.concatenate(pair) for pair in zip(forward, backward)]
        weight = np.array([np.tanh(s @ p["attend"]) @ p["query"] for s in states])
        weight = np.exp(weight - weight.max())
        context = sum(w * s for w, s in zip(weight / weight.sum(), states))
        best = max(best, float(context @ p["out"] + p["shift"][0]))
    return 1 / (1 + math.exp(-(best * float(parameters["scale"]) + float(parameters["offset"]))))


def test_scores_equal_plain_loops():
    rng = np.random.default_rng(9)
    parameters = {k: v * 3 for k, v in toxicity.Network.fresh(4).p.items()} | {"scale": 1.7, "offset": -0.4}
    words = ["vex", "été", "Alpha", "b", "longerword", "x1", "ÄÖ", "!"]
    texts = [None, "", " \n", "one", *[" ".join(rng.choice(words, n)) for n in (2, 23, 24, 25, 36, 37, 60, 121)]]
    got = toxicity.scores(parameters, texts)
    assert np.allclose(got, [plain_score(parameters, t) for t in texts], atol=2e-5)


def dense_rates(p, tokens, wanted, pull):
    """Rates that minimise half the squared residual plus the pull, by damped Newton steps on the residual."""
    share = tokens / tokens.sum()
    residual = np.zeros(p.shape[1])

    def miss(r):
        rate = np.maximum(1 - p @ r / pull, 0)
        return (rate * share) @ p - wanted - r, rate

    gap, rate = miss(residual)
    for _ in range(500):
        on = rate > 0
        slope = -(p[on] * share[on, None]).T @ p[on] / pull - np.eye(len(residual))
        step = -np.linalg.solve(slope, gap)
        for _ in range(40):
            trial, trial_rate = miss(residual + step)
            if np.abs(trial).max() < np.abs(gap).max():
                break
            step = step / 2
        residual, gap, rate = residual + step, trial, trial_rate
        if np.abs(gap).max() < 1e-12:
            break
    return rate


def test_rates_equal_a_dense_solver(spark):
    rng = np.random.default_rng(12)
    rows, labels = [], []
    for i in range(240):
        d = i % 3
        mixed = [f"d{d}w{rng.integers(30)}" if rng.random() < 0.8 else f"d{(d + 1) % 3}w{rng.integers(30)}" for _ in range(rng.integers(10, 80))]
        rows.append((i, " ".join(mixed)))
        labels.append((i, int(d != 1), int(d == 2)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    targets = {"prime": 0.5, "rough": 0.2, "toxic": 0.3}
    out = mixing.mixed(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), targets, tolerance=1e-7, rounds=120).collect()
    p, rate = np.array([r._p for r in out]), np.array([r._rate for r in out])
    tokens = np.array([r._tokens for r in out], float)
    wanted = np.array(list(targets.values()))
    pull = mixing.pull_for(tokens @ p / tokens.sum(), wanted)
    want = dense_rates(p, tokens, wanted, pull)
    assert np.abs(want - rate).max() < 0.05
    shares = [(r * tokens) @ p / tokens.sum() for r in (want, rate)]
    assert np.abs(shares[0] - shares[1]).max() < 1e-3
