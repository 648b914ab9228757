"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Each step reads a word: an embedding of the word and the mean embedding of its character
3- and 4-grams (both hashed, so every word has inputs). Forward and backward states of a
window are pooled by attention into one logit. A text is as toxic as its most toxic window;
all overlapping windows of the whole text are scored. The network is trained in numpy on a
bounded sample of labelled rows and calibrated on a part of them kept aside.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS, GRAMS = 1 << 13, 1 << 13  # cells of the two embedding tables
SIZE, HIDDEN = 8, 8  # embedding size of each table; states per direction
STEPS, STRIDE = 24, 12  # words of a window, and from one window to the next
BATCH = 256
KNOWN = 0.1  # share of a batch's words whose own embedding is read in training; the others show their grams only
DECAY = 0.1  # of the embeddings, per unit of the learning rate


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word cells, gram cells end to end, and the number of grams per word."""
    cells = np.fromiter((zlib.crc32(w) % WORDS for w in words), np.int64, len(words))
    raw = np.frombuffer(b"".join([b"\x02" + w + b"\x03" for w in words]) + bytes(4), np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(ends))
    three = (raw[:-4] * np.uint32(31) + raw[1:-3]) * np.uint32(31) + raw[2:-2]
    four = three * np.uint32(31) + raw[3:-1] + np.uint32(0x9E3779B9)
    hashed = [(h * np.uint32(0x85EBCA6B) >> np.uint32(15)) % np.uint32(GRAMS) for h in (three, four)]
    grams = np.stack(hashed, axis=1).astype(np.int64)
    real = np.stack([at + 3 <= ends, at + 4 <= ends], axis=1)
    counts = np.maximum(lengths - 2, 0) + np.maximum(lengths - 3, 0)
    return cells, grams[real], counts


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words; a text without any is one empty word."""
    return (text or "").lower().encode("utf-8", "replace").split() or [b""]


def window_starts(n: int) -> list[int]:
    """First words of the overlapping windows that cover ``n`` words."""
    return [0] if n <= STEPS else [*range(0, n - STEPS, STRIDE), n - STEPS]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters by name, forward scores, and gradients."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    @classmethod
    def fresh(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        wide = 6 * HIDDEN
        return cls({
            "words": normal(WORDS, SIZE, scale=0.1),
            "grams": normal(GRAMS, SIZE, scale=0.3),
            "inputs": normal(2 * SIZE, wide, scale=0.3),
            "bias": np.zeros(wide, np.float32),
            "forward": normal(HIDDEN, 3 * HIDDEN, scale=0.3),
            "backward": normal(HIDDEN, 3 * HIDDEN, scale=0.3),
            "attend": normal(2 * HIDDEN, 2 * HIDDEN, scale=0.3),
            "query": normal(2 * HIDDEN, scale=0.3),
            "out": normal(2 * HIDDEN, scale=0.3),
            "shift": np.zeros(1, np.float32),
        })

    def embedded(self, feats) -> np.ndarray:
        cells, grams, counts = feats
        owner = np.repeat(np.arange(len(cells)), counts)
        total = np.empty((len(cells), SIZE), np.float32)
        picked = self.p["grams"][grams]
        for j in range(SIZE):
            total[:, j] = np.bincount(owner, picked[:, j], len(cells))
        return np.concatenate([self.p["words"][cells], total / np.maximum(counts, 1)[:, None].astype(np.float32)], axis=1)

    def table(self, words: list[bytes]) -> np.ndarray:
        """Inputs of the gates for each distinct word."""
        parts = [self.embedded(features(words[i : i + 20_000])) for i in range(0, len(words), 20_000)]
        return np.concatenate([x @ self.p["inputs"] + self.p["bias"] for x in parts])

    def states(self, table, ids, mask, direction, keep=None) -> np.ndarray:
        """States of one direction, ``windows x steps x HIDDEN``; ``keep`` collects what the gradient needs."""
        own = table[:, : 3 * HIDDEN] if direction == "forward" else table[:, 3 * HIDDEN :]
        own = np.ascontiguousarray(own)
        u = self.p[direction]
        steps = range(ids.shape[1]) if direction == "forward" else range(ids.shape[1] - 1, -1, -1)
        h = np.zeros((len(ids), HIDDEN), np.float32)
        out = np.empty((len(ids), ids.shape[1], HIDDEN), np.float32)
        for t in steps:
            g = own[ids[:, t]]
            zr = sigmoid(g[:, : 2 * HIDDEN] + h @ u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN] * mask[:, t, None], zr[:, HIDDEN:]
            n = np.tanh(g[:, 2 * HIDDEN :] + (r * h) @ u[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, z, r, n, zr[:, :HIDDEN]))
            h = h + z * (n - h)
            out[:, t] = h
        return out

    def pooled(self, states, mask):
        hidden = np.tanh(states @ self.p["attend"])
        weight = hidden @ self.p["query"] + np.where(mask > 0, np.float32(0), np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        context = np.einsum("bt,bth->bh", weight, states)
        return context @ self.p["out"] + self.p["shift"], hidden, weight, context

    def logits(self, table, ids, mask) -> np.ndarray:
        out = np.empty(len(ids), np.float32)
        for i in range(0, len(ids), 2048):
            part, m = ids[i : i + 2048], mask[i : i + 2048]
            both = [self.states(table, part, m, d) for d in ("forward", "backward")]
            out[i : i + 2048] = self.pooled(np.concatenate(both, axis=2), m)[0]
        return out

    def gradients(self, feats, ids, mask, target, weight, known: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted cross-entropy of the windows; words not ``known`` are read by grams alone."""
        p, grads = self.p, {}
        x = self.embedded(feats)
        x[~known, :SIZE] = 0
        table = x @ p["inputs"] + p["bias"]
        kept = {"forward": [], "backward": []}
        states = np.concatenate([self.states(table, ids, mask, d, kept[d]) for d in kept], axis=2)
        logit, hidden, alpha, context = self.pooled(states, mask)
        d_logit = ((sigmoid(logit) - target) * weight / weight.sum()).astype(np.float32)
        grads["shift"], grads["out"] = np.array([d_logit.sum()]), context.T @ d_logit
        d_context = d_logit[:, None] * p["out"]
        d_states = alpha[:, :, None] * d_context[:, None, :]
        d_alpha = np.einsum("bth,bh->bt", states, d_context)
        d_weight = alpha * (d_alpha - (alpha * d_alpha).sum(axis=1, keepdims=True))
        grads["query"] = np.einsum("bt,bth->h", d_weight, hidden)
        d_hidden = d_weight[:, :, None] * p["query"] * (1 - hidden**2)
        flat = d_hidden.reshape(-1, 2 * HIDDEN)
        grads["attend"] = states.reshape(-1, 2 * HIDDEN).T @ flat
        d_states += (flat @ p["attend"].T).reshape(states.shape)
        d_table = np.empty((len(ids), ids.shape[1], 6 * HIDDEN), np.float32)
        for k, d in enumerate(kept):
            u, d_u = p[d], np.zeros_like(p[d])
            d_h = np.zeros((len(ids), HIDDEN), np.float32)
            for t, h, z, r, n, gate in reversed(kept[d]):
                d_h = d_h + d_states[:, t, k * HIDDEN : (k + 1) * HIDDEN]
                d_n = d_h * z * (1 - n**2)
                d_z = d_h * (n - h) * mask[:, t, None] * gate * (1 - gate)
                d_rh = d_n @ u[:, 2 * HIDDEN :].T
                d_r = d_rh * h * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], axis=1)
                d_u[:, : 2 * HIDDEN] += h.T @ d_zr
                d_u[:, 2 * HIDDEN :] += (r * h).T @ d_n
                d_table[:, t, 3 * k * HIDDEN : 3 * (k + 1) * HIDDEN] = np.concatenate([d_zr, d_n], axis=1)
                d_h = d_h * (1 - z) + d_rh * r + d_zr @ u[:, : 2 * HIDDEN].T
            grads[d] = d_u
        order = np.argsort(ids, axis=None, kind="stable")
        first = np.searchsorted(ids.reshape(-1)[order], np.arange(len(table)))
        d_table = np.add.reduceat(d_table.reshape(-1, 6 * HIDDEN)[order], first, axis=0)
        grads["bias"], grads["inputs"] = d_table.sum(axis=0), x.T @ d_table
        d_x = d_table @ p["inputs"].T
        cells, grams, counts = feats
        grads["words"], grads["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
        np.add.at(grads["words"], cells[known], d_x[known, :SIZE])
        shared = d_x[:, SIZE:] / np.maximum(counts, 1)[:, None]
        np.add.at(grads["grams"], grams, np.repeat(shared, counts, axis=0))
        return grads


class Adam:
    def __init__(self, rate: float):
        self.rate, self.m, self.v, self.t = rate, {}, {}, 0

    def step(self, parameters: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for name, g in grads.items():
            m = self.m[name] = 0.9 * self.m.get(name, 0) + 0.1 * g
            v = self.v[name] = 0.99 * self.v.get(name, 0) + 0.01 * g * g
            change = m / (1 - 0.9**self.t) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-8)
            kept = 1 - self.rate * DECAY if name in ("words", "grams") else 1
            parameters[name] = (parameters[name] * kept - self.rate * change).astype(np.float32)


class Windows:
    """The windows of some texts: word numbers, masks, and the text of each."""

    def __init__(self, texts: list[str | None]):
        number: dict[bytes, int] = {}
        ids, mask, owner = [], [], []
        for i, text in enumerate(texts):
            own = np.array([number.setdefault(w, len(number)) for w in tokens(text)])
            starts = np.array(window_starts(len(own)))
            at = starts[:, None] + np.arange(STEPS)
            ids.append(own[np.minimum(at, len(own) - 1)].astype(np.int32))
            mask.append((at < len(own)).astype(np.float32))
            owner.append(np.full(len(starts), i))
        self.words = list(number)
        self.ids = np.concatenate(ids)
        self.mask = np.concatenate(mask)
        self.owner = np.concatenate(owner)

    def batch(self, chosen: np.ndarray):
        used, ids = np.unique(self.ids[chosen], return_inverse=True)
        return features([self.words[i] for i in used]), ids.reshape(-1, STEPS), self.mask[chosen]


def best_windows(network: Network, windows: Windows, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest logit of each text, and its windows from the highest down."""
    logit = network.logits(network.table(windows.words), windows.ids, windows.mask)
    order = np.lexsort((-logit, windows.owner))
    first = np.searchsorted(windows.owner[order], np.arange(texts))
    return logit[order[first]], order


def trained(texts: list[str | None], toxic: np.ndarray, prior: float, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters of a network for the labelled texts, with scale and shift of its calibrated logit.

    First every window learns its text's label; then, in rounds, the highest windows of each text do,
    so that what is toxic in a long text is found and what is not is left alone.
    """
    rng = np.random.default_rng(seed)
    network, adam = Network.fresh(seed), Adam(0.02)
    aside = rng.random(len(texts)) < 0.2
    for label in (0, 1):  # both classes are in both parts if there are two rows at all
        own = np.flatnonzero(toxic == label)
        if len(own) > 1:
            aside[own[0]], aside[own[1]] = True, False
    train = np.flatnonzero(~aside)
    windows, label = Windows([texts[i] for i in train]), toxic[train].astype(np.float32)
    target = label[windows.owner]
    per_text = 1.0 / np.bincount(windows.owner)[windows.owner]

    def learn(choices: np.ndarray, steps: int) -> None:
        by_class = [choices[target[choices] == c] for c in (0, 1)]
        odds = [per_text[c] / per_text[c].sum() for c in by_class]
        for _ in range(steps):
            chosen = np.concatenate([rng.choice(c, BATCH // 2, p=o) for c, o in zip(by_class, odds)])
            feats, ids, mask = windows.batch(chosen)
            weight = np.ones(len(chosen), np.float32)
            known = rng.random(len(feats[0])) < KNOWN
            adam.step(network.p, network.gradients(feats, ids, mask, target[chosen], weight, known))

    learn(np.arange(len(target)), 200)
    for _ in range(5):
        _, order = best_windows(network, windows, len(train))
        place = np.arange(len(order)) - np.searchsorted(windows.owner[order], windows.owner[order])
        learn(order[place < np.where(target[order] > 0, 1, 4)], 60)

    held = Windows([texts[i] for i in np.flatnonzero(aside)])
    best, _ = best_windows(network, held, int(aside.sum()))
    truth = toxic[aside].astype(float)
    share = truth.mean()
    weight = np.where(truth > 0, prior / share, (1 - prior) / (1 - share))
    # One pseudo-row of the other class on each side keeps the scale finite when the classes separate.
    spread = max(float(best.std()), 1e-3)
    z = np.concatenate([(best - best.mean()) / spread, [2.0, -2.0]])
    truth, weight = np.concatenate([truth, [0.0, 1.0]]), np.concatenate([weight, [0.05, 0.05]])
    x, fit = np.stack([z, np.ones(len(z))], axis=1), np.zeros(2)
    for _ in range(50):
        q = 1 / (1 + np.exp(-x @ fit))
        curve = (x * (weight * q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        fit += np.clip(np.linalg.solve(curve, x.T @ (weight * (truth - q)) - 1e-3 * fit), -2, 2)
    return network.p | {"scale": np.array([max(fit[0], 0.0) / spread]),
                        "offset": np.array([fit[1] - fit[0] * best.mean() / spread])}


def scores(parameters: dict[str, np.ndarray], texts: list[str | None]) -> np.ndarray:
    """The calibrated score of each text over all its windows."""
    network = Network(parameters)
    windows = Windows(texts)
    table = network.table(windows.words)
    logit = network.logits(table, windows.ids, windows.mask)
    best = np.maximum.reduceat(logit, np.searchsorted(windows.owner, np.arange(len(texts))))
    return 1 / (1 + np.exp(-(best.astype(float) * parameters["scale"] + parameters["offset"])))


def portions(texts: list[str | None], limit: int = 1 << 21) -> Iterator[list[str | None]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string")) % 4 == 2


def fitted(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    per_class: int = 1500, longest: int = 10_000,
) -> dict[str, np.ndarray] | float:
    """The network for the labelled rows that are not held out, or their base rate if a class is missing.

    The sample is bounded: the ``per_class`` keys of each label with the smallest hashes, of those the
    texts of at most ``longest`` characters. The base rate is counted over all labelled rows. Null keys and null
    labels teach nothing, null texts count as empty ones; of several labels of a key the larger counts, of several rows the
    smallest text. Without labels or documents the result is a base rate.
    """
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key)
    marks = marks.agg(F.max(label).cast("int").alias("_toxic")).where(~F.coalesce(held_out(key), F.lit(False)))
    counts = {r["_toxic"]: r["count"] for r in marks.groupBy("_toxic").count().collect()}
    if not counts:
        return 0.0
    prior = counts.get(1, 0) / sum(counts.values())
    order = [F.xxhash64(F.col(key).cast("string")), F.col(key)]
    keys = [marks.where(F.col("_toxic") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("_text")).where(
        F.coalesce(F.length("_text"), F.lit(0)) <= longest
    ).join(F.broadcast(keys[0].unionByName(keys[1])), key)
    # A key that several rows share counts once.
    rows = rows.groupBy(key, "_toxic").agg(F.min("_text").alias("_text"))
    sample = sorted(rows.collect(), key=lambda r: (r["_toxic"], str(r[key])))
    toxic = np.array([r["_toxic"] for r in sample])
    if min((toxic == 0).sum(), (toxic == 1).sum()) < 2:
        return prior
    return trained([r["_text"] for r in sample], toxic, prior)


def score_toxicity(
    docs: DataFrame, model: dict[str, np.ndarray] | float, key: str = "doc_id", text: str = "text",
    threshold: float = 0.3,
) -> DataFrame:
    """Per row of ``docs``: the key, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Whole texts are scored. Null and empty texts count as one empty word. Without two rows of each
    label to learn from, every score is the base rate of the labels (0 without labels). Repeated rows
    are scored alike; other columns are ignored; an empty table gives an empty result.
    """
    slim = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    if isinstance(model, float):
        scored = slim.select(key, F.lit(model).alias("score"))
    else:
        shipped = docs.sparkSession.sparkContext.broadcast(model)

        def add(batches):
            for batch in batches:
                texts = batch.column(1).to_pylist()
                found = [scores(shipped.value, part) for part in portions(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.concatenate([np.zeros(0), *found]))], [key, "score"]
                )

        schema = slim.select(key).schema.add("score", "double")
        scored = slim.mapInArrow(add, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
