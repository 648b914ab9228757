"""Mixing to target weights with soft membership.

A softmax classifier, fitted on a bounded sample of labelled rows, gives every document a posterior
over domains. Nonnegative rates of the documents are then fitted by least squares, so that the tokens
expected per domain meet the targets, with a weak pull of every rate towards 1 that makes the answer
unique and is small against the smallest target and share. The fit is a projected gradient with momentum,
scaled by the shares of a document's domains: each step is one distributed sum over the posteriors; the
driver sees one total per domain. A document's rate follows from its posterior and the steps taken, so no
step keeps a table of rates.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.tables import stored

CELLS = 1 << 15  # of each of the three hashed word features
DIGITS = 2  # to which posteriors are rounded
PULL = 0.003  # greatest weight of the pull of the rates towards 1
MISSED = 0.02  # part of its target by which the pull may move a domain whose posteriors are 0 and 1


def word_cells(words: list[bytes]) -> np.ndarray:
    """Cells of each word as a whole, of its beginning and of its end."""
    crc = zlib.crc32
    return np.array([
        (crc(w) % CELLS, CELLS + crc(w[:4]) % CELLS, 2 * CELLS + crc(w[-3:]) % CELLS) for w in words
    ], np.int64).reshape(-1, 3)


class Texts:
    """Distinct words of some texts, by text, and how many words each text has."""

    def __init__(self, texts: list[str | None]):
        number: dict[bytes, int] = {}
        ids, owner, self.tokens = [], [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            words = (t or "").encode("utf-8", "replace").split()
            self.tokens[i] = len(words)
            own = np.unique(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
            ids.append(own)
            owner.append(np.full(len(own), i))
        self.ids, self.owner = np.concatenate([*ids, np.zeros(0, np.int64)]), np.concatenate([*owner, np.zeros(0, np.int64)])
        self.cells = word_cells(list(number))
        distinct = np.bincount(self.owner, minlength=len(texts))
        self.scale = 1 / np.sqrt(np.maximum(distinct, 1))
        # How often words recur, in tenths, is a feature of its own.
        self.spread = 3 * CELLS + np.minimum(10 * distinct // np.maximum(self.tokens, 1), 9)

    def logits(self, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        by_word = weights[self.cells].sum(axis=1)
        total = np.stack([np.bincount(self.owner, w[self.ids], len(self.tokens)) for w in by_word.T], axis=1)
        return total * self.scale[:, None] + weights[self.spread] + bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def trained(texts: list[str | None], domain: np.ndarray, share: np.ndarray, rounds: int = 120) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of the classifier, for domains that make up ``share`` of all labelled rows."""
    data, k = Texts(texts), len(share)
    weights, bias = np.zeros((3 * CELLS + 10, k)), np.zeros(k)
    truth = np.eye(k)[domain]
    each = (share / np.maximum(truth.sum(axis=0), 1))[domain]
    state = [[np.zeros_like(v), np.zeros_like(v)] for v in (weights, bias)]
    for t in range(1, rounds + 1):
        error = (softmax(data.logits(weights, bias)) - truth) * each[:, None]
        scaled = error * data.scale[:, None]
        by_word = np.stack([np.bincount(data.ids, s[data.owner], len(data.cells)) for s in scaled.T], axis=1)
        gradient = np.zeros_like(weights)
        for j in range(k):
            for column in data.cells.T:
                gradient[:, j] += np.bincount(column, by_word[:, j], len(weights))
            gradient[:, j] += np.bincount(data.spread, error[:, j], len(weights))
        for value, g, (m, v) in zip((weights, bias), (gradient + 1e-5 * weights, error.sum(axis=0)), state):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value -= 0.1 * m / (1 - 0.9**t) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return weights.astype(np.float32), bias


def label_domain() -> Column:
    """Domains of the ``labels`` table: ``toxic``, else ``rough`` (low quality), else ``prime``."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "rough").when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), "prime"
    )


def posteriors(
    docs: DataFrame, labels: DataFrame, domain: Column, domains: list[str], key: str = "doc_id", text: str = "text",
    per_domain: int = 1500, longest: int = 10_000,
) -> DataFrame:
    """``docs`` with ``_tokens`` (words) and ``_p``, the rounded posterior of each of ``domains``.

    The sample: of each domain the ``per_domain`` labelled keys with the smallest hashes, of these the
    texts of at most ``longest`` characters. A domain without labelled rows has posterior 0; without any
    labelled rows all domains are equally likely. A null text is empty; empty texts have no tokens and one posterior in
    common. Of several labels of a key the smallest domain counts. Repeated rows stay; an empty table gives an empty result.
    """
    marks = labels.select(F.col(key).alias("_key"), domain.alias("_domain"))
    marks = marks.where(F.col("_domain").isin(domains) & F.col("_key").isNotNull())
    marks = marks.groupBy("_key").agg(F.min("_domain").alias("_domain"))
    marks = marks.join(docs.select(F.col(key).alias("_key")).distinct(), "_key", "left_semi")
    marks = stored(marks, "marks")
    counts = {r["_domain"]: r["count"] for r in marks.groupBy("_domain").count().collect()}
    present = [d for d in domains if d in counts]
    k = len(domains)
    if len(present) > 1:
        keys = [
            marks.where(F.col("_domain") == d).orderBy(F.xxhash64(F.col("_key").cast("string")), "_key").limit(per_domain)
            for d in present
        ]
        chosen = keys[0]
        for more in keys[1:]:
            chosen = chosen.unionByName(more)
        rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).where(
            F.coalesce(F.length("_text"), F.lit(0)) <= longest
        ).join(F.broadcast(chosen), "_key").groupBy("_key", "_domain").agg(F.min("_text").alias("_text"))
        sample = sorted(rows.collect(), key=lambda r: (r["_domain"], str(r["_key"])))
        share = np.array([counts[d] for d in present], float)
        weights, bias = trained(
            [r["_text"] for r in sample], np.array([present.index(r["_domain"]) for r in sample]), share / share.sum()
        )
        model = (weights, bias)
    else:
        model = None
    fixed = np.array([float(d in present) if present else 1.0 for d in domains])
    fixed /= fixed.sum()
    at = [domains.index(d) for d in present]
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    place = names.index(text)

    def add(batches):
        for batch in batches:
            texts = batch.column(0).field(place).to_pylist()
            tokens, found = [], []
            for i in range(0, len(texts), 256):
                data = Texts(texts[i : i + 256])
                p = np.tile(fixed, (len(data.tokens), 1))
                if shipped.value is not None:
                    p = np.zeros((len(data.tokens), k))
                    p[:, at] = np.round(softmax(data.logits(*shipped.value)), DIGITS)
                    p /= p.sum(axis=1, keepdims=True)
                tokens.append(data.tokens)
                found.append(p)
            tokens = np.concatenate([np.zeros(0, np.int64), *tokens])
            found = np.concatenate([np.zeros((0, k)), *found])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, k), pa.int32()), found.reshape(-1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens), lists], ["_row", "_tokens", "_p"])

    whole = docs.select(F.struct("*").alias("_row"))
    row = whole.schema["_row"].dataType.simpleString()
    return whole.mapInArrow(add, _schema(whole, row))


def _schema(whole: DataFrame, row: str):
    from pyspark.sql import types as T

    return T.StructType([
        *whole.schema.fields, T.StructField("_tokens", T.LongType()), T.StructField("_p", T.ArrayType(T.DoubleType())),
    ])


@dataclass(frozen=True)
class Fit:
    """Residuals of the steps taken (in shares of all tokens), the domains' shares before, weight of the pull."""

    steps: list[np.ndarray]
    shares: np.ndarray
    pull: float


def rates_of(p: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the steps of ``fit`` for posteriors ``p``, and the point where the next gradient is taken."""
    rate = point = np.ones(len(p))
    momentum = 1.0
    # The curvature along a document's rate is at most the share of its domains, weighed by its posterior.
    size = 1 / (p @ fit.shares + fit.pull)
    for residual in fit.steps:
        moved = np.maximum(point - size * (p @ residual + fit.pull * (point - 1)), 0.0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        point = moved + (momentum - 1) / following * (moved - rate)
        rate, momentum = moved, following
    return rate, point


def pull_for(shares: np.ndarray, wanted: np.ndarray) -> float:
    """The weight of the pull with which no domain misses its target by more than ``MISSED`` of it."""
    with np.errstate(divide="ignore", invalid="ignore"):
        bound = MISSED * shares * wanted / np.abs(shares - wanted)
    return float(min([PULL, *bound[(wanted > 0) & (shares > 0) & (shares != wanted)]]))


def fitted_steps(marked: DataFrame, weights: np.ndarray, total: str, rounds: int, tolerance: float):
    """The fit by projected gradient.

    ``total`` says how many tokens the targets make up: ``"all"`` of the corpus, or as many as go with the
    whole of the domain of the ``"largest"`` weight.
    """
    k = len(weights)
    cells = stored(marked.groupBy("_p").agg(F.sum("_tokens").cast("double").alias("_tokens")), "posteriors")

    def totals(fit):
        def part(batches):
            for batch in batches:
                p = np.asarray(batch.column(0).flatten(), float).reshape(-1, k)
                point = rates_of(p, fit)[1]
                own = (point * batch.column(1).to_numpy()) @ p
                yield pa.RecordBatch.from_pydict({"domain": pa.array(np.arange(k)), "tokens": pa.array(own)})

        rows = cells.select("_p", "_tokens").mapInArrow(part, "domain long, tokens double")
        rows = rows.groupBy("domain").agg(F.sum("tokens").alias("tokens")).collect()
        out = np.zeros(k)
        for r in rows:
            out[r["domain"]] = r["tokens"]
        return out

    have = totals(Fit([], np.ones(k), PULL))
    every = have.sum()
    if not every:
        return Fit([], np.ones(k), PULL)
    goal = weights * (have > 0)
    goal = goal / goal.sum() if goal.sum() else have / every
    main = int(np.argmax(goal))
    wanted = goal * (every if total == "all" else have[main] / goal[main])
    fit = Fit([], have / every, pull_for(have / every, wanted / every))
    residual = (have - wanted) / every
    for _ in range(rounds):
        fit.steps.append(residual)
        following = (totals(fit) - wanted) / every
        settled = np.abs(following - residual).max() < tolerance * fit.pull / PULL
        residual = following
        if settled:
            break
    return fit


def mixed(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float], domain: Column | None = None, total: str = "all",
    key: str = "doc_id", text: str = "text", rounds: int = 100, tolerance: float = 2e-5,
) -> DataFrame:
    """Per row of ``docs``: the row in a struct ``_row``, ``_tokens``, ``_p`` (posterior per target, in the
    order of ``targets``), ``_rate`` and ``_copies``.

    ``_copies`` is the rate rounded up or down by a hash of the row, so that its mean over rows is the rate.
    Tokens are maximal runs of other characters than ASCII white space. Null and empty texts have none and
    the posterior of a text without words. A target without labelled rows is left out and the others
    scaled up; without tokens all rates are 1. Repeated rows share a rate and a number of copies. An empty
    table gives an empty result.
    """
    domain = label_domain() if domain is None else domain
    marked = stored(posteriors(docs, labels, domain, list(targets), key, text), "posteriors")
    fit = fitted_steps(marked, np.array(list(targets.values()), float), total, rounds, tolerance)
    k = len(targets)

    def add(batches):
        for batch in batches:
            p = np.asarray(batch.column(2).flatten(), float).reshape(-1, k)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rates_of(p, fit)[0])], [*batch.schema.names, "_rate"]
            )

    from pyspark.sql import types as T

    schema = T.StructType([*marked.schema.fields, T.StructField("_rate", T.DoubleType())])
    rated = marked.mapInArrow(add, schema)
    dice = F.pmod(F.xxhash64(F.lit("copies"), F.col(f"_row.{key}"), F.xxhash64(f"_row.{text}")), F.lit(1 << 20)) / float(1 << 20)
    return rated.withColumn("_copies", F.floor(F.col("_rate") + dice).cast("int"))
