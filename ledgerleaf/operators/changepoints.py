"""Trends whose slope may change, with a yearly season, for many series in one job.

Possible changes lie on a grid over the first part of a series, each a hinge among the
regressors. Spark aggregates the products of all regressors per series; on that matrix
coordinate descent finds which few changes are needed, along a path of penalties judged by
BIC after refitting without the penalty. The band comes from simulated paths on which the slope goes on
changing as often and as much as it did.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.functions.calendar import future_month_ends
from ledgerleaf.operators.forecast import _key_schema, trend_features
from ledgerleaf.operators.leastsq import Moments, lag_moments, scaled_inverse, solved

PENALTIES = 40  # steps of the path, from the penalty that allows no change down to a thousandth of it
WAVES = 6


def grid(changes: int, share: float) -> list[float]:
    """Where changes may lie, as shares of the history."""
    return [share * j / (changes + 1) for j in range(1, changes + 1)]


def sparse_changes(products: np.ndarray, fixed: list[int], hinges: list[int], target: int, n: int) -> tuple[list[int], np.ndarray, float]:
    """Chosen hinges, coefficients of ``fixed`` and the chosen, and the residual sum of squares.

    ``products`` are sums about the means. The fixed regressors are swept out, then only hinges are penalised.
    """
    base = products[np.ix_(fixed, fixed)]
    rest = [*hinges, target]
    swept = products[np.ix_(rest, rest)] - products[np.ix_(rest, fixed)] @ scaled_inverse(base) @ products[np.ix_(fixed, rest)]
    scale = np.sqrt(np.maximum(np.diag(swept), 0))
    # What the fixed regressors explain already is no change.
    able = scale[:-1] > 1e-6 * np.sqrt(np.maximum(np.diag(products)[hinges], 1e-300))
    scale[scale == 0] = 1
    unit = swept / np.outer(scale, scale)
    gram, answer = unit[:-1, :-1], np.where(able, unit[:-1, -1], 0.0)

    def refit(active: list[int]) -> tuple[np.ndarray, float]:
        used = [*fixed, *[hinges[i] for i in active]]
        beta = scaled_inverse(products[np.ix_(used, used)]) @ products[used, target]
        return beta, max(float(products[target, target] - products[target, used] @ beta), 0.0)

    def criterion(active: list[int], ssr: float) -> float:
        return n * math.log(max(ssr, 1e-12 * products[target, target], 1e-300) / n) + math.log(n) * (len(fixed) + 2 * len(active) + 2)

    beta, ssr = refit([])
    best, tried = (criterion([], ssr), [], beta, ssr), {()}
    delta = np.zeros(len(hinges))
    top = float(np.abs(answer).max(initial=0.0))
    for step in range(1, PENALTIES + 1):
        penalty = top * 1000.0 ** (-step / PENALTIES)
        for _ in range(200):
            before = delta.copy()
            for j in np.flatnonzero(able):
                pull = answer[j] - gram[j] @ delta + delta[j]
                delta[j] = math.copysign(max(abs(pull) - penalty, 0.0), pull)
            if np.abs(delta - before).max(initial=0.0) < 1e-7:
                break
        active = peaks(delta)
        if tuple(active) in tried or len(fixed) + len(active) + 2 >= n:
            continue
        tried.add(tuple(active))
        beta, ssr = refit(active)
        best = min(best, (criterion(active, ssr), active, beta, ssr), key=lambda b: b[0])
    return best[1], best[2], best[3]


def peaks(delta: np.ndarray) -> list[int]:
    """Of neighbours on the grid that bend the same way only the strongest: one change between two grid points is one change."""
    out: list[int] = []
    for j in np.flatnonzero(delta):
        if out and out[-1] == j - 1 and delta[out[-1]] * delta[j] > 0:
            if abs(delta[j]) > abs(delta[out[-1]]):
                out[-1] = int(j)
        else:
            out.append(int(j))
    return out


def _fitted(df: DataFrame, keys: Sequence[str], column: str, schema: str, solve, changes: int, share: float) -> DataFrame:
    """``solve(key values, n, chosen places, coefficients, their changes, deviation)`` on every series' fit."""
    places = grid(changes, share)
    rows = df.where(F.col(column).isNotNull()).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    names = [f"f{i}" for i in range(1 + WAVES)]
    bends = [f"b{j}" for j in range(changes)]
    columns = dict(zip(names, trend_features(F.col("t"), F.col("_n"))))
    columns |= {b: F.greatest(F.col("t") / F.col("_n") - F.lit(p), F.lit(0.0)) for b, p in zip(bends, places)}
    inputs = rows.withColumns(columns)
    used = [*names, *bends, column]
    moments = lag_moments(inputs, keys, used, 0)

    def one(m: Moments, row) -> list[tuple]:
        n, products = m.sample(0)
        if n < WAVES + 4:
            return []
        mean = products[0] / n
        about = products - np.outer(products[0], mean)
        fixed, hinges, target = [m.at(c, 0) for c in names], [m.at(c, 0) for c in bends], m.at(column, 0)
        active, beta, ssr = sparse_changes(about, fixed, hinges, target, n)
        chosen = [*fixed, *[hinges[i] for i in active]]
        whole = mean + m.about
        constant = whole[target] - whole[chosen] @ beta
        deviation = math.sqrt(ssr / max(1, n - len(chosen) - 1))
        return solve([row[k] for k in keys], n, [places[i] for i in active], np.concatenate([[constant], beta]), deviation)

    return solved(moments, keys, used, 0, f"{_key_schema(df, keys)}, {schema}", one)


def trend_breaks(df: DataFrame, keys: Sequence[str], column: str, ts: str = "ts", changes: int = 25, share: float = 0.8) -> DataFrame:
    """``t, ts, change``: the periods from which a series' slope is another, and the change of the slope per period."""
    def solve(_keys, n, places, beta, _deviation) -> list[tuple]:
        return [(math.ceil(p * n), float(b / n)) for p, b in zip(places, beta[2 + WAVES :])]

    found = _fitted(df, keys, column, "t int, change double", solve, changes, share)
    return found.join(df.select(*keys, "t", ts), [*keys, "t"]).select(*keys, "t", ts, "change")


def changepoint_forecast(
    df: DataFrame, keys: Sequence[str], column: str, ts: str = "ts", steps: int = 12, changes: int = 25,
    share: float = 0.8, paths: int = 1000,
) -> DataFrame:
    """``h, ts, breaks, yhat, yhat_lower, yhat_upper``: trend with changes of slope plus season, negatives set to 0.

    The 95 percent band is taken from ``paths`` simulated continuations: in every period the slope changes
    with the frequency of past changes, by Laplace-distributed amounts of their mean size, plus noise. The
    same series always gets the same paths. Null values are left out; a series of fewer than ten rows has no forecast.
    """
    def solve(key, n, places, beta, deviation) -> list[tuple]:
        ahead = np.arange(1, steps + 1)
        t = n + ahead
        angles = 2 * np.pi * t / 12
        waves = np.column_stack([w(angles * k) for k in range(1, WAVES // 2 + 1) for w in (np.sin, np.cos)])
        bends = beta[2 + WAVES :]
        yhat = beta[0] + beta[1] * t / n + waves @ beta[2 : 2 + WAVES]
        yhat = yhat + sum((b * (t / n - p) for b, p in zip(bends, places)), np.zeros(steps))
        rng = np.random.default_rng(zlib.crc32(repr(key).encode()))
        size = np.abs(bends).mean() / n if len(bends) else 0.0
        turns = (rng.random((paths, steps)) < len(bends) / n) * rng.laplace(0.0, max(size, 1e-300), (paths, steps))
        # A change in period i bends everything after it.
        drift = np.cumsum(np.cumsum(turns, axis=1), axis=1)
        simulated = yhat + drift + rng.normal(0.0, max(deviation, 1e-300), (paths, steps))
        lower, upper = np.quantile(simulated, [0.025, 0.975], axis=0)
        clipped = np.maximum([yhat, np.minimum(lower, yhat), np.maximum(upper, yhat)], 0.0)
        return [(int(h), len(places), *map(float, clipped[:, h - 1])) for h in ahead]

    schema = "h int, breaks int, yhat double, yhat_lower double, yhat_upper double"
    found = _fitted(df, keys, column, schema, solve, changes, share)
    last = df.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.max(ts).alias(ts))
    ahead = future_month_ends(last, list(keys), ts, steps).select(*keys, "h", ts)
    return ahead.join(found, [*keys, "h"]).select(*keys, "h", ts, "breaks", "yhat", "yhat_lower", "yhat_upper")
