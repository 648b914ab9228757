"""Seasonal ARIMA models with moving-average terms, for many series in one job.

Every step is a pass over the rows of all series at once: differencing orders from tests,
innovations from a long autoregression, product sums of the lags of series and innovations,
and Gauss-Newton rounds on innovations filtered exactly. What is solved per series is a
matrix whose size depends on the orders only, so all candidate models of the stepwise search
are judged from one aggregate.

Signs: φ(B)Φ(Bˢ) w = θ(B)Θ(Bˢ) e with φ(B) = 1 − φ₁B − … and θ(B) = 1 + θ₁B + …
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.operators.forecast import _key_schema, _tail, augmented_dickey_fuller
from ledgerleaf.operators.leastsq import Moments, lag_moments, log_likelihood_aic, scaled_inverse, solved
from ledgerleaf.operators.series import decomposed, in_time
from ledgerleaf.session import checkpointed

STRENGTH = 0.64  # share of the season in the detrended variance from which a seasonal difference is taken
INSIDE = 1.001  # roots of the polynomials lie outside this circle


class Orders(NamedTuple):
    """Numbers of autoregressive and moving-average terms, plain and seasonal."""

    p: int
    q: int
    sp: int
    sq: int


class Terms:
    """The coefficients of a model, held as one vector in the order of :class:`Orders`."""

    def __init__(self, orders: Orders, season: int, values=None):
        self.orders, self.season = orders, season
        self.values = np.zeros(sum(orders)) if values is None else np.asarray(values, float)

    def parts(self) -> list[np.ndarray]:
        ends = np.cumsum(self.orders)[:-1]
        return np.split(self.values, ends)

    def polynomials(self) -> list[np.ndarray]:
        """φ, θ, Φ and Θ as coefficients of powers of B."""
        p, q, sp, sq = self.parts()
        return [plain(-p), plain(q), spaced(-sp, self.season), spaced(sq, self.season)]

    def inside(self) -> bool:
        """Whether the series is stationary and its innovations can be found from its past."""
        return all(
            len(c) == 1 or not np.any(c[1:]) or np.abs(np.roots(np.trim_zeros(c, "b")[::-1])).min() > INSIDE
            for c in self.shortened()
        )

    def shortened(self) -> list[np.ndarray]:
        p, q, sp, sq = self.parts()
        return [plain(-p), plain(q), plain(-sp), plain(sq)]


def plain(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[1.0], values])


def spaced(values: np.ndarray, season: int) -> np.ndarray:
    out = np.zeros(len(values) * season + 1)
    out[0] = 1.0
    out[season::season] = values
    return out


def power_series(above: np.ndarray, below: np.ndarray, length: int) -> np.ndarray:
    """The first ``length`` coefficients of above(B) / below(B)."""
    out = np.zeros(length)
    out[: min(length, len(above))] = above[:length]
    for i in range(length):
        back = min(i, len(below) - 1)
        out[i] -= below[1 : back + 1] @ out[i - back : i][::-1] if back else 0.0
    return out


def lagged(polynomial: np.ndarray, shift: int, length: int) -> np.ndarray:
    out = np.zeros(length)
    out[shift : shift + len(polynomial)] = polynomial
    return out


def weighted_past(column: str, weights: str, keys: Sequence[str], length: int) -> Column:
    """Σ weights[j] · column(t − j) over the past that a series has, at most ``length`` values."""
    past = F.reverse(F.collect_list(column).over(in_time(keys).rowsBetween(-(length - 1), 0)))
    terms = F.zip_with(past, F.slice(F.col(weights), 1, F.size(past)), lambda x, g: x * g)
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def differencing(df: DataFrame, keys: Sequence[str], column: str, season: int) -> DataFrame:
    """``keys, sd, d``: one seasonal difference where the season is strong, then as many as the unit-root test asks for.

    A series too short for a test is differenced once.
    """
    w = in_time(keys)
    parts = decomposed(df, keys, column, period=season).where(F.col("resid").isNotNull())
    strength = 1 - F.try_divide(F.var_pop("resid"), F.var_pop(F.col("resid") + F.col("seasonal")))
    seasonal = parts.groupBy(*keys).agg(F.when(strength > STRENGTH, 1).otherwise(0).alias("sd"))
    rows = df.join(seasonal, list(keys), "left").fillna(0, ["sd"])
    change = F.when(F.col("sd") == 1, F.col(column) - F.lag(column, season).over(w)).otherwise(F.col(column))
    levels = checkpointed(rows.select(*keys, "t", "sd", change.alias("x")).where(F.col("x").isNotNull()))
    steps = levels.withColumn("x", F.col("x") - F.lag("x").over(w)).where(F.col("x").isNotNull())
    first = augmented_dickey_fuller(levels, keys, "x", season).select(*keys, F.col("stationary").alias("_first"))
    second = augmented_dickey_fuller(steps, keys, "x", season).select(*keys, F.col("stationary").alias("_second"))
    d = F.when(F.col("_first"), 0).when(F.col("_second") | F.col("_second").isNull(), 1).otherwise(2)
    orders = rows.select(*keys, "sd").distinct().join(first, list(keys), "left").join(second, list(keys), "left")
    return orders.select(*keys, "sd", d.alias("d"))


def long_autoregression(rows: DataFrame, keys: Sequence[str], season: int, near: int, length: int) -> DataFrame:
    """``keys, weights``: what turns a series into innovations, by an autoregression on lags near multiples of the season."""
    lags = sorted({j + season * i for i in range(4) for j in range(near + 1)} - {0})
    schema = f"{_key_schema(rows, keys)}, weights array<double>"

    def solve(m: Moments, _row) -> list[tuple]:
        n, products = m.sample(m.lags)
        used = [k for k in lags if 4 * len([j for j in lags if j <= k]) <= n]
        at = [m.at("x", k) for k in used]
        beta = scaled_inverse(products[np.ix_(at, at)]) @ products[at, m.at("x", 0)]
        weights = np.zeros(length)
        weights[0] = 1.0
        weights[used] = -beta
        return [(weights.tolist(),)]

    return solved(lag_moments(rows, keys, ["x"], max(lags), padded=True), keys, ["x"], max(lags), schema, solve)


def fitted_on_lags(products: np.ndarray, size: int, terms: Terms, rounds: int = 30) -> float:
    """Fit ``terms`` on product sums of lags of series and innovations; their sum of squares."""
    def combination(t: Terms) -> np.ndarray:
        ar, ma, sar, sma = t.polynomials()
        own = lagged(np.convolve(ar, sar), 0, size)
        noise = lagged(np.convolve(ma, sma), 0, size)
        noise[0] = 0.0
        return np.concatenate([own, -noise])

    def slopes(t: Terms) -> np.ndarray:
        ar, ma, sar, sma = t.polynomials()
        zero, season = np.zeros(size), t.season
        p, q, sp, sq = t.orders
        out = [np.concatenate([-lagged(sar, i, size), zero]) for i in range(1, p + 1)]
        out += [np.concatenate([zero, -lagged(sma, i, size)]) for i in range(1, q + 1)]
        out += [np.concatenate([-lagged(ar, i * season, size), zero]) for i in range(1, sp + 1)]
        out += [np.concatenate([zero, -lagged(ma, i * season, size)]) for i in range(1, sq + 1)]
        return np.array(out)

    v = combination(terms)
    best = float(v @ products @ v)
    for _ in range(rounds if len(terms.values) else 0):
        j = slopes(terms)
        step = -scaled_inverse(j @ products @ j.T) @ (j @ products @ v)
        for _ in range(12):
            trial = Terms(terms.orders, terms.season, terms.values + step)
            trial_v = combination(trial)
            ssr = float(trial_v @ products @ trial_v)
            if ssr < best:
                break
            step = step / 2
        else:
            break
        done = best - ssr < 1e-10 * abs(best)
        terms.values, v, best = trial.values, trial_v, ssr
        if done:
            break
    return best


def stepwise(products: np.ndarray, size: int, n: int, season: int, longest: int, seasonal: int, most: int):
    """The model of least AIC that single steps from four starting models reach: ``(aic, terms)``."""
    tried: dict[Orders, tuple[float, Terms]] = {}

    def judged(orders: Orders) -> float:
        if orders not in tried:
            fits = max(orders[:2]) <= longest and max(orders[2:]) <= seasonal and sum(orders) <= most
            aic, terms = math.inf, Terms(orders, season)
            if min(orders) >= 0 and fits and n > 2 * (sum(orders) + 2):
                ssr = fitted_on_lags(products, size, terms)
                if ssr > 0 and terms.inside():
                    aic = log_likelihood_aic(ssr, n, sum(orders) + 1)
            tried[orders] = (aic, terms)
        return tried[orders][0]

    one = min(1, seasonal)
    best = min([Orders(2, 2, one, one), Orders(0, 0, 0, 0), Orders(1, 0, one, 0), Orders(0, 1, 0, one)], key=judged)
    moves = [(1, 0, 0, 0), (0, 1, 0, 0), (1, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (0, 0, 1, 1)]
    while True:
        around = [Orders(*(a + s * m for a, m in zip(best, move))) for move in moves for s in (1, -1)]
        around = [o for o in around if min(o) >= 0]
        better = min(around, key=judged)
        if not judged(better) < judged(best):
            return tried[best]
        best = better


MODEL = "orders array<int>, terms array<double>, aic double, weights array<double>, inverse array<double>"


def model_row(orders: Orders, terms: Terms, aic: float, length: int) -> tuple:
    """Orders, coefficients, AIC, and the filters φΦ/θΘ and 1/θΘ."""
    ar, ma, sar, sma = terms.polynomials()
    below = np.convolve(ma, sma)
    return (
        list(orders), terms.values.tolist(), float(aic), power_series(np.convolve(ar, sar), below, length).tolist(),
        power_series(np.ones(1), below, length).tolist(),
    )


def refined(rows: DataFrame, models: DataFrame, keys: Sequence[str], season: int, longest: int, seasonal: int, length: int) -> DataFrame:
    """One Gauss-Newton round on exactly filtered innovations; ``models`` with better coefficients and their AIC."""
    lags = longest + season * seasonal
    schema = f"{_key_schema(rows, keys)}, {MODEL}"
    joined = rows.join(models, list(keys)).withColumn("e", weighted_past("x", "weights", keys, length))
    filtered = joined.withColumns({
        "wf": weighted_past("x", "inverse", keys, length), "ef": weighted_past("e", "inverse", keys, length),
    }).select(*keys, "t", "e", "wf", "ef")
    moments = lag_moments(filtered, keys, ["e", "wf", "ef"], lags, padded=True).join(models, list(keys))

    def solve(m: Moments, row) -> list[tuple]:
        orders = Orders(*row["orders"])
        terms = Terms(orders, season, row["terms"])
        n, products = m.sample(m.lags)
        size = lags + 1
        own, noise = m.at("wf", 0), m.at("ef", 0)
        ar, ma, sar, sma = terms.polynomials()

        def slope(at: int, polynomial: np.ndarray, shift: int) -> np.ndarray:
            out = np.zeros(len(products))
            out[at : at + size] = -lagged(polynomial, shift, size)
            return out

        p, q, sp, sq = orders
        j = [slope(own, sar, i) for i in range(1, p + 1)] + [slope(noise, sma, i) for i in range(1, q + 1)]
        j += [slope(own, ar, i * season) for i in range(1, sp + 1)]
        j += [slope(noise, ma, i * season) for i in range(1, sq + 1)]
        e = m.at("e", 0)
        aic = log_likelihood_aic(products[e, e], n, sum(orders) + 1)
        if j:
            j = np.array(j)
            step = -scaled_inverse(j @ products @ j.T) @ (j @ products[:, e])
            for _ in range(12):
                trial = Terms(orders, season, terms.values + step)
                if trial.inside():
                    terms = trial
                    break
                step = step / 2
        return [model_row(orders, terms, aic, length)]

    return solved(moments, keys, ["e", "wf", "ef"], lags, schema, solve)


def seasonal_arima_models(
    df: DataFrame, keys: Sequence[str], column: str, season: int = 12, longest: int = 4, seasonal: int = 2,
    most: int = 5, rounds: int = 3, seasons_back: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """Rows ``keys, t, y, x, e`` and models ``keys, sd, d, base, mean, orders, terms, aic, …`` of all series.

    ``y`` is the column measured from the series' first value (``base``), ``x`` its differences about their
    mean, ``e`` the innovations. Up to ``longest`` plain and ``seasonal`` seasonal terms of a kind, ``most`` in
    all. Innovations look back ``seasons_back`` seasons. A series without rows left after
    differencing has no model; null values are left out.
    """
    w, group = in_time(keys), Window.partitionBy(*keys)
    length = seasons_back * season + 1
    base = F.first(F.col(column).cast("double")).over(w)
    level = df.where(F.col(column).isNotNull()).select(
        *keys, "t", (F.col(column).cast("double") - base).alias("y"), base.alias("base")
    )
    orders = checkpointed(differencing(level, keys, "y", season))
    rows = level.join(orders, list(keys))
    rows = rows.withColumn("_s", F.when(F.col("sd") == 1, F.col("y") - F.lag("y", season).over(w)).otherwise(F.col("y")))
    rows = rows.withColumn("_1", F.col("_s") - F.lag("_s").over(w)).withColumn("_2", F.col("_1") - F.lag("_1").over(w))
    change = F.when(F.col("d") == 0, F.col("_s")).when(F.col("d") == 1, F.col("_1")).otherwise(F.col("_2"))
    rows = rows.withColumn("_w", change).where(F.col("_w").isNotNull())
    mean = F.when(F.col("sd") + F.col("d") <= 1, F.avg("_w").over(group)).otherwise(F.lit(0.0))
    rows = checkpointed(rows.withColumn("mean", mean).select(*keys, "t", "y", "base", "sd", "d", "mean", (F.col("_w") - F.col("mean")).alias("x")))
    slim = rows.select(*keys, "t", "x")
    start = checkpointed(long_autoregression(slim, keys, season, longest + 1, length))
    noise = slim.join(start, list(keys)).withColumn("e", weighted_past("x", "weights", keys, length))
    lags = longest + season * seasonal
    schema = f"{_key_schema(df, keys)}, {MODEL}"

    def solve(m: Moments, _row) -> list[tuple]:
        n, products = m.sample(m.lags)
        aic, terms = stepwise(products[1:, 1:], lags + 1, n, season, longest, seasonal, most)
        return [model_row(terms.orders, terms, aic, length)] if math.isfinite(aic) else []

    products = lag_moments(noise.select(*keys, "t", "x", "e"), keys, ["x", "e"], lags, padded=True)
    models = checkpointed(solved(products, keys, ["x", "e"], lags, schema, solve))
    for _ in range(rounds):
        models = checkpointed(refined(slim, models, keys, season, longest, seasonal, length))
    with_noise = rows.join(models, list(keys)).withColumn("e", weighted_past("x", "weights", keys, length))
    named = rows.select(*keys, "sd", "d", "base", "mean").distinct().join(models, list(keys))
    return with_noise.select(*keys, "t", "y", "x", "e"), named


def seasonal_arima_forecast(
    df: DataFrame, keys: Sequence[str], column: str, steps: int = 12, season: int = 12, longest: int = 4,
    seasonal: int = 2, most: int = 5,
) -> DataFrame:
    """Automatic seasonal ARIMA: ``p, d, q, sp, sd, sq, aic, h, yhat, yhat_lower, yhat_upper`` per series.

    Orders by unit-root test, strength of the season and a stepwise search by AIC; the 95 percent band
    grows with the model's impulse weights.
    """
    rows, models = seasonal_arima_models(df, keys, column, season, longest, seasonal, most)
    rows = checkpointed(rows)
    back = longest + season * seasonal + season + 2
    spread = rows.groupBy(*keys).agg(F.sum(F.col("e") * F.col("e")).alias("ssr"), F.count(F.lit(1)).alias("rows"))
    start = F.first(F.col(column).cast("double")).over(in_time(keys))
    levels = df.where(F.col(column).isNotNull()).select(*keys, "t", (F.col(column).cast("double") - start).alias("y"))
    ends = _tail(levels, keys, ["y"], back).join(_tail(rows, keys, ["e"], back).withColumnRenamed("tail", "noise"), list(keys))
    inputs = models.join(spread, list(keys)).join(ends, list(keys))
    schema = (
        f"{_key_schema(df, keys)}, p int, d int, q int, sp int, sd int, sq int, aic double, h int, "
        "yhat double, yhat_lower double, yhat_upper double"
    )
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def ahead(batches):
        import pandas as pd

        for batch in batches:
            out = []
            for _, row in batch.iterrows():
                terms = Terms(Orders(*row["orders"]), season, row["terms"])
                ar, ma, sar, sma = terms.polynomials()
                own, noise_weights = np.convolve(ar, sar), np.convolve(ma, sma)
                whole = own
                for _ in range(int(row["sd"])):
                    whole = np.convolve(whole, spaced(np.array([-1.0]), season))
                for _ in range(int(row["d"])):
                    whole = np.convolve(whole, [1.0, -1.0])
                y, e = [v[0] for v in row["tail"]], [v[0] for v in row["noise"]]
                if len(y) < len(whole) - 1:
                    continue
                e = [0.0] * len(noise_weights) + e
                constant = float(row["mean"]) * own.sum()
                impulse = power_series(noise_weights, whole, steps)
                variance = row["ssr"] / max(1, row["rows"] - len(terms.values) - 1)
                p, q, sp, sq = terms.orders
                head = (*[row[k] for k in keys], p, int(row["d"]), q, sp, int(row["sd"]), sq, float(row["aic"]))
                for h in range(1, steps + 1):
                    past = sum(g * y[-i] for i, g in enumerate(whole) if i)
                    e.append(0.0)
                    y.append(float(constant - past + sum(b * e[-1 - i] for i, b in enumerate(noise_weights))))
                    half = 1.959963984540054 * math.sqrt(variance * (impulse[:h] ** 2).sum())
                    at = float(row["base"]) + y[-1]
                    out.append((*head, h, at, at - half, at + half))
            yield pd.DataFrame(out, columns=names)

    return inputs.mapInPandas(ahead, schema)
