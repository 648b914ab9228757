"""Stationarity, causality and cointegration tests, and forecasts, for many series at once.

All take ``keys, t, value…`` with one row per period and series. Moments are
aggregated by :mod:`ledgerleaf.operators.leastsq`; forecasts iterate over a
bounded tail of each series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.operators.leastsq import Moments, lag_moments, log_likelihood_aic, scaled_inverse, solved
from ledgerleaf.operators.series import in_time

# Response surface b0 + b1/n + b2/n² + b3/n³ of the Dickey-Fuller
# distribution with a constant (MacKinnon 2010) at 1, 5 and 10 percent.
DICKEY_FULLER = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10": (-2.56677, -1.5384, -2.809, 0.0),
}
# 95 percent points of the trace statistic without deterministic
# terms, by the number of common trends.
TRACE_95 = {1: 4.1296, 2: 12.3212, 3: 24.2761, 4: 40.1749, 5: 60.0627}


def critical_value(level: str, n: int) -> float:
    return sum(b / n**i for i, b in enumerate(DICKEY_FULLER[level]))


def dickey_fuller(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Lag-0 test in columns only: ``slope, statistic, n`` of Δx on a constant and the last level."""
    w = in_time(keys)
    rows = df.select(*keys, (F.col(column) - F.lag(column).over(w)).alias("_y"), F.lag(column).over(w).alias("_x"))
    stats = rows.where(F.col("_x").isNotNull()).groupBy(*keys).agg(
        F.regr_slope("_y", "_x").alias("slope"), F.regr_sxx("_y", "_x").alias("_sxx"),
        F.regr_syy("_y", "_x").alias("_syy"), F.regr_sxy("_y", "_x").alias("_sxy"), F.count("*").alias("n"),
    )
    ssr = F.col("_syy") - F.try_divide(F.col("_sxy") * F.col("_sxy"), "_sxx")
    error = F.sqrt(F.try_divide(F.try_divide(ssr, F.col("n") - 2), "_sxx"))
    return stats.select(*keys, "slope", F.try_divide("slope", error).alias("statistic"), "n")


def _key_schema(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)


def augmented_dickey_fuller(df: DataFrame, keys: Sequence[str], column: str, max_lag: int = 12) -> DataFrame:
    """Unit-root test with a constant, lag chosen by AIC on the common sample.

    ``lag, n, statistic, crit_1, crit_5, crit_10, stationary`` per series; the
    verdict is the test at five percent.
    """
    w = in_time(keys)
    steps = df.select(
        *keys, "t", (F.col(column) - F.lag(column).over(w)).alias("dx"), F.lag(column).over(w).alias("level")
    ).where(F.col("dx").isNotNull())
    schema = (
        f"{_key_schema(df, keys)}, lag int, n int, statistic double, "
        "crit_1 double, crit_5 double, crit_10 double, stationary boolean"
    )

    def solve(m: Moments, _row) -> list[tuple]:
        target = [m.at("dx", 0)]
        regressors = lambda p: [0, m.at("level", 0), *[m.at("dx", k) for k in range(1, p + 1)]]
        longest = max((p for p in range(max_lag + 1) if m.sample(p)[0] > 2 * p + 4), default=None)
        if longest is None:
            return []
        scores = []
        for p in range(longest + 1):
            _, residual, _, n = m.fit(target, regressors(p), longest)
            scores.append((log_likelihood_aic(residual[0, 0], n, p + 2), p))
        lag = min(scores)[1]
        beta, residual, inverse, n = m.fit(target, regressors(lag), lag)
        variance = max(residual[0, 0], 0.0) / (n - lag - 2)
        error = math.sqrt(variance * inverse[1, 1])
        if error == 0:
            return []
        statistic = float(beta[1, 0] / error)
        levels = [critical_value(name, n) for name in DICKEY_FULLER]
        return [(lag, n, statistic, *levels, bool(statistic < levels[1]))]

    return solved(lag_moments(steps, keys, ["dx", "level"], max_lag), keys, ["dx", "level"], max_lag, schema, solve)


def chi_square_tail(x: float, freedom: int) -> float:
    """P(X > x) of a chi-square variable with whole degrees of freedom, in closed form."""
    half = max(x, 0.0) / 2
    if freedom % 2 == 0:
        term = total = 1.0
        for i in range(1, freedom // 2):
            term *= half / i
            total += term
        return min(1.0, math.exp(-half) * total)
    total, term = math.erfc(math.sqrt(half)), math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for i in range(1, (freedom - 1) // 2 + 1):
        total += term
        term *= half / (i + 0.5)
    return min(1.0, total)


def granger_matrix(df: DataFrame, keys: Sequence[str], columns: Sequence[str], max_lag: int = 12) -> DataFrame:
    """``response, predictor, p_value``: the smallest p over lags 1 … max_lag, to four digits.

    The test compares the squared residuals with and without the predictor's lags.
    A column says nothing about itself beyond its own lags: the diagonal is 1.
    """
    schema = f"{_key_schema(df, keys)}, response string, predictor string, p_value double"

    def solve(m: Moments, _row) -> list[tuple]:
        out = []
        for y in columns:
            for x in columns:
                if x == y:
                    out.append((f"{y}_y", f"{x}_x", 1.0))
                    continue
                best = 1.0
                for lag in range(1, max_lag + 1):
                    own = [0, *[m.at(y, k) for k in range(1, lag + 1)]]
                    other = [m.at(x, k) for k in range(1, lag + 1)]
                    _, small, _, n = m.fit([m.at(y, 0)], own, lag)
                    _, full, _, _ = m.fit([m.at(y, 0)], own + other, lag)
                    if n > 2 * lag + 1 and full[0, 0] > 0:
                        statistic = n * (small[0, 0] - full[0, 0]) / full[0, 0]
                        best = min(best, round(chi_square_tail(statistic, lag), 4))
                out.append((f"{y}_y", f"{x}_x", best))
        return out

    return solved(lag_moments(df, keys, columns, max_lag), keys, columns, max_lag, schema, solve)


def _divided(moments: np.ndarray, by: np.ndarray) -> np.ndarray:
    """``moments⁻¹ @ by``; what does not vary, or only along with other columns, takes no part."""
    scale = np.sqrt(np.maximum(np.diag(moments), 0))
    if scale.all() and np.linalg.eigvalsh(moments / np.outer(scale, scale))[0] > 1e-12:
        return np.linalg.solve(moments, by)
    return scaled_inverse(moments) @ by


def johansen_trace(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], lags: int = 5, origin: str = "zero"
) -> DataFrame:
    """``rank, trace, crit_95, cointegrated`` per hypothesis of at most ``rank`` relations.

    The model has no constant, so the result depends on the levels as they stand. With
    ``origin="first"`` they are measured from each series' first value and adding a
    number to a series changes nothing. A column that never changes has no canonical
    correlation of its own.
    """
    if origin not in ("first", "zero"):
        raise ValueError(origin)
    w = in_time(keys)
    if origin == "first":
        df = df.withColumns({c: F.col(c) - F.first(c).over(w) for c in columns})
    changes = {f"d_{c}": F.col(c) - F.lag(c).over(w) for c in columns}
    steps = df.withColumns(changes).where(F.col(f"d_{columns[0]}").isNotNull())
    names = [*changes, *columns]
    schema = f"{_key_schema(df, keys)}, rank int, trace double, crit_95 double, cointegrated boolean"

    def solve(m: Moments, _row) -> list[tuple]:
        own = [m.at(f"d_{c}", 0) for c in columns]
        level = [m.at(c, lags) for c in columns]
        past = [m.at(f"d_{c}", k) for c in columns for k in range(1, lags + 1)]
        size = len(columns)
        n, products = m.sample(lags)
        if n <= len(past) + size:
            return []
        rows = np.eye(len(products))[own + level + past]
        rows[:, 0] += m.about[own + level + past]
        # The roots are the same for any combinations of the levels: one level carries the large constant, on
        # the scale of one, and the others lose theirs, so no digits are lost to it.
        start = m.about[level]
        pivot = int(np.argmax(np.abs(start)))
        if start[pivot] != 0:
            levels = rows[size : 2 * size]
            others = [i for i in range(size) if i != pivot]
            levels[others] -= np.outer(start[others] / start[pivot], levels[pivot])
            levels[others, 0] = 0.0
            levels[pivot] /= abs(start[pivot])
        products = rows @ products @ rows.T
        xx, xy = products[2 * size :, 2 * size :], products[2 * size :, : 2 * size]
        residual = products[: 2 * size, : 2 * size] - xy.T @ scaled_inverse(xx) @ xy
        s = residual / n
        s00, s0k, skk = s[:size, :size], s[:size, size:], s[size:, size:]
        scale = np.sqrt(np.maximum(np.diag(skk), 1e-300))
        s0k, skk = s0k / scale, skk / np.outer(scale, scale)
        roots = np.linalg.eigvals(_divided(skk, s0k.T @ _divided(s00, s0k)))
        roots = np.clip(np.sort(roots.real)[::-1], 0.0, 1 - 1e-15)
        out = []
        for r in range(size):
            trace = float(-n * np.log(1 - roots[r:]).sum())
            out.append((r, trace, TRACE_95[size - r], bool(trace > TRACE_95[size - r])))
        return out

    return solved(lag_moments(steps, keys, names, lags), keys, names, lags, schema, solve)


def _var_fit(m: Moments, columns: Sequence[str], order: int, sample: int):
    targets = [m.at(c, 0) for c in columns]
    regressors = [0, *[m.at(c, k) for k in range(1, order + 1) for c in columns]]
    beta, residual, _, n = m.fit(targets, regressors, sample)
    return beta, residual, n


def var_orders(df: DataFrame, keys: Sequence[str], columns: Sequence[str], max_lag: int = 12) -> DataFrame:
    """``lag, aic, bic, fpe, hqic`` of vector autoregressions on the common sample."""
    schema = f"{_key_schema(df, keys)}, lag int, aic double, bic double, fpe double, hqic double"

    def solve(m: Moments, _row) -> list[tuple]:
        out, size = [], len(columns)
        for order in range(max_lag + 1):
            _, residual, n = _var_fit(m, columns, order, max_lag)
            used = size * order + 1
            sign, logdet = np.linalg.slogdet(residual / n)
            if n <= used or sign <= 0:
                continue
            free = size * used
            aic = logdet + 2 / n * free
            bic = logdet + math.log(n) / n * free
            hqic = logdet + 2 * math.log(math.log(n)) / n * free
            fpe = ((n + used) / (n - used)) ** size * math.exp(logdet)
            out.append((order, float(aic), float(bic), float(fpe), float(hqic)))
        return out

    return solved(lag_moments(df, keys, columns, max_lag), keys, columns, max_lag, schema, solve)


def var_residual_correlation(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: int) -> DataFrame:
    """``x, y, r``: correlations between the residuals of a fitted vector autoregression."""
    schema = f"{_key_schema(df, keys)}, x string, y string, r double"

    def solve(m: Moments, _row) -> list[tuple]:
        _, residual, _ = _var_fit(m, columns, order, order)
        scale = np.sqrt(np.diag(residual))
        if not (scale > 0).all():
            return []
        r = residual / np.outer(scale, scale)
        return [(a, b, float(r[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]

    return solved(lag_moments(df, keys, columns, order), keys, columns, order, schema, solve)


def _tail(df: DataFrame, keys: Sequence[str], columns: Sequence[str], count: int) -> DataFrame:
    """``keys, tail``: the last ``count`` rows of each series as an array in time order."""
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("t")))
    last = df.select(*keys, "t", *columns, back.alias("_back")).where(F.col("_back") <= count)
    values = F.array(*[F.col(c).cast("double") for c in columns]).alias("v")
    ordered = F.array_sort(F.collect_list(F.struct("t", values)))
    return last.groupBy(*keys).agg(F.transform(ordered, lambda x: x["v"]).alias("tail"))


def var_forecast(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: int, steps: int = 12
) -> DataFrame:
    """``h`` and one forecast column per input column, iterated from the last ``order`` rows."""
    schema = f"{_key_schema(df, keys)}, h int, " + ", ".join(f"{c} double" for c in columns)
    moments = lag_moments(df, keys, columns, order).join(_tail(df, keys, columns, order), list(keys))

    def solve(m: Moments, row) -> list[tuple]:
        beta, _, n = _var_fit(m, columns, order, order)
        recent = [np.array(v) for v in row["tail"]]
        if n < 1 or len(recent) < order:
            return []
        out = []
        for h in range(1, steps + 1):
            z = np.concatenate([[1.0], *[recent[-k] for k in range(1, order + 1)]])
            recent.append(z @ beta)
            out.append((h, *map(float, recent[-1])))
        return out

    return solved(moments, keys, columns, order, schema, solve)


def seasonal_ar_forecast(
    df: DataFrame, keys: Sequence[str], column: str, steps: int = 12, season: int = 12, longest: int = 4
) -> DataFrame:
    """Seasonal autoregression with differencing: ``order, d, aic, h, yhat, yhat_lower, yhat_upper``.

    The series is differenced at the season and, where the unit-root test does not
    reject, once more. Orders 0 … ``longest`` plus the seasonal lag are fitted by
    conditional least squares and compared by AIC. The band is ±1.96 σ √h, the
    growth of a random walk.
    """
    verdict = augmented_dickey_fuller(df, keys, column).select(*keys, "stationary")
    w = in_time(keys)
    seasonal = df.join(verdict, list(keys), "left").select(
        *keys, "t", column, F.when(F.col("stationary"), 0).otherwise(1).alias("_d"),
        (F.col(column) - F.lag(column, season).over(w)).alias("_s"),
    )
    change = F.when(F.col("_d") == 0, F.col("_s")).otherwise(F.col("_s") - F.lag("_s").over(w))
    differenced = seasonal.withColumn("w", change).where(F.col("w").isNotNull())
    moments = lag_moments(differenced, keys, ["w"], season)
    moments = moments.join(_tail(seasonal, keys, [column, "_d"], season + 1), list(keys))
    moments = moments.join(_tail(differenced, keys, ["w"], season).withColumnRenamed("tail", "recent"), list(keys))
    schema = (
        f"{_key_schema(df, keys)}, order int, d int, aic double, h int, "
        "yhat double, yhat_lower double, yhat_upper double"
    )

    def solve(m: Moments, row) -> list[tuple]:
        fits = []
        for p in range(longest + 1):
            lags = [*range(1, p + 1), season]
            beta, residual, _, n = m.fit([m.at("w", 0)], [0, *[m.at("w", k) for k in lags]], season)
            if n > len(lags) + 2 and residual[0, 0] > 0:
                fits.append((log_likelihood_aic(residual[0, 0], n, len(lags) + 2), p, lags, beta[:, 0], residual[0, 0], n))
        if not fits:
            return []
        aic, p, lags, beta, ssr, n = min(fits, key=lambda f: f[:2])
        sigma = math.sqrt(ssr / n)
        levels = [v[0] for v in row["tail"]]
        d = int(row["tail"][-1][1])
        changes = [v[0] for v in row["recent"]]
        if len(levels) <= season or len(changes) < season:
            return []
        out = []
        for h in range(1, steps + 1):
            changes.append(float(beta[0] + sum(b * changes[-k] for b, k in zip(beta[1:], lags))))
            step = changes[-1] + (levels[-1] - levels[-1 - season] if d else 0.0)
            levels.append(levels[-season] + step)
            half = 1.96 * sigma * math.sqrt(h)
            out.append((p, d, float(aic), h, levels[-1], levels[-1] - half, levels[-1] + half))
        return out

    return solved(moments, keys, ["w"], season, schema, solve)


def trend_features(t, n, season: int = 12, harmonics: int = 3) -> list:
    """Scaled time and the harmonics of the season as columns."""
    angle = F.lit(2 * math.pi / season) * t
    waves = [wave(angle * k) for k in range(1, harmonics + 1) for wave in (F.sin, F.cos)]
    return [t / n, *waves]


def regression_coefficients(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str) -> DataFrame:
    """``keys, beta, sigma, n``: least squares of ``target`` on a constant and ``features`` per group."""
    names = [*features, target]
    schema = f"{_key_schema(df, keys)}, beta array<double>, sigma double, n int"

    def solve(m: Moments, _row) -> list[tuple]:
        regressors = [0, *[m.at(f, 0) for f in features]]
        beta, residual, _, n = m.fit([m.at(target, 0)], regressors, 0)
        spare = max(1, n - len(regressors))
        return [(beta[:, 0].tolist(), math.sqrt(max(residual[0, 0], 0.0) / spare), n)]

    return solved(lag_moments(df, keys, names, 0), keys, names, 0, schema, solve)


def linear_prediction(beta: str, features: Sequence[str]):
    """Constant plus weighted features, for coefficients held in an array column."""
    total = F.col(beta)[0]
    for i, f in enumerate(features):
        total = total + F.col(beta)[i + 1] * F.col(f)
    return total


def trend_season_forecast(df: DataFrame, keys: Sequence[str], column: str, ts: str = "ts", steps: int = 12) -> DataFrame:
    """Linear trend plus yearly season: ``h, ts, yhat, yhat_lower, yhat_upper``, negatives set to 0."""
    from ledgerleaf.functions.calendar import future_month_ends

    n = F.count("*").over(Window.partitionBy(*keys))
    sized = df.withColumn("_n", n)
    names = [f"f{i}" for i in range(7)]
    inputs = sized.withColumns(dict(zip(names, trend_features(F.col("t"), F.col("_n")))))
    coefficients = regression_coefficients(inputs, keys, names, column).withColumnRenamed("n", "_n")
    last = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    ahead = future_month_ends(last, list(keys), ts, steps).join(coefficients, list(keys))
    at = F.col("_n") + F.col("h")
    ahead = ahead.withColumns(dict(zip(names, trend_features(at, F.col("_n")))))
    yhat = linear_prediction("beta", names)
    half = 1.959963984540054 * F.col("sigma")
    zero = F.lit(0.0)
    return ahead.select(
        *keys, "h", ts, F.greatest(yhat, zero).alias("yhat"),
        F.greatest(yhat - half, zero).alias("yhat_lower"), F.greatest(yhat + half, zero).alias("yhat_upper"),
    )


def driver_forecast(
    df: DataFrame, keys: Sequence[str], target: str, drivers: Sequence[str], ts: str = "ts", steps: int = 12
) -> DataFrame:
    """Forecast of ``target`` from forecast drivers and fiscal periods: ``h, ts, drivers…, fy, post_period, yhat``.

    Every driver is forecast by trend and season; the forecasts meet on the
    timestamp, get their fiscal columns and enter a regression fitted on history.
    """
    from ledgerleaf.functions.calendar import fiscal_year, post_period

    def with_periods(rows: DataFrame) -> DataFrame:
        flags = {f"period_{p}": (post_period(F.col(ts)) == p).cast("double") for p in range(2, 13)}
        return rows.withColumns(flags)

    features = [*drivers, *[f"period_{p}" for p in range(2, 13)]]
    history = with_periods(df)
    coefficients = regression_coefficients(history, keys, features, target)
    ahead = None
    for driver in drivers:
        one = trend_season_forecast(df, keys, driver, ts, steps).select(*keys, "h", ts, F.col("yhat").alias(driver))
        ahead = one if ahead is None else ahead.join(one, [*keys, "h", ts])
    ahead = with_periods(ahead).join(coefficients, list(keys))
    yhat = F.greatest(linear_prediction("beta", features), F.lit(0.0))
    return ahead.select(
        *keys, "h", ts, *drivers, fiscal_year(F.col(ts)).alias("fy"), post_period(F.col(ts)).alias("post_period"),
        yhat.alias("yhat"),
    )
