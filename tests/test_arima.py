"""Seasonal ARIMA against exact maximum likelihood, and moments at high levels."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import arima, forecast
from ledgerleaf.operators.series import with_time_index

KEY = ["series_id"]
SEASON = 4


def exact_likelihood(x, weights):
    """Minus twice the log likelihood of a moving average with the given impulse weights, its variance profiled out."""
    n = len(x)
    covariance = np.array([weights[: len(weights) - k] @ weights[k:] if k < len(weights) else 0.0 for k in range(n)])
    lower = np.linalg.cholesky(covariance[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))])
    z = np.linalg.solve(lower, x)
    return n * math.log(z @ z / n) + 2 * np.log(np.diag(lower)).sum()


def most_likely(x, ma, sma):
    """Coefficients of a (seasonal) moving average by a narrowing grid."""
    best, width = np.zeros(2), 0.9
    axes = [ma, sma]
    while width > 0.002:
        around = [np.clip(best[i] + width * np.linspace(-1, 1, 7), -0.98, 0.98) if axes[i] else [0.0] for i in range(2)]
        tried = [(exact_likelihood(x, np.convolve([1, a], np.r_[1, np.zeros(SEASON - 1), b])), a, b) for a in around[0] for b in around[1]]
        best = np.array(min(tried)[1:])
        width /= 2.5
    return best


def simulated(seed, n, ma=0.0, sma=0.0, ar=0.0):
    e = np.random.default_rng(seed).normal(size=n + 100)
    w = np.convolve(e, np.convolve([1, ma], np.r_[1, np.zeros(SEASON - 1), sma]))[: n + 100]
    for t in range(1, len(w)):
        w[t] += ar * w[t - 1]
    return w[100:]


def frame_of(spark, series):
    rows = [(k, i, float(v)) for k, x in series.items() for i, v in enumerate(x)]
    return with_time_index(spark.createDataFrame(rows, "series_id STRING, ts INT, x DOUBLE"), KEY, "ts")


@pytest.fixture(scope="module")
def series():
    return {
        "ma": 50 + simulated(3, 260, ma=0.6), "sma": simulated(2, 260, ma=0.5, sma=0.5), "ar": 1e9 + simulated(3, 260, ar=0.7),
        "walk": np.cumsum(simulated(6, 260, ma=-0.4)),
    }


@pytest.fixture(scope="module")
def models(spark, series):
    rows, found = arima.seasonal_arima_models(frame_of(spark, series), KEY, "x", SEASON, longest=3, seasonal=1)
    return {r.series_id: r for r in found.collect()}, rows.cache()


def test_orders_and_coefficients_follow_maximum_likelihood(models, series):
    found, _ = models
    assert {k: (tuple(m.orders), m.d, m.sd) for k, m in found.items()} == {
        "ma": ((0, 1, 0, 0), 0, 0), "sma": ((0, 1, 0, 1), 0, 0), "ar": ((1, 0, 0, 0), 0, 0), "walk": ((0, 1, 0, 0), 1, 0),
    }
    for name, seasonal in (("ma", False), ("sma", True)):
        x = series[name] - series[name].mean()
        want = most_likely(x, True, seasonal)
        assert np.allclose(found[name].terms, want[: 1 + seasonal], atol=0.02)
    x = series["ar"] - series["ar"].mean()
    assert abs(found["ar"].terms[0] - x[1:] @ x[:-1] / (x[:-1] @ x[:-1])) < 0.01
    assert np.allclose(found["walk"].terms, most_likely(np.diff(series["walk"]), True, False)[:1], atol=0.03)


def test_innovations_are_what_the_model_leaves(models, series):
    found, rows = models
    e = np.array([r.e for r in rows.where("series_id = 'ma'").orderBy("t").collect()])
    theta = found["ma"].terms[0]
    x = series["ma"] - series["ma"].mean()
    want = np.zeros(len(x))
    for t in range(len(x)):
        want[t] = x[t] - (theta * want[t - 1] if t else 0.0)
    assert np.allclose(e, want, atol=1e-6)


def test_gradient_of_the_innovations(spark):
    """A Gauss-Newton step of the refinement equals one with numerical derivatives."""
    x = simulated(7, 120, ma=0.4, sma=0.3, ar=0.5)
    x = x - x.mean()
    orders, values = arima.Orders(1, 1, 1, 1), np.array([0.3, 0.2, 0.1, 0.15])

    def innovations(v):
        ar, ma, sar, sma = arima.Terms(orders, SEASON, v).polynomials()
        weights = arima.power_series(np.convolve(ar, sar), np.convolve(ma, sma), len(x))
        return np.array([weights[: t + 1] @ x[t::-1] for t in range(len(x))])

    e = innovations(values)
    slopes = np.array([(innovations(values + d) - innovations(values - d)) / 2e-6 for d in 1e-6 * np.eye(4)])
    want = values - np.linalg.solve(slopes @ slopes.T, slopes @ e)
    rows = frame_of(spark, {"s": x}).select("series_id", "t", "x")
    model = arima.model_row(orders, arima.Terms(orders, SEASON, values), 0.0, 121)
    models = spark.createDataFrame([("s", *model)], f"series_id STRING, {arima.MODEL}")
    got = arima.refined(rows, models, KEY, SEASON, 2, 1, 121).first()
    assert np.allclose(got.terms, want, atol=1e-5)
    assert got.aic == pytest.approx(arima.log_likelihood_aic(e @ e, len(x), 5), rel=1e-9)


def test_forecasts_and_bands(spark, series):
    found = arima.seasonal_arima_forecast(frame_of(spark, series), KEY, "x", 6, SEASON, longest=3, seasonal=1).orderBy("h").collect()
    by = {k: [r for r in found if r.series_id == k] for k in series}
    assert all(len(r) == 6 for r in by.values())
    ma = by["ma"]
    assert abs(ma[0].yhat - 50) < 3 and all(abs(r.yhat - series["ma"].mean()) < 1e-6 for r in ma[1:])
    half = [r.yhat_upper - r.yhat for r in ma]
    assert half[1] == pytest.approx(half[5]) and half[1] / half[0] == pytest.approx(math.hypot(1, 0.6), abs=0.05)
    walk = [r.yhat_upper - r.yhat for r in by["walk"]]
    assert all(b > a for a, b in zip(walk, walk[1:]))
    ar = by["ar"]
    assert abs(ar[5].yhat - 1e9) < 3


def test_a_pure_season_repeats_and_short_series_have_no_model(spark):
    x = [10 + (i % 12) + 0.01 * ((i * 7919) % 13) for i in range(72)]
    df = frame_of(spark, {"s": x, "short": [1.0, 2.0, 3.0], "constant": [5.0] * 40})
    found = arima.seasonal_arima_forecast(df, KEY, "x").orderBy("h").collect()
    season = [r for r in found if r.series_id == "s"]
    assert season[0].sd == 1 and len(season) == 12
    assert all(abs(r.yhat - (10 + (72 + r.h - 1) % 12)) < 0.5 for r in season)
    assert not [r for r in found if r.series_id == "short"]
    assert all(r.yhat == pytest.approx(5.0) for r in found if r.series_id == "constant")


@pytest.mark.parametrize("level", [1e9, 1e12])
def test_tests_and_forecasts_do_not_depend_on_the_level(spark, level):
    """Whole numbers, so that the level itself costs no digits."""
    rng = np.random.default_rng(11)
    a = np.round(1000 * rng.normal(size=120))
    b = np.round(np.cumsum(800 * rng.normal(size=120)))

    def found(add):
        rows = [("s", i, float(p + add), float(q + add)) for i, (p, q) in enumerate(zip(a, b))]
        df = spark.createDataFrame(rows, "series_id STRING, i INT, a DOUBLE, b DOUBLE")
        df = df.withColumn("ts", F.last_day(F.add_months(F.lit("2015-01-31").cast("date"), F.col("i"))))
        df = with_time_index(df, KEY, "ts").cache()
        one = lambda out, *names: np.array([[float(r[n]) for n in names] for r in out.collect()])
        dependent = [
            one(forecast.augmented_dickey_fuller(df, KEY, "a"), "statistic", "lag", "stationary"),
            one(forecast.augmented_dickey_fuller(df, KEY, "b"), "statistic", "lag", "stationary"),
            one(forecast.granger_matrix(df, KEY, ["a", "b"], 4).orderBy("response", "predictor"), "p_value"),
            one(forecast.johansen_trace(df, KEY, ["a", "b"], 2, origin="first").orderBy("rank"), "trace"),
            one(forecast.var_orders(df, KEY, ["a", "b"], 4).orderBy("lag"), "aic", "bic", "hqic"),
        ]
        levels = [
            one(forecast.var_forecast(df, KEY, ["a", "b"], 2).orderBy("h"), "a", "b"),
            one(forecast.trend_season_forecast(df, KEY, "a").orderBy("h"), "yhat"),
            one(forecast.driver_forecast(df, KEY, "a", ["b"]).orderBy("h"), "yhat"),
        ]
        return dependent, levels

    (tests, forecasts), (moved, ahead) = found(1e6), found(level)
    for x, y in zip(tests, moved):
        assert np.allclose(x, y, rtol=1e-6, atol=1e-6)
    for x, y in zip(forecasts, ahead):
        assert np.allclose(x - 1e6, y - level, rtol=1e-5, atol=max(1e-3, 1e-14 * level))


@pytest.mark.parametrize("level", [0.0, 1e6, 1e9])
def test_johansen_on_levels_as_they_stand(spark, level):
    """Against numpy in extended precision, at levels that would use up the digits of plain products."""
    rng = np.random.default_rng(5)
    z = np.round(np.cumsum(800 * rng.normal(size=(150, 2)), axis=0)) + level * np.array([1, 3])
    rows = [("s", i, float(p), float(q)) for i, (p, q) in enumerate(z)]
    df = with_time_index(spark.createDataFrame(rows, "series_id STRING, ts INT, a DOUBLE, b DOUBLE"), KEY, "ts")
    got = [r.trace for r in forecast.johansen_trace(df, KEY, ["a", "b"], 2).orderBy("rank").collect()]
    k, d = 2, np.diff(z, axis=0)
    past = np.column_stack([d[k - i : len(d) - i] for i in range(1, k + 1)])
    q, _ = np.linalg.qr(past)
    # The levels' span is what counts: an orthogonal basis of the same span keeps all digits.
    start = z[0] if level else np.ones(2)
    level_rows = z[: len(z) - k][1:]
    span = np.column_stack([level_rows[:, 0] / abs(start[0]), (level_rows[:, 1] - 3 * level) - 3 * (level_rows[:, 0] - level)])
    if not level:
        span = level_rows
    r0, rk = (v - q @ (q.T @ v) for v in (d[k:], span / np.abs(span).max(axis=0)))
    q0, _ = np.linalg.qr(r0)
    qk, _ = np.linalg.qr(rk)
    roots = np.linalg.svd(q0.T @ qk, compute_uv=False) ** 2
    want = [-len(r0) * np.log(1 - roots[i:]).sum() for i in range(2)]
    assert np.allclose(got, want, rtol=1e-5)
