import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import forecast, series
from ledgerleaf.operators.series import with_time_index

KEY = ["series_id"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    out = {}
    for name in ("a", "b"):
        t = np.arange(90)
        x = 20 + 0.1 * t + 3 * np.sin(2 * np.pi * t / 12) + rng.normal(0, 0.5, 90).cumsum() * 0.3
        y = 5 + 0.5 * np.roll(x, 1) + rng.normal(0, 0.3, 90)
        out[name] = np.column_stack([x, y])
    return out


@pytest.fixture(scope="module")
def frame(spark, data):
    rows = [(k, i, float(r[0]), float(r[1])) for k, v in data.items() for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "series_id STRING, i INT, x DOUBLE, y DOUBLE")
    df = df.withColumn("ts", F.last_day(F.add_months(F.lit("2015-01-31").cast("date"), F.col("i"))))
    return with_time_index(df, KEY, "ts").cache()


def lags(v, order, start):
    return [v[start - k : len(v) - k] for k in range(1, order + 1)]


def ols(y, columns):
    x = np.column_stack([np.ones(len(y)), *columns])
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    residual = y - x @ beta
    return beta, residual, x


def test_decomposition_adds_up(frame):
    for model in ("additive", "multiplicative"):
        parts = series.decomposed(frame, KEY, "x", model)
        whole = F.col("trend") + F.col("seasonal") + F.col("resid")
        if model == "multiplicative":
            whole = F.col("trend") * F.col("seasonal") * F.col("resid")
        assert parts.where(F.abs(whole - F.col("x")) > 1e-9).count() == 0
        assert parts.where(F.col("trend").isNull()).count() == 2 * 12


def test_difference_and_back(frame):
    first = frame.groupBy(*KEY).agg(F.min_by("x", "t").alias("level"))
    changes = series.difference(frame, KEY, "x", "d").join(first, KEY)
    back = series.undifferenced(changes, KEY, "d", "level", "again")
    assert back.where(F.abs(F.col("again") - F.col("x")) > 1e-9).count() == 0


def test_short_and_gappy_series(spark):
    rows = [("s", "2020-01-31", 1.0), ("s", "2020-04-30", 4.0)]
    df = spark.createDataFrame(rows, "series_id STRING, d STRING, v DOUBLE").withColumn("ts", F.to_date("d"))
    zero = series.densified(df, KEY, "ts", "v").orderBy("ts").collect()
    assert [r.v for r in zero] == [1.0, 0.0, 0.0, 4.0]
    held = series.densified(df, KEY, "ts", "v", fill="previous").orderBy("ts").collect()
    assert [r.v for r in held] == [1.0, 1.0, 1.0, 4.0]
    short = with_time_index(df, KEY, "ts")
    assert forecast.augmented_dickey_fuller(short, KEY, "v").count() == 0
    assert forecast.seasonal_ar_forecast(short, KEY, "v").count() == 0
    assert series.decomposed(short, KEY, "v").where("trend is not null").count() == 0


def test_folds(spark):
    df = with_time_index(spark.range(77).select(F.lit("s").alias("series_id"), F.col("id").alias("ts")), KEY, "ts")
    folds = series.expanding_folds(df, KEY)
    starts = folds.where("part = 'test'").groupBy("fold").agg((F.min("t") - 1).alias("s"), F.count("*").alias("n"))
    assert [(r.s, r.n) for r in starts.orderBy("fold").collect()] == [(s, 12) for s in (17, 29, 41, 53, 65)]


def test_dickey_fuller_against_numpy(frame, data):
    found = {r.series_id: r for r in forecast.augmented_dickey_fuller(frame, KEY, "x", 8).collect()}
    for name, values in data.items():
        x = values[:, 0]
        d = np.diff(x)
        def fit(p, start):
            return ols(d[start:], [x[start : len(x) - 1], *lags(d, p, start)])
        scores = []
        for p in range(9):
            _, residual, design = fit(p, 8)
            n = len(residual)
            scores.append((n * (math.log(2 * math.pi * (residual @ residual) / n) + 1) + 2 * design.shape[1], p))
        lag = min(scores)[1]
        beta, residual, design = fit(lag, lag)
        s2 = residual @ residual / (len(residual) - design.shape[1])
        t = beta[1] / math.sqrt(s2 * np.linalg.inv(design.T @ design)[1, 1])
        assert found[name].lag == lag
        assert found[name].n == len(residual)
        assert math.isclose(found[name].statistic, t, rel_tol=1e-6)
        assert found[name].stationary == (t < found[name].crit_5)


def test_chi_square_tail():
    # Known points of the distribution.
    assert math.isclose(forecast.chi_square_tail(3.841458820694124, 1), 0.05, rel_tol=1e-9)
    assert math.isclose(forecast.chi_square_tail(5.991464547107979, 2), 0.05, rel_tol=1e-9)
    assert math.isclose(forecast.chi_square_tail(11.070497693516351, 5), 0.05, rel_tol=1e-9)
    assert math.isclose(forecast.chi_square_tail(21.02606981748307, 12), 0.05, rel_tol=1e-9)
    assert forecast.chi_square_tail(0.0, 3) == 1.0


def test_granger_against_numpy(frame, data):
    found = {(r.series_id, r.response, r.predictor): r.p_value for r in forecast.granger_matrix(frame, KEY, ["x", "y"], 3).collect()}
    for name, values in data.items():
        for (yn, y), (xn, x) in ((("x", values[:, 0]), ("y", values[:, 1])), (("y", values[:, 1]), ("x", values[:, 0]))):
            best = 1.0
            for lag in range(1, 4):
                _, r, _ = ols(y[lag:], lags(y, lag, lag))
                _, u, _ = ols(y[lag:], lags(y, lag, lag) + lags(x, lag, lag))
                best = min(best, round(forecast.chi_square_tail(len(u) * ((r @ r) - (u @ u)) / (u @ u), lag), 4))
            assert abs(found[name, f"{yn}_y", f"{xn}_x"] - best) <= 1e-4
        assert found[name, "x_y", "x_x"] == 1.0


def test_var_against_numpy(frame, data):
    found = forecast.var_forecast(frame, KEY, ["x", "y"], 2, steps=3).orderBy("series_id", "h").collect()
    orders = {(r.series_id, r.lag): r.aic for r in forecast.var_orders(frame, KEY, ["x", "y"], 4).collect()}
    for name, z in data.items():
        design = np.column_stack([np.ones(len(z) - 2), z[1:-1], z[:-2]])
        beta, *_ = np.linalg.lstsq(design, z[2:], rcond=None)
        recent = list(z[-2:])
        for h in range(3):
            recent.append(np.concatenate([[1], recent[-1], recent[-2]]) @ beta)
        rows = [r for r in found if r.series_id == name]
        assert np.allclose([[r.x, r.y] for r in rows], recent[2:], rtol=1e-5)
        design = np.column_stack([np.ones(len(z) - 4), z[3:-1]])
        beta, *_ = np.linalg.lstsq(design, z[4:], rcond=None)
        e = z[4:] - design @ beta
        aic = np.log(np.linalg.det(e.T @ e / len(e))) + 2 / len(e) * 2 * 3
        assert math.isclose(orders[name, 1], aic, rel_tol=1e-5)


def test_johansen_against_numpy(frame, data):
    found = {(r.series_id, r.rank): r.trace for r in forecast.johansen_trace(frame, KEY, ["x", "y"], 2).collect()}
    for name, z in data.items():
        k, d = 2, np.diff(z, axis=0)
        past = np.column_stack([d[k - i : len(d) - i] for i in range(1, k + 1)])
        past = np.column_stack([np.ones(len(past))[:, None] * 0, past])[:, 1:]
        def residual(v):
            beta, *_ = np.linalg.lstsq(past, v, rcond=None)
            return v - past @ beta
        r0, rk = residual(d[k:]), residual(z[: len(z) - k][1:])
        n = len(r0)
        s00, s0k, skk = r0.T @ r0 / n, r0.T @ rk / n, rk.T @ rk / n
        roots = np.sort(np.linalg.eigvals(np.linalg.inv(skk) @ s0k.T @ np.linalg.inv(s00) @ s0k).real)[::-1]
        for rank in range(2):
            assert math.isclose(found[name, rank], -n * np.log(1 - roots[rank:]).sum(), rel_tol=1e-4)


def test_johansen_with_a_column_that_never_changes(spark):
    rng = np.random.default_rng(5)
    walk = np.cumsum(rng.normal(size=(90, 2)), axis=0) + [40.0, 900.0]
    rows = [("s", i + 1, float(a), float(b), 25.0, 3.0) for i, (a, b) in enumerate(walk)]
    df = spark.createDataFrame(rows, "series_id STRING, t INT, x DOUBLE, y DOUBLE, same DOUBLE, other DOUBLE")
    found = forecast.johansen_trace(df, KEY, ["x", "y", "same"], 2).orderBy("rank").collect()
    z, d = np.column_stack([walk, np.full(90, 25.0)]), np.diff(walk, axis=0)
    past = np.column_stack([d[1:-1], d[:-2]])
    r0, rk = (v - past @ np.linalg.lstsq(past, v, rcond=None)[0] for v in (d[2:], z[1:-2]))
    roots = np.linalg.eigvals(np.linalg.solve(rk.T @ rk, rk.T @ r0 @ np.linalg.solve(r0.T @ r0, r0.T @ rk))).real
    roots = np.sort(np.clip(roots, 0, 1))[::-1]
    assert [r["rank"] for r in found] == [0, 1, 2]
    for r in found:
        assert math.isclose(r.trace, -len(r0) * np.log(1 - roots[r["rank"]:]).sum(), rel_tol=1e-5, abs_tol=1e-6)
    assert len(forecast.johansen_trace(df, KEY, ["same", "x", "other"], 2).collect()) == 3
    assert [r.trace for r in forecast.johansen_trace(df, KEY, ["same", "other"], 2).collect()] == [0.0, 0.0]


def test_trend_forecast_against_numpy(frame, data):
    found = forecast.trend_season_forecast(frame, KEY, "x").orderBy("series_id", "h").collect()
    t = np.arange(1, 103)
    features = [t / 90, *[w(2 * np.pi * k * t / 12) for k in (1, 2, 3) for w in (np.sin, np.cos)]]
    design = np.column_stack([np.ones(len(t)), *features])
    for name, z in data.items():
        beta, *_ = np.linalg.lstsq(design[:90], z[:, 0], rcond=None)
        rows = [r for r in found if r.series_id == name]
        assert np.allclose([r.yhat for r in rows], design[90:] @ beta, rtol=1e-6)
        assert all(r.yhat_lower < r.yhat < r.yhat_upper for r in rows)


def test_negative_forecasts_are_clipped(spark):
    rows = [("s", i, float(30 - i)) for i in range(36)]
    df = spark.createDataFrame(rows, "series_id STRING, i INT, x DOUBLE")
    df = with_time_index(df.withColumn("ts", F.last_day(F.add_months(F.lit("2018-01-31").cast("date"), F.col("i")))), KEY, "ts")
    assert forecast.trend_season_forecast(df, KEY, "x").where("yhat <> 0 or yhat_lower <> 0").count() == 0


def test_seasonal_ar_repeats_a_pure_season(spark):
    rows = [("s", i, float(10 + (i % 12) + 0.01 * ((i * 7919) % 13))) for i in range(72)]
    df = with_time_index(spark.createDataFrame(rows, "series_id STRING, ts INT, x DOUBLE"), KEY, "ts")
    found = forecast.seasonal_ar_forecast(df, KEY, "x").orderBy("h").collect()
    assert len(found) == 12
    assert all(abs(r.yhat - (10 + (72 + r.h - 1) % 12)) < 0.5 for r in found)
    assert all(b.yhat_upper - b.yhat > a.yhat_upper - a.yhat for a, b in zip(found, found[1:]))


def test_constant_series(spark):
    rows = [("s", i, 5.0) for i in range(40)]
    df = with_time_index(spark.createDataFrame(rows, "series_id STRING, ts INT, x DOUBLE"), KEY, "ts")
    assert series.autocorrelation(df, KEY, "x", 3).where("acf is not null").count() == 0
    assert forecast.augmented_dickey_fuller(df, KEY, "x", 4).where("stationary").count() == 0
    assert forecast.dickey_fuller(df, KEY, "x").first()["statistic"] is None
    assert series.durbin_watson(df.withColumn("e", F.lit(0.0)), KEY, "e").first()["dw"] is None
    zero = df.withColumn("x", F.lit(0.0))
    assert series.decomposed(zero, KEY, "x", "multiplicative").where("resid is not null").count() == 0
    assert series.accuracy(df, KEY, "x", "x").first()["mae"] == 0.0


def test_regressions_do_not_depend_on_the_unit():
    """Slopes, residuals and standard errors follow numpy's QR at any level and scale."""
    import numpy as np

    from ledgerleaf.operators.leastsq import Moments

    rng = np.random.default_rng(0)
    x, e = np.cumsum(rng.normal(0, 250, 120)), rng.normal(0, 30, 120)
    for scale in (1e-3, 1.0, 1e3, 1e6):
        for level in (0.0, 1e6):
            a, b = scale * (x + level), 0.5 * scale * x + scale * e + 7
            z = np.stack([np.ones(120), a, b], axis=1)
            upper = np.triu_indices(3)
            cells = [{"i": i, "v": v} for i, v in enumerate((z.T @ z)[upper])]
            beta, residual, inverse, n = Moments(["a", "b"], 0, [{"bucket": 0, "n": 120}], cells).fit([2], [0, 1], 0)
            q, r = np.linalg.qr(np.stack([np.ones(120), (a - a.mean()) / scale], axis=1))
            slope = np.linalg.solve(r, q.T @ b)[1] / scale
            error = b - b.mean() - slope * (a - a.mean())
            assert n == 120 and abs(beta[1, 0] / slope - 1) < 1e-5
            assert abs(residual[0, 0] / (error @ error) - 1) < 1e-5
            t = beta[1, 0] / np.sqrt(residual[0, 0] / 118 * inverse[1, 1])
            spread = ((a - a.mean()) ** 2).sum()
            assert abs(t / (slope / np.sqrt(error @ error / 118 / spread)) - 1) < 1e-5
