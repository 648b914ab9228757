"""Trends with planted changes of slope."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import changepoints
from ledgerleaf.operators.series import with_time_index

KEY = ["series_id"]
N = 120


def planted(breaks, noise, seed, level=1000.0, slope=2.0, season=15.0):
    t = np.arange(1, N + 1)
    y = level + slope * t + season * np.sin(2 * np.pi * t / 12)
    for at, change in breaks:
        y = y + change * np.maximum(t - at, 0)
    return y + np.random.default_rng(seed).normal(0, noise, N)


SERIES = {
    "one": ([(48, -5.0)], 3.0), "two": ([(30, 6.0), (70, -9.0)], 3.0), "none": ([], 3.0), "high": ([(48, -5.0)], 3.0),
}


@pytest.fixture(scope="module")
def frame(spark):
    rows = []
    for i, (name, (breaks, noise)) in enumerate(SERIES.items()):
        y = planted(breaks, noise, i if name != "high" else 0, level=1e9 if name == "high" else 1000.0)
        rows += [(name, j, float(v)) for j, v in enumerate(y)]
    rows += [("falling", j, float(400 - 8 * j)) for j in range(60)] + [("short", j, 1.0) for j in range(5)]
    df = spark.createDataFrame(rows, "series_id STRING, i INT, x DOUBLE")
    df = df.withColumn("ts", F.last_day(F.add_months(F.lit("2010-01-31").cast("date"), F.col("i"))))
    return with_time_index(df, KEY, "ts").cache()


def test_planted_breaks_are_found(frame):
    found = {}
    for r in changepoints.trend_breaks(frame, KEY, "x").collect():
        found.setdefault(r.series_id, []).append((r.t, r.change))
    step = 0.8 * N / 26  # of the grid
    for name, (breaks, _) in SERIES.items():
        got = sorted(found.get(name, []))
        assert len(got) == len(breaks)
        for (t, change), (at, planted_change) in zip(got, breaks):
            assert abs(t - at) <= 1.5 * step and abs(change - planted_change) < 0.15 * abs(planted_change)
    assert "short" not in found


def test_forecasts_follow_the_last_slope(frame):
    out = {}
    for r in changepoints.changepoint_forecast(frame, KEY, "x").orderBy("h").collect():
        out.setdefault(r.series_id, []).append(r)
    t = np.arange(N + 1, N + 13)
    for name, (breaks, _) in SERIES.items():
        level = 1e9 if name == "high" else 1000.0
        want = level + 2 * t + 15 * np.sin(2 * np.pi * t / 12) + sum(c * (t - at) for at, c in breaks)
        got = np.array([r.yhat for r in out[name]])
        assert np.abs(got - want).max() < 15 and out[name][0].breaks == len(breaks)
        half = [r.yhat_upper - r.yhat_lower for r in out[name]]
        assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in out[name])
        # Changes to come widen the band where there were changes; without any the band is the noise.
        assert (half[-1] > 1.1 * half[0]) == bool(breaks) and half[0] < 25
    assert out["none"][0].yhat_upper - out["none"][0].yhat == pytest.approx(1.96 * 3, rel=0.3)
    falling = out["falling"]
    assert all(r.yhat == r.yhat_lower == 0.0 for r in falling)
    assert "short" not in out
    assert [str(r.ts) for r in out["one"][:2]] == ["2020-01-31", "2020-02-29"]


def test_the_same_series_gets_the_same_band(frame):
    rows = [sorted(map(str, changepoints.changepoint_forecast(frame.repartition(n), KEY, "x").collect())) for n in (1, 7)]
    assert rows[0] == rows[1]


def test_descent_solves_the_penalised_problem():
    """With the penalty at zero the refit is ordinary least squares on everything chosen."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 6))
    y = x[:, 0] * 2 + x[:, 4] * 3 + rng.normal(0, 0.1, 200)
    z = np.column_stack([x, y])
    z = z - z.mean(axis=0)
    active, beta, ssr = changepoints.sparse_changes(z.T @ z, [0, 1], [2, 3, 4, 5], 6, 200)
    assert active == [2]
    want, rest, *_ = np.linalg.lstsq(z[:, [0, 1, 4]], z[:, 6], rcond=None)
    assert np.allclose(beta, want) and math.isclose(ssr, rest[0], rel_tol=1e-9)
