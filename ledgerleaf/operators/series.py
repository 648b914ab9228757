"""Operators on monthly series ``(keys…, ts, value…)``.

Every window is partitioned by the series key and sees one row per period, so a
partition is bounded by the length of the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_time(keys: Sequence[str], order: str = "t"):
    return Window.partitionBy(*keys).orderBy(order)


def with_time_index(df: DataFrame, keys: Sequence[str], ts: str, name: str = "t") -> DataFrame:
    return df.withColumn(name, F.row_number().over(in_time(keys, ts)))


def difference(df: DataFrame, keys: Sequence[str], column: str, name: str, lag: int = 1) -> DataFrame:
    """``x_t − x_{t−lag}``; the first rows, which have no predecessor, are dropped."""
    changed = df.withColumn(name, F.col(column) - F.lag(column, lag).over(in_time(keys)))
    return changed.where(F.col(name).isNotNull())


def centred_average(column: str, keys: Sequence[str], period: int = 12) -> Column:
    """Centred moving average over an even period: half weights at both ends, null near the borders."""
    half = period // 2
    w = in_time(keys)
    inner = w.rowsBetween(-(half - 1), half - 1)
    ends = F.lag(column, half).over(w) + F.lead(column, half).over(w)
    return (F.sum(column).over(inner) + 0.5 * ends) / period


def decomposed(
    df: DataFrame, keys: Sequence[str], column: str, model: str = "additive", period: int = 12, position: str = "t"
) -> DataFrame:
    """Adds ``trend``, ``seasonal`` and ``resid``.

    ``position`` numbers the rows in time; pass a calendar month index instead of
    the row number to make the season follow the calendar when months are missing.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError(model)
    additive = model == "additive"
    x = F.col(column)
    trend = df.withColumn("trend", centred_average(column, keys, period))
    trend = trend.withColumn("_detrended", x - F.col("trend") if additive else F.try_divide(x, F.col("trend")))
    trend = trend.withColumn("_season", F.pmod(F.col(position), F.lit(period)))
    series = Window.partitionBy(*keys)
    means = trend.groupBy(*keys, "_season").agg(F.avg("_detrended").alias("_mean"))
    level = F.avg("_mean").over(series)
    means = means.select(
        *keys, "_season", (F.col("_mean") - level if additive else F.try_divide("_mean", level)).alias("seasonal")
    )
    joined = trend.join(means, [*keys, "_season"])
    rest = x - F.col("trend") - F.col("seasonal") if additive else F.try_divide(x, F.col("trend") * F.col("seasonal"))
    return joined.withColumn("resid", rest).drop("_detrended", "_season")


def autocorrelation(df: DataFrame, keys: Sequence[str], column: str, lags: int) -> DataFrame:
    """``lag, acf, band``: autocorrelations with Bartlett's 95 % half width; null for a constant series."""
    series = Window.partitionBy(*keys)
    centred = df.select(
        *keys, "t", (F.col(column) - F.avg(column).over(series)).alias("d"), F.count(column).over(series).alias("n")
    )
    shifted = centred.select(
        *keys, "d", "n", *[F.lag("d", k).over(in_time(keys)).alias(f"d{k}") for k in range(1, lags + 1)]
    )
    products = [F.sum(F.col("d") * F.col("d" if k == 0 else f"d{k}")) for k in range(lags + 1)]
    sums = shifted.groupBy(*keys).agg(F.max("n").alias("n"), F.array(*products).alias("c"))
    ratios = sums.select(*keys, "n", F.transform("c", lambda v: F.try_divide(v, F.col("c")[0])).alias("r"))
    rows = ratios.select(*keys, "n", F.posexplode("r").alias("lag", "acf"))
    before = Window.partitionBy(*keys).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    squares = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(before), F.lit(0.0))
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(1.959963984540054 * F.sqrt((1 + 2 * squares) / F.col("n")))
    return rows.select(*keys, "lag", "acf", band.alias("band"))


def lag_columns(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: int) -> DataFrame:
    """Adds ``<column>_l<k>`` for k = 1 … order; rows without all lags stay, with nulls."""
    w = in_time(keys)
    lagged = {f"{c}_l{k}": F.lag(c, k).over(w) for c in columns for k in range(1, order + 1)}
    return df.withColumns(lagged)


def durbin_watson(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    known = df.where(F.col(column).isNotNull())
    step = F.col(column) - F.lag(column).over(in_time(keys))
    steps = known.withColumn("_step", step)
    return steps.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("_step") * F.col("_step")), F.sum(F.col(column) * F.col(column))).alias("dw")
    )


def undifferenced(df: DataFrame, keys: Sequence[str], column: str, last_level: str, name: str) -> DataFrame:
    """Levels from a last level and the cumulative sum of changes."""
    so_far = in_time(keys).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.col(last_level) + F.sum(column).over(so_far))


def last_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The latest row's values per series."""
    return df.groupBy(*keys).agg(*[F.max_by(c, "t").alias(c) for c in columns])


def split_last(df: DataFrame, keys: Sequence[str], test_size: int = 12) -> DataFrame:
    """Adds ``part``: the last ``test_size`` rows of a series are ``test``, the rest ``train``."""
    from_end = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("t")))
    return df.withColumn("part", F.when(from_end <= test_size, "test").otherwise("train"))


def expanding_folds(df: DataFrame, keys: Sequence[str], folds: int = 5) -> DataFrame:
    """Rows of each expanding-window fold: ``fold`` and ``part`` train/test."""
    n = F.count("*").over(Window.partitionBy(*keys))
    size = F.floor(n / (folds + 1))
    every = F.explode(F.sequence(F.lit(1), F.lit(folds))).alias("fold")
    spread = df.withColumns({"_n": n, "_size": size}).select("*", every)
    first_test = F.col("_n") - (folds - F.col("fold") + 1) * F.col("_size")
    part = F.when(F.col("t") <= first_test, "train").when(F.col("t") <= first_test + F.col("_size"), "test")
    return spread.withColumn("part", part).where(F.col("part").isNotNull()).drop("_n", "_size")


def densified(df: DataFrame, keys: Sequence[str], ts: str, column: str, fill: str = "zero") -> DataFrame:
    """A row per calendar month between each series' first and last; gaps get 0 or the previous value."""
    span = df.groupBy(*keys).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    months = F.expr("sequence(trunc(_a, 'MM'), trunc(_b, 'MM'), interval 1 month)")
    calendar = span.select(*keys, F.explode(months).alias("_m")).select(*keys, F.last_day("_m").alias(ts))
    joined = calendar.join(df.select(*keys, ts, column), [*keys, ts], "left")
    if fill == "zero":
        return joined.withColumn(column, F.coalesce(F.col(column), F.lit(0.0)))
    known = in_time(keys, ts).rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn(column, F.last(column, ignorenulls=True).over(known))


def seasonal_naive(df: DataFrame, keys: Sequence[str], column: str, period: int = 12) -> DataFrame:
    """Forecast of the next ``period`` rows by the value one period earlier: ``h, yhat``."""
    from_end = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("t")))
    last = df.select(*keys, F.col(column).alias("yhat"), from_end.alias("_back")).where(F.col("_back") <= period)
    return last.select(*keys, (F.lit(period + 1) - F.col("_back")).alias("h"), "yhat")


def drift(df: DataFrame, keys: Sequence[str], column: str, horizon: int = 12) -> DataFrame:
    """Forecast along the line through the first and last value: ``h, yhat``."""
    ends = df.groupBy(*keys).agg(
        F.min_by(column, "t").alias("_first"), F.max_by(column, "t").alias("_last"), F.count("*").alias("_n")
    )
    ahead = ends.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    slope = F.coalesce(F.try_divide(F.col("_last") - F.col("_first"), F.col("_n") - 1), F.lit(0.0))
    return ahead.select(*keys, "h", (F.col("_last") + F.col("h") * slope).alias("yhat"))


def accuracy(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """MAE, MSE, RMSE and R² per group."""
    error = F.col(actual) - F.col(predicted)
    mse = F.avg(error * error)
    total = F.var_pop(actual)
    return df.groupBy(*keys).agg(
        F.avg(F.abs(error)).alias("mae"), mse.alias("mse"), F.sqrt(mse).alias("rmse"), (1 - F.try_divide(mse, total)).alias("r2")
    )
