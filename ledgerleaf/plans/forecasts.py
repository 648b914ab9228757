"""Tests and forecasts that need small matrix solves; unit tests cross-check them with numpy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerleaf.operators import arima, changepoints, forecast, series
from ledgerleaf.plans.derived import monthly_series
from ledgerleaf.plans.registry import query
from ledgerleaf.plans.series import KEY

VARIABLES = ["amount", "n_requests", "n_orgs"]


def stationary(t):
    """Log growth of amounts and requests per series."""
    monthly = monthly_series(t).withColumn("amount", F.ln("amount")).withColumn("n_requests", F.ln("n_requests"))
    first = series.difference(monthly, KEY, "amount", "d_amount")
    w = series.in_time(KEY)
    both = monthly.withColumn("d_requests", F.col("n_requests") - F.lag("n_requests").over(w))
    return first.select("series_id", "t", "d_amount").join(both.select("series_id", "t", "d_requests"), ["series_id", "t"])


@query("z05_augmented_dickey_fuller")
def _(t):
    return forecast.augmented_dickey_fuller(monthly_series(t), KEY, "amount")


@query("z07_granger_matrix")
def _(t):
    return forecast.granger_matrix(monthly_series(t), KEY, VARIABLES)


@query("z08_johansen_trace")
def _(t):
    return forecast.johansen_trace(monthly_series(t), KEY, VARIABLES)


@query("z09_var_order_selection")
def _(t):
    return forecast.var_orders(stationary(t), KEY, ["d_amount", "d_requests"])


@query("z09_var_residual_correlation")
def _(t):
    return forecast.var_residual_correlation(stationary(t), KEY, ["d_amount", "d_requests"], 11)


@query("z09_var_forecast")
def _(t):
    return forecast.var_forecast(stationary(t), KEY, ["d_amount", "d_requests"], 11)


@query("z12_seasonal_ar_forecast")
def _(t):
    return forecast.seasonal_ar_forecast(monthly_series(t), KEY, "amount")


@query("z12_seasonal_arima")
def _(t):
    """Orders found by tests and a stepwise search, moving averages included."""
    return arima.seasonal_arima_forecast(monthly_series(t), KEY, "amount")


@query("z13_changepoint_forecast")
def _(t):
    """A trend whose slope may change, the season, and a band of simulated changes to come."""
    return changepoints.changepoint_forecast(monthly_series(t), KEY, "amount")


@query("z13_trend_season_forecast")
def _(t):
    return forecast.trend_season_forecast(monthly_series(t), KEY, "amount")


@query("z18_driver_forecast")
def _(t):
    return forecast.driver_forecast(monthly_series(t), KEY, "amount", ["n_requests", "n_orgs"])
