"""Time-series statistics with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerleaf.operators import forecast, series
from ledgerleaf.plans.derived import SQL_MONTHLY, monthly_series
from ledgerleaf.plans.registry import query
from ledgerleaf.plans.relational import SQL_TREND

KEY = ["series_id"]
BY_TIME = "(PARTITION BY series_id ORDER BY t)"


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "z01_monthly_facts",
    f"WITH {SQL_MONTHLY} SELECT series_id, ts, amount, n_requests, n_orgs, t FROM monthly",
)
def _(t):
    return monthly_series(t)


def sql_decomposed(additive: bool, position: str = "t") -> str:
    ratio = "amount - trend" if additive else "amount / trend"
    centred = "m - AVG(m) OVER (PARTITION BY series_id)" if additive else "m / AVG(m) OVER (PARTITION BY series_id)"
    resid = "amount - trend - seasonal" if additive else "amount / (trend * seasonal)"
    return f"""{SQL_MONTHLY}, tr AS (SELECT *, {position} % 12 AS pos, {SQL_TREND} AS trend FROM monthly),
      de AS (SELECT series_id, pos, AVG({ratio}) AS m FROM tr GROUP BY series_id, pos),
      se AS (SELECT series_id, pos, {centred} AS seasonal FROM de),
      dec AS (SELECT series_id, ts, t, amount, trend, seasonal, {resid} AS resid FROM tr JOIN se USING (series_id, pos))"""


PARTS = "round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, round(resid, 6) AS resid"


def _decomposition(name, model, position="t"):
    @query(name, f"WITH {sql_decomposed(model == 'additive', 'month(ts)' if position == 'month' else 't')} "
                 f"SELECT series_id, ts, {PARTS} FROM dec")
    def _(t):
        monthly = monthly_series(t).withColumn("month", F.month("ts"))
        parts = series.decomposed(monthly, KEY, "amount", model, position=position)
        return rounded(parts.select("series_id", "ts", "trend", "seasonal", "resid"), "trend", "seasonal", "resid")


_decomposition("z02_additive_decomposition", "additive")
_decomposition("z02_calendar_decomposition", "additive", position="month")
_decomposition("z03_multiplicative_decomposition", "multiplicative")


@query(
    "z04_autocorrelation",
    f"""WITH {SQL_MONTHLY}, c AS (SELECT series_id, t, amount - AVG(amount) OVER (PARTITION BY series_id) AS d,
                                         COUNT(*) OVER (PARTITION BY series_id) AS n FROM monthly),
        s AS (SELECT series_id, MAX(n) AS n, SUM(d * d) AS s0 FROM c GROUP BY series_id),
        k AS (SELECT CAST(range AS INTEGER) AS lag FROM range(13)),
        p AS (SELECT a.series_id, k.lag, SUM(a.d * b.d) AS sk FROM k JOIN c a ON true
              JOIN c b ON a.series_id = b.series_id AND a.t = b.t + k.lag GROUP BY ALL),
        r AS (SELECT series_id, lag, sk / s0 AS acf, n FROM p JOIN s USING (series_id))
        SELECT series_id, lag, round(acf, 6) AS acf, CASE WHEN lag = 0 THEN 0 ELSE
          round(1.959963984540054 * sqrt((1 + 2 * COALESCE(SUM(CASE WHEN lag > 0 THEN acf * acf END) OVER (
            PARTITION BY series_id ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n), 6) END AS band
        FROM r""",
)
def _(t):
    return rounded(series.autocorrelation(monthly_series(t), KEY, "amount", 12), "acf", "band")


@query(
    "z05_dickey_fuller",
    f"""WITH {SQL_MONTHLY}, d AS (SELECT series_id, amount - LAG(amount) OVER {BY_TIME} AS y,
                                         LAG(amount) OVER {BY_TIME} AS x FROM monthly),
        f AS (SELECT series_id, regr_slope(y, x) AS slope, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy,
                     regr_sxy(y, x) AS sxy, COUNT(*) AS n FROM d WHERE x IS NOT NULL GROUP BY series_id)
        SELECT series_id, round(slope, 6) AS slope,
               round(slope / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx), 6) AS statistic, n FROM f""",
)
def _(t):
    return rounded(forecast.dickey_fuller(monthly_series(t), KEY, "amount"), "slope", "statistic")


@query(
    "z06_stationary_transforms",
    f"""WITH {SQL_MONTHLY}, a AS (SELECT series_id, ts, ln(amount) AS log_amount,
          ln(amount) - LAG(ln(amount)) OVER {BY_TIME} AS growth,
          n_requests - LAG(n_requests) OVER {BY_TIME} AS new_requests FROM monthly)
        SELECT series_id, ts, round(log_amount, 6) AS log_amount, round(growth, 6) AS growth, new_requests
        FROM a WHERE growth IS NOT NULL""",
)
def _(t):
    logged = monthly_series(t).withColumn("log_amount", F.ln("amount"))
    growth = series.difference(logged, KEY, "log_amount", "growth").select("series_id", "ts", "log_amount", "growth")
    requests = series.difference(logged, KEY, "n_requests", "new_requests").select("series_id", "ts", "new_requests")
    both = growth.join(requests, ["series_id", "ts"], "full").dropna()
    return rounded(both, "log_amount", "growth")


@query(
    "z10_durbin_watson",
    f"""WITH {sql_decomposed(True)}, r AS (SELECT * FROM dec WHERE resid IS NOT NULL),
        s AS (SELECT series_id, resid, resid - LAG(resid) OVER {BY_TIME} AS d FROM r)
        SELECT series_id, round(SUM(d * d) / SUM(resid * resid), 6) AS dw FROM s GROUP BY series_id""",
)
def _(t):
    parts = series.decomposed(monthly_series(t), KEY, "amount")
    return rounded(series.durbin_watson(parts, KEY, "resid"), "dw")


@query(
    "z11_inverted_transforms",
    f"""WITH {SQL_MONTHLY} SELECT series_id, ts, round(amount, 8) AS amount FROM monthly WHERE t > 1""",
)
def _(t):
    """Logs, differences, cumulative sums and exponentials lead back to the series."""
    logged = monthly_series(t).withColumn("x", F.ln("amount"))
    first = logged.groupBy("series_id").agg(F.min_by("x", "t").alias("level"))
    changes = series.difference(logged, KEY, "x", "dx").join(first, "series_id")
    levels = series.undifferenced(changes, KEY, "dx", "level", "restored")
    return levels.select("series_id", "ts", F.round(F.exp("restored"), 8).alias("amount"))


@query(
    "z14_seasonal_naive_forecast",
    f"""WITH {SQL_MONTHLY}, b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY t DESC) AS back FROM monthly)
        SELECT series_id, CAST(13 - back AS INTEGER) AS h, round(amount, 8) AS yhat FROM b WHERE back <= 12""",
)
def _(t):
    return rounded(series.seasonal_naive(monthly_series(t), KEY, "amount"), "yhat", digits=8)


@query(
    "z14_drift_forecast",
    f"""WITH {SQL_MONTHLY}, e AS (SELECT series_id, arg_min(amount, t) AS a, arg_max(amount, t) AS b, COUNT(*) AS n
                                  FROM monthly GROUP BY series_id)
        SELECT series_id, CAST(h AS INTEGER) AS h, round(b + h * (b - a) / (n - 1), 6) AS yhat
        FROM e, generate_series(1, 12) AS g(h)""",
)
def _(t):
    return rounded(series.drift(monthly_series(t), KEY, "amount"), "yhat")


SQL_SPLIT = f"""{SQL_MONTHLY}, split AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (
    PARTITION BY series_id ORDER BY t DESC) <= 12 THEN 'test' ELSE 'train' END AS part FROM monthly)"""


@query("z15_time_split", f"WITH {SQL_SPLIT} SELECT series_id, ts, part FROM split")
def _(t):
    return series.split_last(monthly_series(t), KEY).select("series_id", "ts", "part")


SQL_NAIVE = f"""{SQL_MONTHLY}, pred AS (SELECT series_id, t, amount AS actual, LAG(amount, 12) OVER {BY_TIME} AS naive,
     LAG(amount) OVER {BY_TIME} AS last FROM monthly)"""


def sql_accuracy(predicted: str, model: str = "") -> str:
    label = f"'{model}' AS model, " if model else ""
    return f"""SELECT {label}series_id, round(AVG(abs(actual - {predicted})), 6) AS mae,
      round(AVG((actual - {predicted}) * (actual - {predicted})), 6) AS mse,
      round(sqrt(AVG((actual - {predicted}) * (actual - {predicted}))), 6) AS rmse,
      round(1 - AVG((actual - {predicted}) * (actual - {predicted})) / VAR_POP(actual), 6) AS r2
    FROM pred WHERE naive IS NOT NULL GROUP BY series_id"""


def naive_predictions(t):
    w = series.in_time(KEY)
    return monthly_series(t).select(
        "series_id", "t", F.col("amount").alias("actual"),
        F.lag("amount", 12).over(w).alias("naive"), F.lag("amount").over(w).alias("last"),
    ).where(F.col("naive").isNotNull())


@query("z16_accuracy", f"WITH {SQL_NAIVE} {sql_accuracy('naive')}")
def _(t):
    return rounded(series.accuracy(naive_predictions(t), KEY, "actual", "naive"), "mae", "mse", "rmse", "r2")


@query(
    "z17_model_comparison",
    f"WITH {SQL_NAIVE} {sql_accuracy('naive', 'seasonal naive')} UNION ALL {sql_accuracy('last', 'last value')}",
)
def _(t):
    """Both models' predictions in one table, scored by one grouped aggregate."""
    both = F.stack(F.lit(2), F.lit("seasonal naive"), F.col("naive"), F.lit("last value"), F.col("last"))
    rows = naive_predictions(t).select("series_id", "actual", both.alias("model", "predicted"))
    return rounded(series.accuracy(rows, ["model", "series_id"], "actual", "predicted"), "mae", "mse", "rmse", "r2")
