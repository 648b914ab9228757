"""Fiscal calendar (April to March) and month arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fiscal_year(day: Column) -> Column:
    """``yyyy-yyyy`` label of the fiscal year that starts in April."""
    first = F.year(day) - F.when(F.month(day) < 4, 1).otherwise(0)
    return F.concat(first.cast("string"), F.lit("-"), (first + 1).cast("string"))


def post_period(day: Column) -> Column:
    """Position of the month in the fiscal year, April = 1."""
    return ((F.month(day) + 8) % 12 + 1).cast("int")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def future_month_ends(last: DataFrame, keys: list[str], day: str, periods: int) -> DataFrame:
    """``periods`` month ends after each row's ``day``, numbered ``h`` from 1."""
    first = F.expr(f"add_months(trunc({day}, 'MM'), 1)")
    final = F.expr(f"add_months(trunc({day}, 'MM'), {periods})")
    months = F.sequence(first, final, F.expr("interval 1 month"))
    ahead = last.select(*keys, F.posexplode(months).alias("h", "month"))
    return ahead.select(*keys, (F.col("h") + 1).alias("h"), F.last_day("month").alias(day))
