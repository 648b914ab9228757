"""Row positions and running totals over a whole table, without one task seeing it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.session import checkpointed


def with_running_total(df: DataFrame, order: list[Column], weight: Column, name: str) -> DataFrame:
    """Inclusive running sum of ``weight`` in the global order ``order``.

    The table is range-partitioned by the order, each slice sums its own rows and
    is lifted by the total of the slices before it. ``order`` must identify rows,
    otherwise one repeated value would fill one slice. The sorted table is
    checkpointed because slices must not move between the two passes.
    """
    sliced = checkpointed(df.orderBy(*order).withColumn("_slice", F.spark_partition_id()))
    local = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition: small whatever the table's size.
    slices = sliced.groupBy("_slice").agg(F.sum(weight).alias("_total"))
    slices = slices.select("_slice", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    summed = sliced.withColumn("_local", F.sum(weight).over(local))
    lifted = summed.join(F.broadcast(slices), "_slice").withColumn(name, F.col("_local") + F.col("_before"))
    return lifted.drop("_slice", "_local", "_before")


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """0-based position of every row in the global order ``order``."""
    ranked = with_running_total(df, order, F.lit(1), name)
    return ranked.withColumn(name, F.col(name) - 1)


def row_slice(df: DataFrame, order: list[Column], start: int, stop: int) -> DataFrame:
    """Rows ``start`` (inclusive) to ``stop`` (exclusive) of the ordered table, for short slices."""
    return df.orderBy(*order).offset(start).limit(stop - start)


def all_but_last(df: DataFrame, order: list[Column], count: int) -> DataFrame:
    """The ordered table without its last ``count`` rows."""
    placed = with_position(df, order, "_position")
    total = df.agg(F.count("*").alias("n")).scalar()
    return placed.where(F.col("_position") < total - count).drop("_position")


def tail(df: DataFrame, order: list[Column], reverse: list[Column], count: int) -> DataFrame:
    """The last ``count`` rows in order; ``reverse`` is the opposite order."""
    return df.orderBy(*reverse).limit(count).orderBy(*order)


def code_table(values: DataFrame, order: list[Column], name: str, first: int = 0) -> DataFrame:
    """Consecutive codes for distinct rows in the given order."""
    return with_position(values, order, name).withColumn(name, (F.col(name) + first).cast("bigint"))


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float]) -> DataFrame:
    """One row of linearly interpolated quantiles ``q0, q1, …`` of a column of any size."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    ranked = with_running_total(counts, [F.col(column)], F.col("_n"), "_upto")
    size = df.agg(F.count(column).alias("n")).scalar()
    ends = []
    for i, p in enumerate(probabilities):
        place = (size - 1) * F.lit(float(p))
        for side, at in (("low", F.floor(place)), ("high", F.ceil(place))):
            holds = (F.col("_upto") > at) & (F.col("_upto") - F.col("_n") <= at)
            ends.append(F.max(F.when(holds, F.col(column))).alias(f"{side}{i}"))
    found = ranked.agg(F.sum("_n").alias("_size"), *ends)
    result = []
    for i, p in enumerate(probabilities):
        place = (F.col("_size") - 1) * F.lit(float(p))
        share = place - F.floor(place)
        result.append((F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * share).alias(f"q{i}"))
    return found.select(*result)
