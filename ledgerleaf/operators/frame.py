"""Projections, joins and aggregations with the table semantics of the notebooks' data frames."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.operators.ordered import code_table, exact_quantiles


# Largest lookup that is sent to every executor: rows, and characters of all its values written out.
BROADCAST_ROWS = 1_000_000
BROADCAST_CHARS = 64_000_000


def fits_broadcast(lookup: DataFrame) -> bool:
    """Whether a lookup is small enough to be broadcast; at most ``BROADCAST_ROWS`` rows are looked at."""
    width = F.length(F.to_json(F.struct("*")))
    rows, chars = lookup.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.sum(width)).first()
    return rows <= BROADCAST_ROWS and (chars or 0) <= BROADCAST_CHARS


# --- predicates and cells -------------------------------------------------

def equals_ignoring_case(column: str, value: str) -> Column:
    return F.lower(F.col(column)) == value.lower()


def matches(column: str, pattern: str) -> Column:
    """Regular-expression match in which a missing value is no match."""
    return F.coalesce(F.col(column).rlike(pattern), F.lit(False))


def recoded(column: str, mapping: dict, otherwise: Column | None = None) -> Column:
    """Cell values replaced by ``mapping``; others kept, or set to ``otherwise``."""
    result = None
    for old, new in mapping.items():
        test = F.col(column) == old
        result = F.when(test, new) if result is None else result.when(test, new)
    return result.otherwise(F.col(column) if otherwise is None else otherwise)


def clipped_below(column: str, bound: float) -> Column:
    return F.when(F.col(column) < bound, F.lit(bound)).otherwise(F.col(column))


def tolerant_number(text: Column) -> Column:
    """Dirty numeric text as DOUBLE; what does not parse counts as 0."""
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def table_view(df: DataFrame, predicate: Column, sort: Column, tie: Column, page: int, size: int = 6) -> DataFrame:
    """One page of a filtered table sorted by a single column (``tie`` makes the order total)."""
    return df.where(predicate).orderBy(sort, tie).offset(page * size).limit(size)


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column and rows with a null in any of the columns, in one pass."""
    per_column = [F.sum(F.col(c).isNull().cast("bigint")).alias(f"{c}_nulls") for c in columns]
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    return df.agg(*per_column, F.sum(any_null.cast("bigint")).alias("any_nulls"))


# --- joins ----------------------------------------------------------------

def null_safe_left_join(left: DataFrame, right: DataFrame, column: str, spread: Column) -> DataFrame:
    """Left join on one column in which a missing key meets a missing key.

    ``right`` has one row per key. It is broadcast if counted small; otherwise both
    sides are salted, since the missing key alone may hold most of the rows.
    """
    lookup = right.withColumnRenamed(column, "_key")
    same = F.col(column).eqNullSafe(F.col("_key"))
    if fits_broadcast(lookup):
        return left.join(F.broadcast(lookup), same, "left").drop("_key")
    offered = lookup.withColumn("_offer", F.explode(F.sequence(F.lit(0), F.lit(15))))
    picked = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(16)).cast("int"))
    joined = picked.join(offered, same & (F.col("_salt") == F.col("_offer")), "left")
    return joined.drop("_key", "_salt", "_offer")


def salted_join(
    facts: DataFrame, lookup: DataFrame, on: str, spread: Column, salts: int = 16, how: str = "inner"
) -> DataFrame:
    """Join of many facts with a keyed lookup, safe against hot keys.

    Each lookup row is offered under ``salts`` salts and each fact picks one by
    ``spread``, so that the facts of a frequent key reach several tasks.
    """
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    offered = lookup.withColumn("_salt", salt)
    picked = facts.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return picked.join(offered, [on, "_salt"], how).drop("_salt")


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str, spread: Column, how: str = "inner") -> DataFrame:
    """Join facts with a lookup that has one row per key.

    The lookup is broadcast when its measured size stays below the bounds above;
    a larger one is joined by shuffle with salted keys (unmatched facts of a left
    join keep their row).
    """
    if fits_broadcast(lookup):
        return facts.join(F.broadcast(lookup), on, how)
    return salted_join(facts, lookup, on, spread, how=how)


# --- aggregations ---------------------------------------------------------

def sum_by(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Group sums; rows with a missing key vanish and an all-missing group sums to 0."""
    kept = df.dropna(how="any", subset=list(keys))
    return kept.groupBy(*keys).agg(F.coalesce(F.sum(column), F.lit(0.0)).alias(name))


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """How often each present value occurs, most frequent first."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), F.asc(column))


def share_within(df: DataFrame, group: str, category: str) -> DataFrame:
    """Count and share of each category within its group."""
    counts = df.groupBy(group, category).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy(group))
    return counts.withColumn("share", F.col("n") / whole)


def pivot_counts(df: DataFrame, group: str, category: str, values: Sequence[str]) -> DataFrame:
    """One row per group, one count column per listed category and ``other`` for all remaining rows."""
    columns = [F.count(F.when(F.col(category) == v, 1)).alias(v) for v in values]
    listed = F.coalesce(F.col(category).isin(list(values)), F.lit(False))
    columns.append(F.count(F.when(~listed, 1)).alias("other"))
    return df.groupBy(group).agg(*columns)


def histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    """Counts per bin ``[bin * width, (bin + 1) * width)``."""
    place = F.floor(F.col(column) / width).cast("bigint")
    binned = df.where(F.col(column).isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    return binned.select("bin", (F.col("bin") * width).alias("low"), "n")


def described(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of one column."""
    c = F.col(column).cast("double")
    basic = df.agg(
        F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).alias("low"), F.max(c).alias("high"),
    )
    quartiles = exact_quantiles(df.select(c.alias("_v")), "_v", [0.25, 0.5, 0.75])
    found = quartiles.select(F.struct("q0", "q1", "q2").alias("q")).scalar()
    q = [found[f"q{i}"] for i in range(3)]
    return basic.select("n", "mean", "std", "low", q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), "high")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, one row per ordered pair."""
    pairs = list(combinations_with_replacement(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("r")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), F.col(f"c{i}").alias("r")))
    return wide.select(F.inline(F.array(*cells)))


# --- categories -----------------------------------------------------------

def first_seen_codes(df: DataFrame, value: str, key: str, name: str) -> DataFrame:
    """Codes 1, 2, … for values (missing included) in the order of their first key."""
    first = df.groupBy(value).agg(F.min(key).alias("_first"))
    return code_table(first, [F.col("_first"), F.col(value)], name, first=1).drop("_first")


def label_codes(df: DataFrame, value: str, name: str) -> DataFrame:
    """Alphabetical codes 0 … n−1 of the present values."""
    present = df.where(F.col(value).isNotNull()).select(value).distinct()
    return code_table(present, [F.col(value)], name)


def rare_bucketed(df: DataFrame, value: str, most: int, name: str, also: Sequence[str] = ()) -> DataFrame:
    """``value`` with classes of at most ``most`` rows, and those in ``also``, called ``Other``.

    Class sizes come from a grouped count joined back, not from a window: a class
    may hold any share of the table.
    """
    sizes = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_size"))
    is_rare = (F.col("_size") <= most) | F.col(value).isin(list(also))
    rare = sizes.where(is_rare).select(value, F.lit(True).alias("_rare"))
    marked = lookup_join(df, rare, value, F.monotonically_increasing_id(), "left")
    kept = F.when(F.col("_rare"), F.lit("Other")).otherwise(F.col(value))
    return marked.withColumn(name, kept).drop("_rare")


def one_hot(df: DataFrame, column: str, values: Sequence[str], prefix: str) -> DataFrame:
    """An indicator column per listed value and one for all others; the source column goes away."""
    flags = {f"{prefix}_{i}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for i, v in enumerate(values)}
    flags[f"{prefix}_other"] = 1 - F.coalesce(F.col(column).isin(list(values)).cast("int"), F.lit(0))
    return df.withColumns(flags).drop(column)


def min_max_scaled(df: DataFrame, column: str, name: str) -> DataFrame:
    """``column`` mapped linearly onto 0 … 1 over the whole table; null where all values are equal."""
    low = df.agg(F.min(column).alias("v")).scalar()
    high = df.agg(F.max(column).alias("v")).scalar()
    return df.withColumn(name, F.try_divide(F.col(column) - low, high - low))


def min_max_restored(scaled: Column, low: Column, high: Column) -> Column:
    return scaled * (high - low) + low
