"""Tables that several queries derive from the given ones, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.calendar import fiscal_year, post_period
from ledgerleaf.functions.text import Rules
from ledgerleaf.operators.frame import lookup_join
from ledgerleaf.sources.tables import Tables, spread


def money(value: Column) -> Column:
    """Exact arithmetic for sums of amounts with at most four decimals."""
    return value.cast("decimal(18,4)")


def revenue(quoted_price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    return F.col(quoted_price) * (1 - F.col(discount))


def sql_rules(expression: str, rules: Rules) -> str:
    """The same replacement rules as nested SQL calls."""
    for pattern, replacement in rules:
        back = replacement
        for i in range(1, 5):
            back = back.replace(f"${i}", f"\\{i}")
        expression = f"regexp_replace({expression}, {sql_text(pattern)}, {sql_text(back)}, 'g')"
    return expression


def sql_text(value: str) -> str:
    """A string literal; control characters are concatenated by code."""
    special = {"\n": 10, "\u0001": 1, "\u0002": 2}
    parts, plain = [], ""
    for ch in value:
        if ch in special:
            parts += ["'" + plain.replace("'", "''") + "'", f"chr({special[ch]})"]
            plain = ""
        else:
            plain += ch
    parts.append("'" + plain.replace("'", "''") + "'")
    kept = [p for p in parts if p != "''"] or ["''"]
    return kept[0] if len(kept) == 1 else "(" + " || ".join(kept) + ")"


def sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


FISCAL_START = "(year({d}) - CASE WHEN month({d}) < 4 THEN 1 ELSE 0 END)"


def sql_fiscal_year(day: str) -> str:
    start = FISCAL_START.format(d=day)
    return f"(CAST({start} AS VARCHAR) || '-' || CAST({start} + 1 AS VARCHAR))"


def sql_post_period(day: str) -> str:
    return f"CAST((month({day}) + 8) % 12 + 1 AS INTEGER)"


# --- billing: one row per order, and monthly series per market segment --------

def billed_months(t: Tables) -> DataFrame:
    """Customers with their non-negative billed amount and number of orders per month end ``ts``.

    Lines are summed per order first: the map-side sums shrink the shuffle, and
    their partitioning by order key also serves the join. Orders are then summed
    per customer and month, so that a customer with a third of all orders meets
    the customer table with one row per month.
    """
    lines = t.lineitem.where(F.col("l_extendedprice") >= 0)
    billed = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(money(F.col("l_extendedprice"))).alias("billed")
    )
    orders = t.orders.select("o_orderkey", "o_custkey", F.last_day("o_orderdate").alias("ts"))
    per_customer = billed.join(orders, "o_orderkey").groupBy("o_custkey", "ts").agg(
        F.sum("billed").alias("billed"), F.count("*").alias("n_requests")
    )
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    return per_customer.join(customers, "o_custkey")


def month_totals(organisation: str) -> list[Column]:
    """Amount, requests and distinct organisations of a group of customer months."""
    return [
        F.sum("billed").alias("billed"),
        F.sum("n_requests").alias("n_requests"),
        F.count_distinct(organisation).alias("n_orgs"),
    ]


def in_millions(df: DataFrame) -> DataFrame:
    """The billed amount as ``amount`` in millions."""
    return df.withColumn("amount", F.col("billed").cast("double") / 1e6).drop("billed")


SQL_BILLED_ORDERS = """billed_orders AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, c_nationkey, c_mktsegment,
         SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS billed
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  WHERE l_extendedprice >= 0
  GROUP BY ALL)"""


def monthly_series(t: Tables) -> DataFrame:
    """series_id, ts (month end), amount in millions, n_requests, n_orgs; row number ``t`` in time."""
    from ledgerleaf.operators.series import with_time_index

    monthly = billed_months(t).groupBy(F.col("c_mktsegment").alias("series_id"), "ts").agg(*month_totals("c_nationkey"))
    indexed = with_time_index(in_millions(monthly), ["series_id"], "ts")
    return indexed.select("series_id", "ts", "amount", "n_requests", "n_orgs", "t")


SQL_MONTHLY = f"""{SQL_BILLED_ORDERS}, monthly AS (
  SELECT c_mktsegment AS series_id, last_day(day) AS ts, CAST(SUM(billed) AS DOUBLE) / 1e6 AS amount,
         COUNT(*) AS n_requests, COUNT(DISTINCT c_nationkey) AS n_orgs,
         CAST(ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY last_day(day)) AS INTEGER) AS t
  FROM billed_orders GROUP BY c_mktsegment, last_day(day))"""


# --- notes: short texts with dates, addresses and contractions, one per order ---

def order_notes(t: Tables) -> DataFrame:
    """note_id, note: prose with places, dates, links and addresses, written from each order."""
    orders = spread(t.orders, "o_orderkey").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey").join(nations, "c_nationkey")
    joined = lookup_join(orders, customers, "o_custkey", F.col("o_orderkey"))
    key = F.col("o_orderkey").cast("string")
    note = F.concat(
        F.lit("Order "), key, F.lit(" for "), F.col("c_name"), F.lit(" of "), F.col("n_name"),
        F.lit(" wasn't billed before "), F.date_format("day", "MMMM d, yyyy"),
        F.lit(". It's listed at http://orders.example.com/"), key, F.lit("?q=1 and <b>won't</b> change after "),
        F.date_format("day", "yyyy-MM-dd"), F.lit(". Ask desk"), F.col("c_nationkey").cast("string"),
        F.lit("@mail.example.com, they're happy to help: good service + best price!"),
    )
    return joined.select(F.col("o_orderkey").alias("note_id"), note.alias("note"), "day", "n_name")


SQL_NOTES = """notes AS (
  SELECT o_orderkey AS note_id,
    'Order ' || o_orderkey || ' for ' || c_name || ' of ' || n_name || ' wasn''t billed before '
    || strftime(o_orderdate, '%B %-d, %Y') || '. It''s listed at http://orders.example.com/' || o_orderkey
    || '?q=1 and <b>won''t</b> change after ' || strftime(o_orderdate, '%Y-%m-%d') || '. Ask desk' || c_nationkey
    || '@mail.example.com, they''re happy to help: good service + best price!' AS note,
    CAST(o_orderdate AS DATE) AS day, n_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def fiscal_columns(df: DataFrame, day: str) -> DataFrame:
    return df.withColumns({"fy": fiscal_year(F.col(day)), "post_period": post_period(F.col(day))})
