"""How filters act on one another: every order of them, step by step, from counts alone.

A document's failures are one mask, a bit per filter. Documents are counted per part and mask
first, so at most 2^n cells of counts a part remain however many documents there are. A
recursive query then extends prefixes of filters by unused letters, joins each to the cells of
its part and carries the bits applied so far; every level of the recursion emits the counts of
its step, and each order reads its steps from the prefixes that it begins with.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerleaf.llm.tables import stored

SPACE = "[\\x20\\x09-\\x0D]+"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text only, by letter: true where the text fails."""
    words = F.filter(F.split(text, SPACE, -1), lambda w: w != "")
    n, distinct = F.col("_words"), F.col("_distinct")
    return {
        "_words": F.size(words), "_distinct": F.size(F.array_distinct(words)),
        "A": n < 50,
        "B": 100 * distinct.cast("long") < 65 * n.cast("long"),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 5 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def cells_of(docs: DataFrame, labels: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents counted by part and the filters they fail.

    Equal texts are found by their SHA-256; a row fails the last filter if a row with a smaller key has
    its text. Copies of a text are counted per part and labels before texts meet, so a text that is
    half of the table reaches its task as a few rows.
    """
    df = docs.select(
        F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text"),
    )
    failures = text_failures(F.col("_text"))
    counted = df.select("*", failures.pop("_words").alias("_words"), failures.pop("_distinct").alias("_distinct"))
    bits = [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failures.values())]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    slim = counted.select("_key", "part", F.unhex(F.sha2("_text", 256)).alias("_print"), mask.alias("_mask"))
    marks = labels.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("_key")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("_good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("_toxic"),
    )
    group = ["_print", "part", "_mask", "_good", "_toxic"]
    marked = slim.join(marks, "_key", "left").fillna(0, ["_good", "_toxic"])
    # One row per key of a group, then one per group: with its least key and the rows that have it.
    rows = marked.groupBy("_key", *group).agg(F.count(F.lit(1)).alias("_n"))
    groups = rows.groupBy(*group).agg(
        F.sum("_n").alias("n"), F.min(F.struct((F.col("_key").isNull()).alias("none"), "_key", "_n")).alias("first"),
        F.sum(F.when(F.col("_key").isNull(), F.col("_n"))).alias("keyless"),
    )
    # The groups of one text are few, and a window passes them on without collecting them.
    least = F.min("first._key").over(W.partitionBy("_print"))
    first = F.when(F.col("first._key") == least, F.col("first._n")).otherwise(F.lit(0)) + F.coalesce("keyless", F.lit(0))
    judged = groups.select("part", "_mask", "_good", "_toxic", "n", first.alias("first"))
    split = judged.select(
        "part", F.col("_mask").alias("mask"), F.col("_good").alias("good"), F.col("_toxic").alias("toxic"),
        F.explode(F.array(
            F.struct(F.lit(0).alias("bit"), F.col("first").alias("rows")),
            F.struct(F.lit(1 << len(bits)).alias("bit"), (F.col("n") - F.col("first")).alias("rows")),
        )).alias("s"),
    )
    return split.where("s.rows > 0").groupBy("part", F.col("mask").bitwiseOR(F.col("s.bit")).alias("mask")).agg(
        F.sum("s.rows").alias("n"), F.sum(F.col("s.rows") * F.col("good")).alias("good"),
        F.sum(F.col("s.rows") * F.col("toxic")).alias("toxic"),
    )


def steps_sql(letters: str) -> str:
    """The recursive query over a table ``{cells}`` with one row ``(part, cells)`` per part.

    Its rows: ``part``, the prefix of filters applied, ``letter`` (the last of them), ``step`` and the
    step's counts. There are sum n!/k! rows per part (325 for five filters).
    """
    options = ", ".join(f"struct('{c}' AS letter, {1 << i} AS bit)" for i, c in enumerate(letters))

    def total(count: str, condition: str) -> str:
        return f"aggregate(c.cells, 0L, (a, x) -> a + if({condition}, x.{count}, 0L))"

    now, before = "x.mask & o.bit <> 0", "x.mask & s.applied"
    return f"""
        WITH RECURSIVE steps(part, prefix, letter, step, applied, kept, removed, redundant, unique_fails,
                             good_lost, toxic_lost) AS (
            SELECT part, '', '', 0, 0, 0L, 0L, 0L, 0L, 0L, 0L FROM {{cells}}
            UNION ALL
            SELECT s.part, concat(s.prefix, o.letter), o.letter, s.step + 1, s.applied | o.bit,
                   {total("n", "x.mask & (s.applied | o.bit) = 0")},
                   {total("n", f"{now} AND {before} = 0")},
                   {total("n", f"{now} AND {before} <> 0")},
                   {total("n", "x.mask = o.bit")},
                   {total("good", f"{now} AND {before} = 0")},
                   {total("toxic", f"{now} AND {before} = 0")}
            FROM (SELECT part, prefix, step, applied,
                         explode(filter(array({options}), l -> applied & l.bit = 0)) AS o
                  FROM steps) s
            JOIN {{cells}} c ON c.part = s.part
        )
        SELECT * FROM steps WHERE step > 0 LIMIT ALL"""


def orders_sql(letters: str) -> str:
    """``(filter_order, step, prefix)``: all orders and what they begin with; a table of n! * n rows."""
    array = ", ".join(f"'{c}'" for c in letters)
    return f"""
        WITH RECURSIVE orders(filter_order) AS (
            SELECT ''
            UNION ALL
            SELECT concat(filter_order, letter)
            FROM (SELECT filter_order, explode(filter(array({array}), l -> instr(filter_order, l) = 0)) AS letter
                  FROM orders)
        )
        SELECT filter_order, step, substring(filter_order, 1, step) AS prefix
        FROM (SELECT * FROM orders WHERE length(filter_order) = {len(letters)} LIMIT ALL)
        LATERAL VIEW explode(sequence(1, {len(letters)})) AS step"""


def audited(cells: DataFrame, letters: str) -> DataFrame:
    """Every order of the filters over counted cells ``(part, mask, n, good, toxic)``, bit i being letter i.

    One row per part, order and step with the step's counts and ``shapley``: what the step's filter
    removes, summed over all orders. A part's cells come together in one row of at most 2^n cells.
    """
    spark = cells.sparkSession
    rows = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    steps = stored(spark.sql(steps_sql(letters), cells=stored(rows, "filter-cells")), "filter-steps")
    # A prefix of k filters begins (n - k)! orders.
    weight = F.element_at(F.array(*[F.lit(math.factorial(len(letters) - k)) for k in range(1, len(letters) + 1)]),
                          F.col("step"))
    shares = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * weight).alias("shapley"))
    orders = spark.sql(orders_sql(letters))
    return (
        steps.join(shares, ["part", "letter"]).join(F.broadcast(orders), ["prefix", "step"])
        .select("part", "filter_order", "step", *COUNTS, "shapley")
    )


def audit_filters(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """Five filters in all 120 orders, per part: ``part, filter_order, step``, the step's counts and ``shapley``.

    A: under 50 words; B: under 65 % distinct words; C: over 5 % capital letters A-Z; D: one of ``#$%&*|``;
    E: a row with a smaller key has the same text. A null text is empty, a null part is the empty string. A row
    without a key is never a repeat and makes none; rows with one key and one text are no repeats of
    each other. Several label rows of a key count as good or toxic if any is; rows without a key or
    label as neither. Other columns are ignored; an empty table gives an empty result.
    """
    return audited(stored(cells_of(docs, labels, key, text, part), "filter-masks"), "ABCDE")


def sql() -> str:
    """The audit in DuckDB SQL, mask by mask without pre-counting."""
    fails = "|".join(f"(CASE WHEN {c} THEN {1 << i} ELSE 0 END)" for i, c in enumerate("abcde"))
    return f"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        judged AS (
            SELECT doc_id, part, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
                   100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) AS c,
                   regexp_matches(t, '[#$%&*|]') AS d,
                   coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM texts),
        marks AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                   max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        masks AS (
            SELECT part, {fails} AS mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
            FROM judged LEFT JOIN marks USING (doc_id)),
        letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        orders(filter_order, applied) AS (
            SELECT '', 0 UNION ALL
            SELECT filter_order || letter, applied | bit FROM orders, letters WHERE applied & bit = 0),
        steps AS (
            SELECT filter_order, step, substring(filter_order, step, 1) AS letter,
                   (SELECT coalesce(sum(bit), 0) FROM letters
                    WHERE instr(substring(filter_order, 1, step - 1), letter) > 0)::INT AS before
            FROM orders, range(1, 6) r(step) WHERE length(filter_order) = 5),
        metrics AS (
            SELECT part, filter_order, step, letter,
                   count(*) FILTER (mask & (before | bit) = 0) AS kept,
                   count(*) FILTER (mask & bit <> 0 AND mask & before = 0) AS removed,
                   count(*) FILTER (mask & bit <> 0 AND mask & before <> 0) AS redundant,
                   count(*) FILTER (mask = bit) AS unique_fails,
                   count(*) FILTER (mask & bit <> 0 AND mask & before = 0 AND good = 1) AS good_lost,
                   count(*) FILTER (mask & bit <> 0 AND mask & before = 0 AND toxic = 1) AS toxic_lost
            FROM masks, steps JOIN letters USING (letter) GROUP BY part, filter_order, step, letter)
        SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost,
               toxic_lost, sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
        FROM metrics"""
