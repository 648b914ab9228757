"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each measure of a text is a rate in whole steps. Per language and source its distribution is
kept as a mergeable sketch: counts of cells whose width grows with the value (under 64 exact,
then 32 cells per doubling, so a quantile is off by at most 1/32 of itself). Sketches merge by
adding counts, in any order and with the same result. Quantiles of the merged sketches replace
fixed cutoffs: a text is rejected where a measure lies outside the fences of its group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerleaf.llm.tables import stored

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
#: Measure, and the steps beyond the quantiles that are tolerated even where all texts of a group are alike.
#: Symbols, repeated lines and repeated words count per thousand; the word length in hundredths of a character.
SLACK = {"symbol_rate": 50, "line_rate": 300, "repeat_rate": 200, "word_length": 100}
TWO_SIDED = ("word_length",)
#: The upper fence lies so many times the distance from the median to the upper decile above the median, the
#: lower one so many times the distance from the lower decile below it.
ABOVE, BELOW = 1, 3
ENOUGH = 40  # rows from which a group has fences of its own; below, its language's, then everyone's
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_starts(hashes: str) -> Column:
    """Where windows start whose hash occurs twice or more, ascending."""
    pairs = F.array_sort(F.transform(F.col(hashes), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def recurring(sorted_pairs):
        def same(p, i):
            before = F.get(sorted_pairs, i - 1)["h"].eqNullSafe(p["h"])
            return before | F.get(sorted_pairs, i + 1)["h"].eqNullSafe(p["h"])

        return F.array_sort(F.transform(F.filter(sorted_pairs, same), lambda p: p["i"]))

    return F.transform(F.array(pairs), recurring)[0]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of its texts in a struct ``_m``."""
    df = docs.select("*", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    df = df.withColumn("_w", F.filter(F.split("_t", SPACE, -1), lambda w: w != ""))
    df = df.withColumn("_n", F.size("_w"))
    word = lambda i: F.get("_w", i)
    windows = F.transform(
        F.sequence(F.lit(0), F.col("_n") - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))
    )
    df = df.withColumn("_h", F.when(F.col("_n") >= 4, windows).otherwise(F.array().cast("array<long>")))
    df = df.withColumn(
        "_r", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), repeat_starts("_h")).otherwise(
            F.array().cast("array<int>")),
    )
    step = F.struct(F.lit(0).cast("long").alias("total"), F.lit(-3).alias("last"))
    covered = F.aggregate(
        "_r", step,
        lambda a, x: F.struct(
            (a["total"] + F.least(F.lit(3), x - a["last"])).alias("total"), x.alias("last")
        ),
        lambda a: a["total"],
    )
    lines = F.filter(F.split("_t", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = df.withColumn("_l", lines)
    n_lines = F.size("_l")
    base = F.struct(
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        n_lines.cast("long").alias("n_lines"),
    )
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], base.alias("_m"))


def rates(m: str = "_m") -> dict[str, Column]:
    col = lambda name: F.col(f"{m}.{name}")
    words, lines = F.greatest(col("n_words"), F.lit(1)), F.greatest(col("n_lines"), F.lit(1))
    return {
        "symbol_rate": F.floor(col("n_symbols") * 1000 / words),
        "line_rate": F.floor(col("n_dup_lines") * 1000 / lines),
        "repeat_rate": F.floor(col("n_repeat_words") * 1000 / words),
        "word_length": F.floor(col("word_chars") * 100 / words),
    }


def base_failed(m: str = "_m") -> Column:
    return (F.col(f"{m}.n_words") < 50) | (100 * F.col(f"{m}.n_repeat_words") > 50 * F.col(f"{m}.n_words"))


def cell(value: Column) -> Column:
    """The lower end of the sketch cell of a whole number."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    scale = F.pow(F.lit(2.0), shift).cast("long")
    return F.floor(value / scale) * scale


def fences(marked: DataFrame, lang: str, source: str) -> DataFrame:
    """``(lang, source, fence)``: lower and upper limits of every measure, from merged sketches."""
    values = F.array(*[
        F.struct(F.lit(name).alias("measure"), cell(v).alias("cell")) for name, v in rates().items()
    ])
    sketch = (
        marked.where(~base_failed())
        .select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(values).alias("v"))
        .groupBy("lang", "source", "v.measure", "v.cell").agg(F.count(F.lit(1)).alias("n"))
    )
    sketch = stored(sketch, "sketches")
    groups = marked.select(F.col(lang).alias("lang"), F.col(source).alias("source")).distinct()
    measures = F.array(*[F.lit(m) for m in SLACK])

    def quantiles(part: DataFrame, keys: list[str], name: str) -> DataFrame:
        merged = part.groupBy(*keys, "measure", "cell").agg(F.sum("n").alias("n"))
        by = [*keys, "measure"]
        merged = merged.withColumn("_upto", F.sum("n").over(W.partitionBy(*by).orderBy("cell")))
        merged = merged.withColumn("_all", F.sum("n").over(W.partitionBy(*by)))
        at = lambda q: F.min(F.when(F.col("_upto") * 10 >= F.col("_all") * q, F.col("cell")))
        return merged.groupBy(*by).agg(
            F.struct(
                F.max("_all").alias("rows"), at(1).alias("low"), at(5).alias("mid"), at(9).alias("high")
            ).alias(name)
        )

    table = groups.select("*", F.explode(measures).alias("measure"))
    for keys, name in ((["lang", "source"], "_q_own"), (["lang"], "_q_lang"), ([], "_q_every")):
        q = quantiles(sketch, keys, name).select(*[F.col(k).alias(f"_{k}") for k in [*keys, "measure"]], name)
        on = F.col("measure") == F.col("_measure")
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
        table = table.join(q, on, "left").drop(*[f"_{k}" for k in [*keys, "measure"]])
    chosen = F.when(F.col("_q_own.rows") >= ENOUGH, F.col("_q_own"))
    chosen = chosen.when(F.col("_q_lang.rows") >= ENOUGH, F.col("_q_lang")).otherwise(F.col("_q_every"))
    table = table.select("lang", "source", "measure", chosen.alias("q"))
    slack = F.create_map(*[F.lit(x) for kv in SLACK.items() for x in kv])[F.col("measure")]
    lower = F.col("q.mid") - BELOW * (F.col("q.mid") - F.col("q.low")) - slack
    upper = F.col("q.mid") + ABOVE * (F.col("q.high") - F.col("q.mid")) + slack
    limit = F.struct(F.when(F.col("measure").isin(*TWO_SIDED), lower).alias("lower"), upper.alias("upper"))
    return table.groupBy("lang", "source").agg(
        F.map_from_entries(F.collect_list(F.struct("measure", limit.alias("limit")))).alias("fence")
    )


def judged(marked: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``marked`` (with measures ``_m``, in a stored table) with booleans ``_base_failed`` and ``_kept``."""
    limits = fences(marked, lang, source).select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.col("fence").alias("_fence")
    )
    inside = F.lit(True)
    for name, value in rates().items():
        limit = F.col("_fence")[name]
        inside = inside & F.coalesce(value <= limit["upper"], F.lit(True))
        inside = inside & F.coalesce(value >= limit["lower"], F.lit(True))
    on = F.col(lang).eqNullSafe(F.col("_lang")) & F.col(source).eqNullSafe(F.col("_source"))
    return (
        marked.join(limits, on, "left")
        .withColumn("_base_failed", base_failed())
        .withColumn("_kept", ~F.col("_base_failed") & inside)
        .drop("_lang", "_source", "_fence")
    )


def quality_report(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """Per row: the key, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed`` and ``kept``.

    Words are maximal runs of other characters than ASCII white space. A null text is empty and fails.
    Null languages and sources are groups like others. Rows that fail the base rules do not shape the
    fences; a table without any other row keeps none. Repeated rows count each; other columns are
    ignored; an empty table gives an empty result.
    """
    slim = docs.select(key, text, lang, source)
    marked = stored(measured(slim, text).drop(text), "measures")
    return judged(marked, lang, source).select(
        key, *[F.col(f"_m.{c}").alias(c) for c in BASE],
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
    )


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that :func:`quality_report` keeps, unchanged.

    Null and empty texts fail and go; repeated rows stay as often as they occur; an empty table stays empty.
    """
    whole = docs.select(F.struct("*").alias("_row"))
    marked = stored(measured(whole, f"_row.{text}"), "measured")
    return judged(marked, f"_row.{lang}", f"_row.{source}").where("_kept").select("_row.*")
