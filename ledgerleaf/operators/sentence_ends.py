"""Sentence ends learned from the corpus itself, for texts of any language.

A full stop belongs to an abbreviation where a word and the stop go together far more often than
a sentence ends: log-likelihood ratio of the pair, weighted by the word's length, its inner stops
and how often it stands without one. After an abbreviation a sentence ends only before a
capitalised word that is otherwise written small. Statistics are counts per word over the whole
corpus; the learned table is joined with the stops of the texts, not with their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import text as tx
from ledgerleaf.operators.frame import lookup_join
from ledgerleaf.session import checkpointed

# Parameters of the measure as published: the share of stops expected after an abbreviation, and the least score.
EXPECTED, LEAST = 0.99, 0.3
#: Signs around a word that are no part of it.
OPENING = r"^[(\[{\"'«„“‘¿¡]+"
CLOSING = r"[)\]}\"'»”’,;:]+$"
STOP = r"[.!?]$"


def stripped(word: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(word, OPENING, ""), CLOSING, "")


def typed(word: Column) -> Column:
    """A stripped word in lower case without its last stop."""
    return F.lower(F.regexp_replace(word, r"\.$", ""))


def ends_in_stop(word: Column) -> Column:
    """Whether a word, stripped, ends in a stop. Only words with a stop before their end are stripped for it."""

    def one_of(test) -> Column:
        return test(word, F.lit(".")) | test(word, F.lit("!")) | test(word, F.lit("?"))

    return F.when(one_of(F.endswith), F.lit(True)).when(one_of(F.contains), stripped(word).rlike(STOP)).otherwise(F.lit(False))


def word_rows(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """``keep``, ``_w`` (the text's words), ``at``, ``word``: one row per word as it is written."""
    words = docs.select(*keep, tx.words(F.coalesce(F.col(text), F.lit(""))).alias("_w"))
    return tx.unfolded(words, [*keep, "_w"], F.col("_w"), "at", "word")


def word_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``type, stops, plain, small, large``: how often a word stands with and without a stop, how often it begins
    small, and how often with a capital inside a sentence.

    Words are counted as they are written; each spelling is stripped and typed once.
    """
    before = F.get("_w", F.col("at") - 1)
    rows = word_rows(docs, [], text).select("word", ((F.col("at") > 0) & ~ends_in_stop(before)).cast("long").alias("inside"))
    spellings = rows.groupBy("word").agg(F.count("*").alias("n"), F.sum("inside").alias("inside"))
    spellings = spellings.select(stripped(F.col("word")).alias("word"), "n", "inside")
    stop = F.col("word").endswith(".")
    spellings = spellings.select(
        typed(F.col("word")).alias("type"), stop.alias("stop"), F.col("word").rlike(r"^\p{Ll}").alias("small"),
        F.col("word").rlike(r"^\p{Lu}").alias("large"), "n", "inside",
    )
    named = F.col("type") != ""
    count = lambda c, n="n": F.sum(F.when(named & c, F.col(n)).otherwise(F.lit(0).cast("long")))
    counts = spellings.groupBy("type").agg(
        count(F.col("stop")).alias("stops"), count(~F.col("stop")).alias("plain"), count(F.col("small")).alias("small"),
        count(F.col("large"), "inside").alias("large"),
    )
    # A condition on the type itself would be moved in front of both counts, and be tried on every word of the texts.
    return counts.where("stops + plain > 0")


def stop_scores(statistics: DataFrame) -> DataFrame:
    """``type, score`` of the words that stand before a stop: how far the stop is a part of them.

    Words without a letter, or with a digit, have none.
    """
    total = statistics.agg(F.sum("stops").cast("double").alias("s"), F.sum(F.col("stops") + F.col("plain")).cast("double").alias("n"))
    share = total.select(F.try_divide("s", "n")).scalar()
    n, k = (F.col("stops") + F.col("plain")).cast("double"), F.col("stops").cast("double")
    usual = k * F.ln(F.col("_share")) + (n - k) * F.ln(1 - F.col("_share"))
    bound = k * F.ln(F.lit(EXPECTED)) + (n - k) * F.ln(F.lit(1 - EXPECTED))
    inner = F.length("type") - F.length(F.replace("type", F.lit("."), F.lit("")))
    letters = (F.length("type") - inner + 1).cast("double")
    score = -2 * (usual - bound) * F.exp(-letters) * (inner + 1) * F.pow(letters, -F.col("plain").cast("double"))
    able = statistics.where((F.col("stops") > 0) & F.col("type").rlike(r"\p{L}") & ~F.col("type").rlike("[0-9]"))
    able = able.withColumn("_share", share).where((F.col("_share") > 0) & (F.col("_share") < 1))
    return able.select("type", score.alias("score"))


def abbreviations(statistics: DataFrame) -> DataFrame:
    """``type, score`` of the words whose stop is a part of them."""
    return stop_scores(statistics).where(F.col("score") >= LEAST)


def learned_sentences(docs: DataFrame, key: str = "doc_id", text: str = "text", statistics: DataFrame | None = None) -> DataFrame:
    """``key, sent_no, sentence``: the sentences of each document, their words joined by blanks.

    ``statistics`` default to those of ``docs`` itself. ``key`` names a document. A document without words has no sentence.
    """
    statistics = checkpointed(word_statistics(docs, text) if statistics is None else statistics)
    known = abbreviations(statistics).select("type", F.lit(True).alias("short"))
    starters = statistics.where("small > 0 AND large = 0").select(F.col("type").alias("next"))
    # Only words with a stop leave their document.
    stops = word_rows(docs, [key], text).where(ends_in_stop(F.col("word")))
    stops = stops.select(key, "at", stripped(F.col("word")).alias("word"), stripped(F.get("_w", F.col("at") + 1)).alias("follows"))
    stops = stops.select(
        key, "at", F.col("word").endswith(".").alias("dot"), typed(F.col("word")).alias("type"),
        F.col("follows").rlike(r"^\p{Lu}").alias("capital"), typed(F.col("follows")).alias("next"),
    )
    judged = lookup_join(stops, known, "type", F.col("at"), "left")
    maybe = F.col("dot") & F.col("short").isNotNull()
    # Texts are taken apart once for the sure and the open ends.
    judged = checkpointed(judged.groupBy(key).agg(
        F.collect_list(F.when(~maybe, F.col("at"))).alias("_sure"),
        F.collect_list(F.when(maybe & F.col("capital"), F.struct("at", "next"))).alias("_open"),
    ))
    unsure = tx.unfolded(judged, [key], F.col("_open"), "o").select(key, "o.*")
    # Words that follow an abbreviation meet the statistics once each, however often they do.
    starters = starters.join(unsure.select("next").distinct(), "next", "left_semi")
    more = lookup_join(unsure, starters, "next", F.col("at")).groupBy(key).agg(F.collect_list("at").alias("_more"))
    cut = docs.select(key, F.col(text).alias("_text")).join(judged.select(key, "_sure"), key, "left").join(more, key, "left")
    none = F.array().cast("array<int>")
    cut = cut.select(
        key, tx.words(F.coalesce("_text", F.lit(""))).alias("_w"),
        F.array_sort(F.concat(F.coalesce("_sure", none), F.coalesce("_more", none))).alias("_ends"),
    )
    last = F.when(F.element_at(F.concat(F.array(F.lit(-1)), "_ends"), -1) < F.size("_w") - 1, F.array(F.size("_w") - 1))
    ends = F.concat("_ends", F.coalesce(last, none))
    pieces = tx.bound(ends, lambda e: F.transform(
        e, lambda stop, i: F.array_join(F.slice("_w", F.coalesce(F.get(e, i - 1), F.lit(-1)) + 2, stop - F.coalesce(F.get(e, i - 1), F.lit(-1))), " ")
    ))
    return tx.unfolded(cut, [key], pieces, "sent_no", "sentence")
