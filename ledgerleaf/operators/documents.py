"""Sentiment, summaries and translation of document collections.

Where a pretrained network would be called, a transparent scorer with the same
output columns stands in; :mod:`ledgerleaf.operators.models` attaches a real one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerleaf.functions import text as tx
from ledgerleaf.functions.words import GLOSSARY, NEGATIVE_WORDS, POSITIVE_WORDS
from ledgerleaf.operators import extracts
from ledgerleaf.operators.corpus import by_document, document_tasks, smooth_idf
from ledgerleaf.operators.frame import fits_broadcast
from ledgerleaf.operators.pieces import preference_pieces, rejoined
from ledgerleaf.session import checkpointed


# --- sentiment -----------------------------------------------------------------

def polarity(text: Column) -> Column:
    """(positive − negative) / (positive + negative) words of a short text, 0 without any; no shuffle."""

    def balance(found: Column) -> Column:
        good = F.size(F.filter(found, lambda w: w.isin(POSITIVE_WORDS)))
        bad = F.size(F.filter(found, lambda w: w.isin(NEGATIVE_WORDS)))
        return (good - bad) / F.greatest(F.lit(1), good + bad)

    return tx.bound(tx.tokens(text), balance)


def stars(raw: Column) -> Column:
    """1 … 5 from a polarity between −1 and 1."""
    return F.least(F.lit(5), F.greatest(F.lit(1), F.round(3 + 2 * raw).cast("int")))


def star_label(value: Column) -> Column:
    return F.concat(value.cast("string"), F.when(value == 1, " star").otherwise(" stars"))


def label_stars(label: Column) -> Column:
    """``'4 stars'`` → 4."""
    return F.regexp_extract(label, "^([1-5])", 1).cast("int")


def stars_to_unit(value: Column) -> Column:
    """1 … 5 → −1 … 1."""
    return (value - 3) / 2.0


def signed_score(label: Column, score: Column) -> Column:
    return F.when(label == "POSITIVE", score).otherwise(-score)


def sentiment_text(text: Column) -> Column:
    """Cleaned text that still has its sentence ends."""
    return tx.squeeze(tx.clean_text(text, "keep_punct"))


def sentence_sentiment(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, sent_no, sentences, sentiments, stars, score`` per sentence."""
    split = tx.unfolded(docs, [key], tx.sentences(sentiment_text(F.col(text))), "sent_no", "sentences")
    scored = split.withColumn("_raw", polarity(F.col("sentences")))
    value = stars(F.col("_raw"))
    return scored.select(
        key, "sent_no", "sentences", star_label(value).alias("sentiments"), value.alias("stars"),
        F.abs("_raw").alias("score"),
    )


def piece_sentiment(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 256) -> DataFrame:
    """``key, piece_no, piece, sentiment`` with −1 … 1 for every piece of at most ``limit`` characters."""
    pieces = preference_pieces(docs, key, text, limit)
    return pieces.withColumn("sentiment", stars_to_unit(stars(polarity(F.col("piece")))))


# --- extractive summaries -------------------------------------------------------

#: Words, the most frequent ones, whose weights travel to every task.
FREQUENT = 200_000


def led(text: Column) -> Column:
    """The text behind a line end, as :mod:`extracts` reads it; a missing one is empty."""
    return F.concat(F.lit("\n"), F.coalesce(text, F.lit("")))


def summary_idf(docs: DataFrame, documents: int, text: str = "text") -> DataFrame:
    """``token, idf``: inverse document frequencies of the words that occur in two documents at least, materialised once."""
    parts = docs.select(led(F.col(text)).alias("text")).mapInArrow(extracts.counted, "token string, n long")
    found = parts.groupBy("token").agg(F.sum("n").alias("df")).where(F.col("df") > 1)
    return checkpointed(found.select("token", smooth_idf(F.col("df"), F.lit(documents)).alias("idf")))


def _weights(idf: DataFrame) -> extracts.Weights:
    rows = idf.select("token", "idf").toArrow().combine_chunks()
    tokens = rows.column("token").combine_chunks() if rows.num_rows else pa.array([], pa.string())
    return extracts.weights(tokens, rows.column("idf").to_numpy())


def _weighted(parted: DataFrame, idf: DataFrame, key: str) -> tuple[DataFrame, extracts.Weights]:
    """The texts, in the task and order of their key, and the weights that travel to all tasks.

    These are the weights of all words, or of the most frequent ones if there are too many. Those of other
    words come to each document that holds them as ``_rare``; only these pairs of word and document travel.
    """
    if fits_broadcast(idf):
        return parted, _weights(idf)
    # The more frequent a word, the smaller its weight; equal weights stay together.
    border = idf.agg(F.percentile_approx("idf", F.lit(min(1.0, FREQUENT / max(1, idf.count()))), F.lit(100_000))).first()[0]
    common = _weights(idf.where(F.col("idf") < border))
    shared = parted.sparkSession.sparkContext.broadcast(tuple(common))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return extracts.unweighted(batches, extracts.Weights(*shared.value), [key, "token"])

    held = parted.mapInArrow(others, parted.select(key).schema.add("token", StringType()))
    rare = held.join(idf.where(F.col("idf") >= border), "token")
    rare = rare.groupBy(key).agg(F.collect_set(F.struct("token", "idf")).alias("_rare"))
    none = F.array().cast("array<struct<token:string,idf:double>>")
    met = parted.join(rare, key, "left").select(key, "text", F.coalesce("_rare", none).alias("_rare"))
    return met, common


def _summarised(docs: DataFrame, key: str, text: str, size: int, budget: int, fan_in: int | None) -> DataFrame:
    """``key, summary``. A sentence scores the mean of tf(document) · idf(corpus) over its content words; of every ``size``
    words the best sentences stay, at least one, at most ``budget`` words beyond that. With ``fan_in``, so many parts
    are joined and shortened again. All steps of a document run in its task."""
    documents = docs.count()
    idf = summary_idf(docs, documents, text)
    once = float(np.log((1 + documents) / 2) + 1)
    parted = by_document(docs.select(key, led(F.col(text)).alias("text")), key, document_tasks(docs, text))
    parted, known = _weighted(parted, idf, key)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(known))
    schema = docs.select(key).schema.add("summary", StringType())

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = extracts.Weights(*shared.value)
        for batch, groups, keys in extracts.whole_groups(batches):
            found = extracts.summarised(batch, groups, keys, known, once, size, budget, fan_in)
            yield pa.RecordBatch.from_arrays([batch.column(0), found], schema.names)

    return parted.sortWithinPartitions(key).mapInArrow(shorten, schema)


def summaries(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 500, budget: int = 62) -> DataFrame:
    """``key, summary``: chunk by chunk extract of every document, with a leading blank."""
    return _summarised(docs, key, text, size, budget, None)


def tree_summaries(
    docs: DataFrame, key: str = "doc_id", text: str = "text", fan_in: int = 10, size: int = 500, budget: int = 62
) -> DataFrame:
    """``key, summary``: chunk summaries, joined ``fan_in`` at a time and summarised again."""
    return _summarised(docs, key, text, size, budget, fan_in)


# --- translation ------------------------------------------------------------------

def glossary_translation(text: Column) -> Column:
    """Word-by-word translation; unknown words stay."""
    entries = F.create_map(*[F.lit(x) for pair in GLOSSARY.items() for x in pair])
    translated = F.transform(
        tx.words(text), lambda w: F.coalesce(F.try_element_at(entries, F.lower(w)), w)
    )
    return F.array_join(translated, " ")


def translations(docs: DataFrame, key: str = "doc_id", text: str = "text", translate=glossary_translation) -> DataFrame:
    """``key, translation``: cleaned, cut into 100-word chunks, translated chunk by chunk and rejoined.

    A document without words has an empty translation.
    """
    cleaned = tx.apply_rules(F.coalesce(F.col(text), F.lit("")), tx.ALPHANUMERIC)
    pieces = tx.bound(tx.chunks(tx.words(cleaned), 100), lambda c: F.when(F.size(c) > 0, c).otherwise(F.array(F.lit(""))))
    chunks = tx.unfolded(docs, [key], pieces, "chunk_no", "chunk")
    done = chunks.select(key, "chunk_no", translate(F.col("chunk")).alias("chunk"))
    whole = rejoined(done, [key], "chunk_no", "chunk", "translation")
    return whole.withColumn("translation", F.when(F.trim("translation") == "", "").otherwise(F.col("translation")))
