"""Corpus tables: tokens, document frequencies and inverse document frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.text import lemma, tokens, unfolded
from ledgerleaf.functions.words import STOP_WORDS


#: Characters of texts that one task takes apart.
TASK_CHARS = 16_000_000


def by_document(df: DataFrame, key: str = "doc_id", tasks: int | None = None) -> DataFrame:
    """Place every document in one task before its text is taken apart.

    One shuffle of the compact texts then serves all groupings and windows per
    document, instead of several shuffles of the far larger token rows. ``tasks``
    are those of :func:`document_tasks`; none leaves their number to the session.
    """
    return df.repartition(F.col(key)) if tasks is None else df.repartition(tasks, F.col(key))


def document_tasks(docs: DataFrame, text: str = "text") -> int | None:
    """Tasks of at most ``TASK_CHARS`` characters each, as tokens take far more room than texts; none for one task."""
    chars = docs.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    session = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return None if chars <= TASK_CHARS else max(session, -(-chars // TASK_CHARS))


def content_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", lemmas: bool = True) -> DataFrame:
    """``key, token`` per token that is no stop word, lemmatised."""
    found = unfolded(docs, [key], tokens(F.col(text)), "token")
    kept = found.where(~F.col("token").isin(STOP_WORDS))
    return kept.withColumn("token", lemma(F.col("token"))) if lemmas else kept


def term_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", lemmas: bool = True) -> DataFrame:
    """``key, token, n``: how often each content token occurs in each document."""
    return content_tokens(docs, key, text, lemmas).groupBy(key, "token").agg(F.count("*").alias("n"))


def document_frequencies(docs: DataFrame, text: Column, lemmas: bool = True) -> DataFrame:
    """``token, df``: in how many documents each content token occurs.

    Repeats are removed inside the document's row, so that the only shuffle is
    that of the tokens' partial counts.
    """
    kept = F.filter(tokens(text), lambda t: ~t.isin(STOP_WORDS))
    if lemmas:
        kept = F.transform(F.array_distinct(kept), lemma)
    return unfolded(docs, [], F.array_distinct(kept), "token").groupBy("token").agg(F.count("*").alias("df"))


def smooth_idf(df: Column, documents: Column) -> Column:
    """``ln((1 + N) / (1 + df)) + 1``."""
    return F.ln((1 + documents) / (1 + df)) + 1


def document_count(docs: DataFrame) -> Column:
    return docs.agg(F.count("*").alias("n")).scalar()


def idf_table(docs: DataFrame, text: Column, lemmas: bool = True) -> DataFrame:
    """``token, df, idf`` over the corpus."""
    found = document_frequencies(docs, text, lemmas)
    return found.withColumn("idf", smooth_idf(F.col("df"), document_count(docs)))
