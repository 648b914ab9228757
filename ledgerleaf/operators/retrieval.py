"""Passage retrieval for questions, prompts and answers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, BucketedRandomProjectionLSH, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.functions import text as tx
from ledgerleaf.functions.words import STOP_WORDS
from ledgerleaf.operators import postings
from ledgerleaf.operators.search import nearest

# The two slots of a prompt, labelled; instructions to a model are the caller's.
PROMPT = """Passages:
{context}

To answer: {question}
"""


def content_words(text: Column) -> Column:
    return F.filter(tx.tokens(text), lambda w: ~w.isin(STOP_WORDS))


def index_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 600, overlap: int = 20) -> DataFrame:
    """``key, passage_no, passage``: overlapping chunks of whole texts."""
    pieces = tx.chunks(tx.words(F.col(text)), size, overlap)
    return tx.unfolded(docs, [key], pieces, "passage_no", "passage")


def sentence_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return tx.unfolded(docs, [key], tx.sentences(F.col(text)), "passage_no", "passage")


def index_of(passages: DataFrame, ids: Sequence[str], passage: str, path: str | None = None) -> postings.Index:
    """An inverted index of the content words of ``passages``, written at ``path``."""
    return postings.build_index(passages, ids, content_words(F.col(passage)), path)


def asked_words(questions: DataFrame, question_key: str, question: str) -> DataFrame:
    """``question_id, token``: the content words of the questions."""
    terms = F.explode(F.array_distinct(content_words(F.col(question)))).alias("token")
    return questions.select(F.col(question_key).alias("question_id"), terms)


def ranked_passages(
    passages: DataFrame, ids: Sequence[str], passage: str, questions: DataFrame, question_key: str, question: str, k: int
) -> DataFrame:
    """``question_id, ids…, score, rank``: the k best passages per question by BM25, through an index of them."""
    index = index_of(passages, ids, passage)
    return postings.search_index(index, asked_words(questions, question_key, question), k)


def filled_prompt(context: Column, question: Column, template: str = PROMPT) -> Column:
    return F.replace(F.replace(F.lit(template), F.lit("{context}"), context), F.lit("{question}"), question)


def contexts(found: DataFrame, passages: DataFrame, ids: Sequence[str], passage: str = "passage") -> DataFrame:
    """``question_id, context``: the found passages of each question in rank order."""
    texts = found.join(passages.select(*ids, passage), list(ids))
    ordered = F.array_sort(F.collect_list(F.struct("rank", passage)))
    return texts.groupBy("question_id").agg(
        F.array_join(F.transform(ordered, lambda x: x[passage]), "\n\n").alias("context")
    )


def answer_html(question: Column, answer: Column, passages: Column, sources: Column) -> Column:
    """An article with the answer, titled by the question, and a table of documents and their passages."""
    rows = F.zip_with(
        passages, sources,
        lambda p, s: F.concat(F.lit("<tr><th>"), s.cast("string"), F.lit("</th><td>"), p, F.lit("</td></tr>")),
    )
    return F.concat(
        F.lit("<article><h1>"), question, F.lit("</h1><blockquote>"), answer, F.lit("</blockquote><table>"),
        F.array_join(rows, ""), F.lit("</table></article>"),
    )


def embedded(passages: DataFrame, text: str = "passage", size: int = 256):
    """Passages with a unit-length hashed TF-IDF ``vector``, and the fitted stages."""
    prepared = passages.withColumn("_w", content_words(F.col(text)))
    stages = [
        HashingTF(inputCol="_w", outputCol="_tf", numFeatures=size),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_unit"),
    ]
    model = Pipeline(stages=stages).fit(prepared)
    scored = model.transform(prepared).withColumn("vector", vector_to_array("_unit", "float32"))
    return scored.drop("_w", "_tf", "_idf", "_unit"), model


def reach(corpus: DataFrame, queries: DataFrame, k: int, sample: int) -> float:
    """A distance within which every query has k vectors, from an exact search of at most ``sample`` of them."""
    some = corpus.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    farthest = nearest(some, "vec_id", queries, "query_id", k).agg(F.max("distance")).first()[0]
    # Squared distances are rounded to six decimals.
    return float(np.sqrt((farthest or 0.0) + 1e-6))


def approximate_nearest(
    corpus: DataFrame, id_column: str, queries: DataFrame, query_column: str, k: int, radius: float | None = None,
    bucket: float | None = None, tables: int = 4, sample: int = 4096,
) -> DataFrame:
    """``query_id, vec_id, distance, rank`` by locality-sensitive hashing within ``radius``.

    Without a radius it is measured on a sample, so that pairs beyond every query's k nearest are not
    passed on; without a bucket length it is two deviations of a projection of vectors that far apart.
    """
    known = corpus.select(F.col(id_column).alias("vec_id"), "vector")
    wanted = queries.select(F.col(query_column).alias("query_id"), "vector")
    radius = reach(known, wanted, k, sample) if radius is None else radius
    first = wanted.first()
    width = max(1, len(first["vector"])) if first else 1
    lsh = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=bucket or 2 * radius / width**0.5, numHashTables=tables, seed=42
    )
    stored = known.select("vec_id", array_to_vector("vector").alias("features"))
    asked = wanted.select("query_id", array_to_vector("vector").alias("features"))
    model = lsh.fit(stored)
    near = model.approxSimilarityJoin(asked, stored, radius, distCol="distance")
    rows = near.select("datasetA.query_id", "datasetB.vec_id", "distance")
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
