"""Topic words of documents and classes, and their coherence."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.functions.text import lemma, tokens
from ledgerleaf.functions.words import STOP_WORDS
from ledgerleaf.operators.corpus import by_document, content_tokens, document_tasks, term_counts
from ledgerleaf.operators.frame import lookup_join
from ledgerleaf.session import checkpointed


# Topic words that travel to the tasks at a time.
TOPIC_WORDS = 50_000


def _ranked(df: DataFrame, key: str, score: Column, top: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(score.desc(), F.asc("token"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def top_share_words(counts: DataFrame, key: str, top: int) -> DataFrame:
    """``key, rank, token, weight`` where weight is the token's share of the key's tokens."""
    totals = counts.groupBy(key).agg(F.sum("n").alias("_total"))
    best = _ranked(counts, key, F.col("n"), top)
    return best.join(totals, key).select(key, "rank", "token", (F.col("n") / F.col("_total")).alias("weight"))


def topic_words(docs: DataFrame, key: str = "doc_id", text: str = "text", top: int = 10) -> DataFrame:
    """``key, rank, token, weight``: the words of a document's single topic.

    With one topic and one document the variational update of latent Dirichlet
    allocation has a closed form: weight = (n + 1) / (N + V) under the prior 1.
    """
    counts = term_counts(by_document(docs.select(key, text), key, document_tasks(docs, text)), key, text)
    document = Window.partitionBy(key)
    weight = (F.col("n") + 1) / (F.sum("n").over(document) + F.count("*").over(document))
    return _ranked(counts.withColumn("weight", weight), key, F.col("n"), top).select(key, "rank", "token", "weight")


def class_tfidf(counts: DataFrame, key: str) -> DataFrame:
    """``key, token, n, score`` with class-based TF-IDF: tf · ln(1 + A / f).

    ``tf`` is the token's share in the class, ``f`` its count over all classes and
    ``A`` the mean number of tokens per class. The counts are materialised once:
    they are far smaller than the texts and needed three times.
    """
    counts = checkpointed(counts)
    totals = counts.groupBy(key).agg(F.sum("n").alias("_total"))
    mean = totals.agg((F.sum("_total") / F.count("*")).alias("a")).scalar()
    overall = counts.groupBy("token").agg(F.sum("n").alias("_f"))
    joined = counts.join(overall, "token")
    joined = lookup_join(joined, totals, key, F.col("token"))
    score = F.col("n") / F.col("_total") * F.ln(1 + mean / F.col("_f"))
    return joined.select(key, "token", "n", score.alias("score"))


def class_terms(counts: DataFrame, key: str, top: int) -> DataFrame:
    scored = class_tfidf(counts, key).withColumn("score", F.round("score", 9))
    return _ranked(scored, key, F.col("score"), top).select(key, "rank", "token", "score")


def coherence(docs: DataFrame, topics: DataFrame, topic: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Mean normalised pointwise mutual information of each topic's word pairs over the documents.

    ``topics`` lists a few words per topic. Each document keeps only the topic
    words it holds, so its pairs are bounded by the square of a topic's words.
    """
    words = checkpointed(topics.select(topic, "token"))
    present = lookup_join(content_tokens(docs, key, text), words, "token", F.col(key)).dropDuplicates([key, topic, "token"])
    sets = present.groupBy(key, topic).agg(F.array_sort(F.collect_list("token")).alias("w"))
    n = docs.agg(F.count("*").alias("n")).scalar()
    single = present.groupBy(topic, "token").agg(F.count("*").alias("df"))
    firsts = sets.select(topic, "w", F.posexplode("w").alias("i", "a"))
    pairs = firsts.select(topic, "a", F.explode(F.slice("w", F.col("i") + 2, F.size("w"))).alias("b"))
    joint = pairs.groupBy(topic, "a", "b").agg(F.count("*").alias("dfab"))
    a = single.select(topic, F.col("token").alias("a"), F.col("df").alias("dfa"))
    b = single.select(topic, F.col("token").alias("b"), F.col("df").alias("dfb"))
    counted = joint.join(a, [topic, "a"]).join(b, [topic, "b"])
    p = F.col("dfab") / n
    npmi = F.when(F.col("dfab") < n, F.ln(p / ((F.col("dfa") / n) * (F.col("dfb") / n))) / -F.ln(p)).otherwise(F.lit(1.0))
    sums = counted.groupBy(topic).agg(F.sum(npmi).alias("_sum"), F.count("*").alias("pairs_met"))
    size = words.groupBy(topic).agg((F.count("*") * (F.count("*") - 1) / 2).alias("_pairs"))
    # A pair that never meets counts as -1, the limit of the measure.
    met = F.coalesce(F.col("pairs_met"), F.lit(0))
    total = F.coalesce(F.col("_sum"), F.lit(0.0)) - (F.col("_pairs") - met)
    return size.join(sums, topic, "left").select(topic, F.try_divide(total, F.col("_pairs")).alias("coherence"))


def window_coherence(
    docs: DataFrame, topics: DataFrame, topic: str, key: str = "doc_id", text: str = "text", window: int = 110,
    lemmas: bool = True,
) -> DataFrame:
    """``topic, coherence``: how alike the contexts of a topic's words are.

    Windows of ``window`` content words slide over every document (a shorter one is one window). Two words'
    normalised pointwise mutual information is taken over windows that hold both; a word's context
    vector lists its information with all words of the topic, and the coherence is the mean cosine
    between these vectors and their sum. Words that occur nowhere have no vector. Documents without content words have no window.

    ``topics`` lists a few words per topic; ``TOPIC_WORDS`` of them travel to the tasks at a time, and only counts per
    pair of a topic's words come back.
    """
    content = F.filter(tokens(F.col(text)), lambda w: ~w.isin(STOP_WORDS))
    content = F.transform(content, lambda w: lemma(w)) if lemmas else content
    prepared = docs.select(content.alias("_w"))
    total = prepared.where(F.size("_w") > 0).agg(F.sum(F.greatest(F.lit(1), F.size("_w") - (window - 1)))).first()[0] or 0
    words = checkpointed(topics.select(F.col(topic).alias("topic"), "token").distinct())
    kind = words.schema["topic"].dataType.simpleString()
    passes = max(1, -(-words.count() // TOPIC_WORDS))
    part = F.pmod(F.xxhash64("topic"), F.lit(passes))
    counts = None
    for i in range(passes):
        listed: dict = {}
        for r in words.where(part == i).orderBy("topic", "token").collect():
            listed.setdefault(r["topic"], []).append(r["token"])
        one = prepared.mapInPandas(_window_counts(listed, window), f"topic {kind}, a string, b string, n long")
        counts = one if counts is None else counts.unionByName(one)
    pairs = checkpointed(counts.groupBy("topic", "a", "b").agg(F.sum("n").alias("n")))
    single = pairs.where("a = b").select("topic", "a", F.col("n").alias("_a"))
    every = single.join(single.select("topic", F.col("a").alias("b"), F.col("_a").alias("_b")), "topic")
    p = F.coalesce("n", F.lit(0)) / F.lit(float(total)) + 1e-12
    information = F.ln(p / ((F.col("_a") / total) * (F.col("_b") / total))) / -F.ln(p)
    v = every.join(pairs, ["topic", "a", "b"], "left").select("topic", "a", "b", information.alias("v"))
    whole = v.groupBy("topic", "b").agg(F.sum("v").alias("s"))
    cosine = F.try_divide(F.sum(F.col("v") * F.col("s")), F.sqrt(F.sum(F.col("v") * F.col("v"))) * F.sqrt(F.sum(F.col("s") * F.col("s"))))
    met = v.join(whole, ["topic", "b"]).groupBy("topic", "a").agg(cosine.alias("c"))
    return met.groupBy(F.col("topic").alias(topic)).agg(F.avg("c").alias("coherence"))


def _window_counts(listed: dict, window: int):
    """Counts, over a task's documents, of the windows that hold two words of a topic."""

    def count(batches):
        places: dict[str, list] = {}
        for name, words in listed.items():
            for i, w in enumerate(words):
                places.setdefault(w, []).append((name, i))
        sums = {name: np.zeros((len(words),) * 2, np.int64) for name, words in listed.items()}
        for batch in batches:
            for words in batch["_w"]:
                found: dict = {}
                for at, w in enumerate(words if words is not None else ()):
                    for name, i in places.get(w, ()):
                        found.setdefault(name, {}).setdefault(i, []).append(at)
                last = max(len(words) - window, 0) if words is not None else 0
                for name, hits in found.items():
                    # Starts of the windows that hold a word: runs of starts, added up and taken as yes or no.
                    held = np.zeros((len(hits), last + 2), np.int32)
                    for row, at in enumerate(hits.values()):
                        at = np.array(at)
                        np.add.at(held[row], np.maximum(at - window + 1, 0), 1)
                        np.add.at(held[row], np.minimum(at, last) + 1, -1)
                    held = (np.cumsum(held, axis=1)[:, :-1] > 0).astype(np.float64)
                    own = list(hits)
                    sums[name][np.ix_(own, own)] += np.rint(held @ held.T).astype(np.int64)
        rows = [
            (name, words[i], words[j], int(sums[name][i, j]))
            for name, words in listed.items() for i, j in zip(*np.nonzero(sums[name]))
        ]
        yield pd.DataFrame(rows, columns=["topic", "a", "b", "n"])

    return count


def words_per_topic(ranked: DataFrame, keys: Sequence[str], name: str = "words") -> DataFrame:
    """The ranked words of each topic as one comma-separated text."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "token")))
    listed = ranked.groupBy(*keys).agg(ordered.alias("_w"))
    return listed.select(*keys, F.array_join(F.transform("_w", lambda x: x["token"]), ", ").alias(name))
