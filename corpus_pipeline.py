"""From raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm import mixing, personal, quality, simhash
from ledgerleaf.llm.packing import pack
from ledgerleaf.llm.queries import MIXTURE, word_tokenizer
from ledgerleaf.session import shared_dir
from ledgerleaf.sources.tables import Tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside the adaptive fences of their language and source.

    Null and empty texts fail; null languages and sources are groups like others; equal rows share their verdict; an
    empty table stays empty.
    """
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates: the smallest ``doc_id``, a null one last.

    Rows with equal ids: the smallest hash of the row stays. Null and empty texts are one group; an empty table stays empty.
    """
    return simhash.first_of_each(docs, shingle=4, distance=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows.

    Null texts stay null, with a null ``n_chars``; empty ones stay empty; equal rows are rewritten alike; an empty table stays empty.
    """
    return personal.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at rates that bring the domains to their weights, each as often as its copies say.

    Null and empty texts have no tokens and are drawn at the rate of a text without words; equal rows are drawn alike; an empty
    table stays empty.
    """
    drawn = mixing.mixed(docs, Tables(spark, sf_dir).labels, MIXTURE, total="largest").where("_copies >= 1")
    return drawn.select("_row", F.explode(F.sequence(F.lit(1), "_copies"))).select("_row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 4096 tokens.

    Null and empty texts are the end token alone; equal rows are documents of their own; an empty table has no pieces.
    """
    return pack(docs, word_tokenizer(), 4096, 2)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mixing_to_targets),
    ("packing", packing),
]

#: Fingerprints, fitted classifiers and the tokenizer are beyond SQL; tests check the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one written and read again."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        path = shared_dir(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
