"""The registered queries of this subpackage, each beside its SQL oracle where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm import byte_bpe, filter_audit, licences, mixing, personal, spelling, toxicity
from ledgerleaf.llm.neighbours import nearest
from ledgerleaf.llm.packing import pack
from ledgerleaf.llm.parsing import remove_repeated_windows
from ledgerleaf.llm.quality import quality_report
from ledgerleaf.llm.simhash import near_duplicates
from ledgerleaf.llm.suffixes import remove_repeated_substrings
from ledgerleaf.sources.tables import Tables

#: Weights of the domains of the labels in the mixture.
MIXTURE = {"prime": 0.97, "rough": 0.02, "toxic": 0.01}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with its oracle if there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, base: fn(Tables(spark, base))
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def word_tokenizer() -> str:
    """Where the public word tokenizer of the contract lies on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def removed(df: DataFrame):
    lengths = F.transform("spans", lambda s: s["end"] - s["start"])
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)


@query("op1_toxicity_scores")
def op1(t: Tables) -> DataFrame:
    """Toxicity of every whole document by the recurrent network, learned from the rows not held out."""
    scored = toxicity.score_toxicity(t.documents, toxicity.fitted(t.documents, t.labels))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query("op2_substring_repeats")
def op2(t: Tables) -> DataFrame:
    """Bytes of 50-byte strings that an earlier document holds, removed."""
    out = remove_repeated_substrings(t.documents, 50)
    return out.select(
        "doc_id", "n_bytes", removed(out).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op3_window_repeats")
def op3(t: Tables) -> DataFrame:
    """Words of 35-word windows that occur more than once, removed."""
    out = remove_repeated_windows(t.documents, 35)
    return out.select(
        "doc_id", "n_words", removed(out).alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op4_packed_sequences")
def op4(t: Tables) -> DataFrame:
    """Documents packed into sequences of at most 4096 tokens."""
    return pack(t.documents, word_tokenizer(), 4096, 2)


@query("op5_nearest_vectors")
def op5(t: Tables) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector, by a forest of random-projection trees."""
    return nearest(t.embeddings, F.col("vec_id") % 20 == 0, 20)


@query("op6_license_digests", licences.sql())
def op6(t: Tables) -> DataFrame:
    """Canonical digest of every whole document, the licence it is, and the notices among its lines."""
    return licences.scan_licences(t.documents, licences.known_digests(t.spark))


@query("op7_simhash_components")
def op7(t: Tables) -> DataFrame:
    """SimHash fingerprints over 4-word shingles, linked at up to 4 bits."""
    return near_duplicates(t.documents, 4, 4).select("doc_id", "fingerprint", "component_id")


@query("op8_quality_rules")
def op8(t: Tables) -> DataFrame:
    """Quality measures and the verdict of adaptive thresholds per language and source."""
    return quality_report(t.documents)


@query("op9_mixing_rates")
def op9(t: Tables) -> DataFrame:
    """Tokens, domain posteriors, fitted rate and number of copies of every document."""
    out = mixing.mixed(t.documents, t.labels, MIXTURE)
    shares = [F.col("_p")[i].alias(f"p_{d}") for i, d in enumerate(MIXTURE)]
    return out.select(
        F.col("_row.doc_id").alias("doc_id"), F.col("_tokens").alias("n_tokens"), *shares,
        F.col("_rate").alias("rate"), F.col("_copies").alias("copies"),
    )


@query("op10_personal_data")
def op10(t: Tables) -> DataFrame:
    """Spans of personal data: exact ones and those that weak supervision adds."""
    found = personal.personal_data(t.documents)
    exact = F.filter("spans", lambda s: s["exact"])

    def count(i: int, kind: str):
        return F.size(F.filter(exact, lambda s: s["kind"] == i)).cast("long").alias(f"n_{kind}")

    counts = [count(i, kind) for i, kind in enumerate(personal.KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(personal.listed(exact), 256).alias("base_sha256"),
        personal.listed(F.col("spans")).alias("spans"),
    )


@query("op11_byte_bpe")
def op11(t: Tables) -> DataFrame:
    """Byte-level BPE ids of every whole document, and the bytes that they decode to."""
    import public_tokenizers

    model = byte_bpe.shipped(t.spark, byte_bpe.read_ranks(str(public_tokenizers.path("byte_bpe_50k.tiktoken"))))
    pattern = public_tokenizers.PATTERN
    encoded = byte_bpe.encode(t.documents.select("doc_id", "text"), model, pattern)
    decoded = byte_bpe.decode(encoded, model, pattern)
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op12_filter_audit", filter_audit.sql())
def op12(t: Tables) -> DataFrame:
    """Five filters in all orders, per source: what every step keeps, removes and loses."""
    return filter_audit.audit_filters(t.documents, t.labels)


@query("op13_spelling_variants")
def op13(t: Tables) -> DataFrame:
    """Words of the corpus with the form and root that their near words give them."""
    return spelling.group_variants(t.documents).select("word", "form", "root", "n", "n_near", "form_n")
