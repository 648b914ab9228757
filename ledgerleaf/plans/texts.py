"""Scalar text functions, splitting, chunking and corpus counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerleaf.functions import text as tx
from ledgerleaf.functions.words import LEMMA_EXCEPTIONS, STOP_WORDS
from ledgerleaf.operators import corpus, sentence_ends
from ledgerleaf.operators.pieces import preference_pieces, rejoined, topic_text
from ledgerleaf.operators.pii import EMAIL, spans_of
from ledgerleaf.plans.derived import SQL_NOTES, order_notes, sql_list, sql_rules, sql_text
from ledgerleaf.plans.registry import query
from ledgerleaf.session import checkpointed


def sql_strip_markup(x: str) -> str:
    return f"trim({sql_rules(x, tx.MARKUP)}, ' ' || chr(10))"


def sql_squeeze(x: str) -> str:
    return f"trim({sql_rules(x, tx.ONE_BLANK)})"


def sql_clean(x: str, profile: str) -> str:
    x = sql_rules(sql_strip_markup(sql_rules(x, tx.URLS)), tx.CONTRACTIONS)
    return sql_rules(f"trim({sql_rules(x, tx.DIGIT_WORDS)})", tx.PROFILES[profile])


def sql_words(x: str) -> str:
    return f"list_filter(string_split({sql_squeeze(x)}, ' '), lambda w: w <> '')"


def sql_sentences(x: str) -> str:
    """List of sentences of ``x``."""
    parts = f"string_split({sql_rules(x, tx.MARK_SENTENCES)}, chr(1))"
    return f"list_filter(list_transform({parts}, lambda s: trim(translate(s, chr(2), '.'))), lambda s: s <> '')"


def sql_tokens(x: str, low: int = 2, high: int = 15) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({x}), '{tx.TOKEN_PATTERN}'), "
        f"lambda w: length(w) BETWEEN {low} AND {high})"
    )


def sql_lemma(x: str) -> str:
    listed = " ".join(f"WHEN {x} = '{a}' THEN '{b}'" for a, b in LEMMA_EXCEPTIONS.items())
    return f"""CASE WHEN length({x}) <= 3 THEN {x} {listed}
      WHEN {x} LIKE '%ies' THEN {x}[:-4] || 'y'
      WHEN regexp_matches({x}, '(ss|sh|ch|x|z)es$') THEN {x}[:-3]
      WHEN {x} LIKE '%men' THEN {x}[:-3] || 'an'
      WHEN {x} LIKE '%ss' OR {x} LIKE '%us' OR {x} LIKE '%is' THEN {x}
      WHEN {x} LIKE '%s' THEN {x}[:-2] ELSE {x} END"""


SQL_TERMS = f"""raw_terms AS (SELECT doc_id, unnest({sql_tokens('text')}) AS w FROM documents),
  terms AS (SELECT doc_id, {sql_lemma('w')} AS token, COUNT(*) AS n FROM raw_terms
            WHERE w NOT IN ({sql_list(STOP_WORDS)}) GROUP BY ALL),
  idfs AS (SELECT token, COUNT(*) AS df,
                  ln((1 + (SELECT COUNT(*) FROM documents)) / (1 + COUNT(*))) + 1 AS idf FROM terms GROUP BY token)"""


def noted(t, column, name="note"):
    return order_notes(t).select("note_id", column.alias(name))


# --- character-level transforms -------------------------------------------------

@query("f01_remove_urls", f"WITH {SQL_NOTES} SELECT note_id, {sql_rules('note', tx.URLS)} AS note FROM notes")
def _(t):
    return noted(t, tx.remove_urls(F.col("note")))


@query("f02_strip_tags", f"WITH {SQL_NOTES} SELECT note_id, {sql_strip_markup('note')} AS note FROM notes")
def _(t):
    return noted(t, tx.strip_markup(F.col("note")))


@query(
    "f03_expand_contractions",
    """SELECT o_orderkey AS note_id, 'Order ' || o_orderkey || ' for ' || c_name || ' of ' || n_name
        || ' was not billed before ' || strftime(o_orderdate, '%B %-d, %Y')
        || '. It is listed at http://orders.example.com/' || o_orderkey
        || '?q=1 and <b>will not</b> change after ' || strftime(o_orderdate, '%Y-%m-%d') || '. Ask desk' || c_nationkey
        || '@mail.example.com, they are happy to help: good service + best price!' AS note
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def _(t):
    return noted(t, tx.expand_contractions(F.col("note")))


def _document_rule(name, rules, trim=False):
    inner = sql_rules("text", rules)

    @query(name, f"SELECT doc_id, {f'trim({inner})' if trim else inner} AS text FROM documents")
    def _(t):
        cleaned = tx.apply_rules(F.col("text"), rules)
        return t.texts.select("doc_id", (F.trim(cleaned) if trim else cleaned).alias("text"))


_document_rule("f04_remove_digit_words", tx.DIGIT_WORDS, trim=True)
_document_rule("f05_letters_only", tx.LETTERS)
_document_rule("f06_letters_digits_punct", tx.LETTERS_DIGITS_PUNCT)
_document_rule("f07_letters_punct_blanks", tx.KEEP_PUNCT)
_document_rule("f08_alphanumeric_blanks", tx.ALPHANUMERIC)
_document_rule("f09_collapse_blanks", tx.ONE_BLANK, trim=True)
_document_rule("f10_newlines_to_blank", tx.NEWLINES)
_document_rule("f11_classifier_text", tx.CLASSIFIER_TEXT)
_document_rule("f12_nbsp_and_plus", tx.NBSP_PLUS)


@query(
    "f13_clean_text",
    f"WITH {SQL_NOTES}, x AS (SELECT 'd' || doc_id AS name, text FROM documents "
    "UNION ALL SELECT 'n' || note_id, note FROM notes) SELECT name, "
    + ", ".join(f"{sql_clean('text', p)} AS {p}" for p in ("letters", "letters_digits_punct", "keep_punct"))
    + " FROM x",
)
def _(t):
    docs = t.texts.select(F.concat(F.lit("d"), "doc_id").alias("name"), "text")
    notes = order_notes(t).select(F.concat(F.lit("n"), "note_id").alias("name"), F.col("note").alias("text"))
    cleaned = tx.clean_profiles(F.col("text"), ["letters", "letters_digits_punct", "keep_punct"])
    return docs.unionByName(notes).select("name", cleaned.alias("c")).select("name", "c.*")


@query("s04_html_text", f"SELECT page_id, {sql_strip_markup('html')} AS text FROM pages")
def _(t):
    return t.webpages.select("page_id", tx.strip_markup(F.col("html")).alias("text"))


@query(
    "s06_xml_text",
    f"SELECT page_id, trim({sql_rules('(url || chr(10) || html)', tx.XML_TEXT)}) AS text FROM pages",
)
def _(t):
    """Pages with their address as the banner line that precedes the first element."""
    saved = F.concat("url", F.lit("\n"), "html")
    return t.webpages.select("page_id", tx.xml_text(saved).alias("text"))


# --- splitting --------------------------------------------------------------------

@query(
    "f14_sentences",
    f"""SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS sent_no, unnest(s) AS sentence
        FROM (SELECT doc_id, {sql_sentences('text')} AS s FROM documents)""",
)
def _(t):
    return tx.unfolded(t.texts, ["doc_id"], tx.sentences(F.col("text")), "sent_no", "sentence")


def sql_stripped(x: str) -> str:
    quoted = [p.replace("'", "''") for p in (sentence_ends.OPENING, sentence_ends.CLOSING)]
    return f"regexp_replace(regexp_replace({x}, '{quoted[0]}', ''), '{quoted[1]}', '')"


SQL_ENDS = f"""plain AS (SELECT doc_id, {sql_words('text')} AS ws FROM documents),
  word AS (SELECT doc_id, unnest(ws) AS raw, generate_subscripts(ws, 1) AS i FROM plain),
  clean AS (SELECT doc_id, i, raw, {sql_stripped('raw')} AS w FROM word),
  typed AS (SELECT *, lower(regexp_replace(w, '\\.$', '')) AS type, ends_with(w, '.') AS dot,
              lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS before, lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM clean),
  stat AS (SELECT type, COUNT(*) FILTER (dot) AS stops, COUNT(*) FILTER (NOT dot) AS plain,
             COUNT(*) FILTER (regexp_matches(w, '^\\p{{Ll}}')) AS small,
             COUNT(*) FILTER (regexp_matches(w, '^\\p{{Lu}}') AND before IS NOT NULL AND NOT regexp_matches(before, '[.!?]$')) AS large
           FROM typed WHERE type <> '' GROUP BY type),
  share AS (SELECT SUM(stops) / SUM(stops + plain) AS p FROM stat),
  scores AS (SELECT type, -2 * ((stops * ln(p) + plain * ln(1 - p)) - (stops * ln(0.99) + plain * ln(1 - 0.99)))
               * exp(-(length(type) - inside + 1)) * (inside + 1) * pow(length(type) - inside + 1, -plain) AS score
             FROM (SELECT *, length(type) - length(replace(type, '.', '')) AS inside FROM stat) CROSS JOIN share
             WHERE stops > 0 AND p > 0 AND p < 1 AND regexp_matches(type, '\\p{{L}}') AND NOT regexp_matches(type, '[0-9]')),
  abbreviations AS (SELECT * FROM scores WHERE score >= 0.3)"""


@query(
    "f14_learned_abbreviations",
    f"WITH {SQL_ENDS} SELECT type, round(score, 6) AS score, score >= 0.3 AS abbreviation FROM scores",
)
def _(t):
    """Words before a stop, and whether the stop is a part of them, by what the corpus says."""
    found = sentence_ends.stop_scores(checkpointed(sentence_ends.word_statistics(t.texts)))
    return found.select("type", F.round("score", 6).alias("score"), (F.col("score") >= sentence_ends.LEAST).alias("abbreviation"))


@query(
    "f14_learned_sentences",
    f"""WITH {SQL_ENDS},
      ends AS (SELECT doc_id, i, raw, regexp_matches(w, '[.!?]$') AND (NOT dot OR typed.type NOT IN (SELECT type FROM abbreviations)
                 OR coalesce(regexp_matches(after, '^\\p{{Lu}}') AND lower(regexp_replace(after, '\\.$', ''))
                      IN (SELECT type FROM stat WHERE small > 0 AND large = 0), false)) AS stop FROM typed),
      placed AS (SELECT doc_id, i, raw, CAST(coalesce(SUM(stop::INT) OVER (
                   PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS sent_no FROM ends)
      SELECT doc_id, sent_no, string_agg(raw, ' ' ORDER BY i) AS sentence FROM placed GROUP BY doc_id, sent_no""",
)
def _(t):
    """Sentences whose ends are learned from the corpus, in any language."""
    return sentence_ends.learned_sentences(t.texts)


@query(
    "f15_tokens",
    f"""SELECT doc_id, len({sql_words('text')}) AS words, len({sql_tokens('text')}) AS tokens,
               md5(array_to_string({sql_tokens('text')}, ' ')) AS digest FROM documents""",
)
def _(t):
    found = tx.tokens(F.col("text"))
    return t.texts.select(
        "doc_id",
        F.size(tx.words(F.col("text"))).cast("bigint").alias("words"),
        F.size(found).cast("bigint").alias("tokens"),
        F.md5(F.array_join(found, " ")).alias("digest"),
    )


def sql_chunks(source: str, key: str, words: str, size: int, overlap: int = 0) -> str:
    step = size - overlap
    return f"""SELECT {key}, CAST(i AS INTEGER) AS chunk_no, array_to_string(w[i * {step} + 1 : i * {step} + {size}], ' ') AS chunk
      FROM (SELECT {key}, w, unnest(generate_series(0, CAST(greatest(1, ceil((len(w) - {overlap}) / {step})) AS INTEGER) - 1)) AS i
            FROM (SELECT {key}, {words} AS w FROM {source}) WHERE len(w) > 0)"""


def _chunk_query(name, size, overlap=0):
    @query(name, sql_chunks("documents", "doc_id", sql_words("text"), size, overlap))
    def _(t):
        pieces = tx.chunks(tx.words(F.col("text")), size, overlap)
        return tx.unfolded(t.texts, ["doc_id"], pieces, "chunk_no", "chunk")


_chunk_query("f16_chunks_500", 500)
_chunk_query("f16_chunks_100", 100)
_chunk_query("f17_overlapping_chunks", 600, 20)
_chunk_query("v01_index_chunks", 600, 20)


@query(
    "f18_pieces_restore_text",
    "SELECT doc_id, text, true AS within_limit FROM documents",
)
def _(t):
    """The pieces of a text joined in order are the text, and none is longer than the limit."""
    pieces = preference_pieces(t.texts.select("doc_id", "text"), "doc_id", "text", 256)
    parts = pieces.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("piece_no", "piece"))).alias("p"),
        (F.max(F.length("piece")) <= 256).alias("within_limit"),
    )
    return parts.select("doc_id", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("text"), "within_limit")


@query(
    "f19_rejoin_chunks",
    f"SELECT doc_id, ' ' || array_to_string({sql_words('text')}, ' ') AS text FROM documents WHERE len({sql_words('text')}) > 0",
)
def _(t):
    pieces = tx.chunks(tx.words(F.col("text")), 500)
    chunks = tx.unfolded(t.texts, ["doc_id"], pieces, "chunk_no", "chunk")
    return rejoined(chunks, ["doc_id"], "chunk_no", "chunk", "text")


@query(
    "f20_topic_text_round_trip",
    """WITH c AS (SELECT lang, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents),
            n AS (SELECT lang, word, COUNT(*) AS n FROM c GROUP BY ALL),
            r AS (SELECT lang, word, n / SUM(n) OVER (PARTITION BY lang) AS weight,
                         ROW_NUMBER() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank FROM n)
       SELECT lang, CAST(rank AS INTEGER) AS rank, word, printf('%.3f', weight) AS score FROM r WHERE rank <= 10""",
)
def _(t):
    """Topics rendered as ``0.123*"word" + …`` and read back into words and scores."""
    from ledgerleaf.operators.topics import top_share_words

    letters = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    counts = tx.unfolded(t.texts, ["lang"], letters, "token").groupBy("lang", "token").agg(F.count("*").alias("n"))
    return topic_text(top_share_words(counts, "lang", 10), "lang")


@query(
    "f21_substring_by_offsets",
    f"""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '{EMAIL}')) AS entity FROM documents)
        SELECT doc_id, entity, COUNT(*) AS n FROM m GROUP BY ALL""",
)
def _(t):
    """Entities cut out of the text again by the offsets found for them."""
    spans = spans_of(t.texts.select("doc_id", "text"), "doc_id", "text", {"EMAIL_ADDRESS": EMAIL}, keep_text=True)
    cut = tx.span_at(F.col("text"), F.col("start"), F.col("end"))
    return spans.select("doc_id", cut.alias("entity")).groupBy("doc_id", "entity").agg(F.count("*").alias("n"))


@query(
    "f26_lemmas",
    f"""SELECT token, {sql_lemma('token')} AS lemma
        FROM (SELECT DISTINCT unnest({sql_tokens('text')}) AS token FROM documents)""",
)
def _(t):
    distinct = tx.unfolded(t.texts, [], tx.tokens(F.col("text")), "token").distinct()
    return distinct.select("token", tx.lemma(F.col("token")).alias("lemma"))


# --- corpus counts ------------------------------------------------------------------

SQL_MARKS = f"len(regexp_extract_all(text, {sql_text(tx.WORD_OR_MARK)}))"


@query("a16_token_counts", f"SELECT doc_id, CAST({SQL_MARKS} AS INTEGER) AS n FROM documents")
def _(t):
    return t.texts.select("doc_id", F.size(tx.words_and_marks(F.col("text"))).alias("n"))


@query(
    "d16_word_totals",
    f"SELECT source, COUNT(*) AS documents, CAST(SUM({SQL_MARKS}) AS BIGINT) AS n FROM documents GROUP BY source",
)
def _(t):
    n = F.size(tx.words_and_marks(F.col("text")))
    return t.texts.select("source", n.alias("n")).groupBy("source").agg(
        F.count("*").alias("documents"), F.sum("n").alias("n")
    )


@query("d17_document_frequencies", f"WITH {SQL_TERMS} SELECT token, df, round(idf, 6) AS idf FROM idfs")
def _(t):
    idf = corpus.idf_table(t.texts, F.col("text"))
    return idf.select("token", "df", F.round("idf", 6).alias("idf"))
