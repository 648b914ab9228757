"""Sentiment, summaries, personal data, topics and translation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerleaf.functions import text as tx
from ledgerleaf.functions.words import GLOSSARY, NEGATIVE_WORDS, POSITIVE_WORDS, STOP_WORDS
from ledgerleaf.operators import documents as dc
from ledgerleaf.operators import pii, topics
from ledgerleaf.operators.corpus import term_counts
from ledgerleaf.operators.pieces import SEPARATORS, preference_pieces
from ledgerleaf.plans.derived import SQL_NOTES, order_notes, sql_list, sql_rules, sql_text
from ledgerleaf.plans.registry import query
from ledgerleaf.plans.texts import (
    SQL_TERMS, sql_chunks, sql_clean, sql_lemma, sql_sentences, sql_squeeze, sql_tokens, sql_words,
)

# --- sentiment ----------------------------------------------------------------------


def sql_polarity(x: str) -> str:
    good = f"len(list_filter({sql_tokens(x)}, lambda w: w IN ({sql_list(POSITIVE_WORDS)})))"
    bad = f"len(list_filter({sql_tokens(x)}, lambda w: w IN ({sql_list(NEGATIVE_WORDS)})))"
    return f"(({good} - {bad}) / greatest(1, {good} + {bad}))"


def sql_stars(raw: str) -> str:
    return f"CAST(least(5, greatest(1, round(3 + 2 * {raw}))) AS INTEGER)"


SENTIMENT_TEXT = sql_squeeze(sql_clean("text", "keep_punct"))
SQL_SENTIMENT = f"""cleaned AS (SELECT doc_id, {sql_sentences('c')} AS s
    FROM (SELECT doc_id, {SENTIMENT_TEXT} AS c FROM documents)),
  sentence_rows AS (SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS sent_no, unnest(s) AS sentences
                    FROM cleaned),
  raw_scores AS (SELECT *, {sql_polarity('sentences')} AS raw FROM sentence_rows),
  sentiment AS (SELECT doc_id, sent_no, sentences,
      {sql_stars('raw')} || CASE WHEN {sql_stars('raw')} = 1 THEN ' star' ELSE ' stars' END AS sentiments,
      {sql_stars('raw')} AS stars, abs(raw) AS score FROM raw_scores)"""


@query("d02_sentence_sentiment", f"WITH {SQL_SENTIMENT} SELECT * FROM sentiment")
def _(t):
    return dc.sentence_sentiment(t.texts)


@query(
    "d02_sentiment_per_document",
    f"WITH {SQL_SENTIMENT} SELECT doc_id, sentiments, COUNT(*) AS n FROM sentiment GROUP BY ALL",
)
def _(t):
    return dc.sentence_sentiment(t.texts).groupBy("doc_id", "sentiments").agg(F.count("*").alias("n"))


@query(
    "f22_star_labels",
    f"""WITH {SQL_SENTIMENT} SELECT doc_id, sent_no, CAST(sentiments[1] AS INTEGER) AS stars,
          (CAST(sentiments[1] AS INTEGER) - 3) / 2.0::DOUBLE AS unit FROM sentiment""",
)
def _(t):
    number = dc.label_stars(F.col("sentiments"))
    labelled = dc.sentence_sentiment(t.texts).select("doc_id", "sent_no", number.alias("stars"))
    return labelled.withColumn("unit", dc.stars_to_unit(F.col("stars")))


@query(
    "f23_signed_score",
    f"""WITH {SQL_SENTIMENT} SELECT doc_id, sent_no, CASE WHEN stars >= 3 THEN score ELSE -score END AS signed
        FROM sentiment""",
)
def _(t):
    label = F.when(F.col("stars") >= 3, "POSITIVE").otherwise("NEGATIVE")
    scored = dc.sentence_sentiment(t.texts)
    return scored.select("doc_id", "sent_no", dc.signed_score(label, F.col("score")).alias("signed"))


@query(
    "j08_sentences_with_scores",
    f"WITH {SQL_SENTIMENT} SELECT doc_id, sent_no, sentences, stars FROM sentiment",
)
def _(t):
    """Sentences and their scores, kept as two arrays and met by position inside the row."""
    sentences = tx.sentences(dc.sentiment_text(F.col("text")))

    def zipped(known):
        scores = F.transform(known, lambda s: dc.stars(dc.polarity(s)))
        return F.zip_with(known, scores, lambda s, n: F.struct(s.alias("sentences"), n.alias("stars")))

    rows = tx.unfolded(t.texts, ["doc_id"], tx.bound(sentences, zipped), "sent_no", "pair")
    return rows.select("doc_id", "sent_no", "pair.sentences", "pair.stars")


def sql_cut(x: str, limit: int) -> str:
    """Length of the first piece of ``x``."""
    w = f"left({x}, {limit})"
    cases = " ".join(
        f"WHEN contains({w}, '{s}') THEN {limit} - strpos(reverse({w}), '{s[::-1]}') + 1" for s in SEPARATORS
    )
    return f"CASE WHEN length({x}) <= {limit} THEN length({x}) {cases} ELSE {limit} END"


SQL_PIECES = f"""RECURSIVE walk AS (
    SELECT doc_id, -1 AS piece_no, '' AS piece, text AS rest FROM documents
    UNION ALL
    SELECT doc_id, piece_no + 1, left(rest, n), substr(rest, n + 1)
    FROM (SELECT doc_id, piece_no, rest, CAST({sql_cut('rest', 256)} AS INTEGER) AS n FROM walk WHERE rest <> '')),
  pieces AS (SELECT doc_id, CAST(piece_no AS INTEGER) AS piece_no, piece FROM walk WHERE piece_no >= 0),
  scored AS (SELECT doc_id, piece_no, piece, ({sql_stars('raw')} - 3) / 2.0::DOUBLE AS sentiment
             FROM (SELECT *, {sql_polarity('piece')} AS raw FROM pieces))"""


@query("f18_preference_pieces", f"WITH {SQL_PIECES} SELECT doc_id, piece_no, piece FROM pieces")
def _(t):
    return preference_pieces(t.texts.select("doc_id", "text"), "doc_id", "text", 256)


@query("d03_piece_sentiment", f"WITH {SQL_PIECES} SELECT * FROM scored")
def _(t):
    return dc.piece_sentiment(t.texts)


@query(
    "d03_mean_sentiment",
    f"WITH {SQL_PIECES} SELECT doc_id, round(SUM(sentiment) / COUNT(*), 6) AS mean, COUNT(*) AS pieces "
    "FROM scored GROUP BY doc_id",
)
def _(t):
    scored = dc.piece_sentiment(t.texts)
    return scored.groupBy("doc_id").agg(F.round(F.avg("sentiment"), 6).alias("mean"), F.count("*").alias("pieces"))


@query(
    "d03_sentiment_histogram",
    f"""WITH {SQL_PIECES} SELECT source, CAST(floor(sentiment / 0.5) AS BIGINT) AS bin, COUNT(*) AS n
        FROM scored JOIN documents USING (doc_id) GROUP BY ALL""",
)
def _(t):
    scored = dc.piece_sentiment(t.texts).select("doc_id", F.floor(F.col("sentiment") / 0.5).alias("bin"))
    per_document = scored.groupBy("doc_id", "bin").agg(F.count("*").alias("n"))
    joined = per_document.join(t.texts.select("doc_id", "source"), "doc_id")
    return joined.groupBy("source", "bin").agg(F.sum("n").alias("n"))


# --- summaries -----------------------------------------------------------------------

def sql_extract(level: str, rows: str, idf: str) -> str:
    """CTEs that keep the best sentences of ``rows(doc_id, part_no, sent_no, sentence)`` in ``<level>_kept``."""
    return f"""{level}_raw AS (SELECT doc_id, part_no, sent_no, unnest({sql_tokens('sentence')}) AS token FROM {rows}),
  {level}_terms AS (SELECT doc_id, part_no, sent_no, token, COUNT(*) AS c FROM {level}_raw
                    WHERE token NOT IN ({sql_list(STOP_WORDS)}) GROUP BY ALL),
  {level}_tf AS (SELECT *, SUM(c) OVER (PARTITION BY doc_id, token) AS tf FROM {level}_terms),
  {level}_score AS (SELECT doc_id, part_no, sent_no, round(SUM(c * tf * idf) / SUM(c), 6) AS score
                    FROM {level}_tf JOIN {idf} USING (token) GROUP BY ALL),
  {level}_rank AS (SELECT r.*, ROW_NUMBER() OVER best AS rank, SUM(len({sql_words('sentence')})) OVER (
                     PARTITION BY r.doc_id, r.part_no ORDER BY COALESCE(score, 0) DESC, r.sent_no
                     ROWS UNBOUNDED PRECEDING) AS used
                   FROM {rows} r LEFT JOIN {level}_score s USING (doc_id, part_no, sent_no)
                   WINDOW best AS (PARTITION BY r.doc_id, r.part_no ORDER BY COALESCE(score, 0) DESC, r.sent_no)),
  {level}_kept AS (SELECT doc_id, part_no, sent_no, sentence FROM {level}_rank WHERE rank = 1 OR used <= 62)"""


def sql_summary_ctes(source: str, key: str) -> str:
    chunked = sql_chunks(source, key, sql_words(sql_rules("text", tx.KEEP_PUNCT)), 500)
    rows = f"""part_rows AS (SELECT {key} AS doc_id, chunk_no AS part_no, {sql_sentences('chunk')} AS s FROM ({chunked})),
  sents AS (SELECT doc_id, part_no, generate_subscripts(s, 1) - 1 AS sent_no, unnest(s) AS sentence FROM part_rows),
  idf_raw AS (SELECT doc_id, unnest({sql_tokens('sentence')}) AS token FROM sents),
  idf_doc AS (SELECT DISTINCT doc_id, token FROM idf_raw WHERE token NOT IN ({sql_list(STOP_WORDS)})),
  idf AS (SELECT token, ln((1 + (SELECT COUNT(*) FROM {source})) / (1 + COUNT(*))) + 1 AS idf FROM idf_doc GROUP BY token)"""
    return f"{rows}, {sql_extract('one', 'sents', 'idf')}"


SQL_SUMMARY_TEXT = "' ' || COALESCE(string_agg(sentence, ' ' ORDER BY part_no, sent_no), '')"


@query(
    "d06_summaries",
    f"WITH {sql_summary_ctes('documents', 'doc_id')} SELECT doc_id, {SQL_SUMMARY_TEXT} AS summary "
    "FROM documents LEFT JOIN one_kept USING (doc_id) GROUP BY doc_id",
)
def _(t):
    return dc.summaries(t.texts)


@query(
    "d06_contribution_summaries",
    f"""WITH talks AS (SELECT conv_id || '-' || turn AS talk, text FROM conversations),
        {sql_summary_ctes('talks', 'talk')} SELECT talk, {SQL_SUMMARY_TEXT} AS summary
        FROM talks LEFT JOIN one_kept ON talk = doc_id GROUP BY talk""",
)
def _(t):
    """Every contribution to a conversation summarised like a meeting's note."""
    talks = t.conversations.select(F.concat_ws("-", "conv_id", "turn").alias("talk"), "text")
    return dc.summaries(talks, "talk")


SQL_SECOND_LEVEL = f"""twos AS (SELECT doc_id, part_no // 10 AS part_no,
      ROW_NUMBER() OVER (PARTITION BY doc_id, part_no // 10 ORDER BY part_no, sent_no) - 1 AS sent_no, sentence
    FROM one_kept), {sql_extract('two', 'twos', 'idf')}"""


@query(
    "r06_tree_summaries",
    f"WITH {sql_summary_ctes('documents', 'doc_id')}, {SQL_SECOND_LEVEL} "
    f"SELECT doc_id, {SQL_SUMMARY_TEXT} AS summary "
    "FROM documents LEFT JOIN two_kept USING (doc_id) GROUP BY doc_id",
)
def _(t):
    return dc.tree_summaries(t.texts)


# --- personal data -----------------------------------------------------------------------

def sql_spans(source: str, key: str, text: str, patterns: dict[str, str]) -> str:
    parts = []
    for kind, pattern in patterns.items():
        p = sql_text(pattern)
        parts.append(f"""SELECT {key}, '{kind}' AS entity_type, m[i] AS entity,
            CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
                 + COALESCE(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS INTEGER) AS start
          FROM (SELECT {key}, m, g, unnest(generate_series(1, len(m))) AS i FROM (
            SELECT {key}, regexp_extract_all({text}, {p}) AS m, string_split_regex({text}, {p}) AS g FROM {source}))""")
    return f"""SELECT {key}, entity_type, entity, start, CAST(start + length(entity) AS INTEGER) AS "end"
      FROM ({' UNION ALL '.join(parts)})"""


PII_TEXT = sql_rules("text", tx.NEWLINES)
PLACE = r"\p{Lu}[\p{L}\p{N}_]+"


def sql_pii(source: str, key: str, text: str, patterns: dict[str, str]) -> str:
    """All spans of the patterns, and the words that the nations' names list."""
    spans = sql_spans(source, key, text, {**patterns, "LOCATION": PLACE})
    return f"""SELECT * FROM ({spans})
      WHERE entity_type <> 'LOCATION' OR upper(entity) IN (SELECT upper(n_name) FROM nation)"""


SQL_PII = f"pii AS ({sql_pii(f'(SELECT doc_id, {PII_TEXT} AS text FROM documents)', 'doc_id', 'text', pii.PATTERNS)})"


def document_pii(t):
    flat = t.texts.select("doc_id", tx.apply_rules(F.col("text"), tx.NEWLINES).alias("text"))
    return pii.spans_with_places(flat, "doc_id", "text", t.nation.select(F.col("n_name").alias("place")), PLACE)


@query("d07_pii_spans", f"WITH {SQL_PII} SELECT * FROM pii")
def _(t):
    return document_pii(t)


NOTE_PATTERNS = {k: pii.PATTERNS[k] for k in ("EMAIL_ADDRESS", "DATE")}


@query(
    "d07_pii_dates_and_places",
    f"WITH {SQL_NOTES} {sql_pii('notes', 'note_id', 'note', NOTE_PATTERNS)}",
)
def _(t):
    notes = order_notes(t).select("note_id", "note")
    places = t.nation.select(F.col("n_name").alias("place"))
    return pii.spans_with_places(notes, "note_id", "note", places, PLACE, NOTE_PATTERNS)


@query(
    "ub_union_of_entities",
    f"""WITH {SQL_NOTES}, dates AS ({sql_spans('notes', 'note_id', 'note', {'DATE': pii.DATE})}),
        mails AS ({sql_spans('notes', 'note_id', 'note', {'EMAIL_ADDRESS': pii.EMAIL})})
        SELECT note_id, entity_type, entity FROM mails UNION ALL SELECT note_id, entity_type, entity FROM dates""",
)
def _(t):
    notes = order_notes(t).select("note_id", "note")
    mails = pii.spans_of(notes, "note_id", "note", {"EMAIL_ADDRESS": pii.EMAIL})
    dates = pii.spans_of(notes, "note_id", "note", {"DATE": pii.DATE})
    return mails.unionByName(dates).select("note_id", "entity_type", "entity")


@query(
    "d08_pii_counts",
    f"WITH {SQL_PII} SELECT doc_id, entity_type, COUNT(*) AS n, COUNT(DISTINCT entity) AS entities FROM pii GROUP BY ALL",
)
def _(t):
    return document_pii(t).groupBy("doc_id", "entity_type").agg(
        F.count("*").alias("n"), F.count_distinct("entity").alias("entities")
    )


@query("d08_pii_of_one_type", f"WITH {SQL_PII} SELECT * FROM pii WHERE entity_type = 'PHONE_NUMBER'")
def _(t):
    return document_pii(t).where(F.col("entity_type") == "PHONE_NUMBER")


# --- topics --------------------------------------------------------------------------------

SQL_TOPIC_WORDS = f"""{SQL_TERMS}, totals AS (SELECT doc_id, SUM(n) AS nn, COUNT(*) AS vv FROM terms GROUP BY doc_id),
  topic_words AS (SELECT doc_id, CAST(rank AS INTEGER) AS rank, token, round((n + 1) / (nn + vv), 9) AS weight FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY n DESC, token) AS rank FROM terms JOIN totals USING (doc_id))
    WHERE rank <= 10)"""


@query("d09_topic_words", f"WITH {SQL_TOPIC_WORDS} SELECT * FROM topic_words")
def _(t):
    return topics.topic_words(t.texts).withColumn("weight", F.round("weight", 9))


SQL_CLASS_TERMS = f"""{SQL_TERMS}, per_class AS (
    SELECT lang, token, SUM(n) AS n FROM terms JOIN documents USING (doc_id) GROUP BY ALL),
  class_total AS (SELECT lang, SUM(n) AS total FROM per_class GROUP BY lang),
  overall AS (SELECT token, SUM(n) AS f FROM per_class GROUP BY token),
  scored_terms AS (SELECT lang, token, round(n / total * ln(1 + (SELECT SUM(total) / COUNT(*) FROM class_total) / f), 9) AS score
            FROM per_class JOIN class_total USING (lang) JOIN overall USING (token)),
  class_terms AS (SELECT lang, CAST(rank AS INTEGER) AS rank, token, score FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, token) AS rank FROM scored_terms) WHERE rank <= 10)"""


def class_counts(t):
    """Token counts per language, straight from the texts."""
    return term_counts(t.texts, "lang")


@query("d13_class_terms", f"WITH {SQL_CLASS_TERMS} SELECT * FROM class_terms")
def _(t):
    return topics.class_terms(class_counts(t), "lang", 10)


@query(
    "d11_topic_coherence",
    f"""WITH {SQL_CLASS_TERMS},
      hit AS (SELECT doc_id, c.lang, token FROM terms JOIN class_terms c USING (token)),
      one AS (SELECT lang, token, COUNT(*) AS df FROM hit GROUP BY ALL),
      two AS (SELECT a.lang, a.token AS a, b.token AS b, COUNT(*) AS dfab
              FROM hit a JOIN hit b ON a.doc_id = b.doc_id AND a.lang = b.lang AND a.token < b.token GROUP BY ALL),
      n AS (SELECT COUNT(*) AS n FROM documents),
      every AS (SELECT x.lang, x.token AS a, y.token AS b FROM class_terms x JOIN class_terms y
                ON x.lang = y.lang AND x.token < y.token),
      npmi AS (SELECT every.lang, CASE WHEN dfab IS NULL THEN -1
                 ELSE ln((dfab / n) / ((oa.df / n) * (ob.df / n))) / -ln(dfab / n) END AS v
               FROM every CROSS JOIN n LEFT JOIN two USING (lang, a, b)
               LEFT JOIN one oa ON oa.lang = every.lang AND oa.token = a
               LEFT JOIN one ob ON ob.lang = every.lang AND ob.token = b)
      SELECT lang, round(AVG(v), 6) AS coherence FROM npmi GROUP BY lang""",
)
def _(t):
    terms = topics.class_terms(class_counts(t), "lang", 10).select("lang", "token")
    scored = topics.coherence(t.texts.drop("lang"), terms, "lang")
    return scored.withColumn("coherence", F.round("coherence", 6))


@query(
    "d11_window_coherence",
    f"""WITH {SQL_CLASS_TERMS},
      toks AS (SELECT doc_id, list_transform(list_filter({sql_tokens('text')}, lambda w: w NOT IN ({sql_list(STOP_WORDS)})),
                                             lambda w: {sql_lemma('w')}) AS w FROM documents),
      total AS (SELECT SUM(greatest(1, len(w) - 109)) AS windows FROM toks WHERE len(w) > 0),
      pos AS (SELECT doc_id, len(w) AS n, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS p FROM toks),
      cover AS (SELECT DISTINCT doc_id, lang, token, unnest(range(greatest(0, p - 109), least(p, greatest(n - 110, 0)) + 1)) AS s
                FROM pos JOIN class_terms USING (token)),
      one AS (SELECT lang, token, COUNT(*) AS n FROM cover GROUP BY ALL),
      two AS (SELECT a.lang, a.token AS a, b.token AS b, COUNT(*) AS n FROM cover a JOIN cover b USING (doc_id, lang, s) GROUP BY ALL),
      v AS (SELECT x.lang, x.token AS a, y.token AS b,
              ln((coalesce(two.n, 0) / windows + 1e-12) / ((x.n / windows) * (y.n / windows)))
              / -ln(coalesce(two.n, 0) / windows + 1e-12) AS v
            FROM one x JOIN one y ON x.lang = y.lang CROSS JOIN total
            LEFT JOIN two ON two.lang = x.lang AND two.a = x.token AND two.b = y.token),
      s AS (SELECT lang, b, SUM(v) AS s FROM v GROUP BY ALL),
      cosines AS (SELECT lang, a, SUM(v * s) / (sqrt(SUM(v * v)) * sqrt(SUM(s * s))) AS c FROM v JOIN s USING (lang, b) GROUP BY ALL)
      SELECT lang, round(AVG(c), 6) AS coherence FROM cosines GROUP BY lang""",
)
def _(t):
    """The coherence by sliding windows and context vectors of each language's leading words, over all documents."""
    terms = topics.class_terms(class_counts(t), "lang", 10).select("lang", "token")
    scored = topics.window_coherence(t.texts.drop("lang"), terms, "lang")
    return scored.withColumn("coherence", F.round("coherence", 6))


@query(
    "d12_topics_with_summary",
    f"""WITH {SQL_TOPIC_WORDS}, w AS (SELECT doc_id, string_agg(token, ', ' ORDER BY rank) AS words
                                     FROM topic_words GROUP BY doc_id),
        {sql_summary_ctes('documents', 'doc_id')}, s AS (
          SELECT doc_id, {SQL_SUMMARY_TEXT} AS summary FROM documents LEFT JOIN one_kept USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, summary, words FROM s LEFT JOIN w USING (doc_id)""",
)
def _(t):
    words = topics.words_per_topic(topics.topic_words(t.texts), ["doc_id"])
    return dc.summaries(t.texts).join(words, "doc_id", "left")


# --- translation ------------------------------------------------------------------------------

ALNUM_WORDS = sql_words(sql_rules("text", tx.ALPHANUMERIC))
SQL_GLOSSARY = "CASE lower(w) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in GLOSSARY.items()) + " ELSE w END"


@query(
    "d15_translation",
    f"""SELECT doc_id, CASE WHEN len(ws) > 0 THEN ' ' || array_to_string(list_transform(ws, lambda w: {SQL_GLOSSARY}), ' ')
          ELSE '' END AS translation FROM (SELECT doc_id, {ALNUM_WORDS} AS ws FROM documents)""",
)
def _(t):
    return dc.translations(t.texts)
