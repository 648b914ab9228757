"""Vector search, question answering and attached models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, DoubleType

from ledgerleaf.functions import text as tx
from ledgerleaf.functions.words import STOP_WORDS
from ledgerleaf.operators import inverted_lists, models, pii, postings, retrieval
from ledgerleaf.operators.search import nearest
from ledgerleaf.plans.derived import sql_list, sql_text
from ledgerleaf.plans.documents import sql_spans
from ledgerleaf.plans.registry import ORACLES, query
from ledgerleaf.plans.texts import sql_chunks, sql_sentences, sql_tokens, sql_words
from ledgerleaf.session import checkpointed, shared_dir
from ledgerleaf.sources.tables import overwrite_table

# --- vectors ----------------------------------------------------------------------------


def class_means(t):
    cells = t.embeddings.select("label", F.posexplode("embedding").alias("i", "v"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("c"))
    parts = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "c"))).alias("p"))
    return parts.select(F.col("label").alias("query_id"), F.transform("p", lambda x: x["c"]).alias("vector"))


def stored(t):
    return t.embeddings.select("vec_id", F.col("embedding").alias("vector"))


SQL_MEANS = """flat AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
  m AS (SELECT label, i, AVG(CAST(v AS DOUBLE)) AS c FROM flat GROUP BY label, i),
  q AS (SELECT label, list(c ORDER BY i) AS c FROM m GROUP BY label),
  pairs AS (SELECT q.label AS query_id, e.vec_id, q.c, list_transform(e.embedding, lambda x: CAST(x AS DOUBLE)) AS v
            FROM q, embeddings e)"""


def sql_nearest(distance: str, k: int) -> str:
    return f"""WITH {SQL_MEANS}, d AS (SELECT query_id, vec_id, round({distance}, 6) AS distance FROM pairs)
      SELECT query_id, vec_id, distance, CAST(r AS INTEGER) AS rank FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS r FROM d) WHERE r <= {k}"""


SQL_L2 = "list_sum(list_transform(list_zip(c, v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
SQL_COSINE = "1 - list_cosine_similarity(c, v)"


@query("v03_exact_l2_search", sql_nearest(SQL_L2, 5))
def _(t):
    return nearest(stored(t), "vec_id", class_means(t), "query_id", k=5)


@query("v04_cosine_search", sql_nearest(SQL_COSINE, 5))
def _(t):
    return nearest(stored(t), "vec_id", class_means(t), "query_id", k=5, metric="cosine")


@query("v05_approximate_search")
def _(t):
    return retrieval.approximate_nearest(stored(t), "vec_id", class_means(t), "query_id", k=5)


@query("v05_inverted_lists")
def _(t):
    """The nearest stored vectors of every class mean, from the lists of a persisted index that measurement asks for."""
    path = shared_dir(t.spark, "lists")
    inverted_lists.build_lists(stored(t), "vec_id", path)
    return inverted_lists.search_lists(inverted_lists.open_lists(t.spark, path), class_means(t), "query_id", k=5)


# --- questions -----------------------------------------------------------------------------

STOP = sql_list(STOP_WORDS)
SQL_CONTENT = "list_filter({}, lambda w: w NOT IN (" + STOP + "))"


def sql_bm25(passages: str, k: int) -> str:
    """CTEs from ``passages(doc_id, passage_no, passage)`` to ``best(question_id, doc_id, passage_no, score, rank)``."""
    content = SQL_CONTENT.format(sql_tokens("passage"))
    asked = SQL_CONTENT.format(sql_tokens("text"))
    return f"""passages AS ({passages}),
  pw AS (SELECT doc_id, passage_no, {content} AS w FROM passages),
  stats AS (SELECT COUNT(*) AS n, AVG(len(w)) AS mean FROM pw),
  tok AS (SELECT doc_id, passage_no, len(w) AS length, unnest(w) AS token FROM pw),
  tf AS (SELECT doc_id, passage_no, length, token, COUNT(*) AS tf FROM tok GROUP BY ALL),
  df AS (SELECT token, COUNT(*) AS df FROM tf GROUP BY token),
  asked AS (SELECT DISTINCT item_id AS question_id, token FROM (SELECT item_id, unnest({asked}) AS token FROM benchmark)),
  sc AS (SELECT question_id, doc_id, passage_no, round(SUM(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5
            / (tf + 1.5 * (1 - 0.75 + 0.75 * length / mean))), 6) AS score
         FROM asked JOIN tf USING (token) JOIN df USING (token), stats GROUP BY ALL),
  best AS (SELECT question_id, doc_id, passage_no, score, CAST(r AS INTEGER) AS rank FROM (
     SELECT *, ROW_NUMBER() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id, passage_no) AS r FROM sc)
     WHERE r <= {k})"""


PASSAGES = (
    sql_chunks("documents", "doc_id", sql_words("text"), 600, 20)
    .replace("AS chunk_no", "AS passage_no").replace("AS chunk\n", "AS passage\n")
)
SENTENCES = f"""SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS passage_no, unnest(s) AS passage
  FROM (SELECT doc_id, {sql_sentences('text')} AS s FROM documents)"""
IDS = ["doc_id", "passage_no"]


@query(
    "v02_embedded_chunks",
    f"""SELECT doc_id, passage_no, 256 AS width,
          CASE WHEN len({SQL_CONTENT.format(sql_tokens('passage'))}) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS length
        FROM ({PASSAGES})""",
)
def _(t):
    chunks = retrieval.index_passages(t.texts)
    vectors, _model = retrieval.embedded(chunks)
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    return vectors.select("doc_id", "passage_no", F.size("vector").alias("width"), F.round(F.sqrt(squares), 4).alias("length"))


@query(
    "r01_persisted_index",
    f"SELECT doc_id, COUNT(*) AS passages, CAST(256 * COUNT(*) AS BIGINT) AS cells FROM ({PASSAGES}) GROUP BY doc_id",
)
def _(t):
    """Chunked, embedded, written to the shared folder and read back."""
    vectors, _model = retrieval.embedded(retrieval.index_passages(t.texts))
    index = overwrite_table(vectors.select("doc_id", "passage_no", "passage", "vector"), shared_dir(t.spark, "index"))
    return index.groupBy("doc_id").agg(F.count("*").alias("passages"), F.sum(F.size("vector")).alias("cells"))


@query(
    "r01_inverted_index",
    f"""SELECT token, COUNT(*) AS df FROM (
          SELECT DISTINCT doc_id, passage_no, unnest({SQL_CONTENT.format(sql_tokens('passage'))}) AS token FROM ({PASSAGES}))
        GROUP BY token""",
)
def _(t):
    """Every word of the passages with the number of passages that hold it, read from the written index alone."""
    path = shared_dir(t.spark, "postings")
    retrieval.index_of(retrieval.index_passages(t.texts), IDS, "passage", path)
    return postings.document_frequencies(postings.open_index(t.spark, path))


def found_passages(t, k):
    passages = retrieval.index_passages(t.texts)
    return retrieval.ranked_passages(passages, IDS, "passage", t.benchmark, "item_id", "text", k)


def found_texts(t, k):
    """The found passages with their texts; only documents that were found are cut again."""
    found = checkpointed(found_passages(t, k))
    docs = t.texts.join(found.select("doc_id").distinct(), "doc_id", "left_semi")
    return retrieval.index_passages(docs), found


@query("r02_passages_per_question", f"WITH {sql_bm25(PASSAGES, 3)} SELECT * FROM best")
def _(t):
    return found_passages(t, 3)


@query(
    "r03_best_sentence",
    f"""WITH {sql_bm25(SENTENCES, 1)} SELECT question_id, doc_id, passage AS answer, score,
          CAST(strpos(text, passage) - 1 AS INTEGER) AS start, CAST(strpos(text, passage) - 1 + length(passage) AS INTEGER) AS "end"
        FROM best JOIN passages USING (doc_id, passage_no) JOIN documents USING (doc_id)""",
)
def _(t):
    """The best sentence per question, cut out of its text with offsets."""
    sentences = retrieval.sentence_passages(t.texts)
    best = retrieval.ranked_passages(sentences, IDS, "passage", t.benchmark, "item_id", "text", 1)
    rows = best.join(t.documents.select("doc_id", "text"), "doc_id")
    answer = F.get(tx.sentences(F.col("text")), F.col("passage_no"))
    rows = rows.select("question_id", "doc_id", answer.alias("answer"), "score", "text")
    start = F.instr("text", F.col("answer")) - 1
    spans = rows.withColumn("start", start)
    return spans.select(
        "question_id", "doc_id", "answer", "score", "start", (F.col("start") + F.length("answer")).alias("end")
    )


BEFORE, BETWEEN, AFTER = (
    retrieval.PROMPT.split("{context}")[0],
    retrieval.PROMPT.split("{context}")[1].split("{question}")[0],
    retrieval.PROMPT.split("{question}")[1],
)
SQL_CONTEXT = "string_agg(passage, chr(10) || chr(10) ORDER BY rank)"
SQL_PROMPTS = f"""prompts AS (SELECT question_id, {sql_text(BEFORE)} || context || {sql_text(BETWEEN)} || text || {sql_text(AFTER)} AS prompt
  FROM (SELECT question_id, {SQL_CONTEXT} AS context FROM best JOIN passages USING (doc_id, passage_no) GROUP BY question_id)
  JOIN benchmark ON item_id = question_id)"""


def prompts_of(t, k=2):
    passages, found = found_texts(t, k)
    questions = t.benchmark.select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))
    joined = retrieval.contexts(found, passages, IDS).join(questions, "question_id")
    prompt = retrieval.filled_prompt(F.col("context"), F.col("question"))
    return joined.select("question_id", prompt.alias("prompt"))


@query("r04_stuffed_prompts", f"WITH {sql_bm25(PASSAGES, 2)}, {SQL_PROMPTS} SELECT * FROM prompts")
def _(t):
    return prompts_of(t)


@query(
    "f27_prompt_template",
    """SELECT conv_id, turn, 'You are the ' || role || '. Reply to: ' || text || chr(10) || 'Reply:' AS prompt
       FROM conversations""",
)
def _(t):
    template = "You are the {context}. Reply to: {question}\nReply:"
    prompt = retrieval.filled_prompt(F.col("role"), F.col("text"), template)
    return t.conversations.select("conv_id", "turn", prompt.alias("prompt"))


SQL_ANSWERS = """SELECT question_id, '<article><h1>' || b.text || '</h1><blockquote>' || arg_min(passage, rank)
    || '</blockquote><table>' || string_agg('<tr><th>' || doc_id || '</th><td>' || passage || '</td></tr>', '' ORDER BY rank)
    || '</table></article>' AS answer_html
  FROM best JOIN passages USING (doc_id, passage_no) JOIN benchmark b ON item_id = question_id GROUP BY question_id, b.text"""


@query("r05_answers_with_sources", f"WITH {sql_bm25(PASSAGES, 2)} {SQL_ANSWERS}")
def _(t):
    """Without an attached generator the best passage is the answer."""
    passages, found = found_texts(t, 2)
    texts = found.join(passages, IDS).groupBy("question_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "passage", "doc_id"))).alias("p")
    )
    questions = t.benchmark.select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))
    page = retrieval.answer_html(
        F.col("question"), F.col("p")[0]["passage"], F.transform("p", lambda x: x["passage"]), F.transform("p", lambda x: x["doc_id"])
    )
    return texts.join(questions, "question_id").select("question_id", page.alias("answer_html"))


@query(
    "f28_answer_pages",
    """SELECT a.conv_id, a.turn, '<article><h1>' || a.text || '</h1><blockquote>' || b.text
         || '</blockquote><table><tr><th>' || b.turn || '</th><td>' || b.text || '</td></tr></table></article>' AS page
       FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
)
def _(t):
    """Each contribution as a question, the next one as its answer and source."""
    reply = t.conversations.select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("turn").alias("source"), F.col("text").alias("answer")
    )
    pairs = t.conversations.join(reply, ["conv_id", "turn"])
    page = retrieval.answer_html(F.col("text"), F.col("answer"), F.array("answer"), F.array("source"))
    return pairs.select("conv_id", "turn", page.alias("page"))


# --- attached models --------------------------------------------------------------------------

def vowel_classifier():
    """Stands for a loaded classifier: texts with at least 40 % vowels among their characters are OPEN."""

    def predict(texts: np.ndarray) -> dict[str, np.ndarray]:
        flat = [str(x) for x in np.ravel(texts)]
        share = np.array([sum(c in "aeiou" for c in s.lower()) / max(1, len(s)) for s in flat])
        return {"label": np.where(share >= 0.4, "OPEN", "CLOSED"), "score": share}

    return predict


def echo_generator():
    """Stands for a loaded generator: repeats the prompt, answers and runs on past its stop mark."""

    def predict(prompts: np.ndarray) -> np.ndarray:
        return np.array([f"{p} Noted.<stop> And more." for p in np.ravel(prompts)], dtype=object)

    return predict


CLASSES = StructType([StructField("label", StringType()), StructField("score", DoubleType())])


@query(
    "u01_plugged_classifier",
    """SELECT doc_id, CASE WHEN share >= 0.4 THEN 'OPEN' ELSE 'CLOSED' END AS label, round(share, 6) AS score
       FROM (SELECT doc_id, len(regexp_extract_all(lower(text), '[aeiou]')) / greatest(1, length(text)) AS share FROM documents)""",
)
def _(t):
    classify = models.batch_model(vowel_classifier, CLASSES)
    scored = t.texts.select("doc_id", classify("text").alias("p"))
    return scored.select("doc_id", "p.label", F.round("p.score", 6).alias("score"))


@query("u01_plugged_generator", "SELECT conv_id, turn, ' Noted.' AS reply FROM conversations")
def _(t):
    generate = models.batch_model(echo_generator, StringType())
    answered = t.conversations.select("conv_id", "turn", "text", generate("text").alias("raw"))
    reply = models.cut_at_stop(models.without_prompt(F.col("raw"), F.col("text")), ["<stop>", "###"])
    return answered.select("conv_id", "turn", reply.alias("reply"))


TASK_TEXTS = {
    "sentiment-analysis": ("sentences", ORACLES["d02_sentence_sentiment"]),
    "summarization": ("summary", ORACLES["d06_summaries"]),
    "translation": ("translation", ORACLES["d15_translation"]),
    "token-classification": ("entity", sql_spans("documents", "doc_id", "text", pii.PATTERNS)),
}


@query(
    "u02_registered_tasks",
    " UNION ALL ".join(
        f"SELECT '{task}' AS task, COUNT(*) AS n, CAST(COALESCE(SUM(length({column})), 0) AS BIGINT) AS chars FROM ({sql})"
        for task, (column, sql) in TASK_TEXTS.items()
    ),
)
def _(t):
    """Every registered task run by name over all documents: its rows, and the characters of what it found or wrote."""
    docs = checkpointed(t.texts.select("doc_id", "text"))
    counted = None
    for name in TASK_TEXTS:
        chars = F.coalesce(F.sum(F.length(TASK_TEXTS[name][0])), F.lit(0)).alias("chars")
        one = models.run_task(name, docs).agg(F.lit(name).alias("task"), F.count("*").alias("n"), chars)
        counted = one if counted is None else counted.unionByName(one)
    return counted
