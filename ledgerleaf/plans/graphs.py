"""Knowledge graphs built from personal data spans and from sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerleaf.operators import graph
from ledgerleaf.plans.derived import sql_text
from ledgerleaf.plans.documents import SQL_PII, document_pii
from ledgerleaf.plans.registry import query
from ledgerleaf.plans.texts import sql_sentences

SQL_EDGES = f"""{SQL_PII}, edges AS (SELECT CAST(doc_id AS VARCHAR) AS source, entity AS target, entity_type AS edge FROM pii)"""


def edges_of(t):
    return graph.entity_edges(document_pii(t), "doc_id")


@query("g01_entity_graph", f"WITH {SQL_EDGES} SELECT * FROM edges")
def _(t):
    return edges_of(t)


@query("g02_graph_facet", f"WITH {SQL_EDGES} SELECT * FROM edges WHERE edge = 'EMAIL_ADDRESS'")
def _(t):
    return graph.facet(edges_of(t), "EMAIL_ADDRESS")


SQL_PAIRS = f"""{SQL_EDGES}, pairs AS (SELECT source AS node, target AS neighbour FROM edges
    UNION SELECT target, source FROM edges)"""


@query(
    "g03_adjacency_titles",
    f"""WITH {SQL_PAIRS}, d AS (SELECT node, COUNT(*) AS degree FROM pairs GROUP BY node),
        p AS (SELECT node, degree, neighbour, CAST(('0x' || substr(md5(neighbour), 1, 8)) AS BIGINT)
                % CAST(ceil(degree / 500) AS BIGINT) AS page FROM pairs JOIN d USING (node))
        SELECT node, page, degree, node || ': ' || string_agg(neighbour, '; ' ORDER BY neighbour) AS title
        FROM p GROUP BY node, page, degree""",
)
def _(t):
    return graph.adjacency_titles(edges_of(t))


@query("g03_degrees", f"WITH {SQL_PAIRS} SELECT node, COUNT(*) AS degree FROM pairs GROUP BY node")
def _(t):
    return graph.degrees(edges_of(t))


@query("g04_nodes", f"WITH {SQL_EDGES} SELECT source AS node FROM edges UNION SELECT target FROM edges")
def _(t):
    return graph.nodes(edges_of(t))


@query("g04_weighted_edges", f"WITH {SQL_EDGES} SELECT source, target, edge, COUNT(*) AS n FROM edges GROUP BY ALL")
def _(t):
    return graph.weighted_edges(edges_of(t))


SPAN = sql_text(graph.NAME_SPAN)
SQL_TRIPLES = f"""found AS (SELECT doc_id, sent_no, sentence, regexp_extract_all(sentence, {SPAN}) AS m,
       string_split_regex(sentence, {SPAN}) AS gaps
     FROM (SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS sent_no, unnest(s) AS sentence
           FROM (SELECT doc_id, {sql_sentences('text')} AS s FROM documents))),
  triples AS (SELECT doc_id, sent_no, COALESCE(m[1], '') AS source,
       CASE WHEN len(m) >= 2 THEN m[-1] ELSE '' END AS target,
       CASE WHEN len(m) >= 2 THEN array_to_string(list_filter(string_split(regexp_replace(
            substr(sentence, length(gaps[1]) + length(m[1]) + 1,
                   length(sentence) - length(gaps[1]) - length(m[1]) - length(gaps[-1]) - length(m[-1])),
            '[^\\p{{L}}]+', ' ', 'g'), ' '), lambda w: w <> '')[1:4], ' ') ELSE '' END AS edge
     FROM found)"""


@query("g05_sentence_triples", f"WITH {SQL_TRIPLES} SELECT * FROM triples")
def _(t):
    return graph.triples(t.texts)


@query("g06_triples_by_relation", f"WITH {SQL_TRIPLES} SELECT doc_id, sent_no, source, target FROM triples WHERE edge = 'work is licensed under'")
def _(t):
    return graph.triples(t.texts).where(F.col("edge") == "work is licensed under").select("doc_id", "sent_no", "source", "target")
