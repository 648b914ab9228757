"""Sources, sinks and incremental ingest, run over files that Spark writes from the tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.calendar import fiscal_year, post_period
from ledgerleaf.plans.derived import SQL_BILLED_ORDERS, billed_months, month_totals, sql_fiscal_year, sql_post_period
from ledgerleaf.plans.registry import query
from ledgerleaf.session import shared_dir
from ledgerleaf.sources import files
from ledgerleaf.sources.tables import SCHEMAS, append_table, overwrite_table, read_merged, spread
from ledgerleaf.streaming.ingest import ingest_folder, latest_counts, running_counts
from ledgerleaf.streaming.sessions import ingest_sessions, session_corpus

SQL_SOURCE_CHARS = "SELECT source, CAST(SUM(n_chars + 1) AS BIGINT) AS chars FROM documents GROUP BY source"


def exported_texts(t) -> str:
    """The documents as text files below one folder per source, at most 50 documents to a file."""
    folder = shared_dir(t.spark, "texts")
    docs = t.texts.select("text", "source")
    docs.write.partitionBy("source").option("maxRecordsPerFile", 50).text(folder)
    return folder


def source_of(path):
    return F.regexp_extract(path, "source=([^/]+)/", 1)


@query("s01_folder_listing", "SELECT 'txt' AS extension, CAST(SUM(strlen(text) + 1) AS BIGINT) AS bytes FROM documents")
def _(t):
    """The bytes that a plain listing finds in a folder of all texts, each ended by a line feed."""
    folder = shared_dir(t.spark, "listed")
    t.texts.select("text").write.option("maxRecordsPerFile", 50).text(folder)
    listed = files.list_files(t.spark, folder, extensions=["txt"])
    return listed.groupBy("extension").agg(F.sum("length").alias("bytes"))


@query("s02_recursive_listing", "SELECT DISTINCT source, 'txt' AS extension FROM documents")
def _(t):
    listed = files.list_files(t.spark, exported_texts(t), extensions=["txt"], recursive=True)
    return listed.select(source_of("path").alias("source"), "extension").distinct()


@query("s03_text_files", SQL_SOURCE_CHARS)
def _(t):
    texts = files.read_texts(t.spark, exported_texts(t))
    return texts.groupBy(source_of("path").alias("source")).agg(F.sum(F.length("text")).alias("chars"))


def packed_docx(docs: DataFrame) -> DataFrame:
    """``doc_id, content``: every text as the bytes of a word-processor file, a paragraph per line."""
    head = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>'

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            contents = []
            for text in batch["text"]:
                lines = "".join(f"<w:p><w:r><w:t>{escape(line)}</w:t></w:r></w:p>" for line in text.split("\n"))
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("word/document.xml", f"{head}{lines}</w:body></w:document>")
                contents.append(buffer.getvalue())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "content": contents})

    return docs.select("doc_id", "text").mapInPandas(pack, "doc_id bigint, content binary")


@query("s05_docx_paragraphs", "SELECT doc_id, text FROM documents")
def _(t):
    return files.docx_texts(packed_docx(t.texts), "doc_id").select("doc_id", "text")


REPORT = """concat('This file has no style information.', chr(10), '<xbrl><context id="c', o_orderkey,
  '"><entity><identifier>', o_custkey, '</identifier></entity><period><startDate>', date_format(o_orderdate, 'yyyy-MM-dd'),
  '</startDate><endDate>', date_format(last_day(o_orderdate), 'yyyy-MM-dd'), '</endDate></period></context>',
  '<dei:OrderStatus contextRef="c', o_orderkey, '" id="x">', o_orderstatus, '</dei:OrderStatus>',
  '<dei:Priority contextRef="c', o_orderkey, '">', o_orderpriority, '</dei:Priority></xbrl>')"""


def reports(t):
    return spread(t.orders, "o_orderkey").select("o_orderkey", F.expr(REPORT).alias("xml"))


@query(
    "s07_xbrl_facts",
    """SELECT o_orderkey, element, 'c' || o_orderkey AS context, value, CAST(o_orderdate AS DATE) AS start,
              last_day(o_orderdate) AS "end" FROM (
         SELECT *, 'dei:OrderStatus' AS element, o_orderstatus AS value FROM orders
         UNION ALL SELECT *, 'dei:Priority', o_orderpriority FROM orders)""",
)
def _(t):
    return files.xbrl_facts(reports(t), "o_orderkey", "xml")


NAMESPACED = """concat('<?xml version="1.0"?>', chr(10), '<xbrli:xbrl xmlns:xbrli="http://www.xbrl.org/2003/instance" xmlns:o="http://orders.example.com">',
  '<xbrli:context', chr(10), " id='c", o_orderkey, "'>", '<xbrli:entity><xbrli:identifier scheme="s">', o_custkey, '</xbrli:identifier></xbrli:entity>',
  '<xbrli:period><xbrli:instant>', date_format(o_orderdate, 'yyyy-MM-dd'), '</xbrli:instant></xbrli:period></xbrli:context>',
  '<o:Total', chr(10), chr(9), "decimals='2' contextRef='c", o_orderkey, "'>", cast(cast(o_totalprice as decimal(18,2)) as string), '</o:Total>',
  '<o:Note contextRef="c', o_orderkey, '">', 'R&amp;D &lt;', o_orderpriority, '&gt;</o:Note>',
  '<o:Closed contextRef="c', o_orderkey, '" xsi:nil="true" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"/></xbrli:xbrl>')"""


@query(
    "s07_namespaced_facts",
    """SELECT o_orderkey, element, 'c' || o_orderkey AS context, value, NULL::DATE AS start, CAST(o_orderdate AS DATE) AS "end" FROM (
         SELECT *, 'o:Total' AS element, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS value FROM orders
         UNION ALL SELECT *, 'o:Note', 'R&D <' || o_orderpriority || '>' FROM orders
         UNION ALL SELECT *, 'o:Closed', NULL FROM orders)""",
)
def _(t):
    """Prefixed contexts, single quotes, line ends inside tags, entities, nil facts, amounts with all their digits."""
    docs = spread(t.orders, "o_orderkey").select("o_orderkey", F.expr(NAMESPACED).alias("xml"))
    return files.xbrl_facts(docs, "o_orderkey", "xml")


@query(
    "r07_listed_dates",
    """SELECT day, COUNT(*) AS reports FROM (
         SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
         UNION ALL SELECT o_orderkey, last_day(o_orderdate) FROM orders) GROUP BY day""",
)
def _(t):
    """All dates that the reports' contexts name."""
    contexts = files.xbrl_contexts(reports(t), "o_orderkey", "xml")
    days = contexts.select(F.explode(F.array("start", "end")).alias("day"))
    return days.groupBy("day").agg(F.count("*").alias("reports"))


@query(
    "s08_delimited_series",
    f"""WITH {SQL_BILLED_ORDERS} SELECT last_day(day) AS "Timestamp", {sql_fiscal_year('last_day(day)')} AS "FY",
          {sql_post_period('last_day(day)')} AS "POST_PERIOD", CAST(SUM(billed) AS DOUBLE) / 1e6 AS "Revenue",
          CAST(COUNT(*) AS INTEGER) AS "COUNT_BR_NMBR", CAST(COUNT(DISTINCT c_nationkey) AS INTEGER) AS "COUNT_GC_ORG"
        FROM billed_orders GROUP BY ALL""",
)
def _(t):
    """The monthly facts written as a delimited file in the series format and read again."""
    monthly = billed_months(t).withColumnRenamed("ts", "end").groupBy("end").agg(*month_totals("c_nationkey"))
    monthly = monthly.select(
        "end", F.col("billed").cast("decimal(18,2)").alias("SUM_of_BR_BILLED_AMT"),
        F.col("n_requests").alias("COUNT_BR_NMBR"), F.col("n_orgs").alias("COUNT_GC_ORG"),
    )
    stamp = F.upper(F.date_format(F.col("end").cast("timestamp_ntz") + F.expr("interval '23:59:59' hour to second"), "ddMMMyyyy:HH:mm:ss"))
    rows = monthly.select(
        stamp.alias("SNAPSHOT_PERIOD_END"), fiscal_year(F.col("end")).alias("FY"), post_period(F.col("end")).alias("POST_PERIOD"),
        "SUM_of_BR_BILLED_AMT", "COUNT_BR_NMBR", "COUNT_GC_ORG",
    )
    folder = shared_dir(t.spark, "series")
    rows.write.csv(folder, sep=";", header=True)
    return files.read_series(t.spark, folder)


@query("s11_overwrite_sink", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def _(t):
    path = shared_dir(t.spark, "customers")
    overwrite_table(t.customer.select("c_custkey"), path)
    return overwrite_table(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"), path)


@query(
    "s12_append_with_new_column",
    "SELECT s_suppkey AS id, s_name AS name, NULL::DOUBLE AS balance FROM supplier "
    "UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer",
)
def _(t):
    path = shared_dir(t.spark, "parties")
    append_table(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), path)
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    append_table(customers, path)
    return read_merged(t.spark, path)


@query("s13_persisted_corpus", "SELECT doc_id, text, lang FROM documents")
def _(t):
    return overwrite_table(t.texts.select("doc_id", "text", "lang"), shared_dir(t.spark, "corpus"))


@query("d01_corpus_from_folder", SQL_SOURCE_CHARS)
def _(t):
    rows = files.read_files(t.spark, exported_texts(t), recursive=True)
    whole = rows.select("path", F.coalesce("text", F.lit("")).alias("text"))
    return whole.groupBy(source_of("path").alias("source")).agg(F.sum(F.length("text")).alias("chars"))


@query("st01_incremental_ingest", SQL_SOURCE_CHARS)
def _(t):
    """Two deliveries into one folder, ingested one after the other; nothing is taken twice."""
    folder, table, state = (shared_dir(t.spark, name) for name in ("uploads", "ingested", "ingest-state"))
    docs = t.texts.select("text", "source", (F.col("lang") == "en").alias("english"))
    for english in (True, False):
        part = docs.where(F.col("english") == english).drop("english")
        part.write.mode("append").partitionBy("source").option("maxRecordsPerFile", 50).text(folder)
        ingest_folder(t.spark, folder, table, state)
    corpus = t.spark.read.schema("path STRING, document_name STRING, text STRING").parquet(table)
    return corpus.groupBy(source_of("path").alias("source")).agg(F.sum(F.length("text")).alias("chars"))


@query("s14_upload_sessions", SQL_SOURCE_CHARS)
def _(t):
    """One session per source: its texts arrive in two deliveries, a file of another format completes it."""
    uploads, table, state = (shared_dir(t.spark, name) for name in ("sessions", "session-corpus", "session-state"))
    docs = t.texts.select("text", "source", (F.col("lang") == "en").alias("english"))
    for english in (True, False):
        part = docs.where(F.col("english") == english).drop("english")
        part.write.mode("append").partitionBy("source").option("maxRecordsPerFile", 50).text(uploads)
        if not english:
            docs.select("source").distinct().withColumn("done", F.lit(1)).write.mode("append").partitionBy("source").json(uploads)
        ingest_sessions(t.spark, uploads, table, state, mark=r"\.json$")
    corpus, _rejects = session_corpus(t.spark, table)
    return corpus.groupBy(F.regexp_replace("session", "^source=", "").alias("source")).agg(F.sum(F.length("text")).alias("chars"))


@query("st02_running_counts", "SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY ALL")
def _(t):
    stream = t.spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(t.base)
    table, state = shared_dir(t.spark, "counts"), shared_dir(t.spark, "counts-state")
    running_counts(stream, ["user_id", "event_type"], table, state)
    return latest_counts(t.spark, table)
