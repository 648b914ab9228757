"""Folders of documents and delimited files as DataFrames."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from xml.etree import ElementTree
from xml.parsers import expat

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.functions import text as tx
from ledgerleaf.session import checkpointed

EXTENSIONS = ("docx", "docm", "doc", "pdf", "html", "htm", "txt", "xml")
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _files(spark: SparkSession, path: str, extensions: Sequence[str] | None, recursive: bool) -> DataFrame:
    """Files with one of the extensions, in upper or lower case, or all of them."""
    either = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in extensions or ()]
    glob = "*" if extensions is None else "*.{" + ",".join(either) + "}"
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", str(recursive).lower()).load(path)


def _name_columns() -> list[Column]:
    name = F.element_at(F.split("path", "/"), -1)
    return [name.alias("document_name"), F.lower(F.element_at(F.split(name, r"\."), -1)).alias("extension")]


def list_files(
    spark: SparkSession, path: str, extensions: Sequence[str] = EXTENSIONS, recursive: bool = False
) -> DataFrame:
    """``path, document_name, extension, length``; hidden files are left out and contents are not read."""
    return _files(spark, path, extensions, recursive).select("path", *_name_columns(), "length")


def read_texts(spark: SparkSession, path: str, pattern: str = "*.txt", recursive: bool = True) -> DataFrame:
    """``path, document_name, text``: one row per UTF-8 file."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    rows = reader.text(path, wholetext=True)
    return rows.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("document_name"),
        F.col("value").alias("text"),
    )


def docx_paragraphs(content: bytes) -> str:
    """The paragraphs of a word-processor file, one per line."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        root = ElementTree.fromstring(archive.read("word/document.xml"))
    return "\n".join("".join(t.text or "" for t in p.iter(f"{_WORD}t")) for p in root.iter(f"{_WORD}p"))


def docx_texts(files: DataFrame, key: str = "path") -> DataFrame:
    """``key, text, reason`` of ``key, content`` rows; an unreadable file has a reason instead of a text."""

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch[key], batch["content"]):
                try:
                    rows.append((name, docx_paragraphs(content), None))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as error:
                    rows.append((name, None, f"unreadable: {type(error).__name__}"))
            yield pd.DataFrame(rows, columns=[key, "text", "reason"])

    kind = files.schema[key].dataType.simpleString()
    return files.select(key, "content").mapInPandas(extract, f"{key} {kind}, text string, reason string")


def read_files(spark: SparkSession, path: str, profile: str = "none", recursive: bool = False) -> DataFrame:
    """``path, document_name, text, reason`` of every file of a folder, in one pass over the contents.

    A file that is read has a text, any other one a reason.
    """
    return extracted(_files(spark, path, None, recursive).select("path", *_name_columns(), "content"), profile)


def extracted(files: DataFrame, profile: str = "none", keep: Sequence[str] = ()) -> DataFrame:
    """``path, document_name, keep…, text, reason`` of rows with ``path, document_name, extension, content``.

    Formats without a reader and files that do not decode have a reason instead of a text. Word-processor
    files pass the workers, others do not; no content is read twice.
    """
    plain = F.col("content").cast("string")
    kind = F.col("extension")
    text = F.when(kind == "txt", plain).when(kind.isin("html", "htm"), tx.strip_markup(plain)).when(
        kind == "xml", tx.xml_text(plain)
    )
    word_file = kind.isin("docx", "docm")
    reason = F.when(~kind.isin("txt", "html", "htm", "xml"), F.concat(F.lit("no reader for ."), kind)).when(
        ~F.is_valid_utf8(plain), F.lit("not UTF-8")
    )
    others = files.select(
        "path", "document_name", *keep, F.when(word_file, F.col("content")).alias("content"),
        F.when(~word_file & reason.isNull(), text).alias("text"), F.when(~word_file, reason).alias("reason"),
    )

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in batch.index[batch["content"].notna()]:
                try:
                    batch.at[i, "text"] = docx_paragraphs(batch.at[i, "content"])
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as error:
                    batch.at[i, "reason"] = f"unreadable: {type(error).__name__}"
            yield batch.drop(columns="content")

    rows = others.mapInPandas(extract, others.drop("content").schema)
    return rows.withColumn("text", F.when(F.col("reason").isNull(), tx.clean_text(F.col("text"), profile)))


def read_corpus(
    spark: SparkSession, path: str, profile: str = "none", recursive: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(corpus, rejects)`` of a folder: ``path, document_name, text`` and ``path, document_name, reason``.

    Every file lands in exactly one of the two. Formats without a reader and
    files that do not decode are rejected with a reason. The files are read once for both.
    """
    rows = checkpointed(read_files(spark, path, profile, recursive))
    corpus = rows.where(F.col("reason").isNull()).select("path", "document_name", "text")
    return corpus, rows.where(F.col("reason").isNotNull()).select("path", "document_name", "reason")


# The columns of the delimited series format.
SERIES_SCHEMA = (
    "SNAPSHOT_PERIOD_END STRING, FY STRING, POST_PERIOD INT, SUM_of_BR_BILLED_AMT DECIMAL(18,2), "
    "COUNT_BR_NMBR INT, COUNT_GC_ORG INT"
)


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """Monthly series from ``;``-separated files: ``Timestamp, Revenue`` (millions) and counts."""
    rows = spark.read.csv(path, sep=";", header=True, schema=SERIES_SCHEMA)
    day = F.to_date(F.to_timestamp("SNAPSHOT_PERIOD_END", "ddMMMyyyy:HH:mm:ss"))
    return rows.select(
        day.alias("Timestamp"), "FY", "POST_PERIOD",
        (F.col("SUM_of_BR_BILLED_AMT").cast("double") / 1e6).alias("Revenue"), "COUNT_BR_NMBR", "COUNT_GC_ORG",
    )


# --- business reports in XML -----------------------------------------------------

# Put before every text and attribute value, whose leading blanks then stay; removed from all results.
_MARK = "\ue000"
_ROOT = "report"
_HEAD = re.compile(r"^[^<]+|<\?.*?\?>|<!DOCTYPE[^>\[]*(\[[^\]]*\])?[^>]*>", re.S)
_LAST_TEXT = re.compile(">([^<>]*)</")
_QUOTED = re.compile("=([ \t\r\n]*[\"'])")
_NUMBER = re.compile("-?(0|[1-9][0-9]*)")
_BLANKS = "".join(map(chr, range(33)))
# Reports handed back to Spark at a time.
REPORTS_OUT = 1024


class _Element:
    __slots__ = ("name", "attributes", "children", "texts")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children, self.texts = name, attributes, [], []

    @property
    def local(self) -> str:
        return self.name.rpartition(":")[2]

    def attribute(self, name: str) -> str | None:
        value = self.attributes.get(name)
        return None if value is None else value.strip(_BLANKS).replace(_MARK, "")

    def below(self) -> list[_Element]:
        """The elements inside, by name and then in their order."""
        return sorted(self.children, key=lambda e: e.name)

    def text(self) -> str | None:
        """Null where there is neither a text nor an end tag of its own; several texts, cut by elements or comments,
        are a JSON array."""
        found = [x for x in (t.strip(_BLANKS) for t in self.texts) if x]
        if len(found) < 2:
            return found[0].replace(_MARK, "") if found else None
        return "[" + ",".join(x if _NUMBER.fullmatch(x) else json.dumps(x.replace(_MARK, ""), ensure_ascii=False) for x in found) + "]"

    def first(self, *names: str) -> _Element | None:
        return next((e for e in self.below() if e.local in names), None)


def report_elements(content: bytes | None) -> list[_Element]:
    """The elements of a report and those of its root element, which may be missing.

    What stands before the first element and instructions do not count. A report that is null or no well-formed XML
    has none.
    """
    xml = "" if content is None else content.decode("utf-8", "replace")
    if "<" not in xml:
        return []
    body = _QUOTED.sub(f"=\\1{_MARK}", _LAST_TEXT.sub(f">{_MARK}\\1</", _HEAD.sub("", xml)))
    top = _Element(_ROOT, {})
    open_elements = [top]
    joined = False

    def cut(*_event) -> None:
        nonlocal joined
        joined = False

    def start(name: str, attributes: dict[str, str]) -> None:
        element = _Element(name, attributes)
        open_elements[-1].children.append(element)
        open_elements.append(element)
        cut()

    def end(_name: str) -> None:
        open_elements.pop()
        cut()

    def characters(text: str) -> None:
        nonlocal joined
        texts = open_elements[-1].texts
        if joined:
            texts[-1] += text
        else:
            texts.append(text)
        joined = True

    parser = expat.ParserCreate("utf-8")
    parser.buffer_text = True
    parser.StartElementHandler = start
    parser.EndElementHandler = end
    parser.CharacterDataHandler = characters
    parser.CommentHandler = cut
    try:
        parser.Parse(f"<{_ROOT}>{body}</{_ROOT}>".encode("utf-8", "replace"), True)
    except expat.ExpatError:
        return []
    outer = top.children[0].below()
    return outer + [e for o in outer for e in o.below()]


def _period(context: _Element) -> tuple[str | None, str | None]:
    """First and last day of a reporting context as texts; a point in time has an end only."""
    period = context.first("period")
    days = [period and period.first("startDate"), period and period.first("endDate", "instant")]
    return tuple(d and d.text() for d in days)


def _contexts(elements: list[_Element]) -> list[tuple]:
    named = [(e.attribute("id"), e) for e in elements if e.local == "context"]
    return [(i, *_period(e)) for i, e in named if i is not None]


def _facts(elements: list[_Element]) -> list[tuple]:
    periods: dict[str, tuple] = {}
    # A context id is unique in a report by definition; a repeated one keeps its first period.
    for i, *days in _contexts(elements):
        periods.setdefault(i, tuple(days))
    facts = [(e, e.attribute("contextRef")) for e in elements]
    return [(e.name, c, e.text(), *periods.get(c, (None, None))) for e, c in facts if c is not None]


def _read_reports(docs: DataFrame, key: str, xml: str, listed: Callable[[list[_Element]], list[tuple]], *names: str) -> DataFrame:
    """``key, names…, start, end``: what ``listed`` finds in each report, which is parsed once; nothing is shuffled."""
    rows = docs.select(key, F.col(xml).cast("binary").alias("_xml"))
    schema = rows.drop("_xml").schema
    for name in (*names, "start", "end"):
        schema = schema.add(name, "string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, REPORTS_OUT):
                part = batch.slice(begin, REPORTS_OUT)
                at, found = [], []
                for i, content in enumerate(part.column(1).to_pylist()):
                    own = listed(report_elements(content))
                    at += [i] * len(own)
                    found += own
                columns = list(zip(*found)) or [()] * (len(names) + 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, pa.string()) for c in columns]], schema.names
                )

    day = lambda name: F.try_to_date(F.trim(F.col(name))).alias(name)
    return rows.mapInArrow(read, schema).select(key, *names, day("start"), day("end"))


def xbrl_contexts(docs: DataFrame, key: str, xml: str) -> DataFrame:
    """``key, context, start, end`` of every reporting context; a date that cannot be read is null.

    A report that is null or no well-formed XML has none.
    """
    return _read_reports(docs, key, xml, _contexts, "context")


def xbrl_facts(docs: DataFrame, key: str, xml: str) -> DataFrame:
    """``key, element, context, value, start, end``: facts with their context's period.

    Contexts and facts of one report meet inside its row, so nothing is shuffled. An empty fact has an empty
    value, a nil one null. A report that is null or no well-formed XML has no facts.
    """
    return _read_reports(docs, key, xml, _facts, "element", "context", "value")
