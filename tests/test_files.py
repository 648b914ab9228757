import io
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerleaf.sources import files
from ledgerleaf.sources.tables import append_table, overwrite_table, read_merged
from ledgerleaf.streaming.ingest import ingest_folder, latest_counts, running_counts


def docx(*paragraphs):
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr(
            "word/document.xml",
            '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main">'
            f"<w:body>{body}</w:body></w:document>",
        )
    return buffer.getvalue()


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.txt").write_text("Grüße, Anna.\nBye.", encoding="utf-8")
    (tmp_path / "b.html").write_text("<p>One</p><p>Two</p>", encoding="utf-8")
    (tmp_path / "c.xml").write_text("banner\n<r><x>1</x><y>two</y></r>", encoding="utf-8")
    (tmp_path / "d.docx").write_bytes(docx("First", "Second &amp; last"))
    (tmp_path / "e.docx").write_bytes(b"no archive")
    (tmp_path / "f.doc").write_bytes(b"old")
    (tmp_path / "g.txt").write_bytes(b"\xff\xfe\xfa")
    (tmp_path / ".hidden.txt").write_text("x")
    (tmp_path / "deep" / "a.txt").write_text("Same name", encoding="utf-8")
    return tmp_path


def test_listing(spark, folder):
    flat = {r.document_name for r in files.list_files(spark, str(folder)).collect()}
    assert flat == {"a.txt", "b.html", "c.xml", "d.docx", "e.docx", "f.doc", "g.txt"}
    assert files.list_files(spark, str(folder), ["txt"], recursive=True).count() == 3


def test_corpus_and_rejects(spark, folder):
    corpus, rejects = files.read_corpus(spark, str(folder), recursive=True)
    texts = {(r.path.split("/")[-2] == "deep", r.document_name): r.text for r in corpus.collect()}
    assert texts == {
        (False, "a.txt"): "Grüße, Anna.\nBye.", (True, "a.txt"): "Same name", (False, "b.html"): "One\n\nTwo",
        (False, "c.xml"): "1 two", (False, "d.docx"): "First\nSecond & last",
    }
    reasons = {r.document_name: r.reason for r in rejects.collect()}
    assert reasons["f.doc"] == "no reader for .doc" and reasons["g.txt"] == "not UTF-8"
    assert reasons["e.docx"].startswith("unreadable")


def test_series_file(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(
        "SNAPSHOT_PERIOD_END;FY;POST_PERIOD;SUM_of_BR_BILLED_AMT;COUNT_BR_NMBR;COUNT_GC_ORG\n"
        "30JUN2016:23:59:59;2016-2017;3;28752739.90;460;118\n"
    )
    row = files.read_series(spark, str(path)).first()
    assert str(row.Timestamp) == "2016-06-30" and row.Revenue == 28752739.90 / 1e6 and row.COUNT_GC_ORG == 118


def test_append_with_growing_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(spark.range(2), path)
    append_table(spark.range(2, 4).withColumn("extra", F.lit("x")), path)
    assert read_merged(spark, path).where("extra is null").count() == 2
    assert overwrite_table(spark.range(1), path).count() == 1


def test_facts_without_context(spark):
    xml = (
        'banner <xbrl><context id="c1"><period><startDate>2022-12-13</startDate><endDate>2022-12-14</endDate></period>'
        '</context><dei:Flag contextRef="c1" id="z">false</dei:Flag><dei:Lost contextRef="c9">1</dei:Lost></xbrl>'
    )
    rows = files.xbrl_facts(spark.createDataFrame([(1, xml)], "id INT, xml STRING"), "id", "xml").collect()
    got = {(r.element, r.value, str(r.start), str(r.end)) for r in rows}
    assert got == {("dei:Flag", "false", "2022-12-13", "2022-12-14"), ("dei:Lost", "1", "None", "None")}


def test_ingest_takes_each_file_once(spark, tmp_path):
    inbox, table, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    inbox.mkdir()
    (inbox / "one.txt").write_text("first")
    ingest_folder(spark, str(inbox), table, state)
    ingest_folder(spark, str(inbox), table, state)
    (inbox / "two.txt").write_text("second\nline")
    ingest_folder(spark, str(inbox), table, state)
    rows = {r.document_name: r.text for r in spark.read.parquet(table).collect()}
    assert rows == {"one.txt": "first", "two.txt": "second\nline"}
    assert spark.read.parquet(table).count() == 2


def test_running_counts_follow_new_rows(spark, tmp_path):
    source, table, state = (str(tmp_path / n) for n in ("rows", "counts", "state"))
    for part in (["a", "a", "b"], ["b", "c"]):
        spark.createDataFrame([(x,) for x in part], "k STRING").write.mode("append").parquet(source)
        stream = spark.readStream.schema("k STRING").parquet(source)
        running_counts(stream, ["k"], table, state)
    assert {(r.k, r.n) for r in latest_counts(spark, table).collect()} == {("a", 2), ("b", 2), ("c", 1)}


def test_odd_extensions_are_read_or_rejected(spark, tmp_path):
    for name in ("a.txt", "B.TXT", "c.htm", "d.HTML", "noextension", "f.md", "e.docm", "g.pdf"):
        (tmp_path / name).write_text("<p>words</p>")
    corpus, rejects = files.read_corpus(spark, str(tmp_path))
    assert {r.document_name for r in corpus.collect()} == {"a.txt", "B.TXT", "c.htm", "d.HTML"}
    assert {r.document_name for r in rejects.collect()} == {"noextension", "f.md", "e.docm", "g.pdf"}


def test_reports_with_instants_and_other_attribute_orders(spark):
    xml = (
        '<context scheme="s" id="i1"><period><instant>2023-01-18</instant></period></context>'
        '<context id="d1"><period><startDate>2022-01-01</startDate><endDate>2022-12-31</endDate></period></context>'
        '<us_gaap2:Cash decimals="0" contextRef="i1">5</us_gaap2:Cash><dei:Name contextRef="d1" id="x">N</dei:Name>'
    )
    df = spark.createDataFrame([(1, xml)], "k int, xml string")
    facts = {r.element: (r.value, str(r.start), str(r.end)) for r in files.xbrl_facts(df, "k", "xml").collect()}
    assert facts == {"us_gaap2:Cash": ("5", "None", "2023-01-18"), "dei:Name": ("N", "2022-01-01", "2022-12-31")}
    assert {r.context for r in files.xbrl_contexts(df, "k", "xml").collect()} == {"i1", "d1"}


def test_reports_with_namespaces_quotes_and_line_ends(spark):
    xml = """<?xml version="1.0" encoding="utf-8"?>
<!DOCTYPE xbrl>
<xbrli:xbrl xmlns:xbrli="http://www.xbrl.org/2003/instance" xmlns:dei="d" xmlns:xsi="x">
<!-- a comment with <dei:Lost contextRef="c1">1</dei:Lost> -->
<xbrli:context
   id='c1'><xbrli:period><xbrli:startDate> 2022-01-01 </xbrli:startDate><xbrli:endDate>2022-12-31</xbrli:endDate></xbrli:period></xbrli:context>
<xbrli:context id="007"><xbrli:period><xbrli:instant>2023-01-18</xbrli:instant></xbrli:period></xbrli:context>
<xbrli:context id="odd"><xbrli:period><xbrli:instant>soon</xbrli:instant></xbrli:period></xbrli:context>
<dei:Name
   contextRef='c1'
   id="z">A &amp; B &lt;x&gt; &#233;</dei:Name><dei:Num decimals="2" contextRef="007">5.10</dei:Num><dei:Num contextRef="c1">0012</dei:Num>
<dei:Nil contextRef="c1" xsi:nil="true"/><dei:Empty contextRef="odd"></dei:Empty><dei:Quote contextRef="c1" note="a>b">say "x='y'"</dei:Quote>
</xbrli:xbrl>"""
    rows = [(1, xml), (2, "no xml <a"), (3, None), (4, ""), (5, "<a><b></a>"), (6, "just words")]
    df = spark.createDataFrame(rows, "k int, xml string")
    facts = sorted((r.k, r.element, r.context, r.value, str(r.start), str(r.end)) for r in files.xbrl_facts(df, "k", "xml").where("value is not null").collect())
    assert facts == [
        (1, "dei:Empty", "odd", "", "None", "None"), (1, "dei:Name", "c1", "A & B <x> é", "2022-01-01", "2022-12-31"),
        (1, "dei:Num", "007", "5.10", "None", "2023-01-18"), (1, "dei:Num", "c1", "0012", "2022-01-01", "2022-12-31"),
        (1, "dei:Quote", "c1", "say \"x='y'\"", "2022-01-01", "2022-12-31"),
    ]
    assert [(r.element, r.context) for r in files.xbrl_facts(df, "k", "xml").where("value is null").collect()] == [("dei:Nil", "c1")]
    contexts = {(r.k, r.context, str(r.start), str(r.end)) for r in files.xbrl_contexts(df, "k", "xml").collect()}
    assert contexts == {(1, "c1", "2022-01-01", "2022-12-31"), (1, "007", "None", "2023-01-18"), (1, "odd", "None", "None")}


def test_reports_are_parsed_once_each(spark):
    """No expression of the plan parses a report, which it did four times a row; odd reports stay as they were."""
    xml = '<context id="c"><period><instant>2020-01-02</instant></period></context><x contextRef="c">'
    rows = [(1, f"{xml} a </x>"), (2, f"{xml}a<b/>c</x>"), (3, f"{xml}<![CDATA[ x<y ]]></x>"), (4, f"{xml}&bad;</x>"), (5, f"{xml}1 <!-- 2 -->3</x>")]
    df = spark.createDataFrame(rows, "k int, xml string")
    facts = files.xbrl_facts(df, "k", "xml")
    assert {r.k: r.value for r in facts.collect()} == {1: " a", 2: '["a","c"]', 3: "x<y ", 5: '[1,"3"]'}
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert "from_xml" not in plan.lower() and "xmltostructs" not in plan.lower() and plan.count("MapInArrow") == 1


def test_files_are_read_once(spark, folder):
    """Corpus and rejects come from one frame with a reason."""
    rows = files.read_files(spark, str(folder), recursive=True).collect()
    assert len(rows) == 8 and all((r.text is None) == (r.reason is not None) for r in rows)
    plan = files.read_files(spark, str(folder), recursive=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("binaryFile") <= 2 and plan.count("MapInPandas") == 1  # one scan, named with its format
