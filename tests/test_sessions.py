"""Upload sessions against the batch reader."""

import io
import os
import zipfile

import pytest

from ledgerleaf.sources import files
from ledgerleaf.streaming.sessions import closed_sessions, ingest_sessions, session_corpus

START = 1_700_000_000


def docx(*paragraphs):
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr(
            "word/document.xml",
            f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>',
        )
    return buffer.getvalue()


def put(path, content, at):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    os.utime(path, (START + at, START + at))


@pytest.fixture
def place(tmp_path):
    return tmp_path / "uploads", str(tmp_path / "table"), str(tmp_path / "state")


def rows_of(frame, column):
    return sorted((r.path.split("/uploads/")[-1], r[column]) for r in frame.collect())


def batch(spark, uploads, sessions):
    corpus, rejects = [], []
    for s in sessions:
        c, r = files.read_corpus(spark, str(uploads / s), recursive=True)
        corpus += rows_of(c.where("document_name <> 'complete.txt'"), "text")
        rejects += rows_of(r, "reason")
    return sorted(corpus), sorted(rejects)


def test_two_sessions_equal_the_batch_reader(spark, place):
    uploads, table, state = place
    run = lambda: ingest_sessions(spark, str(uploads), table, state)
    for i in range(14):  # more than ten files in one delivery
        put(uploads / "ann" / f"note{i}.txt", f"note {i}", i)
    put(uploads / "ann" / "deep" / "page.html", "<p>One</p><p>Two</p>", 20)
    put(uploads / "ann" / "letter.docx", docx("First", "Last"), 21)
    put(uploads / "ann" / "broken.docx", b"no archive", 22)
    put(uploads / "ann" / "bad.txt", b"\xff\xfe\xfa", 23)
    put(uploads / "ann" / "old.doc", b"x", 24)
    put(uploads / "bob" / "report.xml", "banner\n<r><x>1</x><y>two</y></r>", 25)
    put(uploads / "stray.txt", "belongs to nobody", 26)
    run()
    assert closed_sessions(spark, table).count() == 0
    assert [f.count() for f in session_corpus(spark, table)] == [0, 0]

    put(uploads / "ann" / "late but in time.txt", "still open", 30)
    put(uploads / "ann" / "complete.txt", "done", 40)
    run()
    run()  # nothing new: nothing is taken or closed twice
    closed = {r.session: (r.files, r.reason) for r in closed_sessions(spark, table).collect()}
    assert closed == {"ann": (20, "mark")}
    corpus, rejects = session_corpus(spark, table)
    assert (rows_of(corpus, "text"), rows_of(rejects, "reason")) == batch(spark, uploads, ["ann"])
    assert len(rows_of(corpus, "text")) == 17 and len(rows_of(rejects, "reason")) == 3

    put(uploads / "bob" / "more.txt", "more of bob", 50)
    put(uploads / "bob" / "complete.txt", "done", 60)
    put(uploads / "ann" / "too late.txt", "after the mark", 70)
    run()
    corpus, rejects = session_corpus(spark, table)
    want, refused = batch(spark, uploads, ["ann", "bob"])
    want.remove(("ann/too late.txt", "after the mark"))
    assert rows_of(corpus, "text") == want
    assert rows_of(rejects, "reason") == sorted([*refused, ("ann/too late.txt", "after the session was closed")])
    assert closed_sessions(spark, table).count() == 2


def test_a_silent_session_is_closed(spark, place):
    uploads, table, state = place
    put(uploads / "ann" / "a.txt", "a", 0)
    ingest_sessions(spark, str(uploads), table, state, silence="10 minutes")
    put(uploads / "bob" / "b.txt", "b", 300)
    ingest_sessions(spark, str(uploads), table, state, silence="10 minutes")
    assert closed_sessions(spark, table).count() == 0
    put(uploads / "bob" / "c.txt", "c", 1200)  # time has passed: the first session has been silent for too long
    ingest_sessions(spark, str(uploads), table, state, silence="10 minutes")
    put(uploads / "cyd" / "d.txt", "d", 1300)
    ingest_sessions(spark, str(uploads), table, state, silence="10 minutes")
    closed = {r.session: (r.files, r.reason, int(r.closed.timestamp())) for r in closed_sessions(spark, table).collect()}
    assert {k: v[:2] for k, v in closed.items()} == {"ann": (1, "silence")}
    corpus, _ = session_corpus(spark, table)
    assert rows_of(corpus, "text") == [("ann/a.txt", "a")]


def test_a_repeated_batch_changes_nothing(spark, place, monkeypatch):
    """A run that dies after its files were written, before that was noted, writes the same batch again."""
    uploads, table, state = place
    put(uploads / "ann" / "a.txt", "a", 0)
    put(uploads / "ann" / "complete.txt", "done", 1)
    ingest_sessions(spark, str(uploads), table, state)
    for d in ("files", "closed"):
        commits = os.path.join(state, d, "commits")
        last = max(f for f in os.listdir(commits) if f.isdigit())
        for name in (last, f".{last}.crc"):
            if os.path.exists(os.path.join(commits, name)):
                os.remove(os.path.join(commits, name))
    ingest_sessions(spark, str(uploads), table, state)
    corpus, rejects = session_corpus(spark, table)
    assert rows_of(corpus, "text") == [("ann/a.txt", "a")] and rejects.count() == 0
    assert closed_sessions(spark, table).count() == 1
