"""Quality measures and personal data against plain Python."""

import collections
import hashlib
import re
import textwrap
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerleaf.llm import licences, personal, quality, queries

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    grams = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


ODD = [None, "", " \n ", "a b c a b c", "a a a a", "é ü 😀😀 x\r\ny\r\ny", "# * $ % & | < >", "x " * 3000 + "\n" * 40]


def test_measures_equal_plain_python(spark, sf_dir):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = [(i, t, "en" if i % 2 else None, "s", 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    for r in quality.quality_report(df).collect():
        want = measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_fences_follow_the_group(spark):
    """Where symbols are usual they are kept, where they are not they are rejected."""
    def text(i, symbols):
        return " ".join(f"w{i}x{j}" + ("#" if symbols and j % 2 else "") for j in range(80))

    rows = [(i, text(i, True), "en", "code") for i in range(60)] + [(100 + i, text(i, i == 0), "en", "news") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.quality_report(df).collect()}
    assert [d for d, k in kept.items() if not k] == [100]
    wide = df.withColumn("_m", F.lit(1)).withColumn("_row", F.lit(2))
    good = quality.keep_good(wide)
    assert good.columns == wide.columns and good.count() == 119


def test_every_fence_follows_the_upper_tail(spark):
    """Two sources that differ in the upper tail of every measure, though not in its median, have different upper fences."""
    def text(i, odd):
        words = [f"w{i}x{j}" for j in range(90)]
        lines = [" ".join(words[j : j + 6]) for j in range(0, 90, 6)]
        if odd:
            lines += ["# $ & #"] * 6 + ["one two three four five"] * 3 + [" ".join("verylongwordindeed" + str(j) for j in range(40))]
        return "\n".join(lines)

    # An eighth of the rows of the second source are odd: above its median, at its upper decile.
    rows = [(i, text(i, i >= 100 and i % 8 == 0), "en", "news" if i < 100 else "code") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    fence = {r.source: r.fence for r in quality.fences(quality.measured(df), "lang", "source").collect()}
    for measure in quality.SLACK:
        assert fence["code"][measure]["upper"] > fence["news"][measure]["upper"], measure
    assert all(fence["news"][m]["upper"] == s for m, s in quality.SLACK.items() if m != "word_length")


def test_fences_differ_between_groups_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(16)
    table = quality.fences(quality.stored(quality.measured(docs).drop("text"), "measures"), "lang", "source").collect()
    for measure in quality.SLACK:
        assert len({r.fence[measure]["upper"] for r in table}) > 1, measure


def test_very_long_texts(spark):
    rnd = "".join(chr(97 + i * i % 26) for i in range(40))
    texts = ["x" * 2_000_000, " ".join(rnd[i % 30 :] + str(i) for i in range(200_000)), "#" * 100_000 + "\n" * 100_000]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for r in quality.quality_report(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measures(texts[r.doc_id])


def test_clean_documents_are_kept_and_junk_goes(spark):
    base = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op8_quality_rules"](spark, base).collect() if not r.base_failed]
    wrong = [r.doc_id for r in rows if r.doc_id in labels and r.kept != (labels[r.doc_id] == 1)]
    assert len(wrong) <= 2


EXACT = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def exact_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in EXACT for m in p.finditer(text or "") if passes(k, m[0])]


MIXED = [
    None, "", "a@b.com_x@y.com", "x@y", "a.b@c.d.e@f.g", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.0004 255.255.255.255",
    "4111 1111 1111 1111, 4111111111111112", "+49 (30) 1234-567.8", "+1+2 333", "é😀 mail ü@x.de é.e@x-y.fr 1.2.3.4", "7" * 4000 + " @",
    "+1 (017) 555-7713 and (017) 555-7713", "call me: (555) 123-4567 or jane (at) site (dot) org today", "1..2.3.4 " * 50,
]


def test_exact_spans_and_counts(spark, sf_dir):
    texts = MIXED + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, _spans int").drop("_spans")
    for r in personal.personal_data(df).collect():
        want = exact_spans(texts[r.doc_id])
        found = [f"{personal.KINDS[s.kind]}:{s.start}:{s.end}" for s in r.spans if s.exact]
        assert found == want, texts[r.doc_id]


def test_query_digest(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.QUERIES["op10_personal_data"](spark, sf_dir).collect():
        want = exact_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w.startswith(k) for w in want) for k, _ in EXACT)
        assert set(want) <= set(r.spans.split(","))


def test_supervision_adds_what_the_labelers_agree_on(spark):
    near = [(i, f"please call our phone (555) 123-45{i:02d} or write to contact jane{i} (at) site (dot) org") for i in range(40)]
    near += [(100 + i, f"card 4111 1111 1111 1111 mail x{i}@y.com phone +1 555 123 45{i:02d} ip 10.0.0.{i}") for i in range(40)]
    df = spark.createDataFrame([*near, (300, None)], "doc_id long, text string")
    found = {r.doc_id: r.spans for r in personal.personal_data(df).collect()}
    assert {personal.KINDS[s.kind] for s in found[0]} == {"email", "phone"} and not any(s.exact for s in found[0])
    assert len(found[100]) >= 4 and found[300] == []
    clean = {r.doc_id: r.text for r in personal.redacted(df.withColumn("_row", F.lit(1))).collect()}
    assert clean[0] == "please call our phone <PHONE> or write to contact <EMAIL>" and clean[300] is None


def test_false_forms_are_rejected_and_loose_ones_found(spark):
    """Every kind has candidates that are right and such that are wrong; the classifier tells them apart."""
    def number(i, digits):
        return str(7 * 10 ** (digits - 1) + i * 7919 + 13)[:digits]

    rows = []
    for i in range(60):
        rows += [
            (f"right{i}", f"please call our phone (555) 423-45{i:02d} or write to contact jane{i} (at) site (dot) org, card 4111.1111.1111.1111"),
            (f"order{i}", f"see order {number(i, 10)} and invoice {number(i, 11)}, serial {number(i, 16)} of the lot"),
            (f"version{i}", f"upgrade from version 300.{i}.2.1 to release 4.{i}.999.1 soon, build 0123456789"),
            (f"exact{i}", f"mail x{i}@y.com phone +1 555 423 45{i:02d} ip 10.20.30.{i + 10} card 4111 1111 1111 1111"),
        ]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    marked = personal.spotted(df).cache()
    tried = collections.Counter((r.doc_id.rstrip("0123456789"), s.kind) for r in marked.collect() for s in r._spans)
    assert tried["order", 3] >= 100 and tried["order", 2] >= 30 and tried["version", 1] >= 100
    found = {r.doc_id: r.spans for r in personal.personal_data(df).collect()}
    for i in range(60):
        assert {personal.KINDS[s.kind] for s in found[f"right{i}"]} >= {"phone", "email"}
        assert not [s for s in found[f"order{i}"] + found[f"version{i}"] if not s.exact]
        assert [personal.KINDS[s.kind] for s in found[f"exact{i}"]] == ["email", "ip", "card", "phone"]


def test_classifier_learns_from_traits():
    """Two spans with equal votes but different words before them are told apart where the word goes with belief."""
    votes = {(0, 1, 1, 1, 0, 0): 0.99, (0, -1, -1, 0, -1, 0): 0.01, (0, 0, 0, 0, 0, 0): 0.5}
    counts = {((0, 1, 1, 1, 0, 0), (3, 1, 2)): 50.0, ((0, -1, -1, 0, -1, 0), (3, 0, 5)): 50.0,
              ((0, 0, 0, 0, 0, 0), (3, 1, 2)): 5.0, ((0, 0, 0, 0, 0, 0), (3, 0, 5)): 5.0}
    w = personal.classifier(counts, votes)
    import numpy as np

    x = personal.features(np.array([[0] * 6, [0] * 6]), np.array([[3, 1, 2], [3, 0, 5]]))
    right, wrong = x @ w
    assert right > 0 > wrong


def test_reliabilities_separate_agreeing_labelers():
    patterns = {(1, 1, 1, 0): 80.0, (0, -1, -1, -1): 70.0, (0, 1, -1, 0): 5.0}
    belief = personal.reliabilities(patterns)
    assert belief[(1, 1, 1, 0)] > 0.9 and belief[(0, -1, -1, -1)] < 0.1


@pytest.mark.parametrize("operator", [quality.quality_report, quality.keep_good, personal.personal_data, personal.redacted])
def test_empty_tables(spark, operator):
    assert operator(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0


def test_licences_in_all_spellings(spark):
    upper = "Copyright (c) 2020 Someone\n\n" + licences.MIT.upper().replace(", ", " ,\t").replace("SUBLICENSE", "SUB-LICENSE")
    rows = [(1, upper), (2, licences.MIT + " and more"), (3, "text\nLicensed under CC BY-NC 4.0.\nmore"), (4, None), (5, "..."),
            (6, "© x\nall rights reserved\n" + "ISC Licence\n\n" + licences.ISC + licences.NO_WARRANTY), (6, "")]
    df = spark.createDataFrame([(d, t, "q") for d, t in rows], "doc_id long, text string, license string")
    got = licences.scan_licences(df, licences.known_digests(spark)).collect()
    found = collections.Counter((r.doc_id, r.license, r.notices) for r in got)
    assert found == {(1, "MIT", ""): 1, (2, None, ""): 1, (3, None, "CC-BY-NC-4.0"): 1, (4, None, ""): 1, (5, None, ""): 1,
                     (6, "ISC", ""): 1, (6, None, ""): 1}


def test_licences_however_wrapped(spark):
    whole = {"MIT": licences.MIT, "ISC": licences.ISC + licences.NO_WARRANTY, "0BSD": licences.ZERO_CLAUSE + licences.NO_WARRANTY}
    rows = []
    for name, text in whole.items():
        paragraphs = [" ".join(p.split()) for p in text.split("\n\n")]
        rows.append((name, " ".join(paragraphs)))
        for width in (20, 40, 60, 72, 78, 100, 10**6):
            lines = "\n\n".join(textwrap.fill(p, width) for p in paragraphs)
            rows += [(name, lines), (name, "Copyright (c) 2020 Someone\n\n" + lines)]
            for sign in ("# ", " * ", "// "):
                rows.append((name, "".join(sign + x + "\n" for x in ["Copyright 2020 Someone", "All rights reserved.", *lines.split("\n")])))
    rows += [("MIT", licences.MIT.replace("sublicense", "sub-\nlicence")), (None, "\nCopyright holders decide.")]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan_licences(df, licences.known_digests(spark)).collect()}
    assert [got[i].license for i in range(len(rows))] == [n for n, _ in rows]
    assert got[len(rows) - 1].digest == hashlib.sha256(b"copyright holders decide").hexdigest()


def test_whole_texts_of_common_licences(spark):
    folder = Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1",
             "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    rows = [(name, (folder / f).read_text()) for f, name in files.items() if (folder / f).exists()]
    for name, t in list(rows):
        paragraphs = [p if re.search(r"(?i)copyright (\(c\)|\[|<)", p) else textwrap.fill(p, 60) for p in t.split("\n\n")]
        rows.append((name, "\n\n".join(paragraphs)))
    rows += [("BSD-2-Clause", "Copyright (c) 2020, Someone\nAll rights reserved.\n\n" + licences.BSD_2 + licences.BSD_WARRANTY),
             ("BSD-3-Clause", textwrap.fill(licences.BSD_3 + licences.BSD_WARRANTY, 70))]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in licences.scan_licences(df, licences.known_digests(spark)).collect()}
    assert [got[i] for i in range(len(rows))] == [n for n, _ in rows]


def test_notices_of_the_caller(spark):
    known = spark.createDataFrame([("PD", hashlib.sha256(b"public domain").hexdigest())], "license string, digest string")
    df = spark.createDataFrame([(1, "a\nPublic domain.\nb")], "doc_id long, text string")
    assert [r.notices for r in licences.scan_licences(df, known).collect()] == ["PD"]


def test_notices_in_many_frames(spark):
    frames = ["This work is licensed under the {}.", "This program is free software under the {}", "Licensed under {}", "Released under the {}.",
              "// Distributed under the terms of the {}.", "This file is also made available under the {}", "The source code is subject to the terms and conditions of the {}"]
    names = {"GNU General Public License, version 3": "GPL-3.0", "GNU GPL v3": "GPL-3.0", "GPL-2.0": "GPL-2.0", "MIT License": "MIT", "MIT licence": "MIT",
             "Apache License, Version 2.0": "Apache-2.0", "Apache 2.0 License": "Apache-2.0", "CC BY-SA 4.0": "CC-BY-SA-4.0",
             "Creative Commons Attribution 4.0 International License": "CC-BY-4.0", "Mozilla Public License 2.0": "MPL-2.0"}
    rows = [("some text\n" + f.format(n) + "\nmore", want) for f in frames for n, want in names.items()]
    rows += [("SPDX-License-Identifier: LGPL-2.1-only", "LGPL-2.1"), ("This work is licensed under the GNU General Public License, version 9.", ""),
             ("We talk about the MIT License here.", ""), ("Copyright policy is what the MIT decides\nLicensed under MIT", "MIT"), ("under the sea", "")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.notices for r in licences.scan_licences(df, licences.known_digests(spark)).collect()}
    assert [got[i] for i in range(len(rows))] == [want for _, want in rows]


def test_the_oracle_has_the_same_rule(spark, tmp_path):
    """Wrapped licences, lines about copyright, frames, odd and very long texts: the scan and its SQL agree."""
    mit = licences.MIT
    texts = [
        mit, textwrap.fill(" ".join(mit.split()), 50), "Copyright (c) 2020 X\n\n" + mit, "Copyright policy of the house\n" + mit, mit.upper(),
        "# Copyright 2020\n# Licensed under the MIT Licence.\nx", "Copyright policy: Licensed under the MIT License.", "copyright holders\nsub-licence", None, "",
        "...", "é ß Ω\n© 2020 me\nReleased under GPL v3", "This work is licensed under the GNU General Public License, version 3.", " \n\n ",
        licences.BSD_3 + licences.BSD_WARRANTY, "word " * 200_000, "x" * 1_000_000, "Licensed under MIT\n" * 50_000, "all rights reserved", "(c) 1999",
        textwrap.fill(licences.ISC + licences.NO_WARRANTY, 30), "under the", "licensed under ", "a  copyright owner\tfavour",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    want = con.execute(queries.ORACLES["op6_license_digests"]).fetchall()
    got = [tuple(r) for r in licences.scan_licences(df, licences.known_digests(spark)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert licences.scan_licences(df.limit(0), licences.known_digests(spark)).count() == 0


def test_the_commonest_notice_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text LIKE '%licensed under the GNU General%'")
    found = licences.scan_licences(docs, licences.known_digests(spark)).collect()
    assert len(found) >= 79 and all("GPL-3.0" in r.notices for r in found)


def test_licence_oracle(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    want = con.execute(queries.ORACLES["op6_license_digests"]).fetchall()
    got = [tuple(r) for r in queries.QUERIES["op6_license_digests"](spark, sf_dir).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
