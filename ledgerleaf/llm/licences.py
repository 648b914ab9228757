"""Licence scans by canonical digests, in DataFrame functions only.

A text is put into canonical form: lower case, no copyright notices, nothing but single spaces between
letters and digits, and one spelling for words that licences spell differently, however lines are wrapped.
Its digest is then joined with those of known licences and notices. Whole texts are looked up, and whole lines.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Copyright lines: "copyright" has a sign or year after it; comment signs may stand before it.
NOTICE = (
    r"(^|\n)[ \t#*/;%>|!<\"'-]*(copyright[ \t:]*(\(c\)|©|&copy;|[\[<{]|[0-9]{4})|\(c\)[ \t]*[0-9]{4}|©|&copy;)[^\n]*"
)
#: Spellings that count as equal, each by the one that replaces it.
SPELLINGS = {
    "licence": "license", "sub-licen": "sublicen", "sub licen": "sublicen", "non-infringement": "noninfringement",
    "organisation": "organization", "favour": "favor", "acknowledgement": "acknowledgment", "per cent": "percent",
    "merchantibility": "merchantability", "copyright owner": "copyright holder", "analogue": "analog",
}
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ZERO_CLAUSE = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted."""
ISC = ZERO_CLAUSE[:-1] + """, provided that the above copyright notice and this permission notice appear in all copies."""
NO_WARRANTY = """

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
#: Known texts by name: whole licences and the notices that stand for them.
KNOWN = [
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("ISC", ISC + NO_WARRANTY),
    ("ISC", "ISC License\n\n" + ISC + NO_WARRANTY),
    ("0BSD", ZERO_CLAUSE + NO_WARRANTY),
    ("0BSD", "BSD Zero Clause License\n\n" + ZERO_CLAUSE + NO_WARRANTY),
]

#: Ways to say under which licence something is, after the canonical form; all count as "licensed under".
THINGS = (
    "article|book|code|content|data|database|dataset|distribution|document|documentation|file|image|library|material|module|"
    "package|page|program|project|repository|script|software|source code|text|tool|website|work"
)
VERBS = "available|distributed|licensed|made available|offered|provided|published|released"
FRAME = (
    f"^(this |the |these )?(({THINGS})s? )?((is|are) )?(free software )?((is|are) )?(also |hereby )?"
    f"(({VERBS}) )?(under|subject to|according to) (the )?(terms (and conditions )?of )?(the |a |an )?"
)
#: What may follow the name of a licence.
TAIL = " (only|license only|see license for details|see the license file for details|as published by the free software foundation)$"
#: Names of licences as notices spell them; versions are spelled in every usual way.
NAMES = {
    "MIT": (["MIT", "MIT License", "Expat License", "MIT/Expat License"], []),
    "ISC": (["ISC", "ISC License"], []),
    "Apache-2.0": (["Apache", "Apache License", "Apache Software License", "Apache Public License"], ["2", "2.0"]),
    "BSD-2-Clause": (["BSD 2-Clause", "BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License"], []),
    "BSD-3-Clause": (["BSD 3-Clause", "BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"], []),
    "GPL-2.0": (["GPL", "GNU GPL", "GNU General Public License", "General Public License", "GNU General Public License (GPL)"], ["2", "2.0"]),
    "GPL-3.0": (["GPL", "GNU GPL", "GNU General Public License", "General Public License", "GNU General Public License (GPL)"], ["3", "3.0"]),
    "LGPL-2.1": (["LGPL", "GNU LGPL", "GNU Lesser General Public License", "Lesser General Public License"], ["2.1"]),
    "LGPL-3.0": (["LGPL", "GNU LGPL", "GNU Lesser General Public License", "Lesser General Public License"], ["3", "3.0"]),
    "AGPL-3.0": (["AGPL", "GNU AGPL", "GNU Affero General Public License", "Affero General Public License"], ["3", "3.0"]),
    "MPL-2.0": (["MPL", "Mozilla Public License"], ["2", "2.0"]),
    "CC-BY-4.0": (["CC BY", "Creative Commons Attribution", "Creative Commons Attribution International License"], ["4.0"]),
    "CC-BY-SA-4.0": (["CC BY-SA", "Creative Commons Attribution-ShareAlike", "Creative Commons Attribution Share Alike"], ["4.0"]),
    "CC-BY-NC-4.0": (["CC BY-NC", "Creative Commons Attribution-NonCommercial", "Creative Commons Attribution Non Commercial"], ["4.0"]),
    "CC0-1.0": (["CC0", "Creative Commons Zero", "CC0 Universal"], ["1.0"]),
    "Unlicense": (["Unlicense"], []),
}


def notices() -> list[tuple[str, str]]:
    """Every known notice: a licence's name and version in all spellings, and its identifier."""
    out = []
    for license, (names, versions) in NAMES.items():
        spelled = {form for name in names for v in versions for form in (
            f"{name} {v}", f"{name} v{v}", f"{name} version {v}", f"{name} {v} License", f"{name} v. {v}",
            f"{name} {v} International", f"{name} {v} International License", f"{name} {v} Universal",
        )} if versions else set(names)
        out += [(license, f"Licensed under {form}") for form in sorted(spelled)]
        out += [(license, f"SPDX-License-Identifier: {license}{ending}") for ending in ("", "-only")]
    return out


BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_3 = BSD_2 + """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
BSD_WARRANTY = """

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Whole licences beside those of the SQL; lists of conditions stand with and without numbers.
TEXTS = [
    (name, title + text)
    for name, heading, body in [("BSD-2-Clause", "BSD 2-Clause License", BSD_2), ("BSD-3-Clause", "BSD 3-Clause License", BSD_3)]
    for title in ("", heading + "\n\n")
    for text in (body + BSD_WARRANTY, re.sub(r"(?m)^[1-3][.] ", "* ", body) + BSD_WARRANTY)
]
#: Digests of the canonical forms of long licences as their publishers print them. Where a licence
#: has two, the first is of the whole text with its appendix on how to apply it, the second of its terms alone.
#: Apache Software Foundation 2004; Creative Commons 2009; Free Software Foundation 1989 (GPL 1), 1991 (GPL 2,
#: Library GPL 2), 1999 (LGPL 2.1), 2007 (GPL 3, LGPL 3); Mozilla 1998 (MPL 1.1) and 2012 (MPL 2.0).
WHOLE = [
    ("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("Apache-2.0", "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "26ba73e836ecb04fe87d5eca80ca27cff1afa2d7683455be1517bd23b8d27986"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
]


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    lowered = F.lower(text)
    has_mark = lowered.rlike(r"copyright|\(c\)|©|&copy;")
    lowered = F.when(has_mark, F.regexp_replace(lowered, NOTICE, "$1")).otherwise(lowered)
    joined = F.regexp_replace(lowered, r"[^\p{L}\p{N}]+", " ")

    def spelled(t):
        out = t
        for old, new in spellings().items():
            out = F.replace(out, F.lit(old), F.lit(new))
        out = F.regexp_replace(out, " +", " ")
        return F.when(t.rlike("|".join(spellings())), out).otherwise(t)

    def framed(t):
        plain = F.regexp_replace(F.regexp_replace(t, FRAME, "licensed under "), TAIL, "")
        return F.when((F.length(t) <= 300) & t.rlike("under |subject to |according to "), plain).otherwise(t)

    trimmed = F.transform(F.transform(F.array(joined), spelled), lambda t: F.trim(t))
    return F.transform(trimmed, framed)[0]


def spellings() -> dict[str, str]:
    return {old.replace("-", " "): new for old, new in SPELLINGS.items()} | {"all rights reserved": ""}


def known_digests(spark: SparkSession) -> DataFrame:
    """``(license, digest)`` of the known texts; a digest belongs to one licence."""
    rows = spark.createDataFrame(KNOWN + notices() + TEXTS, "license string, text string")
    rows = rows.select("license", F.sha2(canonical(F.col("text")), 256).alias("digest"))
    rows = rows.unionByName(spark.createDataFrame(WHOLE, "license string, digest string"))
    return rows.groupBy("digest").agg(F.min("license").alias("license"))


def scan_licences(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``digest`` of the canonical whole text, its ``license`` (null if unknown) and
    ``notices``: the licences whose known text is a whole line, distinct and sorted.

    Null texts have a null digest and no notices; texts without letters and digits have the digest of the
    empty text and match nothing. Rows are kept as they are, repeated ones too; other columns are ignored;
    an empty table gives an empty result. ``known`` has ``(license, digest)``, digests once; it is a list of
    licences, small enough for the driver.
    """
    body = F.col(text).cast("string")
    slim = docs.select(F.col(key), body.alias("_text"))
    lines = F.array_distinct(F.split("_text", "\n", -1))
    lines = F.array_distinct(F.transform(lines, lambda x: F.sha2(canonical(x), 256)))
    marked = slim.select(key, F.sha2(canonical(F.col("_text")), 256).alias("digest"), lines.alias("_lines"))
    names = known.where(F.col("digest") != F.sha2(F.lit(""), 256)).select(F.col("digest").alias("_digest"), "license")
    found = marked.join(names, F.col("digest") == F.col("_digest"), "left").drop("_digest")
    # The digests of a row's lines are compared with the known ones as sets, and only hits looked up in a map;
    # both are as large as the list of licences.
    entries = names.collect()
    table = F.create_map(*[F.lit(v) for r in entries for v in (r["_digest"], r["license"])]) if entries else F.create_map().cast("map<string,string>")
    hits = F.array_intersect("_lines", F.array(*[F.lit(r["_digest"]) for r in entries]).cast("array<string>"))
    found_notices = F.transform(hits, lambda x: F.element_at(table, x))
    found_notices = F.coalesce(F.array_sort(F.array_distinct(found_notices)), F.array().cast("array<string>"))
    return found.select(key, "digest", "license", F.array_join(found_notices, ",").alias("notices"))


def sql() -> str:
    """The scan of ``documents`` in ANSI SQL (DuckDB's functions), by the same rule."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def joined(column: str) -> str:
        return rf"regexp_replace(regexp_replace(lower({column}), {quoted(NOTICE)}, '\1', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')"

    def form(source: str, key: str, column: str) -> str:
        """``key`` and the digest of ``column`` in the canonical form, step by step."""
        spelled = "t"
        for old, new in spellings().items():
            spelled = f"replace({spelled}, {quoted(old)}, {quoted(new)})"
        any_ = quoted("|".join(spellings()))
        step = f"SELECT {key}, {joined(column)} AS t FROM {source}"
        step = f"SELECT {key}, trim(CASE WHEN regexp_matches(t, {any_}) THEN regexp_replace({spelled}, ' +', ' ', 'g') ELSE t END) AS t FROM ({step})"
        plain = f"regexp_replace(regexp_replace(t, {quoted(FRAME)}, 'licensed under '), {quoted(TAIL)}, '')"
        return (
            f"SELECT {key}, sha256(CASE WHEN length(t) <= 300 AND regexp_matches(t, 'under |subject to |according to ') "
            f"THEN {plain} ELSE t END) AS digest FROM ({step})"
        )

    rows = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in KNOWN + notices() + TEXTS)
    digests = ", ".join(f"({quoted(n)}, {quoted(d)})" for n, d in WHOLE)
    return f"""
    WITH listed(name, text) AS (VALUES {rows}), whole(name, digest) AS (VALUES {digests}),
    known AS (
      SELECT digest, min(name) AS license FROM ({form("listed", "name", "text")} UNION ALL SELECT name, digest FROM whole)
      WHERE digest <> sha256('') GROUP BY digest
    ), lines AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents
    ), notices AS (
      SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
      FROM ({form("lines", "doc_id", "line")}) JOIN known USING (digest) GROUP BY doc_id
    ), texts AS ({form("documents", "doc_id", "text")})
    SELECT d.doc_id, d.digest, k.license, coalesce(n.notices, '') AS notices
    FROM texts d LEFT JOIN known k ON k.digest = d.digest LEFT JOIN notices n ON n.doc_id = d.doc_id
    """
