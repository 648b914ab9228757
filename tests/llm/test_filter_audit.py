"""The filter audit against plain lists."""

import itertools
import random
import re

from ledgerleaf.llm import filter_audit

DOCS = "doc_id long, text string, source string, mask int, n long, part int"
LABELS = "doc_id long, quality int, toxic int, _key int"


def failures(docs):
    """A set of letters per row."""
    out = []
    for key, text, _ in docs:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        found = set()
        if len(words) < 50:
            found.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            found.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            found.add("C")
        if re.search(r"[#$%&*|]", text):
            found.add("D")
        if key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in docs):
            found.add("E")
        out.append(found)
    return out


def brute(docs, labels):
    fails = failures(docs)
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    rows, shapley = {}, {}
    for part in {s or "" for _, _, s in docs}:
        mine = [(d[0], f) for d, f in zip(docs, fails) if (d[2] or "") == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(range(len(mine)))
            for step, letter in enumerate(order, 1):
                gone = [i for i in left if letter in mine[i][1]]
                failing = sum(letter in f for _, f in mine)
                left = [i for i in left if letter not in mine[i][1]]
                shapley[part, letter] = shapley.get((part, letter), 0) + len(gone)
                rows[part, order, step] = [
                    len(left), len(gone), failing - len(gone), sum(f == {letter} for _, f in mine),
                    sum(mine[i][0] in good for i in gone), sum(mine[i][0] in toxic for i in gone),
                ]
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in rows.items()}


def audited(spark, docs, labels):
    frame = spark.createDataFrame([(*d, 7, 8, 9) for d in docs], DOCS)
    marks = spark.createDataFrame([(*m, 3) for m in labels], LABELS)
    out = filter_audit.audit_filters(frame, marks)
    got = out.collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[c] for c in [*filter_audit.COUNTS, "shapley"]) for r in got}
    assert len(found) == len(got)
    return found


def test_equals_plain_lists(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    texts = [
        " ".join(rnd.choice(words[: rnd.choice([20, 200])]) for _ in range(rnd.randint(30, 90)))
        + rnd.choice(["", "", " 100%", " ABCDEFGHIJKLMNOPQRSTUVWXYZ"]) for _ in range(25)
    ]
    texts += [None, "", " \n", "été " * 60, "A" * 100_000, "x " * 100_000]
    docs = [(i, rnd.choice(texts), rnd.choice(["s1", "s2", None, ""])) for i in range(120)]
    docs += [(None, texts[0], "s1"), (None, texts[0], None), (3, docs[3][1], "s2"), (3, docs[3][1], docs[3][2]), (3, "other", "s1")]
    docs += [(i, "one text", "hot") for i in range(200, 400)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 400, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_without_labels_and_without_documents(spark):
    docs = [(1, "a b", "s"), (2, "a b", "s")]
    assert audited(spark, docs, []) == brute(docs, [])
    assert audited(spark, [], [(1, 1, 1)]) == {}


def test_more_parts_than_the_recursion_would_return_by_default(spark):
    """325 rows a part: beyond a million rows the recursion must still be whole."""
    cells = spark.range(3200).selectExpr("CAST(id AS STRING) AS part", "5 AS mask", "2L AS n", "1L AS good", "0L AS toxic")
    out = filter_audit.audited(cells, "ABCDE")
    assert out.count() == 3200 * 600
    row = out.where("part = '7' AND filter_order = 'BCAED' AND step = 3").first()
    assert (row.kept, row.removed, row.redundant, row.unique_fails, row.shapley) == (0, 0, 2, 0, 120)
