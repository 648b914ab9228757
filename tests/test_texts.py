import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerleaf.functions import text as tx
from ledgerleaf.operators import documents as dc
from ledgerleaf.operators import pii
from ledgerleaf.operators.pieces import SEPARATORS, cut_points, preference_pieces, rejoined


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "text STRING").select(expression.alias("r")).first()["r"]


def test_clean_text(spark):
    text = "Visit http://a.b/c now, I can't wait: <b>2nd</b> x9 ok!"
    assert one(spark, text, tx.clean_text(F.col("text"), "letters")) == "Visit now I cannot wait ok "
    assert one(spark, text, tx.clean_text(F.col("text"), "none")) == text
    assert one(spark, None, tx.clean_text(F.col("text"))) is None
    assert one(spark, "", tx.clean_text(F.col("text"))) == ""
    assert one(spark, "2022 31 7", tx.clean_text(F.col("text"))).strip() == ""


def test_unknown_profile():
    with pytest.raises(ValueError):
        tx.clean_text(F.lit("x"), "shiny")


@pytest.mark.parametrize(
    "given_text, expected",
    [
        ("I won't, can’t and shan't.", "I will not, cannot and shall not."),
        ("They're sure it's what we've said; let's go, he'd say.",
         "They are sure it is what we have said; let us go, he would say."),
        ("John's dog isn't here", "John's dog is not here"),
    ],
)
def test_contractions(spark, given_text, expected):
    assert one(spark, given_text, tx.expand_contractions(F.col("text"))) == expected


def test_outside_is_the_negated_class():
    # Python spells code points differently.
    positive = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", tx.outside("AZ", "az", *"., \t\r\n+"))
    sample = "".join(map(chr, range(0, 0x600)))
    assert re.sub(positive, "", sample) == re.sub(r"[^A-Za-z., \t\r\n+]", "", sample)


def test_markup(spark):
    html = '<head><title>T</title></head><!-- x --><script>var a="</p>";</script><p>One &amp; <a href="u">two</a></p>&copy;'
    assert one(spark, html, tx.strip_markup(F.col("text"))) == "One & two\n©"


def test_sentences(spark):
    text = "Dr. Smith paid 3.5 francs. Really?! Yes. no end"
    assert one(spark, text, tx.sentences(F.col("text"))) == ["Dr. Smith paid 3.5 francs.", "Really?!", "Yes.", "no end"]
    assert one(spark, "", tx.sentences(F.col("text"))) == []


@pytest.mark.parametrize("n, size, overlap, sizes", [
    (0, 500, 0, []), (1, 500, 0, [1]), (500, 500, 0, [500]), (501, 500, 0, [500, 1]), (1001, 500, 0, [500, 500, 1]),
    (579, 600, 20, [579]), (600, 600, 20, [600]), (601, 600, 20, [600, 21]), (1160, 600, 20, [600, 580]),
])
def test_chunks(spark, n, size, overlap, sizes):
    text = " ".join(f"w{i}" for i in range(n))
    found = one(spark, text, tx.chunks(tx.words(F.col("text")), size, overlap))
    assert [len(c.split()) for c in found] == sizes
    if len(found) > 1 and overlap:
        assert found[0].split()[-overlap:] == found[1].split()[:overlap]


def test_lemma(spark):
    words = ["cities", "classes", "boxes", "women", "glass", "status", "dogs", "as", "children", "data"]
    rows = spark.createDataFrame([(w,) for w in words], "w STRING").select(tx.lemma(F.col("w")).alias("l")).collect()
    assert [r.l for r in rows] == ["city", "class", "box", "woman", "glass", "status", "dog", "as", "child", "data"]


@given(st.text(alphabet="ab .!?:;-/é", max_size=200), st.integers(2, 20))
def test_cut_points(text, limit):
    ends = cut_points(text, limit)
    pieces = [text[a:b] for a, b in zip([0, *ends], ends)]
    assert "".join(pieces) == text
    assert all(len(p) <= limit for p in pieces)
    for piece, rest in zip(pieces, pieces[1:]):
        if len(piece) < limit:
            assert piece.endswith(tuple(SEPARATORS)) and rest is not None


def test_pieces_and_rejoin(spark):
    rows = spark.createDataFrame([(1, "One two. Three four five"), (2, ""), (3, None)], "id INT, text STRING")
    pieces = preference_pieces(rows, "id", "text", 12)
    found = [(r.id, r.piece_no, r.piece) for r in pieces.orderBy("id", "piece_no").collect()]
    assert found == [(1, 0, "One two. "), (1, 1, "Three four "), (1, 2, "five"), (2, 0, "")]
    joined = rejoined(pieces.where("id = 1"), ["id"], "piece_no", "piece", "text").first()
    assert joined["text"] == " One two.  Three four  five"


def test_spans(spark):
    text = "a.b@c.org x +1 (743) 555-3824, 10.20.30.40 on March 5, 1998 Ann Lee 😀 2020-01-31"
    rows = spark.createDataFrame([(1, text), (2, "nothing"), (3, None), (4, "")], "id INT, text STRING")
    found = pii.spans_of(rows, "id", "text", keep_text=True)
    assert found.where(tx.span_at(F.col("text"), F.col("start"), F.col("end")) != F.col("entity")).count() == 0
    got = {(r.entity_type, r.entity, r.start) for r in found.collect()}
    assert got == {
        ("EMAIL_ADDRESS", "a.b@c.org", 0), ("PHONE_NUMBER", "+1 (743) 555-3824", 12),
        ("DATE", "March 5, 1998", text.index("March")), ("DATE", "2020-01-31", text.index("2020")),
        ("PERSON", "Ann Lee", text.index("Ann")),
    }


def test_sentiment(spark):
    rows = spark.createDataFrame([(1, "Good and great. This stupid trash! It is so.")], "doc_id INT, text STRING")
    found = dc.sentence_sentiment(rows).orderBy("sent_no").collect()
    assert [(r.sentiments, r.stars, r.score) for r in found] == [("5 stars", 5, 1.0), ("1 star", 1, 1.0)]
    unit = spark.createDataFrame([("1 star",), ("4 stars",)], "s STRING").select(
        dc.stars_to_unit(dc.label_stars(F.col("s"))).alias("u")
    )
    assert [r.u for r in unit.collect()] == [-1.0, 0.5]


def test_summary_budget(spark):
    long = " ".join(f"Word{i} apple{i % 7} stays {'pear ' * (i % 5)}here." for i in range(300))
    rows = spark.createDataFrame([(1, long), (2, "Just one sentence"), (3, "")], "doc_id INT, text STRING")
    found = {r.doc_id: r.summary for r in dc.summaries(rows).collect()}
    assert found[2] == " Just one sentence"
    chunks = rows.select("doc_id", F.size(tx.chunks(tx.words(F.col("text")), 500)).alias("n"))
    n = {r.doc_id: r.n for r in chunks.collect()}
    assert len(found[1].split()) <= 62 * n[1]
    tree = {r.doc_id: r.summary for r in dc.tree_summaries(rows).collect()}
    assert len(tree[1].split()) <= 62


def test_translation_hook(spark):
    rows = spark.createDataFrame([(1, "The house of this man!")], "doc_id INT, text STRING")
    assert dc.translations(rows).first()["translation"] == " le house de ceci man"
    assert dc.translations(rows, translate=F.upper).first()["translation"] == " THE HOUSE OF THIS MAN"


def test_documents_without_words_have_an_empty_translation(spark):
    from ledgerleaf.operators import documents as dc

    df = spark.createDataFrame([(1, ""), (2, None), (3, " !? "), (4, "the best")], "doc_id INT, text STRING")
    got = {r.doc_id: r.translation for r in dc.translations(df).collect()}
    assert got == {1: "", 2: "", 3: "", 4: " le meilleur"}


def test_window_coherence_equals_plain_python(spark, monkeypatch):
    import math
    import random

    import numpy as np

    from ledgerleaf.operators import topics

    rnd = random.Random(3)
    vocabulary = [f"{a}{b}" for a in "bdfgk" for b in ("alo", "emi", "otu", "uva")]
    docs = [[rnd.choice(vocabulary[: rnd.choice([5, 20])]) for _ in range(rnd.choice([0, 3, 12, 40, 200]))] for _ in range(50)]
    listed = {"x": vocabulary[:5], "y": vocabulary[3:11], "z": [*vocabulary[15:18], "absent"]}
    window = 10
    windows = [set(d[i : i + window]) for d in docs if d for i in range(max(1, len(d) - window + 1))]
    want = {}
    for name, words in listed.items():
        p = lambda *w: sum(all(x in s for x in w) for s in windows) / len(windows)  # noqa: E731, B023
        words = [w for w in words if p(w)]
        v = np.array([[math.log((p(a, b) + 1e-12) / (p(a) * p(b))) / -math.log(p(a, b) + 1e-12) for b in words] for a in words])
        s = v.sum(axis=0)
        want[name] = np.mean([row @ s / np.linalg.norm(row) / np.linalg.norm(s) for row in v])
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)] + [(99, None)], "doc_id INT, text STRING")
    rows = spark.createDataFrame([(n, w) for n, ws in listed.items() for w in ws], "topic STRING, token STRING")
    for words in (topics.TOPIC_WORDS, 6):
        monkeypatch.setattr(topics, "TOPIC_WORDS", words)
        got = {r.topic: r.coherence for r in topics.window_coherence(df, rows, "topic", window=window, lemmas=False).collect()}
        assert got == pytest.approx(want, abs=1e-6)


def test_abbreviations_of_four_languages_are_learned(spark):
    import random

    from ledgerleaf.operators import sentence_ends

    rnd = random.Random(8)
    vocabulary = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(4, 9))) for _ in range(300)]
    planted = ["Dr", "bzw", "env", "pág", "z.B"]
    docs, truth = [], {}
    for i in range(150):
        wanted = []
        for _ in range(rnd.randint(2, 9)):
            words = [rnd.choice(vocabulary) for _ in range(rnd.randint(4, 10))]
            if rnd.random() < 0.4:
                words.insert(rnd.randint(1, len(words) - 1), rnd.choice(planted) + ".")
            wanted.append(" ".join([words[0].capitalize(), *words[1:]]) + rnd.choice([".", ".", ".", "?", "!", '."', ".)"]))
        docs.append((i, rnd.choice([" ", "\n", "  "]).join(wanted)))
        truth[i] = wanted
    df = spark.createDataFrame([*docs, (900, ""), (901, None), (902, "no end")], "doc_id INT, text STRING")
    statistics = sentence_ends.word_statistics(df)
    found = {r.type for r in sentence_ends.abbreviations(statistics).collect()}
    assert found == {p.lower() for p in planted}
    got = {}
    for r in sentence_ends.learned_sentences(df).orderBy("doc_id", "sent_no").collect():
        assert r.sent_no == len(got.setdefault(r.doc_id, []))
        got[r.doc_id].append(r.sentence)
    assert got.pop(902) == ["no end"]
    assert got == truth
    assert sentence_ends.learned_sentences(df.limit(0)).count() == 0


def test_words_are_stripped_once_per_spelling_and_texts_taken_apart_once_for_all_ends(spark, monkeypatch):
    from ledgerleaf.operators import frame, sentence_ends

    texts = [f"Der Weg {i}. Er sah bzw. Der Weg war bzw. er lang (Wegesende.) Gut! so" for i in range(40)] + ["", None, " bzw. \n Er", "( ) ."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plan = sentence_ends.word_statistics(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "lower(" in plan and "lower(" not in plan[plan.rindex("Aggregate"):]  # per spelling, not per word
    found = sentence_ends.learned_sentences(docs)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    expected = sorted(map(tuple, found.collect()))
    assert [s for k, _, s in expected if k == 7] == ["Der Weg 7.", "Er sah bzw. Der Weg war bzw. er lang (Wegesende.)", "Gut!", "so"]
    assert [s for k, _, s in expected if k >= 40] == ["bzw.", "Er", "( ) ."]
    monkeypatch.setattr(frame, "fits_broadcast", lambda _lookup: False)
    assert sorted(map(tuple, sentence_ends.learned_sentences(docs).collect())) == expected


def test_stops_at_the_end_of_odd_words(spark):
    from ledgerleaf.operators import sentence_ends

    odd = ["a.", "a", ".", "...", '("a.")', "a.b", "a!,;", '?"x', "a.\u2028", "a.)\u2028", "a.\u0085", "(", "«¿Qué?»", "a.,b.", "Ä!’", "3.", ""]
    df = spark.createDataFrame([(w,) for w in odd], "w string")
    stripped = sentence_ends.stripped(F.col("w"))
    rows = df.select(sentence_ends.ends_in_stop(F.col("w")).alias("a"), stripped.rlike(sentence_ends.STOP).alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows] and {r.a for r in rows} == {True, False}


def test_contraction_rules_run_only_where_their_sign_is(spark):
    texts = ["won't won't can't", "It’s Who's SHAN'T shan't", "let's 've they've'd I'm", "n't 'tis", "He'll, she'd we're don't", "", "plain", None]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    rows = df.select(tx.expand_contractions(F.col("x")).alias("a"), tx.apply_rules(F.col("x"), tx.CONTRACTIONS).alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]
    assert len(tx.CONTRACTION_SIGNS) == len(tx.CONTRACTIONS)


def test_spans_take_one_pass_of_their_pattern(spark):
    texts = ["1/2/2020 and May 3, 2021.", f"a{tx.FENCE}b 2020-01-02 {tx.FENCE}2021-01-02", "none", "", None, "3 May 2020 3 May 2021"]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    spans = df.select("x", tx.match_spans(F.col("x"), pii.DATE).alias("s"))
    for r in spans.collect():
        found = None if r.x is None else [(m.start(), m.end(), m.group()) for m in re.finditer(pii.DATE, r.x)]
        assert (r.s if r.s is None else [tuple(s) for s in r.s]) == found
    found = pii.spans_of(df, "x", "x", {"DATE": pii.DATE}).groupBy("x").count().collect()
    assert {r.x: r["count"] for r in found} == {texts[0]: 2, texts[1]: 2, texts[5]: 2}


def test_summaries_with_more_words_than_a_broadcast_takes(spark, monkeypatch):
    """Weights of rarer words come to the documents; no term leaves its document's task for them."""
    rows = [(i, " ".join(f"word{chr(97 + (i * j) % 26)}{chr(97 + j % 7)} report{chr(97 + j % 5)}." for j in range(60))) for i in range(40)]
    df = spark.createDataFrame(rows + rows[:3] + [(90, None), (91, "")], "doc_id LONG, text STRING")
    expected = sorted(map(tuple, dc.tree_summaries(df).collect()), key=repr)
    monkeypatch.setattr(dc, "fits_broadcast", lambda _idf: False)
    monkeypatch.setattr(dc, "FREQUENT", 20)
    assert sorted(map(tuple, dc.tree_summaries(df).collect()), key=repr) == expected
    plan = dc.summaries(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan and "_rare" in plan


def test_tasks_grow_with_the_texts(spark, monkeypatch):
    from ledgerleaf.operators import corpus

    docs = spark.createDataFrame([(i, "one two three " * 10) for i in range(50)], "doc_id LONG, text STRING")
    assert corpus.document_tasks(docs) is None
    monkeypatch.setattr(corpus, "TASK_CHARS", 100)
    assert corpus.document_tasks(docs) == 70
    assert corpus.by_document(docs, "doc_id", 70).rdd.getNumPartitions() == 70


def test_summaries_equal_plain_python_and_no_term_is_a_row(spark, monkeypatch):
    """Long terms, abbreviations, repeated and missing keys, slices of few bytes; terms are counted inside the documents' tasks."""
    import math
    import random
    import re
    from collections import Counter

    from ledgerleaf.functions.words import ABBREVIATIONS, STOP_WORDS
    from ledgerleaf.operators import extracts

    monkeypatch.setattr(extracts, "SLICE", 3000)
    rnd = random.Random(3)
    known = ["".join(rnd.choice("abcdefg") for _ in range(rnd.choice([1, 2, 4, 6, 13, 14, 15, 16]))) for _ in range(150)]
    known += ["a" * 13 + "b", "a" * 13 + "bc", "Dr.", "xDr.", "Dr.Mr.", "Mr.", "the", "end.", "stop.", "a1b.", "naïve", "don't", "+", ",", "...", "x.y", "Ö."]
    write = lambda n: "".join(rnd.choice(known) + rnd.choice([" ", " ", "\n", "\t "]) for _ in range(n))
    rows = [(i, write(rnd.choice([0, 3, 80, 500, 501, 1700]))) for i in range(40)] + [(None, write(60)), (None, write(5)), (50, None), (51, "!?")]
    rows += [(5, rows[5][1]), (5, rows[5][1])]

    def terms(s):
        return [w for w in re.findall("[a-z]+", s.lower()) if 2 <= len(w) <= 15 and w not in STOP_WORDS]

    def parts(text):
        words = re.sub(r"[^A-Za-z., \t\r\n+]", "", text or "").split()
        for i in range(0, len(words), 500):
            guarded = re.sub(rf"(^|[^A-Za-z])({'|'.join(ABBREVIATIONS)})\.", "\\1\\2\u0002", " ".join(words[i : i + 500]))
            yield [s.strip().replace("\u0002", ".") for s in re.sub(r"([.!?]) ", "\\1\u0001", guarded).split("\u0001")]

    df = Counter(w for _, text in rows for w in {w for p in parts(text) for s in p for w in terms(s)})

    def shortened(parted):
        tf = Counter(w for p in parted for s in p for w in terms(s))
        out = []
        for p in parted:
            score = lambda s: round(sum(tf[w] * (math.log((1 + len(rows)) / (1 + df[w])) + 1) for w in terms(s)) / max(1, len(terms(s))), 6)
            order, used, kept = sorted(range(len(p)), key=lambda i: (-score(p[i]), i)), 0, []
            for i in order:
                used += len(p[i].split(" "))
                kept += [i] if not kept or used <= 62 else []
            out.append([p[i] for i in sorted(kept)])
        return out

    joined = lambda p: " " + " ".join(s for one in p for s in one)
    # Copies of a row count together and change no order: every term counts as often.
    first = [(k, shortened(list(parts(text))) if k is not None else []) for k, text in rows]
    second = [(k, shortened([sum(p[i : i + 10], []) for i in range(0, len(p), 10)])) for k, p in first]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = dc.summaries(table)
    for got, want in ((found, first), (dc.tree_summaries(table), second)):
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(((k, joined(p)) for k, p in want), key=repr)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan and "MapInArrow" in plan


def test_line_rules_run_only_where_their_signs_are(spark):
    """A text without a rule's sign is left as the rule would leave it; words with digits go as by the plain rule."""
    import random

    rnd = random.Random(8)
    texts = ["".join(rnd.choice([" ", " ", "\n", "\t", "\r", "a", "b7", "é", "9", " "]) for _ in range(rnd.randint(0, 14))) for _ in range(800)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for signs, rule in zip(tx.LINE_SIGNS, tx.LINES, strict=True):
        assert df.where(~tx.apply_where(F.col("t"), signs, [rule]).eqNullSafe(tx.apply_rules(F.col("t"), [rule]))).isEmpty()
    lines = F.btrim(tx.apply_rules(F.col("t"), tx.LINES), F.lit(" \n"))
    plain = F.trim(tx.apply_rules(lines, tx.DIGIT_WORDS))
    assert df.where(~tx.clean_text(F.col("t"), "keep_punct").eqNullSafe(tx.apply_rules(plain, tx.KEEP_PUNCT))).isEmpty()
