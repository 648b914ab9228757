"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from exact patterns, from matches of these that fail their check (a wrong
check digit, a part over 255, too many digits), and from looser forms, many of them wrong: bare
runs of digits, versions, order numbers. Labelers vote on each: on its form and shape (patterns),
on known names and numbers (gazetteers), on the words before it (context for and against), and on
its digits. Expectation-maximisation over the counted vote patterns estimates how reliable each
labeler is for each kind, and so how likely each candidate is personal data. A logistic span
classifier is trained on these likelihoods; beside the votes it sees the span's length, its
separators and the hashed word before it. It decides about all but the spans of the exact
patterns, which always stay.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.text import match_spans
from ledgerleaf.llm.tables import stored

KINDS = ["email", "ip", "card", "phone"]
#: The exact patterns of the contract. What stands before a run cannot belong to a match unless
#: the last match ended there, which the anchors say so that long runs are not tried from each character.
#: Repetitions are possessive, which changes no match here: others use up the stack on very long runs.
EXACT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser forms: written-out signs, dots in brackets, numbers in groups, numbers without country code.
LOOSE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]+"
    r"(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]++)++"
    r"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ at [A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9.])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+.(-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])"
    r"|(?<![0-9+.(A-Za-z#-])[0-9]{10,11}(?![0-9A-Za-z]|[.-][0-9])",
}
#: Matches of the exact patterns that fail their check are candidates if they have so many digits.
FAILING = {"email": None, "ip": (4, 12), "card": (12, 19), "phone": (7, 16)}
#: Without one of these signs there is no match.
SIGNS = {"email": ["@"], "ip": ["."], "card": [""], "phone": ["+"]}
LOOSE_SIGNS = {"email": ["(at)", "[at]", "{at}", " dot "], "ip": ["[.]", "(.)"], "card": [""], "phone": [""]}
#: Gazetteers: ends of host names, first digits of card issuers, country codes.
DOMAINS = ["com", "org", "net", "edu", "gov", "int", "info", "biz", "io", "eu", "de", "fr", "es", "it", "uk", "nl", "ch", "at", "us"]
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|36|38|35|6011|64|65)"
COUNTRIES = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CONTEXT = {
    "email": "mail|contact|write to|correo|courriel|kontakt",
    "ip": r"\bip\b|address|host|server|login|from|adresse|direcci",
    "card": "card|visa|master|credit|payment|carte|tarjeta|karte",
    "phone": r"phone|tel\b|tel\.|call|mobile|fax|rufen|appele|llame",
}
AGAINST = (
    r"version|\bv\.|release|isbn|issn|order|section|chapter|invoice|token|key|sha|md5|serial|part no|item|ticket|batch|"
    r"build|model|total|population|page|reference|\bref\b|\bno\.|\bid\b|#$"
)
VOTES = ["form", "shape", "gazetteer", "context", "against", "digits"]
#: Further traits of a span and how many values each has: its length, its separators, the word before it (hashed).
TRAITS = {"length": 6, "separators": 5, "before": 8}
FAILED = 0.02  # likelihood of a candidate that fails its check
SPAN = "array<struct<kind:int,start:int,end:int,exact:boolean,votes:array<int>,traits:array<int>>>"


def vote(positive: Column, negative: Column | None = None) -> Column:
    out = F.when(positive, F.lit(1))
    if negative is not None:
        out = out.when(negative, F.lit(-1))
    return out.otherwise(F.lit(0))


def digits(entity: Column) -> Column:
    return F.regexp_replace(entity, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    def add(total, i):
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, entity: Column) -> Column:
    if kind == "ip":
        def small(part):
            short = F.regexp_replace(part, "^0+", "")
            return (F.length(short) <= 3) & (F.coalesce(F.try_to_number(short, F.lit("999")), F.lit(0)) <= 255)

        return F.forall(F.split(entity, r"\."), small)
    if kind == "card":
        number = digits(entity)
        return F.when(F.length(number).between(13, 19), luhn(number)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(entity)).between(9, 15)
    return F.lit(True)


def before_span(text: Column, span: Column) -> Column:
    """The 30 characters before a span, in lower case."""
    return F.lower(F.substring(text, F.greatest(span["start"] - 29, F.lit(1)), F.least(span["start"], F.lit(30))))


def votes(kind: str, text: Column, span: Column, form: int) -> Column:
    """The votes of the labelers on one candidate: 1 for, -1 against, 0 none. ``form`` is 1 for an exact span,
    -1 for one that fails its check, 0 for a looser form."""
    entity = span["entity"]
    number = digits(entity)
    before = before_span(text, span)
    by_form = vote(luhn(number), F.lit(True)) if kind == "card" else F.lit(form)
    odd = number.rlike(r"^([0-9])\1*$|0123456|1234567|9876543|0{5}|^(00|99)")
    if kind == "email":
        plain = F.regexp_replace(entity, r" ?[\[({](?:at|dot)[\])}] ?| dot ", ".")
        shape = vote(entity.rlike(r"^[A-Za-z][^ ]*$"), entity.rlike(r"\.\.|^[.%+-]"))
        known = vote(F.lower(F.element_at(F.split(plain, r"\."), -1)).isin(DOMAINS), F.lit(True))
        odd = entity.rlike(r"(?i)^[a-z]?(@| at )|^(noreply|no-reply|example|user|name)[@ ]|@(localhost|example)")
    elif kind == "ip":
        shape = vote(~entity.rlike(r"(^|[^0-9])0[0-9]|[0-9]{4}"), F.lit(True))
        known = vote(~entity.rlike(r"^(0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])[^0-9]"), F.lit(True))
        odd = entity.rlike(r"^[0-9][^0-9]+[0-9][^0-9]+[0-9][^0-9]+[0-9]$")  # as versions are
    elif kind == "card":
        shape = vote(F.length(number) == 16, ~F.length(number).between(14, 16))
        known = vote(number.rlike(ISSUERS), F.lit(True))
    else:
        shape = vote(F.length(number).between(10, 12) & entity.rlike(r"[^0-9+]"), ~F.length(number).between(9, 15))
        known = vote(entity.rlike(COUNTRIES)) if form else vote(number.rlike("^[02-9]"), F.lit(True))
    against = vote(F.lit(False), before.rlike(AGAINST))
    return F.array(by_form, shape, known, vote(before.rlike(CONTEXT[kind])), against, vote(F.lit(False), odd))


def traits(kind: str, text: Column, span: Column) -> Column:
    """Length, separators and the word before, each as a small number."""
    entity = span["entity"]
    length = F.length(entity) if kind == "email" else F.length(digits(entity))
    short = F.least(F.floor(length / (6 if kind == "email" else 3)), F.lit(TRAITS["length"] - 1)).cast("int")
    signs = F.regexp_replace(entity, "[A-Za-z0-9+]", "")
    classes = F.when(signs == "", 0).when(signs.rlike("^ +$"), 1).when(signs.rlike("^-+$"), 2).when(signs.rlike(r"^[.@]+$"), 3)
    word = F.regexp_extract(before_span(text, span), r"([\p{L}]+)[^\p{L}]*$", 1)
    hashed = F.when(word == "", 0).otherwise(1 + F.pmod(F.xxhash64(word), F.lit(TRAITS["before"] - 1))).cast("int")
    return F.array(short, classes.otherwise(4), hashed)


def gated(text: Column, signs: list[str], digit: Column) -> Column:
    has = F.lit(False)
    for s in signs:
        has = has | F.contains(text, F.lit(s))
    return has & digit


def candidates(text: Column, has_digit: Column, kind: str) -> Column:
    """Exact spans of a kind, matches that fail their check, and looser spans that touch none of the exact ones."""
    number = F.lit(KINDS.index(kind))
    digit = F.lit(True) if kind == "email" else has_digit
    none = F.expr(f"cast(array() as {SPAN})")

    def as_spans(found, form):
        return F.transform(found, lambda s: F.struct(
            number.alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(form == 1).alias("exact"),
            votes(kind, text, s, form).alias("votes"), traits(kind, text, s).alias("traits"),
        ))

    def split(matches):
        good = as_spans(F.filter(matches, lambda s: valid(kind, s["entity"])), 1)
        if FAILING[kind] is None:
            return good
        bad = F.filter(
            matches, lambda s: F.length(digits(s["entity"])).between(*FAILING[kind]) & ~valid(kind, s["entity"])
        )
        return F.concat(good, as_spans(bad, -1))

    own = F.transform(F.array(match_spans(text, EXACT[kind])), split)[0]
    own = F.when(gated(text, SIGNS[kind], digit), own).otherwise(none)
    loose = as_spans(match_spans(text, LOOSE[kind]), 0)
    loose = F.when(gated(text, LOOSE_SIGNS[kind], digit), loose).otherwise(none)
    return F.concat(own, loose)


def spotted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with an array ``_spans`` of candidates with votes."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    def apart(spans):
        """Without looser or failing spans that touch an exact one, of any kind, or a failing one of their kind."""
        def touched(s):
            near = lambda e: (e["start"] < s["end"]) & (s["start"] < e["end"])
            failing = lambda e: (e["kind"] == s["kind"]) & (e["votes"][0] < 0) & (s["votes"][0] >= 0)
            return F.exists(spans, lambda e: near(e) & (e["exact"] | failing(e)))

        return F.filter(spans, lambda s: s["exact"] | ~touched(s))

    found = F.concat(*[candidates(value, value.rlike("[0-9]"), k) for k in KINDS])
    found = F.transform(F.array(found), apart)[0]
    # A text without a digit or a sign of an address is not looked at again.
    needed = value.rlike(r"[0-9@]|[\[({]at[\])}]| dot ")
    return docs.select("*", F.when(needed, found).otherwise(F.expr(f"cast(array() as {SPAN})")).alias("_spans"))


def reliabilities(patterns: dict[tuple[int, ...], float], rounds: int = 50) -> dict[tuple[int, ...], float]:
    """Likelihood of each vote pattern by expectation-maximisation with one reliability per labeler and vote.

    Candidates that fail their check (first vote against) are known negatives: how often the other labelers
    speak for them says how little these can be relied on.
    """
    keys = np.array(list(patterns))
    count = np.array(list(patterns.values()), float)
    failed = keys[:, 0] < 0
    belief = np.where(failed, FAILED, 1 / (1 + np.exp(-1.5 * keys.sum(axis=1))))
    for _ in range(rounds):
        mass = np.stack([count * (1 - belief), count * belief])
        log = np.log((mass.sum(axis=1) + 1) / (count.sum() + 2))[:, None].repeat(len(keys), axis=1)
        for j in range(keys.shape[1]):
            for v in (-1, 0, 1):
                here = keys[:, j] == v
                # A vote for is no evidence against, and the other way round, before data say so.
                start = np.array([1.5 if v < 0 else 1.0, 1.5 if v > 0 else 1.0])
                share = (mass[:, here].sum(axis=1) + start) / (mass.sum(axis=1) + 3.5)
                log[:, here] += np.log(share)[:, None]
        belief = np.where(failed, FAILED, 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50))))
    return dict(zip(patterns, belief.tolist()))


def features(votes_: np.ndarray, traits_: np.ndarray) -> np.ndarray:
    """One for and one against per labeler, one per value of each trait, and a constant."""
    parts = [votes_ > 0, votes_ < 0]
    parts += [traits_[:, [j]] == np.arange(n) for j, n in enumerate(TRAITS.values())]
    return np.concatenate([*parts, np.ones((len(votes_), 1))], axis=1).astype(float)


def classifier(counts: dict[tuple, float], belief: dict[tuple[int, ...], float]) -> list[float]:
    """Weights of a logistic classifier of :func:`features`, for counted ``(votes, traits)``."""
    keys = list(counts)
    x = features(np.array([k[0] for k in keys]), np.array([k[1] for k in keys]))
    y, n = np.array([belief[k[0]] for k in keys]), np.array(list(counts.values()), float)
    n = n / n.sum()
    w, pull = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-3)
    pull[2 * len(VOTES) : -1] = 1e-2  # traits correct the votes, they do not replace them
    for _ in range(100):
        q = 1 / (1 + np.exp(-x @ w))
        curve = (x * (n * q * (1 - q))[:, None]).T @ x + np.diag(pull)
        w += np.linalg.solve(curve, x.T @ (n * (y - q)) - pull * w)
    return w.tolist()


def trained(marked: DataFrame) -> dict[int, list[float]]:
    """Classifier weights per kind, from the counted votes and traits of all candidates.

    The driver sees one row per combination that occurs: at most 3^6 of votes times 240 of traits a kind.
    """
    spans = marked.select(F.explode("_spans").alias("s"))
    rows = spans.groupBy("s.kind", "s.votes", "s.traits").agg(F.count(F.lit(1)).alias("n")).collect()
    by_kind: dict[int, dict[tuple, float]] = defaultdict(dict)
    for r in sorted(rows, key=lambda r: (r["kind"], r["votes"], r["traits"])):
        by_kind[r["kind"]][tuple(r["votes"]), tuple(r["traits"])] = r["n"]
    weights = {}
    for kind, counts in by_kind.items():
        patterns: dict[tuple[int, ...], float] = defaultdict(float)
        for (pattern, _), n in counts.items():
            patterns[pattern] += n
        weights[kind] = classifier(counts, reliabilities(dict(patterns)))
    return weights


def chosen(weights: dict[int, list[float]]) -> Column:
    """The exact spans and those the classifier accepts, as ``kind, start, end, exact`` by kind and start."""
    def accepted(s):
        total = F.lit(False)
        for kind, w in weights.items():
            score, at = F.lit(w[-1]), 2 * len(VOTES)
            for j in range(len(VOTES)):
                v = s["votes"][j]
                score = score + F.when(v > 0, w[j]).when(v < 0, w[len(VOTES) + j]).otherwise(0.0)
            for j, n in enumerate(TRAITS.values()):
                score = score + F.get(F.array(*[F.lit(x) for x in w[at : at + n]]), s["traits"][j])
                at += n
            total = total | ((s["kind"] == kind) & (score > 0))
        return s["exact"] | total

    slim = F.transform(F.filter("_spans", accepted), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["exact"].alias("exact")))
    return F.array_sort(slim)


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key and ``spans``, an array of ``kind`` (index into ``KINDS``), ``start``, ``end`` (code
    points, end exclusive) and ``exact`` (found by the exact pattern), by kind and start.

    A null text is empty; empty texts have no spans. Reliabilities are estimated from all rows, repeated
    ones counted as often as they occur; without candidates nothing is added. Other columns are ignored;
    an empty table gives an empty result.
    """
    marked = stored(spotted(docs.select(key, text), text).drop(text), "spans")
    return marked.select(key, chosen(trained(marked)).alias("spans"))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of :func:`personal_data` replaced by its kind in angle brackets.

    Overlapping spans are replaced together, under the kind of the first. Null texts stay null, empty ones
    empty; repeated rows stay as often as they occur; an empty table gives an empty result.
    """
    whole = docs.select(F.struct("*").alias("_row"))
    marked = stored(spotted(whole, f"_row.{text}"), "spans")
    body = F.col(f"_row.{text}")
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    in_order = F.array_sort(F.transform(chosen(trained(marked)), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, s):
        fresh = s["start"] >= state["at"]
        gap = F.substring(body, state["at"] + 1, s["start"] - state["at"])
        out = F.when(fresh, F.concat(state["out"], gap, F.get(names, s["kind"]))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    rewritten = F.aggregate(
        in_order, start, step, lambda a: F.concat(a["out"], F.substring(body, a["at"] + 1, F.length(body)))
    )
    clean = F.when(F.size("_spans") > 0, rewritten).otherwise(body)
    return marked.withColumn("_clean", clean).select(*[
        (F.col("_clean") if c == text else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns
    ])
