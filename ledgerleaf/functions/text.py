"""Text transforms as column expressions.

A transform is a list of ``(pattern, replacement)`` rules applied in order.
Patterns use explicit ASCII classes and neither look-around nor back-references,
so that they mean the same in every regular-expression dialect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.words import ABBREVIATIONS, LEMMA_EXCEPTIONS

Rules = list[tuple[str, str]]


def outside(*kept: str) -> str:
    """Character class of everything but ``kept``, given as ranges (``"AZ"``) and single characters.

    Spelled with positive ranges: the JVM tests a long negated class several times slower.
    """
    ends = sorted((ord(k[0]), ord(k[-1])) for k in kept)
    gaps, low = [], 0
    for first, last in [*ends, (0x110000, 0x110000)]:
        if first > low:
            gaps.append(f"\\x{{{low:x}}}-\\x{{{first - 1:x}}}")
        low = max(low, last + 1)
    return f"[{''.join(gaps)}]"


URLS: Rules = [(r"http[^ \t\r\n]+", "")]
# Anchored at the word's start, so that words without digits are passed over in linear time.
DIGIT_WORDS: Rules = [(r"(^|[ \t\r\n])[^ \t\r\n0-9]*[0-9][^ \t\r\n]*", "$1")]
LETTERS: Rules = [(r"[^A-Za-z]+", " ")]
LETTERS_DIGITS_PUNCT: Rules = [(outside("AZ", "az", "09", *".,") + "+", " ")]
# Runs, not single characters: the same result from far fewer matches.
KEEP_PUNCT: Rules = [(outside("AZ", "az", *"., \t\r\n+") + "+", "")]
ALPHANUMERIC: Rules = [(outside("AZ", "az", "09", *" \t\r\n+") + "+", "")]
CLASSIFIER_TEXT: Rules = [(outside("AZ", "az", *" \t\r\n+") + "+", ""), (r"[ \t\r\n]+", " ")]
ONE_BLANK: Rules = [(r"[ \t\r\n]+", " ")]
NEWLINES: Rules = [(r"\n+", " ")]
NBSP_PLUS: Rules = [("[\u00a0+]+", " ")]
SAFE_NAME: Rules = [(r"[^A-Za-z0-9]", "_")]

# Irregular forms first, then the regular endings.
CONTRACTIONS: Rules = [
    ("’", "'"),
    (r"(^|[^A-Za-z])([Ww])on't([^A-Za-z]|$)", "$1$2ill not$3"),
    (r"(^|[^A-Za-z])([Cc])an't([^A-Za-z]|$)", "$1$2annot$3"),
    (r"(^|[^A-Za-z])([Ss])han't([^A-Za-z]|$)", "$1$2hall not$3"),
    (r"(^|[^A-Za-z])([Ll])et's([^A-Za-z]|$)", "$1$2et us$3"),
    (r"([A-Za-z])n't([^A-Za-z]|$)", "$1 not$2"),
    (r"([A-Za-z])'re([^A-Za-z]|$)", "$1 are$2"),
    (r"([A-Za-z])'ve([^A-Za-z]|$)", "$1 have$2"),
    (r"([A-Za-z])'ll([^A-Za-z]|$)", "$1 will$2"),
    (r"([A-Za-z])'m([^A-Za-z]|$)", "$1 am$2"),
    (r"([A-Za-z])'d([^A-Za-z]|$)", "$1 would$2"),
    (r"(^|[^A-Za-z])([Ii]t|[Tt]hat|[Ww]hat|[Hh]ere|[Tt]here|[Ww]ho|[Hh]e|[Ss]he)'s([^A-Za-z]|$)", "$1$2 is$3"),
]
# What a text holds wherever the rule of the same place matches.
CONTRACTION_SIGNS = ["’", "on't", "an't", "han't", "et's", "n't", "'re", "'ve", "'ll", "'m", "'d", "'s"]

_BLOCK = "p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|footer|header|blockquote|pre|hr|main|aside"
_ENTITIES = [
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
    ("&copy;", "©"), ("&middot;", "·"), ("&mdash;", "—"), ("&hellip;", "…"), ("&amp;", "&"),
]
# Invisible parts go, block elements become line ends, other tags vanish.
TAGS: Rules = [
    (r"(?is)<!--.*?-->", ""),
    (r"(?is)<script[^>]*>.*?</script>", ""),
    (r"(?is)<style[^>]*>.*?</style>", ""),
    (r"(?is)<head(?:[ \t\r\n][^>]*)?>.*?</head>", ""),
    (rf"(?i)</?(?:{_BLOCK})(?:[ \t\r\n/][^>]*)?>", "\n"),
    (r"<[^>]*>", ""),
]
ENTITIES: Rules = _ENTITIES
LINES: Rules = [(r"[ \t\r]+", " "), (r" ?\n ?", "\n"), (r"\n{3,}", "\n\n")]
# What a text holds wherever the rule of the same place changes something.
LINE_SIGNS = [["  ", "\t", "\r"], [" \n", "\n "], ["\n\n\n"]]
MARKUP: Rules = [*TAGS, *ENTITIES, *LINES]
# A viewer's banner may precede the first element of a saved XML file.
XML_TEXT: Rules = [(r"^[^<]*", ""), (r"<[^>]*>", " "), *_ENTITIES, (r"[ \t\r\n]+", " ")]

PROFILES: dict[str, Rules] = {
    "none": [],
    "letters": LETTERS,
    "letters_digits_punct": LETTERS_DIGITS_PUNCT,
    "keep_punct": KEEP_PUNCT,
}

SENTENCE_END = "\u0001"
GUARDED_STOP = "\u0002"
GUARD: Rules = [(rf"(^|[^A-Za-z])({'|'.join(ABBREVIATIONS)})\.", f"$1$2{GUARDED_STOP}")]
MARK_SENTENCES: Rules = [*GUARD, (r"([.!?])[ \t\r\n]+", f"$1{SENTENCE_END}")]

FENCE = "\u0003"
SPAN_ARRAY = "array<struct<start:int,end:int,entity:string>>"
TOKEN_PATTERN = r"[\p{L}_]+"
WORD_OR_MARK = "[A-Za-z0-9]+|" + outside("AZ", "az", "09", *" \t\r\n")


def apply_rules(text: Column, rules: Rules) -> Column:
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def apply_where(text: Column, signs: list[str], rules: Rules) -> Column:
    """The rules, run only on texts that contain one of the ``signs`` without which none can match."""

    def gate(x: Column) -> Column:
        needed = F.contains(x, F.lit(signs[0]))
        for sign in signs[1:]:
            needed = needed | F.contains(x, F.lit(sign))
        return F.when(needed, apply_rules(x, rules)).otherwise(x)

    return bound(text, gate)


def unfolded(df: DataFrame, keep: list, array: Column, *names: str) -> DataFrame:
    """One row per array element, as ``posexplode`` (two names) or ``explode`` (one name).

    The outer form with a filter behind it keeps the optimizer from testing the
    array for emptiness in front, which would compute an array expression twice.
    Elements must not be null.
    """
    spread = F.posexplode_outer(array) if len(names) == 2 else F.explode_outer(array)
    return df.select(*keep, spread.alias(*names)).where(F.col(names[-1]).isNotNull())


def remove_urls(text: Column) -> Column:
    return apply_where(text, ["http"], URLS)


def expand_contractions(text: Column) -> Column:
    """The rules of ``CONTRACTIONS``, each run only on texts that hold its sign."""

    def expanded(x: Column) -> Column:
        for sign, rule in zip(CONTRACTION_SIGNS, CONTRACTIONS, strict=True):
            x = apply_where(x, [sign], [rule])
        return x

    return bound(text, lambda x: F.when(F.contains(x, F.lit("'")) | F.contains(x, F.lit("’")), expanded(x)).otherwise(x))


def strip_markup(html: Column) -> Column:
    """Readable text of an HTML page; links keep their words and lose their targets."""
    plain = apply_where(apply_where(html, ["<"], TAGS), ["&"], ENTITIES)
    for signs, rule in zip(LINE_SIGNS, LINES, strict=True):
        plain = apply_where(plain, signs, [rule])
    return F.btrim(plain, F.lit(" \n"))


def xml_text(xml: Column) -> Column:
    """Text content of an XML document, white space normalised."""
    return F.trim(apply_rules(xml, XML_TEXT))


def clean_profiles(text: Column, profiles: list[str]) -> Column:
    """STRUCT of cleaned texts, one per profile; the steps they share run once.

    URLs, tags, contractions and words with digits go first, then each profile's
    character filter; the profile ``none`` leaves the text as it is.
    """
    unknown = [p for p in profiles if p not in PROFILES]
    if unknown:
        raise ValueError(f"unknown cleaning profiles {unknown}")
    plain = expand_contractions(strip_markup(remove_urls(text)))
    # The rule as it is, but no sign of a word without digits is tried twice.
    plain = F.trim(apply_rules(plain, [(p.replace("0-9]*[", "0-9]*+["), r) for p, r in DIGIT_WORDS]))
    return bound(plain, lambda x: F.struct(
        *[(text if p == "none" else apply_rules(x, PROFILES[p])).alias(p) for p in profiles]
    ))


def clean_text(text: Column, profile: str = "letters") -> Column:
    """The text cleaned by one profile."""
    if profile == "none":
        return text
    return clean_profiles(text, [profile])[profile]


def squeeze(text: Column) -> Column:
    return F.trim(apply_rules(text, ONE_BLANK))


def sentences(text: Column) -> Column:
    """ARRAY of sentences; a stop after a listed abbreviation does not split."""
    parts = F.split(apply_rules(text, MARK_SENTENCES), SENTENCE_END)
    parts = F.transform(parts, lambda s: F.trim(F.translate(s, GUARDED_STOP, ".")))
    return F.filter(parts, lambda s: s != "")


def words(text: Column) -> Column:
    """ARRAY of white-space separated words; empty for blank text."""

    def cut(line: Column) -> Column:
        return F.when(line == "", F.array().cast("array<string>")).otherwise(F.split(line, " "))

    return bound(squeeze(text), cut)


def tokens(text: Column, shortest: int = 2, longest: int = 15) -> Column:
    """ARRAY of lower-case alphabetic tokens within the length bounds."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.filter(found, lambda t: F.length(t).between(shortest, longest))


def words_and_marks(text: Column) -> Column:
    """ARRAY of words and single punctuation marks."""
    return F.regexp_extract_all(text, F.lit(WORD_OR_MARK), F.lit(0))


def chunks(word_list: Column, size: int, overlap: int = 0) -> Column:
    """ARRAY of blank-joined runs of ``size`` words, each sharing ``overlap`` with the one before."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be non-negative and below the chunk size")
    step = size - overlap

    def cut(known: Column) -> Column:
        count = F.greatest(F.lit(1), F.ceil((F.size(known) - overlap) / F.lit(step)).cast("int"))
        pieces = F.transform(
            F.sequence(F.lit(0), count - 1), lambda i: F.array_join(F.slice(known, i * step + 1, size), " ")
        )
        return F.when(F.size(known) > 0, pieces).otherwise(F.array().cast("array<string>"))

    return bound(word_list, cut)


def lemma(token: Column) -> Column:
    """Singular noun form by suffix rules; words the rules would spoil are listed."""
    listed = F.create_map(*[F.lit(x) for pair in LEMMA_EXCEPTIONS.items() for x in pair])
    return (
        F.when(F.length(token) <= 3, token)
        .when(token.isin(list(LEMMA_EXCEPTIONS)), F.try_element_at(listed, token))
        .when(~(token.endswith("s") | token.endswith("men")), token)
        .when(token.endswith("ies"), F.regexp_replace(token, "ies$", "y"))
        .when(token.rlike("(ss|sh|ch|x|z)es$"), F.regexp_replace(token, "es$", ""))
        .when(token.endswith("men"), F.regexp_replace(token, "men$", "man"))
        .when(token.endswith("ss") | token.endswith("us") | token.endswith("is"), token)
        .otherwise(F.regexp_replace(token, "s$", ""))
    )


def span_at(text: Column, start: Column, end: Column) -> Column:
    """The substring between 0-based ``start`` and exclusive ``end``."""
    return F.substring(text, start + 1, end - start)


def match_spans(text: Column, pattern: str) -> Column:
    """ARRAY<STRUCT<start, end, entity>> of all matches, offsets 0-based, end exclusive.

    Matches are fenced in by a sign in one pass of the pattern. The text between matches and the
    matches themselves then alternate, so running lengths give every offset without leaving the
    row. A text that holds the sign itself is gone through twice instead.
    """
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPAN_ARRAY})").alias("spans"))

    def step(state, pair):
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["entity"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["entity"].alias("entity"))
        return F.struct(end.alias("at"), F.array_append(state["spans"], span).alias("spans"))

    def walk(pairs):
        return F.aggregate(pairs, start, step, lambda state: state["spans"])

    def paired(parts):
        places = F.filter(parts, lambda _p, i: i % 2 == 1)
        gaps = F.slice(F.filter(parts, lambda _p, i: i % 2 == 0), 1, F.size(places))
        return F.zip_with(gaps, places, lambda g, m: F.struct(g.alias("gap"), m.alias("entity")))

    def twice(found):
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        return F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), m.alias("entity")))

    fenced = F.split(F.regexp_replace(text, pattern, f"{FENCE}$0{FENCE}"), FENCE, -1)
    pairs = F.when(F.contains(text, F.lit(FENCE)), bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), twice))
    return walk(pairs.otherwise(bound(fenced, paired)))
