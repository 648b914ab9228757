"""Personal data: typed spans with offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.text import SPAN_ARRAY, match_spans, unfolded
from ledgerleaf.functions.words import MONTHS
from ledgerleaf.operators.frame import lookup_join

# Fixed patterns; alternatives are tried from left to right.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"\+?[0-9]{1,2} \([0-9]{3}\) [0-9]{3}-[0-9]{4}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}"
# A heuristic: two capitalised words in a row, letters of any alphabet.
PERSON = r"\p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+"
_MONTH = "|".join(MONTHS)
DATE = (
    rf"(?:{_MONTH}) [0-9]{{1,2}}, [0-9]{{4}}|[0-9]{{1,2}} (?:{_MONTH}) [0-9]{{4}}"
    r"|[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}"
)
# A sign without which a pattern cannot match; texts without it skip the pattern.
SIGNS = {"EMAIL_ADDRESS": "@", "PHONE_NUMBER": "-"}
# Signs with which every match of a pattern begins; looked at before its alternatives are tried one by one.
FIRST = {DATE: "(?=[0-9ADFJMNOS])"}
PATTERNS = {"EMAIL_ADDRESS": EMAIL, "PHONE_NUMBER": PHONE, "PERSON": PERSON, "DATE": DATE}


def spans_of(
    df: DataFrame, key: str, text: str, patterns: dict[str, str] | None = None, keep_text: bool = False
) -> DataFrame:
    """``key, entity_type, entity, start, end`` of all matches of all patterns, in one pass over the texts."""
    def typed(kind: str, pattern: str):
        known = FIRST.get(pattern, "")
        spans = match_spans(F.col(text), f"{known}(?:{pattern})" if known else pattern)
        if kind in SIGNS:
            present = F.contains(F.col(text), F.lit(SIGNS[kind]))
            spans = F.when(present, spans).otherwise(F.expr(f"cast(array() as {SPAN_ARRAY})"))
        return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("entity_type"), s.alias("s")))

    # A text without matches has empty arrays; a missing text has null and gives no rows.
    spans = F.concat(*[typed(kind, p) for kind, p in (patterns or PATTERNS).items()])
    rows = unfolded(df, [key, *([text] if keep_text else [])], spans, "m")
    columns = ["m.entity_type", "m.s.entity", "m.s.start", "m.s.end"]
    return rows.select(key, *([text] if keep_text else []), *columns)


def spans_with_places(
    df: DataFrame, key: str, text: str, places: DataFrame, candidate: str, patterns: dict[str, str] | None = None
) -> DataFrame:
    """:func:`spans_of`, and as LOCATION the matches of ``candidate`` that the ``place`` column of a gazetteer holds.

    Upper and lower case do not matter to the gazetteer.
    """
    found = spans_of(df, key, text, {**(patterns or PATTERNS), "LOCATION": candidate})
    found = found.withColumn("_place", F.when(F.col("entity_type") == "LOCATION", F.upper("entity")))
    names = places.where(F.col("place").isNotNull()).select(F.upper("place").alias("_place"), F.lit(True).alias("_known"))
    met = lookup_join(found, names.distinct(), "_place", F.struct(key, "start"), "left")
    return met.where("_place IS NULL OR _known").select(key, "entity_type", "entity", "start", "end")
