"""Cutting texts into pieces and putting piece-wise results together again."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Preferred places to cut, best first; the cut comes after the separator.
SEPARATORS = [". ", "! ", "? ", ": ", "; ", "-", "/", ".", "!", "?", " "]

# Pieces handed back to Spark at a time.
ROWS_OUT = 20_000


def cut_points(text: str, limit: int) -> list[int]:
    """Ends of the pieces of ``text``, none longer than ``limit``."""
    ends, start = [], 0
    while len(text) - start > limit:
        window = text[start : start + limit]
        best = next((s for s in SEPARATORS if s in window), None)
        start += window.rindex(best) + len(best) if best else limit
        ends.append(start)
    return [*ends, len(text)]


def preference_pieces(df: DataFrame, key: str, text: str, limit: int) -> DataFrame:
    """``key, piece_no, piece``: every text cut before ``limit`` characters at its best separator.

    Where the next cut may fall depends on the cut before, which no column
    expression states; texts stay in their partition and pass in Arrow batches.
    """
    schema = f"{key} {df.schema[key].dataType.simpleString()}, piece_no int, piece string"

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, value in zip(batch[key], batch[text]):
                if value is None:
                    continue
                ends = cut_points(value, limit)
                rows += [(name, i, value[a:b]) for i, (a, b) in enumerate(zip([0, *ends], ends))]
                if len(rows) >= ROWS_OUT:
                    yield pd.DataFrame(rows, columns=[key, "piece_no", "piece"])
                    rows = []
            yield pd.DataFrame(rows, columns=[key, "piece_no", "piece"])

    return df.select(key, text).mapInPandas(split, schema)


def rejoined(df: DataFrame, keys: Sequence[str], number: str, part: str, name: str) -> DataFrame:
    """The parts of each text in order, each with a leading blank."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(number).alias("i"), F.col(part).alias("p"))))
    parts = df.groupBy(*keys).agg(ordered.alias("_parts"))
    joined = F.concat(F.lit(" "), F.array_join(F.transform("_parts", lambda x: x["p"]), " "))
    return parts.select(*keys, joined.alias(name))


def topic_text(ranked: DataFrame, key: str) -> DataFrame:
    """Render ``key, rank, token, weight`` as topic strings and read words and scores back."""
    cell = F.format_string('%.3f*"%s"', "weight", "token")
    ordered = F.array_sort(F.collect_list(F.struct("rank", cell.alias("cell"))))
    shown = ranked.groupBy(key).agg(ordered.alias("cells"))
    shown = shown.select(key, F.array_join(F.transform("cells", lambda c: c["cell"]), " + ").alias("topic"))
    found = F.regexp_extract_all("topic", F.lit('"([A-Za-z]+)"'), F.lit(1))
    scores = F.regexp_extract_all("topic", F.lit(r"([0-9.]+)\*"), F.lit(1))
    pairs = shown.select(key, F.posexplode(F.arrays_zip(found.alias("word"), scores.alias("score"))).alias("i", "pair"))
    return pairs.select(key, (F.col("i") + 1).alias("rank"), "pair.word", "pair.score")
