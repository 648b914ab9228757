"""Groups of spelling variants, by Bloom-guided neighbourhoods of a whole vocabulary.

Every word's possible edits (one code point deleted or replaced; insertions are deletions seen
from the other word) are generated as hashes only and probed against blocked Bloom filters, one
shard per word length, that the workers hold. Only positives are shuffled: they meet the exact
vocabulary by hash, and what is left is compared as text, which removes the false ones.

A filter has a bounded size. A vocabulary that needs more blocks is probed in several passes,
each over another range of blocks, so what is sent to the workers does not grow with the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.tables import stored

SHORTEST = 7
RUN = "[A-Za-z\\u00C0-\\u00FF]{7,}"  # shorter runs never become words: a deletion only shortens
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST = 256  # words of this length and more share a shard
WORDS_PER_BLOCK = 4  # a block is 64 bits, a word sets up to five of them
BLOCKS = 1 << 22  # a pass's filter has at most so many blocks: 32 MB
PROBES = 1 << 20  # hashes made at once
BASE = 0x9E3779B97F4A7C15  # odd, so that powers of it never vanish
FOLLOWED = 8  # rounds of doubling; a form has ten times the count, so chains have under 20 words


def marked_runs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``word``: every run of seven letters or more, lower-case, some with one code point deleted by rule.

    The crc32 h of ``key:run`` decides: if 31 divides h, the code point h mod length goes.
    """
    # pattern matched by the JVM; \\u escapes are resolved by its regular expressions
    runs = F.regexp_extract_all(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(RUN), F.lit(0))
    raw = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("_key"), F.explode(runs).alias("_raw")
    )
    run = F.when(F.col("_raw").rlike("[A-Z]"), F.translate("_raw", UPPER, LOWER)).otherwise(F.col("_raw"))
    df = raw.select("_key", run.alias("run"))
    df = df.select("run", F.crc32(F.concat("_key", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return df.select(F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, key: str, text: str, least: int = 2) -> DataFrame:
    """``(word, n)`` of the words of at least seven code points and ``least`` occurrences."""
    words = marked_runs(docs, key, text).where(F.length("word") >= SHORTEST)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def code_points(words: list[str], length: int) -> np.ndarray:
    """A matrix of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def powers(count: int) -> np.ndarray:
    out = np.full(count, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    """Sums of code points times powers, scattered over 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(points: np.ndarray) -> np.ndarray:
    return mixed((points.astype(np.uint64) * powers(points.shape[1])).sum(axis=1, dtype=np.uint64))


def places(hashes: np.ndarray, first: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of every hash in a shard of ``blocks`` from ``first``, and the bits it sets there."""
    block = first + (((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)
    one, bits = np.uint64(1), np.zeros(len(hashes), np.uint64)
    for shift in range(0, 30, 6):
        bits |= one << ((hashes >> np.uint64(shift)) & np.uint64(63))
    return block, bits


def by_length(words: list[str]):
    """``(length, rows)`` for every length among the words."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


def hashed(words: DataFrame) -> DataFrame:
    """``(word, n, length, hash)``."""

    def add(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = np.zeros(len(texts), np.uint64)
            for length, rows in by_length(texts):
                step = max(1, PROBES // length)
                for i in range(0, len(rows), step):
                    part = rows[i : i + step]
                    found[part] = word_hashes(code_points([texts[r] for r in part], length))
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([len(t) for t in texts], pa.int32()), pa.array(found.view(np.int64)),
            ], ["word", "n", "length", "hash"])

    return words.select("word", "n").mapInArrow(add, "word string, n long, length int, hash long")


def shards_of(words: DataFrame) -> dict[int, tuple[int, int]]:
    """First block and number of blocks per shard, at most 250 shards."""
    counted = words.groupBy(F.least("length", F.lit(LONGEST)).alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    out, first = {}, 0
    for r in sorted(counted.collect(), key=lambda r: r["shard"]):
        blocks = max(64, -(-r["n"] // WORDS_PER_BLOCK))
        out[r["shard"]] = (first, blocks)
        first += blocks
    return out


def filter_rows(words: DataFrame, shards: dict[int, tuple[int, int]], start: int, stop: int) -> DataFrame:
    """``(block, bits)``: the blocks of the filter from ``start`` to ``stop``, partial ones merged by OR."""

    def put(batches):
        for batch in batches:
            hashes = batch.column(1).to_numpy().view(np.uint64)
            shard = np.minimum(batch.column(0).to_numpy(), LONGEST)
            for s in np.unique(shard):
                block, bits = places(hashes[shard == s], *shards[int(s)])
                inside = (block >= start) & (block < stop)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[inside]), pa.array(bits[inside].view(np.int64))], ["block", "bits"]
                )

    parts = words.select("length", "hash").mapInArrow(put, "block long, bits long")
    return parts.groupBy("block").agg(F.bit_or("bits").alias("bits"))


def alphabet_of(words: DataFrame) -> list[int]:
    """The code points that words consist of: at most the 90 of the pattern."""
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    return sorted(ord(r["c"]) for r in letters.collect())


def edits(points: np.ndarray, alphabet: np.ndarray):
    """``(rows, hashes, change of length)`` of the words' deletions and replacements, in bounded steps.

    A replacement puts a later code point than the one it replaces, so each pair is met from one side.
    """
    count, length = points.shape
    power = powers(length)
    terms = points.astype(np.uint64) * power
    whole = terms.sum(axis=1, dtype=np.uint64)
    ahead = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    # What follows a deleted code point moves down by one place.
    moved = np.zeros_like(terms)
    moved[:, :-1] = points[:, 1:].astype(np.uint64) * power[:-1]
    behind = moved.sum(axis=1, dtype=np.uint64)[:, None] - (np.cumsum(moved, axis=1, dtype=np.uint64) - moved)
    rows = np.repeat(np.arange(count), length)
    yield rows, mixed((ahead + behind).ravel()), -1
    wide = max(1, PROBES // (count * len(alphabet)))
    for i in range(0, length, wide):
        part = points[:, i : i + wide]
        shift = (alphabet[None, None, :].astype(np.uint64) - part[:, :, None].astype(np.uint64)) * power[i : i + wide, None]
        later = alphabet[None, None, :] > part[:, :, None]
        rows, _, _ = np.nonzero(later)
        yield rows, mixed((whole[:, None, None] + shift)[later]), 0


def positives(
    words: DataFrame, alphabet: list[int], shards: dict[int, tuple[int, int]], start: int, stop: int, filled
) -> DataFrame:
    """``(source, candidate)`` hashes of the edits that the filter's blocks from ``start`` to ``stop`` hold."""

    def probe(batches):
        signs = np.array(alphabet, np.uint32)
        bits = filled.value
        for batch in batches:
            texts, own = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for length, rows in by_length(texts):
                step = max(1, PROBES // (length * len(signs)))
                for i in range(0, len(rows), step):
                    part = rows[i : i + step]
                    for at, hashes, change in edits(code_points([texts[r] for r in part], length), signs):
                        shard = shards.get(min(length + change, LONGEST))
                        if shard is None or shard[0] >= stop or sum(shard) <= start:
                            continue
                        block, wanted = places(hashes, *shard)
                        if shard[0] < start or sum(shard) > stop:
                            inside = (block >= start) & (block < stop)
                            at, hashes, block, wanted = at[inside], hashes[inside], block[inside], wanted[inside]
                        held = (bits[block - start] & wanted) == wanted
                        if held.any():
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(own[part[at[held]]]), pa.array(hashes[held].view(np.int64))],
                                ["source", "candidate"],
                            )

    return words.select("word", "hash").mapInArrow(probe, "source long, candidate long")


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, n, other, other_n)``: all pairs of words one insertion, deletion or replacement apart, both ways.

    ``words`` holds distinct words with ``n``, ``length`` and ``hash`` and is read more than once.
    """
    spark = words.sparkSession
    shards, alphabet = shards_of(words), alphabet_of(words)
    total = max((first + blocks for first, blocks in shards.values()), default=0)
    found = None
    for start in range(0, total, BLOCKS):
        stop = min(total, start + BLOCKS)
        bits = np.zeros(stop - start, np.uint64)
        rows = filter_rows(words, shards, start, stop).toArrow()  # at most BLOCKS rows of two numbers
        bits[rows["block"].to_numpy() - start] = rows["bits"].to_numpy().view(np.uint64)
        passed = positives(words, alphabet, shards, start, stop, spark.sparkContext.broadcast(bits)).distinct()
        found = passed if found is None else found.unionAll(passed)
    if found is None:
        found = spark.createDataFrame([], "source long, candidate long")
    exact = words.select(F.col("hash").alias("candidate"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    known = found.join(exact, "candidate")
    sources = words.select(F.col("hash").alias("source"), "word", "n")
    pairs = known.join(sources, "source").where(F.levenshtein("word", "other", 1) == 1)
    turned = F.explode(F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"),
                 F.col("n").alias("other_n")),
    ))
    return pairs.select(turned.alias("p")).select("p.*").distinct()


def best(other: str, n: str) -> Column:
    """The neighbour of the largest count, ties to the smallest word."""
    return F.min(F.struct((-F.col(n)).alias("less"), F.col(other).alias("word")))


def roots_of(forms: DataFrame) -> DataFrame:
    """``(word, root)`` by doubling: every round follows each chain twice as far."""
    links = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(FOLLOWED):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = stored(links.join(onward, "root", "left"), "roots")
        links = further.select("word", F.coalesce("_next", "root").alias("root"))
        if further.where(F.col("_next").isNotNull()).isEmpty():
            break
    return links


def group_variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 2, factor: int = 10
) -> DataFrame:
    """The words of a corpus: ``word, n, form, root, n_near, form_n``.

    A word is a run of at least seven letters (some with a code point deleted, see :func:`marked_runs`)
    that occurs ``least`` times or more. ``form`` is its near word of the largest count (ties: the smaller
    word) if that count is at least ``factor`` times its own; ``root`` ends the chain of forms. A
    null text has no words, a null key counts as an empty string; repeated rows count as often as they occur; other columns are ignored; an
    empty table gives an empty result. Runs and texts may have any length.
    """
    words = stored(hashed(vocabulary(docs, key, text, least)), "vocabulary")
    pairs = near_pairs(words)
    top = pairs.groupBy("word").agg(
        F.max("n").alias("n"), F.count(F.lit(1)).alias("n_near"), best("other", "other_n").alias("top")
    )
    strong = -F.col("top.less") >= factor * F.col("n")
    near = stored(top.select(
        "word", "n_near", F.when(strong, F.col("top.word")).alias("form"),
        F.when(strong, -F.col("top.less")).alias("form_n"),
    ), "near-words")
    roots = roots_of(near.where(F.col("form").isNotNull()))
    return (
        words.select("word", "n").join(near, "word", "left").join(roots, "word", "left")
        .select("word", "n", "form", F.coalesce("root", "word").alias("root"),
                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
