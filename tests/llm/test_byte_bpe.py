"""Byte-level BPE against the library that reads the ranks itself."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerleaf.llm import byte_bpe

PATTERN = public_tokenizers.PATTERN
RANKS = byte_bpe.read_ranks(str(public_tokenizers.path("byte_bpe_50k.tiktoken")))
PLAIN = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
IDS = byte_bpe.PretokenIds(byte_bpe.bpe_model(RANKS), PATTERN)


def unpacked(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def test_every_token_is_itself_and_decodes_to_its_bytes():
    for token, rank in RANKS.items():
        assert IDS.tokens[rank] == token
        assert IDS.model.encode(byte_bpe.letters(token)) == [rank]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text_encodes_as_the_library_does(text):
    assert unpacked(IDS.encode(text, 1000)) == PLAIN.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab'sré \n\t1?　​\x1c\x85", max_size=300))
def test_blanks_signs_and_endings(text):
    assert unpacked(IDS.encode(text, 50)) == PLAIN.encode_ordinary(text)


def test_a_token_that_merges_do_not_reach():
    """A pre-token that is in the vocabulary is its token, although its merges lead elsewhere."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"cd": 258, b"abcd": 259, b"zabcd": 260}
    model = byte_bpe.bpe_model(ranks)
    own = byte_bpe.PretokenIds(model, PATTERN)
    plain = tiktoken.Encoding("small", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "zabcd", "zzabcd", "bcd zabcd abcab", "abcbcd"):
        assert unpacked(own.encode(text, 10)) == plain.encode_ordinary(text)


@pytest.mark.parametrize("ranks", [{b"a": 0}, {bytes([b]): b + 1 for b in range(256)}])
def test_vocabularies_that_cannot_be_models(ranks):
    with pytest.raises(ValueError):
        byte_bpe.bpe_model(ranks)


def rows():
    rnd = random.Random(1)
    long_word = "".join(rnd.choice("abcdefé") for _ in range(60_000))
    many = " ".join(rnd.choice(["alpha", "Été", "1234", "??", "\n\n", "naïve"]) for _ in range(250_000))
    return [(1, None), (2, ""), (3, "Hello world"), (3, "Hello world"), (None, "it's  \n 100%"), (4, long_word), (5, many),
            (6, "<|endoftext|> \U0001F600 你好"), (7, " " * 5000)]


def test_documents_encode_and_decode_whole(spark):
    data = rows()
    df = spark.createDataFrame(
        [(k, t, "x", 1, b"old") for k, t in data], "doc_id long, text string, _text string, _0 int, ids binary"
    )
    model = byte_bpe.shipped(spark, RANKS)
    out = byte_bpe.decode(byte_bpe.encode(df, model, PATTERN), model, PATTERN)
    assert out.columns == ["doc_id", "_text", "_0", "ids", "decoded"]
    got = sorted(((r.doc_id, unpacked(r.ids), bytes(r.decoded)) for r in out.collect()), key=str)
    want = sorted(((k, PLAIN.encode_ordinary(t or ""), (t or "").encode()) for k, t in data), key=str)
    assert got == want


def test_bytes_that_are_no_text(spark):
    df = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    out = byte_bpe.encode(df, byte_bpe.shipped(spark, RANKS), PATTERN).first()
    assert unpacked(out.ids) == PLAIN.encode_ordinary("a�b")


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    model = byte_bpe.shipped(spark, RANKS)
    assert byte_bpe.decode(byte_bpe.encode(df, model, PATTERN), model, PATTERN).collect() == []


def test_the_query(spark, sf_dir):
    from ledgerleaf.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op11_byte_bpe"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = PLAIN.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
