import base64
import random
import unicodedata

import numpy as np
import pytest
import tiktoken

import public_tokenizers
from tidemill.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", " ", "  ", "a  b", "x\t y", " a b\n c  d \n\n  e", "\n\n\na", "don't 'S we'll"]
TEXTS += ["a" * 1000, "ab" * 3000, "日本語 混ぜ", "é ́x", "🙂🙂 " * 50, "<|endoftext|>", "\x1c a\x1d b"]
TEXTS += ["x" * 255 + " " + "y" * 257 + "ÿ" * 300, "\xa0a b\xa0 c", "12345 6789", "...  !!"]


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    pattern = public_tokenizers.PATTERN
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_encode_like_the_library(reference):
    with open(PATH, "rb") as file:
        coder = byte_bpe.ByteBpe(file.read(), public_tokenizers.PATTERN)
    random.seed(3)
    letters = "ab \n\té漢'st0!🙂 "
    texts = ["".join(random.choices(letters, k=random.randint(0, 60))) for _ in range(3000)]
    for text, ids in zip(texts, coder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


def test_letters_and_numbers_that_are_younger_than_the_library():
    """A vocabulary whose merges show whether a character shares a match with a letter or a digit."""
    pieces = [bytes([b]) for b in range(256)]
    pieces += [p + bytes([b]) for p in (b"a", b"1") for b in range(128, 256)]
    ranks = {piece: rank for rank, piece in enumerate(pieces)}
    file = b"".join(base64.b64encode(p) + b" %d\n" % r for p, r in ranks.items())
    pattern = public_tokenizers.PATTERN
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    # Only what Python's own tables do not know, too, can have become a letter or number since.
    unknown = [chr(c) for c in range(0x34000) if unicodedata.category(chr(c)) == "Cn"]
    texts = [f"a{c} 1{c}{c}" for c in unknown]
    for text, ids in zip(texts, byte_bpe.ByteBpe(file, pattern).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), ascii(text)


def test_dataframe_with_odd_texts_and_clashing_columns(spark, work, reference):
    rows = [(n, t, "ids", b"x") for n, t in enumerate(TEXTS * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded binary")
    vocabulary = byte_bpe.Vocabulary(spark, PATH, public_tokenizers.PATTERN)
    coded = byte_bpe.decode(byte_bpe.encode(docs, vocabulary), vocabulary).collect()
    assert len(coded) == len(rows)
    for row in coded:
        text = row.text or ""
        assert row.ids == reference.encode_ordinary(text)
        assert bytes(row.decoded) == text.encode()


def test_no_rows_and_null_ids(spark, work):
    vocabulary = byte_bpe.Vocabulary(spark, PATH, public_tokenizers.PATTERN)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.round_trip(empty, vocabulary).collect() == []
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(byte_bpe.decode(nothing, vocabulary).first().decoded) == b""


def test_round_trip(spark, work):
    vocabulary = byte_bpe.Vocabulary(spark, PATH, public_tokenizers.PATTERN)
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(TEXTS)], "doc_id long, text string")
    assert all(r.intact for r in byte_bpe.round_trip(docs, vocabulary).collect())
