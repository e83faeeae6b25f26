import base64
import random

import public_tokenizers
import pytest
import tiktoken

from gleanery.llm.bpe import ByteBpe, digest

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def ids(row):
    return [int.from_bytes(row.ids[i:i + 4], "little") for i in range(0, len(row.ids), 4)]


def test_odd_rows(spark, odd, reference):
    coder = ByteBpe(spark, PATH, public_tokenizers.PATTERN, chunk=4000, overlap=100)
    got = coder.decode(coder.encode(odd)).collect()
    assert len(got) == odd.count()
    for r in got:
        assert ids(r) == reference.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_chunks_agree_with_whole(spark, reference):
    """Small chunks over runs of spaces, digits, contractions and tokens longer than the overlap."""
    rng = random.Random(7)
    parts = ["  ", "\n\n\n", " ", "'re", "it's", "don't", "é", "é", " ", "  ", "東京都",
             "\U0001f600", "12345", "!!", "a", "word", "\r\n", "\x1c", "'", "L'"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 600))) for _ in range(60)]
    texts += ["a" * 500, " " * 500, "x" + "\n" * 300 + "y", "ab " * 200 + "q" * 300 + " z" * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coder = ByteBpe(spark, PATH, public_tokenizers.PATTERN, chunk=64, overlap=32)
    for r in coder.encode(docs).collect():
        assert ids(r) == reference.encode_ordinary(r.text), r.text
    both = coder.encode(docs, decoded="decoded").collect()
    assert all(bytes(r.decoded).decode() == r.text and ids(r) == reference.encode_ordinary(r.text) for r in both)
    assert digest(coder.decode(coder.encode(docs))).count() == len(texts)


def test_empty(spark, empty):
    coder = ByteBpe(spark, PATH, public_tokenizers.PATTERN)
    assert digest(coder.decode(coder.encode(empty))).collect() == []


def test_bad_overlap(spark):
    with pytest.raises(ValueError):
        ByteBpe(spark, PATH, public_tokenizers.PATTERN, chunk=10, overlap=10)
