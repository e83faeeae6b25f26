import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gleanery.llm import records

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_words_alone_give_the_ids_of_the_text(tokenizer):
    rng = random.Random(8)
    parts = ["The", "the", "it's", "IT'S", "'re", "don't!!", "x|y", "<|endoftext|>", "a1b2", "99", "É", "été", "ΟΔΟΣ",
             "é", "́", "ﬁ", "東京", "\U0001f600", "foo.", "(bar)", "###", " ", "a b", "\x1c",
             "İstanbul", "ß", "²", "½", "_", "--", "a-b", " ", "\u0085", "K"]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", "  ", "\n", "\t", "", "\r\n"])
                     for _ in range(rng.randint(0, 60))) for _ in range(400)] + [None, "", " \n"]
    with open(PATH, "rb") as f:
        coder = records._WordIds(f.read())
    for text, ids in zip(texts, coder.encode(texts, "<u2")):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [records.END_ID]
        assert np.frombuffer(ids, "<u2").tolist() == want, text


def test_memory_starts_anew(tokenizer, monkeypatch):
    monkeypatch.setattr(records, "MEMORY_WORDS", 3)
    with open(PATH, "rb") as f:
        coder = records._WordIds(f.read())
    for text in ("one two three four", "five one", "été one été"):
        (ids,) = coder.encode([text], "<u4")
        assert np.frombuffer(ids, "<u4").tolist()[:-1] == tokenizer.encode(text, add_special_tokens=False).ids


def test_frames():
    data = b"".join(records.frame(i, bytes([i]) * (4 * i)) for i in (3, 0, 10)) + records.frame(None, b"")
    got = list(records.parse(data))
    assert [(i, ids) for _, _, i, ids in got] == [(3, b"\3" * 12), (0, b""), (10, b"\n" * 40), (None, b"")]
    for offset, length, _, _ in got:
        assert next(records.parse(data[offset:offset + length]))[1] == length
    for at in (0, 9, 14, 25, len(data) - 2):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(records.parse(bytes(broken)))
    with pytest.raises(ValueError):
        list(records.parse(data[:-7]))


def test_round_trip(spark, odd, tokenizer, tmp_path):
    folder = str(tmp_path / "out")
    records.write(odd, folder, PATH, shards=3)
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    start, want = 0, []
    for r in rows:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = records.digests(spark, folder).orderBy("start").collect()
    assert [tuple(r) for r in got] == want
    index = spark.read.parquet(f"{folder}/index")
    assert index.count() == len(rows)
    wanted = spark.createDataFrame([(7,), (1,), (99,)], "doc_id long")
    found = records.fetch(spark, folder, wanted).collect()
    assert sorted(r.doc_id for r in found) == [1, 7]


def test_damage_is_seen(spark, odd, tmp_path):
    folder = tmp_path / "out"
    records.write(odd, str(folder), PATH, shards=1)
    shard = next((folder / "shards").glob("part-*"))
    data = bytearray(shard.read_bytes())
    data[len(data) // 2] ^= 4
    shard.write_bytes(bytes(data))
    (folder / "shards" / f".{shard.name}.crc").unlink()
    with pytest.raises(Exception, match="damaged"):
        records.digests(spark, str(folder)).collect()


def test_empty(spark, empty, tmp_path):
    records.write(empty, str(tmp_path / "out"), PATH)
    assert records.digests(spark, str(tmp_path / "out")).collect() == []


def test_special_tokens_have_their_own_id(spark, tmp_path):
    library = Tokenizer.from_file(PATH)
    texts = ["end of text <|endoftext|> again <|startoftext|>x", "a<|endoftext|>b", "<|ENDOFTEXT|> <|end", "plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    records.write(docs, str(tmp_path / "out"), PATH, shards=2)
    ids = [library.encode(t, add_special_tokens=False).ids + [records.END_ID] for t in texts]
    assert 49407 in ids[0] and 49406 in ids[0]
    got = records.digests(spark, str(tmp_path / "out")).orderBy("doc_id").collect()
    assert [(r.start, r.n_tokens, r.ids_crc32) for r in got] == [
        (sum(map(len, ids[:k])), len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for k, v in enumerate(ids)]


def test_pieces_are_found_once(monkeypatch):
    """Words that share their letters, at either end of punctuation, cost one call of the model; a full memory keeps the pieces."""
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        coder = records._WordIds(f.read(), literal=False)
    calls = []

    class Model:
        def tokenize(self, text, of=coder.model):
            calls.append(text)
            return of.tokenize(text)

    coder.model = Model()
    texts = ["Word, (word) WORD! word? \u00c9t\u00e9, it's <|endoftext|> 12.", "word."]
    got = coder.encode(texts, "<u2")
    monkeypatch.setattr(records, "MEMORY_WORDS", len(coder.pieces) * 2)
    coder.known.update((str(i).encode(), b"") for i in range(99))
    assert coder.encode(texts, "<u2") == got and calls.count("word") == 1 and len(coder.known) < 99
    plain = records._WordIds(coder.tokenizer.to_str().encode(), literal=False).tokenizer
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u2").tolist() == [*plain.encode(t, add_special_tokens=False).ids, records.END_ID]
    assert coder.encode(texts[1:], "<u4")[0] == np.frombuffer(got[1], "<u2").astype("<u4").tobytes()
