import random

import numpy as np
import pytest

from gleanery.llm import suffixdedup
from gleanery.llm.chunks import Hasher


def brute(rows):
    """{doc_id: (bytes, removed, spans, kept)} from a set of all strings of 100 bytes; ids are unique."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(data[p:p + 100])
        spans, p = [], 0
        while p < len(data):
            q = p
            while q < len(data) and gone[q] == gone[p]:
                q += 1
            if gone[p]:
                spans.append((p, q))
            p = q
        out[doc_id] = (len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g))
    return out


def result(docs, **options):
    return {r.doc_id: (r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept))
            for r in suffixdedup.remove_repeats(docs, **options).collect()}


def texts(seed):
    rng = random.Random(seed)
    words = ["ab", "c", "déf", "ghij", "k  ", "lmnop", "\0\0", "東京"]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 300))) for _ in range(8)]
    rows = [(None, base[0])]
    for i in range(90):
        text, kind = rng.choice(base), rng.randrange(7)
        if kind == 0:  # a copy with one word changed
            p = rng.randrange(len(text) + 1)
            text = text[:p] + "X" + text[p + 1:]
        elif kind == 1:  # overlapping parts of two
            text = text[rng.randint(0, 60):] + rng.choice(base)
        elif kind == 2:  # one character, which overlaps itself
            text = "z" * rng.randint(95, 400)
        elif kind == 3:  # near the length of a string
            text = "".join(rng.choice("ab") for _ in range(rng.randint(95, 130)))
        elif kind == 4:
            text = rng.choice([None, "", "a" * 99])
        rows.append((i * 3 - 20 + i % 2, text))
    rng.shuffle(rows)
    return rows


def test_cover():
    differences = {(a - b) % suffixdedup.PERIOD for a in suffixdedup.COVER for b in suffixdedup.COVER}
    assert differences == set(range(suffixdedup.PERIOD))


def test_hashes_depend_on_the_bytes_alone():
    data = np.frombuffer(random.Random(1).randbytes(300_000), np.uint8).copy()
    data[200_000:200_044] = data[5:49]
    hasher = Hasher(0)
    at = np.array([5, 6, 200_000, 299_956])
    a, b, c, _ = hasher.at(data, at, 44)
    assert a == c != b
    assert hasher.at(data, at[:1], 44)[0] == Hasher(0).at(data[5:], np.array([0]), 44)[0]


@pytest.mark.parametrize("options", [
    {},  # everything in one chunk
    {"chunk_bytes": 3000, "bucket_bytes": 2000},  # most copies in other chunks
    {"chunk_bytes": 3000, "bucket_bytes": 2000, "hot": 2},  # most names dealt string by string
])
def test_against_brute_force(spark, options):
    rows = texts(len(options))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3 if options else 1)
    assert result(docs, **options) == brute(rows)


def test_slices_do_not_change_the_result():
    rng = np.random.default_rng(2)
    context = rng.integers(97, 99, (400, 156), dtype=np.uint8)
    context[200:] = context[:200]
    left, right = rng.integers(0, 57, (2, 400)).astype(np.uint8)
    rank = rng.permutation(400)
    masks = suffixdedup.repeats(context, left, right, rank)
    for i in range(400):
        for d in range(57):
            def string(j, d=d):
                return bytes(context[j, 56 - d:156 - d]) if left[j] >= d and right[j] >= 56 - d else None
            mine = string(i)
            earlier = mine is not None and any(rank[j] < rank[i] and string(j) == mine for j in range(400))
            assert bool(int(masks[i]) >> d & 1) == earlier


def test_odd_rows(spark, odd):
    got = suffixdedup.remove_repeats(odd).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes) for r in got) == sorted(
        (r.doc_id is not None, r.doc_id or 0, len((r.text or "").encode())) for r in odd.collect())
    long = next(r for r in got if r.doc_id == 7)
    assert [tuple(s) for s in long.spans] == [(5, 45000)] and bytes(long.kept) == b"word "


def test_rows_of_one_id(spark):
    text = "some words that are more than a hundred bytes long, " * 2 + "so that they can be found twice in a table"
    docs = spark.createDataFrame([(1, text)] * 3 + [(2, text)], "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_removed) for r in suffixdedup.remove_repeats(docs, chunk_bytes=10).collect())
    assert got == [(1, 0), (1, len(text)), (1, len(text)), (2, len(text))]


def test_empty(spark, empty):
    assert suffixdedup.remove_repeats(empty).collect() == []
