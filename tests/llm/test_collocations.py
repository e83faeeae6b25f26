import random
import re
from collections import Counter

import pytest

from gleanery.llm import collocations


def brute(rows, top, min_count):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = [w for w in re.split(r"[ \t]", piece) if w]
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    kept = {key: f for key, f in counts.items() if f >= min_count}
    covered = {}
    for (lang, p), f in kept.items():
        for i in range(len(p)):
            for j in range(i + 1, len(p) + 1):
                if j - i < len(p):
                    covered[lang, p[i:j]] = max(covered.get((lang, p[i:j]), 0), f)
    out = []
    for (lang, p), a in kept.items():
        if len(p) > 1 and covered.get((lang, p), 0) < a:
            n = totals[lang]
            score, _, l, r = min((1000 * a * n // (counts[lang, p[:k]] * counts[lang, p[k:]]), k,
                                  counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, l, r, n, score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    ranked, last = [], None
    for row in out:
        rank = rank + 1 if row[0] == last else 1
        last = row[0]
        if rank <= top:
            ranked.append((row[0], rank, *row[1:]))
    return ranked


def texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "b", "New", "york", "été", "東京", "x1", " ", "#"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ", ", ".\n", "  ", "\x0b"])
                       for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.4:
            text += " new york city hall park "
        rows.append((rng.choice(["en", "en", "fr", None]), text if rng.random() < 0.95 else None))
    return rows


def result(docs, **options):
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in columns) for r in collocations.collocations(docs, **options).collect())


@pytest.mark.parametrize("top,min_count,chunk_bytes", [(2000, 5, 1 << 23), (7, 3, 700)])
def test_against_brute_force(spark, top, min_count, chunk_bytes):
    rows = texts(top, 150)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert result(docs, top=top, min_count=min_count, chunk_bytes=chunk_bytes) == brute(rows, top, min_count)


def test_normal_text():
    assert collocations.normal("É Ab\t c,, d. \x0b\n\x85e  ;\n".encode()) == ("É ab c\nd\n\x85e\n".encode(), 5)
    assert collocations.normal(b" ,\n") == (b"", 0)


def test_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("en", "a", 5 * 10**16), ("en", "b", 6 * 10**16), ("en", "a b", 3 * 10**16)],
                                    "lang string, phrase string, f long").selectExpr("*", "split(phrase, ' ') AS words")
    totals = spark.createDataFrame([("en", 9 * 10**17)], "lang string, n long")
    got = collocations.scored(phrases, totals, 10).first()
    assert got.score == 1000 * 3 * 90 // (5 * 6)


def test_odd_rows(spark, odd, empty):
    docs = odd.withColumnRenamed("ids", "lang")
    assert result(docs, min_count=2) == brute([(r.lang, r.text) for r in docs.collect()], 2000, 2)
    assert result(odd.selectExpr("*", "CAST(null AS string) AS lang")) != []
    assert result(empty) == []


def test_rare_phrases_only(spark):
    assert result(spark.createDataFrame([("en", "one two three")], "lang string, text string")) == []


def test_counts_travel_as_blocks(spark):
    """Frequent phrases that lie in many chunks: a chunk makes one row per bucket of them, and each comes out once."""
    rows = [(f"l{i % 2}", "red fish swims, blue fish sleeps. ") for i in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(20)
    phrases, _ = collocations.frequent_phrases(docs, min_count=20, chunk_bytes=30)
    got = [(r.lang, r.phrase, r.f) for r in phrases.collect()]
    words = Counter(w for p in ("red fish swims", "blue fish sleeps") for w in
                    (" ".join(p.split()[i:j]) for i in range(3) for j in range(i + 1, 4)))
    assert sorted(got) == sorted((lang, w, 30 * k) for lang in ("l0", "l1") for w, k in words.items())
    words = collocations._Words(collocations.normal(rows[0][1].encode() * 5 + b"\n")[0])
    chunk = collocations.pa.table({"chunk": [3], "lang": ["l0"], "words": collocations.pa.array(
        [words.data.tobytes()], collocations.pa.binary())})
    told = collocations.pa.table({"n": [2], "bucket": [None], "names": [b"red fish\nfish swims\nblue fish\nfish sleeps\n"]})
    block = collocations._count(3, 1)((3,), chunk, told).to_pylist()
    assert [(b["chunk"], sorted(b["names"].split(b"\n")), len(b["counts"])) for b in block] == [
        (3, [b"", b"blue fish sleeps", b"red fish swims"], 8)]
