import random
import re
from collections import Counter

from pyspark.sql import functions as F

from gleanery.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= {i, i + 1, i + 2}
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            rep, n < 50 or 100 * rep > 50 * n)


def compare(docs):
    got = rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept").collect()
    want = sorted((r.doc_id, *brute(r.text)) for r in docs.where("doc_id is not null").collect())
    assert sorted(tuple(r)[:-1] for r in got if r.doc_id is not None) == want
    assert not any(r.base_failed and r.kept for r in got)
    return got


def test_base_counts(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        words = [rng.choice(["a", "b", "c", "naïve", "東京", "x|y", "\U0001f600"] if i % 2 else
                            [f"w{k}" for k in range(40)]) for _ in range(rng.randint(0, 120))]
        rows.append((i, "".join(w + rng.choice([" ", "  ", "\n", "\t", "\n\n", " "]) for w in words)))
    compare(spark.createDataFrame(rows, "doc_id long, text string"))


def test_sf(spark, sf):
    got = compare(spark.read.parquet(f"{sf}/documents.parquet"))
    assert any(r.kept for r in got) and any(not r.kept and not r.base_failed for r in got)


def test_order_does_not_matter(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    forward = {r.doc_id: r.kept for r in rules.judge(docs).collect()}
    backward = {r.doc_id: r.kept for r in rules.judge(docs, dict(reversed(rules.RULES.items())), 5).collect()}
    assert forward == backward
    order = rules.ranked(docs)
    assert sorted(o[0] for o in order) == sorted(rules.RULES)
    gains = [share / seconds for _, seconds, share in order]
    assert gains == sorted(gains, reverse=True)


def test_each_rule_rejects(spark):
    good = " ".join(f"word{i} plain{i}" for i in range(60)) + "."
    rows = {"word_length": " ".join(f"{'x' * 30}{i}" for i in range(80)),
            "symbols": good + " %%% ### $$$ &&& *** ||| <<< >>>",
            "repeated_lines": "\n".join([good, "again", "again", "again"]),
            "shouting": good.upper().replace("PLAIN", "PLAINLY"),
            "exclaiming": good.replace(" ", "! "),
            "words_with_letters": good + " " + " ".join(str(i) for i in range(100)),
            "bullets": "\n".join(f"- {a}" for a in re.findall(r"\S+ \S+", good)),
            "cut_lines": "\n".join(f"{a} ..." for a in re.findall(r"\S+ \S+", good))}
    docs = spark.createDataFrame([(good, "fine")] + [(t, k) for k, t in rows.items()], "text string, doc_id string")
    base = rules.base(docs)
    got = base.select("doc_id", "base_failed", *[rule().alias(k) for k, rule in rules.RULES.items()]).collect()
    for r in got:
        assert not r.base_failed
        if r.doc_id == "fine":
            assert all(r[k] for k in rules.RULES)
        else:
            assert not r[r.doc_id], r.doc_id


def test_odd_rows(spark, odd, empty):
    assert len(compare(odd)) == odd.count()
    assert rules.judge(empty).collect() == []
    assert rules.judge(odd.withColumn("kept", F.lit(1))).count() == odd.count()
