import random

import pytest
from pyspark.sql import functions as F

from gleanery.llm import linededup


def sets(text):
    return [frozenset(w for w in line.translate({i: " " for i in (9, 11, 12, 13)}).split(" ") if w)
            for line in (text or "").split("\n")]


def brute(rows, threshold=0.8):
    """{doc_id: text} after comparing every line with every earlier one; rows have distinct ids."""
    seen, out = [], {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        kept = []
        for line, own in zip((text or "").split("\n"), sets(text)):
            if not any(own and 5 * len(own & s) >= 5 * threshold * len(own | s) - 1e-9 for s in seen):
                kept.append(line)
            if own:
                seen.append(own)
        out[doc_id] = None if text is None else "\n".join(kept)
    return out


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
    assert got == brute(rows)


def test_random_lines(spark):
    """Few words and many small edits: pairs at, above and below the threshold, dense groups."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of"] * 10
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 25))] for _ in range(40)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                line[rng.randrange(len(line))] = rng.choice(vocabulary + [f"x{rng.random()}"])
            rng.shuffle(line)
            lines.append(rng.choice([" ", "  ", "\t"]).join(line) + rng.choice(["", " ", "\r"]))
            if rng.random() < 0.2:
                lines.append(rng.choice(["", "  ", "\t"]))
        rows.append((i * 7 % 120, "\n".join(lines)))
    check(spark, rows)


def test_dense_group(spark):
    """Hundreds of sets that all resemble each other: each goes by the leader, none by all pairs."""
    words = [f"word{i}" for i in range(40)]
    rows = [(i, " ".join(words[:i % 40] + [f"edit{i}"] + words[i % 40 + 1:])) for i in range(300)]
    check(spark, rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = linededup.kept_lines(docs).collect()
    assert [tuple(r) for r in kept] == [(0, 0)]


def test_small_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
    assert got == brute(rows)


def test_odd_rows(spark, odd):
    got = linededup.dedup_lines(odd)
    assert got.columns == odd.columns
    rows = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    want = [(r.doc_id, "" if r.doc_id == 5 else r.text) for r in odd.collect()]  # 5 repeats 1
    assert rows == sorted(want, key=str)


def test_threshold(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c e"), (3, "f g")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs, 0.6).collect()}
    assert got == {1: "a b c d", 2: "", 3: "f g"}


def test_empty(spark, empty):
    got = linededup.dedup_lines(empty)
    assert got.columns == empty.columns and got.collect() == []


@pytest.mark.parametrize("partitions", [1, 7])
def test_any_partitioning(spark, sf, partitions):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    want = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
    dealt = docs.repartition(partitions, F.rand(3))
    assert {r.doc_id: r.text for r in linededup.dedup_lines(dealt).collect()} == want


def test_ranks_once(spark, sf):
    """No filter of the plan ranks the words of a line, which the projection then does again."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    firsts = linededup.first_lines(docs, linededup.rarity(docs))
    plan = firsts._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert [line for line in plan if "transform(" in line]
    assert not [line for line in plan if "Filter" in line and "transform(" in line]


def test_white_space(spark):
    """Each white space parts words, alone, in rows and at the ends of lines; U+00A0 does not."""
    check(spark, [(1, "a b c d e f"), (2, "\va\fb\rc\td \t e\f\f f\r"), (3, "\f\v\r\t"), (4, "a b c d e f"),
                  (5, "x  y"), (6, " y\r\nx y\v")])
