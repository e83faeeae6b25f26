import re

import pytest
from pyspark.sql import functions as F

from gleanery.llm import mixing
from gleanery.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """{source: target}: share by weight, stop at the caps, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = total - sum(3 * sizes[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else free * weight[s] / share for s in names}
        over = {s for s in names if target[s] > 3 * sizes[s] and s not in capped}
        if not over:
            return target
        capped |= over


def test_targets(spark):
    for sizes in ({"a": 5, "b": 1000, "c": 10, "d": 20, None: 3}, {"x": 0, "y": 7}, {"z": 4},
                  {"é": 10, "z": 10, "Z": 10, "\U0001f600": 1, "￿": 1}):
        rows = [(s, n) for s, n in sizes.items()]
        got = {r.source: r.target for r in mixing.targets(
            spark.createDataFrame(rows, "source string, z long")).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys()
        assert all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want)


@pytest.mark.parametrize("few", [True, False])
def test_taken_words(spark, sf, few, monkeypatch):
    if not few:  # the way beyond the broadcast bound
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    docs = table(spark, sf, "documents").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 50 == 1, None).otherwise(
            F.concat(F.lit("s"), F.col("doc_id") % 4)))
    got = mixing.mix(docs).select("doc_id", "source_size", "target", "size", "copies", "taken",
                                  "row.source").collect()
    texts = {r.doc_id: r for r in docs.collect()}
    sizes = {}
    for r in texts.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
    target = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.size == len(WORD.findall(texts[r.doc_id].text or ""))
        assert r.source_size == sizes[r.source] and 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(0.02 * t, 60), s


def test_odd_rows(spark, odd):
    docs = odd.withColumn("source", F.lit(None).cast("string"))
    first = sorted(mixing.mix(docs).select("doc_id", "size", "copies", "taken").collect(), key=str)
    again = sorted(mixing.mix(docs.repartition(5)).select("doc_id", "size", "copies", "taken").collect(), key=str)
    assert first == again and len(first) == docs.count()
    assert all(r.taken == 0 and r.copies == 1 for r in first if r["size"] == 0)
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in first)


def test_empty(spark, empty):
    assert mixing.repeated(empty).collect() == []


def _off(spark, rows):
    """{source: (gap, target)} of documents (doc_id, source, words)."""
    docs = spark.createDataFrame(rows, "doc_id long, source string, n int").select(
        "doc_id", "source", F.expr("trim(repeat('w ', n))").alias("text"))
    got = mixing.mix(docs).groupBy("row.source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    return {r.source: (r.taken - r.target, r.target) for r in got.collect()}


def test_long_tailed_source(spark):
    # "b" and "c" stop at their caps and "a" gives up a few hundredths, among many short documents and few long ones:
    # one section of lambda holds the steps of several long ones.
    rows = [(i, "a", 2 + i % 5) for i in range(20000)] + [(50000 + i, "a", 3000 + i % 97) for i in range(100)]
    rows += [(100000 + i, s, 40 + i % 30) for s in "bc" for i in range(40)]
    for s, (gap, target) in _off(spark, rows).items():
        assert abs(gap) <= max(1e-3 * target, 1), (s, gap, target)


def test_gap_of_a_long_document(spark):
    # The target of "z" lies between two copies of its long document: short ones make up for the gap.
    rows = [(i, "z", 5) for i in range(3000)] + [(9000, "z", 20000)]
    rows += [(100000 + 1000 * k + i, s, 50) for k, s in enumerate("xy") for i in range(550)]
    for s, (gap, target) in _off(spark, rows).items():
        assert abs(gap) <= max(1e-3 * target, 50), (s, gap, target)
