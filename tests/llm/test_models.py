import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import passages, toxicity
from gleanery.llm.common import held_out, table

CLEAN = "walk river stone green quiet morning paper window table under light garden".split()
RUDE = "gronkface blatherskite numbskulled".split()


def toxic_rows(rng, n=300):
    rows = []
    for i in range(n):
        words = ["".join(rng.sample(w, len(w))) if rng.random() < 0.3 else w
                 for w in rng.choices(CLEAN, k=rng.randint(20, 200))]
        bad = i % 3 == 0
        if bad:
            for _ in range(1 + len(words) // 25):
                words[rng.randrange(len(words))] = rng.choice(RUDE)
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity_learns_and_reads_misspellings(spark):
    rows = toxic_rows(random.Random(1))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    assert all(got[i].predicted == y for i, _, y in rows if got[i].held_out)
    assert any(r.held_out for r in got.values())
    odd = spark.createDataFrame([(1, "walk river gronkfacee stone quiet morning blatherskyte"),
                                 (2, "walk river stone quiet morning"), (3, None), (4, " ")],
                                "doc_id long, text string")
    model = toxicity.train(docs, labels)
    score = {r.doc_id: r.s for r in odd.select("doc_id", model.score(spark, odd["text"]).alias("s")).collect()}
    assert score[1] > 0.5 > score[2] and 0 < score[3] == score[4] < 0.5


def test_long_texts_add_up_over_blocks(monkeypatch):
    rng = np.random.default_rng(0)
    per_gram = rng.normal(size=toxicity.BUCKETS)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 999, 700)), "", "one", None]
    whole = toxicity._mean_scores(texts, per_gram)
    bags = [toxicity._bag(t) for t in texts]
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 64)
    assert np.allclose(toxicity._mean_scores(texts, per_gram), whole)
    for (b, w), t in zip(bags, texts):
        b2, w2 = toxicity._bag(t)
        assert b == b2 and np.allclose(np.frombuffer(w, "<f4"), np.frombuffer(w2, "<f4"))
        linear = np.frombuffer(w, "<f4") @ per_gram[np.frombuffer(b, "<u4")]
        assert linear == pytest.approx(toxicity._mean_scores([t], per_gram)[0], abs=1e-4)


def test_no_labels(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    got = toxicity.scored(odd, none).collect()
    assert len(got) == odd.count() and all(r.score < 0.5 for r in got)
    assert toxicity.scored(empty, none).collect() == []
    assert len(passages.scored(odd, none).collect()) == odd.count()
    assert passages.scored(empty, none).collect() == []
    assert toxicity.reject(odd, none).columns == odd.columns


def test_quality_on_held_out(spark, sf):
    """A low bar for two hundred documents; sf0.1 gives an accuracy of 0.99."""
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = passages.scored(docs, labels).join(labels, "doc_id").where("held_out and quality is not null").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.93
    assert all(0 <= r.score <= 1 for r in got)


def test_passage_features_do_not_depend_on_neighbours(monkeypatch):
    text = " ".join(f"Word{i % 37}!" for i in range(500))
    alone = passages._bag(text)
    both = np.concatenate([x for _, x in passages._bags(["other words", text])])
    assert alone == both[1:].astype("f4").tobytes()
    monkeypatch.setattr(passages, "BLOCK", 2)
    assert alone == passages._bag(text)


def test_attention_sums_need_no_whole_bag(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["good", "BAD!!", "%%%", "fine"]) for _ in range(rng.randint(0, 600)))
             for _ in range(40)]
    bags = [np.frombuffer(passages._bag(t), "<f4").reshape(-1, passages.WIDTH) for t in texts]
    model = passages.fit(bags, np.array([i % 2 for i in range(40)]), epochs=2)
    whole = model.predict(texts)
    monkeypatch.setattr(passages, "BLOCK", 3)
    assert np.allclose(model.predict(texts), whole)


def test_held_out(spark):
    rows = [(i,) for i in range(-5, 60)] + [(None,)]
    got = spark.createDataFrame(rows, "doc_id long").select(
        "doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    for r in got:
        assert r.h == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_driver_gets_telling_grams_only(spark):
    """The driver's part of training holds the telling n-grams alone, and learns the same from them."""
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    bags = toxicity.sample(docs, labels, "toxic").select(
        "doc_id", "y", toxicity._bags(F.col("text")).alias("bag")).select("doc_id", "y", "bag.*").localCheckpoint()

    def rows(df):
        got = df.orderBy("doc_id", "y").collect()
        return [(np.array(r.buckets or [], "i4"), np.array(r.weights or [], "f4")) for r in got], np.array([r.y for r in got])

    (every, labelled), (few, same) = rows(bags), rows(toxicity.telling_bags(bags))
    told = set(toxicity._telling(every, labelled).tolist())
    assert labelled.tolist() == same.tolist() and told
    assert set(np.concatenate([b for b, _ in few]).tolist()) == told
    assert sum(len(b) for b, _ in few) < sum(len(b) for b, _ in every) / 10
    one, other = toxicity.fit(every, labelled, 20), toxicity.fit(few, same, 20)
    assert (one.per_gram() == other.per_gram()).all() and (one.bias == other.bias).all()
