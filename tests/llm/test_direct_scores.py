"""Scores of the trained models against the models' definitions, computed one passage and one n-gram at a time."""

import math

import pytest
from pyspark.sql import functions as F

from gleanery.llm import passages, toxicity
from gleanery.llm.common import table



def logistic(x):
    return 1 / (1 + math.exp(-x))


def toxic(model, text):
    """The softmax over the mean, over words, of the mean embedding of each word's n-grams."""
    rows = {int(b): model.embeddings[i] for i, b in enumerate(model.buckets)}
    words = (text or "").lower().encode().split()
    document = [0.0] * model.softmax.shape[0]
    for word in words:
        marked = b"<" + word + b">"
        grams = [marked[i:i + n] for n in toxicity.SIZES for i in range(len(marked) - n + 1)]
        for gram in grams:
            code = gram[0]
            for byte in gram[1:]:
                code = (code * 0x01000193 + byte) % 2**32
            bucket = (code + len(gram)) * 2654435761 % 2**32 >> 12
            for d, x in enumerate(rows.get(bucket, ())):
                document[d] += x / len(grams) / len(words)
    logits = [sum(document[d] * model.softmax[d, k] for d in range(len(document))) + model.bias[k] for k in (0, 1)]
    return logistic(logits[1] - logits[0])


def described(words, seen):
    """A passage's features, counted."""
    text = b" ".join(words) + b" "
    kinds, slots = [0] * 8, [0] * passages.HASHED
    for byte in text:
        kinds[passages._KIND[byte]] += 1
    for i in range(len(text) - 2):
        mixed = (text[i] * 65599 + text[i + 1] * 257 + text[i + 2]) * 2654435761 % 2**32
        slots[mixed >> 25] += 1
    n = len(words)
    shares = [k / len(text) for k in kinds] + [
        (len(text) - n) / n / 10, 1 - len(set(words)) / n, sum(len(w) == 1 for w in words) / n,
        n / passages.PASSAGE, float(seen), math.log1p(n) / 4]
    return [3 * math.sqrt(s / len(text)) for s in slots] + [3 * s for s in shares]


def quality(model, text):
    """Gated attention over every passage of the text, then the logistic of the weighted mean."""
    p = model.params
    words = (text or "").encode().split()
    parts = [words[i:i + passages.PASSAGE] for i in range(0, len(words), passages.PASSAGE)]
    if not parts:
        return model.prior
    encoded, attention = [], []
    for k, part in enumerate(parts):
        x = described(part, part in parts[:k])
        x = [(v - m) / s for v, m, s in zip(x, p["mean"], p["spread"])]
        h = [math.tanh(sum(v * p["We"][i, j] for i, v in enumerate(x)) + p["be"][j]) for j in range(passages.HIDDEN)]
        gates = [math.tanh(sum(h[j] * p["V"][j, g] for j in range(len(h))))
                 * logistic(sum(h[j] * p["U"][j, g] for j in range(len(h)))) for g in range(passages.GATE)]
        encoded.append(h)
        attention.append(math.exp(sum(a * w for a, w in zip(gates, p["w"]))))
    whole = [sum(a * h[j] for a, h in zip(attention, encoded)) / sum(attention) for j in range(passages.HIDDEN)]
    return logistic(sum(z * c for z, c in zip(whole, p["c"])) + p["b"][0])


@pytest.mark.parametrize("operator,label,direct", [
    (toxicity, "toxic", toxic), (passages, "quality", quality)])
def test_scores_follow_the_definition(spark, operator, label, direct):
    sf = "/root/testdata/sf0.01"  # with enough labels for many telling n-grams
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = operator.train(docs, labels, label)
    some = [r.text for r in docs.orderBy(F.length("text").desc()).limit(2).union(docs.limit(25)).select("text").collect()]
    some += ["one", "", None, " \t", "ça va; été 東京 #1 $$ !! A B c", "again and again " * 200]
    df = spark.createDataFrame(list(enumerate(some)), "i int, text string").repartition(3)
    got = {r.i: r.s for r in df.select("i", model.score(spark, F.col("text")).alias("s")).collect()}
    for i, text in enumerate(some):
        assert got[i] == pytest.approx(direct(model, text), abs=2e-4), (i, text and text[:50])
    assert len(set(got.values())) >= 5
