"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words, the last one shorter. Each
passage is described by hashed byte trigrams and by shares of character kinds,
word lengths and repetition, and encoded by a small tanh layer. Gated attention
(a tanh gate times a sigmoid gate) weighs the passages of a document; the
weighted sum is read by a logistic output. Only document labels are learnt from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm import toxicity
from gleanery.llm.common import held_out

PASSAGE = 64
HASHED = 128
SHARES = 14
WIDTH = HASHED + SHARES
HIDDEN, GATE = 16, 8
#: Bound of the labelled rows that a model learns from, half of them of each class at most.
TRAIN_ROWS = 3000
EPOCHS = 60
#: Passages described at a time; longer texts go through several blocks.
BLOCK = 512

_KIND = np.full(256, 7, "u1")  # other ASCII
_KIND[[*range(97, 123)]] = 0
_KIND[[*range(65, 91)]] = 1
_KIND[[*range(48, 58)]] = 2
_KIND[list(b"#*$%&|<>")] = 3
_KIND[list(b"!?")] = 4
_KIND[list(b".,;:")] = 5
_KIND[128:] = 6


def _describe(passages: list[list[bytes]], seen: list[bool]) -> np.ndarray:
    """Features of passages; seen: whether the document held the same passage before."""
    n = len(passages)
    texts = [b" ".join(p) + b" " for p in passages]
    codes = np.frombuffer(b"".join(texts), "u1")
    owner = np.repeat(np.arange(n), [len(t) for t in texts])
    size = np.bincount(owner, minlength=n)
    kinds = np.bincount(owner * 8 + _KIND[codes], minlength=n * 8).reshape(n, 8) / size[:, None]
    wide = codes.astype("u4")
    mixed = (wide[:-2] * np.uint32(65599) + wide[1:-1] * np.uint32(257) + wide[2:]) * np.uint32(2654435761)
    inside = owner[:-2] == owner[2:]
    slot = (owner[:-2] * HASHED + (mixed >> np.uint32(25)))[inside]
    hashed = np.bincount(slot, minlength=n * HASHED)
    hashed = hashed.reshape(n, HASHED) / size[:, None]
    count = np.array([len(p) for p in passages])
    distinct = np.array([len(set(p)) for p in passages])
    lone = np.array([sum(len(w) == 1 for w in p) for p in passages])
    shares = np.column_stack([
        kinds, (size - count) / count / 10, 1 - distinct / count, lone / count, count / PASSAGE,
        np.array(seen, "f8"), np.log1p(count) / 4])
    return np.column_stack([np.sqrt(hashed) * 3, shares * 3]).astype("f4")


def _passages(text: str):
    words = (text or "").encode().split()
    return [words[i:i + PASSAGE] for i in range(0, len(words), PASSAGE)]


def _bags(texts):
    """(text index, features) in blocks of bounded size; a text without words has no passage."""
    parts, seen, owners = [], [], []
    for i, text in enumerate(texts):
        met = set()
        for p in _passages(text):
            mark = hash(tuple(p))
            parts.append(p)
            seen.append(mark in met)
            owners.append(i)
            met.add(mark)
            if len(parts) == BLOCK:
                yield np.array(owners), _describe(parts, seen)
                parts, seen, owners = [], [], []
    if parts:
        yield np.array(owners), _describe(parts, seen)


def _bag(text: str) -> bytes:
    return b"".join(x.tobytes() for _, x in _bags([text]))


def _described(text: Column) -> Column:
    @F.pandas_udf("binary")
    def described(texts: pd.Series) -> pd.Series:
        return pd.Series([_bag(t) for t in texts], dtype=object)

    return described(text)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Model:
    params: dict
    prior: float

    def _encode(self, x):
        p = self.params
        h = np.tanh((x - p["mean"]) / p["spread"] @ p["We"] + p["be"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        return h, t, s, (t * s) @ p["w"]

    def predict(self, texts) -> np.ndarray:
        """Sums over passages block by block: the attention's softmax needs no whole bag at once."""
        n = len(texts)
        if not self.params:
            return np.full(n, self.prior)
        weight, total = np.zeros(n), np.zeros((n, HIDDEN))
        for owners, x in _bags(texts):
            h, _, _, a = self._encode(x)
            e = np.exp(a)  # |a| is at most the sum of |w|, which training keeps small
            weight += np.bincount(owners, e, n)
            for j in range(HIDDEN):
                total[:, j] += np.bincount(owners, e * h[:, j], n)
        z = total / np.maximum(weight, 1e-12)[:, None]
        score = _sigmoid(z @ self.params["c"] + self.params["b"])
        return np.where(weight > 0, score, self.prior)

    def score(self, spark, text: Column) -> Column:
        """Probability of good quality; a text without words has the share of good labels."""
        shared = spark.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            return pd.Series(shared.value.predict(texts.tolist()))

        return score(text)


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Mini-batch Adam through attention and encoder; both classes weigh the same."""
    known = [i for i, b in enumerate(bags) if len(b)]
    prior = float(labels.mean()) if len(labels) else 0.5
    if len(set(labels[known].tolist())) < 2:
        return Model({}, prior)
    bags, labels = [bags[i] for i in known], labels[known]
    rng = np.random.default_rng(0)
    stacked = np.concatenate(bags)
    p = {"mean": stacked.mean(0), "spread": stacked.std(0) + 0.02,
         "We": rng.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)), "be": np.zeros(HIDDEN),
         "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
         "w": rng.normal(0, GATE**-0.5, GATE), "c": rng.normal(0, HIDDEN**-0.5, HIDDEN), "b": np.zeros(1)}
    model, learnt = Model(p, prior), ("We", "be", "V", "U", "w", "c", "b")
    first = {k: np.zeros_like(p[k]) for k in learnt}
    second = {k: np.zeros_like(p[k]) for k in learnt}
    balance = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean())
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 64):
            own = order[at:at + 64]
            x = np.concatenate([bags[i] for i in own])
            owner = np.repeat(np.arange(len(own)), [len(bags[i]) for i in own])
            h, t, s, a = model._encode(x)
            e = np.exp(a)
            share = e / np.bincount(owner, e)[owner]
            z = np.zeros((len(own), HIDDEN))
            np.add.at(z, owner, share[:, None] * h)
            error = (_sigmoid(z @ p["c"] + p["b"]) - labels[own]) * balance[own] / len(own)
            dz = error[:, None] * p["c"]
            toward = (dz[owner] * h).sum(1)
            da = share * (toward - np.bincount(owner, share * toward)[owner])
            dt, ds = np.outer(da, p["w"]) * s * (1 - t * t), np.outer(da, p["w"]) * t * s * (1 - s)
            dh = share[:, None] * dz[owner] + dt @ p["V"].T + ds @ p["U"].T
            du = dh * (1 - h * h)
            scaled = (x - p["mean"]) / p["spread"]
            grads = {"We": scaled.T @ du + 1e-4 * p["We"], "be": du.sum(0), "V": h.T @ dt, "U": h.T @ ds,
                     "w": (t * s).T @ da + 1e-3 * p["w"], "c": z.T @ error + 1e-4 * p["c"],
                     "b": np.array([error.sum()])}
            step += 1
            for k in learnt:
                first[k] = 0.9 * first[k] + 0.1 * grads[k]
                second[k] = 0.99 * second[k] + 0.01 * grads[k] ** 2
                p[k] -= 0.005 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    got = toxicity.sample(docs, labels, label, rows).select(
        "doc_id", "y", _described(F.col("text")).alias("bag")).toPandas().sort_values(["doc_id", "y"])
    return fit([np.frombuffer(b, "<f4").reshape(-1, WIDTH) for b in got["bag"]], got["y"].to_numpy("i8"))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs (doc_id, text).

    Null, empty and blank texts hold no passage and score the share of good rows
    among those learnt from; repeated rows share their score; other columns are
    not read; an empty table gives an empty one.
    """
    model = train(docs, labels)
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        model.score(docs.sparkSession, F.col("text")).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
