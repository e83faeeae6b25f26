"""Toxicity by subword-bag embeddings under a linear softmax, trained jointly in numpy.

A word, marked `<word>`, is the mean embedding of its character n-grams, hashed
into `BUCKETS` rows; a document is the mean of its words; a softmax over two
classes reads it. A misspelling nobody labelled shares most n-grams with the
word it stands for. As the classifier is linear, a document's score is the mean
of per-word scores, which needs no document vector at scoring time.

Labels are noisy, and nearly every document has n-grams of its own that a model
could learn a wrong label by. So only n-grams get an embedding that occur in a
different share of the two classes' documents, by `Z` standard errors or more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import held_out, written

SIZES = (3, 4, 5)
BUCKETS = 1 << 20
DIM = 8
#: Bound of the labelled rows that a model learns from, half of them of each class at most.
TRAIN_ROWS = 2400
ROUNDS = 400
#: Standard errors by which an n-gram's share of documents must differ between classes.
Z = 4.0
#: Words handled at a time; longer texts add up over several blocks.
BLOCK_WORDS = 50_000


def _grams(words: list[bytes]):
    """(bucket, word) of every n-gram of the marked words, one n at a time, and their number per word."""
    lengths = np.fromiter(map(len, words), "i8", len(words)) + 2
    codes = np.frombuffer(b"<" + b"><".join(words) + b">", "u1").astype("u4")
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words), dtype="i4"), lengths)
    left = np.repeat(ends, lengths) - np.arange(len(codes))
    found, rolling = [], codes.copy()
    for n in range(2, max(SIZES) + 1):
        rolling = rolling[:-1] * np.uint32(0x01000193) + codes[n - 1:]
        if n in SIZES:
            inside = left[: len(rolling)] >= n
            mixed = (rolling[inside] + np.uint32(n)) * np.uint32(2654435761)
            found.append((mixed >> np.uint32(12), owner[: len(rolling)][inside]))
    return found, sum(np.maximum(lengths - n + 1, 0) for n in SIZES)


def _blocks(texts):
    """Words of the texts and the index of each word's text, in blocks of bounded size."""
    words, owners = [], []
    for i, text in enumerate(texts):
        own = (text or "").lower().encode().split()
        for at in range(0, len(own), BLOCK_WORDS):
            part = own[at:at + BLOCK_WORDS]
            words += part
            owners += [i] * len(part)
            if len(words) >= BLOCK_WORDS:
                yield words, np.array(owners, "i8")
                words, owners = [], []
    if words:
        yield words, np.array(owners, "i8")


def _mean_scores(texts, per_gram: np.ndarray) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for words, owners in _blocks(texts):
        found, grams = _grams(words)
        sums = sum(np.bincount(w, per_gram[b], len(words)) for b, w in found)
        total += np.bincount(owners, sums / grams, len(texts))
        count += np.bincount(owners, minlength=len(texts))
    return total / np.maximum(count, 1)


def _bag(text: str) -> tuple[bytes, bytes]:
    """The text's buckets and their weights in its mean; weights add up to 1."""
    buckets, weights, count = np.empty(0, "u4"), np.empty(0), 0
    for words, _ in _blocks([text]):
        found, grams = _grams(words)
        every = np.concatenate([buckets, *[b for b, _ in found]])
        buckets, at = np.unique(every, return_inverse=True)
        weights = np.bincount(at, np.concatenate([weights, *[1 / grams[w] for _, w in found]]))
        count += len(words)
    return buckets.astype("<u4").tobytes(), (weights / max(count, 1)).astype("<f4").tobytes()


def _bags(text: Column) -> Column:
    @F.pandas_udf("buckets array<int>, weights array<float>")
    def bags(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(np.frombuffer(b, "<i4"), np.frombuffer(w, "<f4")) for b, w in map(_bag, texts)],
                            columns=["buckets", "weights"])

    return bags(text)


@dataclass
class Model:
    buckets: np.ndarray
    embeddings: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray

    def per_gram(self) -> np.ndarray:
        """What one n-gram adds to the toxic class over the other; without an embedding, nothing."""
        out = np.zeros(BUCKETS, "f4")
        out[self.buckets] = self.embeddings @ (self.softmax[:, 1] - self.softmax[:, 0])
        return out

    def score(self, spark, text: Column) -> Column:
        """Probability that the whole text is toxic; a text without words has the prior."""
        shared = spark.sparkContext.broadcast((self.per_gram(), float(self.bias[1] - self.bias[0])))

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            per_gram, bias = shared.value
            logits = _mean_scores(texts.tolist(), per_gram) + bias
            return pd.Series(1 / (1 + np.exp(-np.clip(logits, -500, 500))))

        return score(text)


def _telling(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> np.ndarray:
    """The buckets whose share of documents differs between the classes."""
    known, at = np.unique(np.concatenate([b for b, _ in rows]), return_inverse=True)
    toxic = np.repeat(labels, [len(b) for b, _ in rows])
    count = np.stack([np.bincount(at[toxic == y], minlength=len(known)) for y in (0, 1)])
    size = np.array([(labels == 0).sum(), (labels == 1).sum()])
    share = (count.sum(0) + 1) / (size.sum() + 2)
    error = np.sqrt(share * (1 - share) * (1 / size).sum())
    return known[np.abs(count[1] / size[1] - count[0] / size[0]) >= Z * error]


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Joint full-batch Adam on embeddings, softmax and bias; a quarter of the weight is on toxic rows."""
    rng = np.random.default_rng(0)
    softmax = rng.normal(0, 0.5, (DIM, 2))
    told = _telling(rows, labels) if len(set(labels.tolist())) == 2 else np.empty(0, "i8")
    if not len(told):  # nothing to tell the classes apart by: the share of toxic rows
        share = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-6, 1 - 1e-6))
        return Model(told, np.zeros((0, DIM)), softmax, np.array([0.0, np.log(share / (1 - share))]))
    number = np.full(BUCKETS, -1, "i4")
    number[told] = np.arange(len(told))
    # Row by row, as the few telling n-grams need much less memory than all of them.
    used = [np.flatnonzero(number[b] >= 0) for b, _ in rows]
    owner = np.repeat(np.arange(len(rows)), [len(u) for u in used])
    bucket = np.concatenate([number[b[u]] for (b, _), u in zip(rows, used)])
    weight = np.concatenate([w[u] for (_, w), u in zip(rows, used)]).astype("f8")
    # n-grams as rare as those of one word in a text: weights near 1 let one step size serve all.
    scale = 1 / (np.sqrt(np.bincount(bucket, weight**2, len(told)) / len(rows)) + 1e-4)
    weight = weight * scale[bucket]
    balance = np.where(labels == 1, 0.25 / (labels == 1).sum(), 0.75 / (labels == 0).sum())
    vectors, bias = rng.normal(0, 0.01, (len(told), DIM)), np.array([0.0, np.log(1 / 3)])
    params = [vectors, softmax, bias]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        direction = softmax[:, 1] - softmax[:, 0]
        # The mean commutes with the softmax layer: logits are means of the n-grams' logits.
        gap = np.bincount(owner, weight * (vectors @ direction)[bucket], len(rows)) + bias[1] - bias[0]
        error = (1 / (1 + np.exp(-gap)) - labels) * balance
        pull = np.bincount(bucket, weight * error[owner], len(told))
        toward = vectors.T @ pull
        grads = [np.outer(pull, direction) + 1e-5 * vectors,
                 np.stack([-toward, toward], axis=1), np.array([-error.sum(), error.sum()])]
        for p, g, m, v in zip(params, grads, first, second):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            p -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Model(told, vectors * scale[:, None], softmax, bias)


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most `rows` labelled documents that are not held out: doc_id, text, y.

    Each class gives up to half of them, those of the smallest hash of the id.
    The ids are few by this bound, so they are broadcast.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    order = F.xxhash64(F.lit(17), "doc_id")
    chosen = [known.where(F.col("y") == y).orderBy(order, "doc_id").limit(rows // 2) for y in (0, 1)]
    return docs.select("doc_id", "text").join(
        F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").dropDuplicates(["doc_id", "y"])


def telling_bags(bags: DataFrame) -> DataFrame:
    """bags (doc_id, y, buckets, weights) with the entries that `_telling` chooses; every row stays.

    Most n-grams tell nothing, so they are counted, and dropped, before the driver sees a bag.
    """
    size = bags.agg(*[F.nullif(F.count_if(F.col("y") == y).cast("double"), F.lit(0.0)).alias(f"s{y}") for y in (0, 1)])
    counts = bags.select("y", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        *[F.count_if(F.col("y") == y).alias(f"c{y}") for y in (0, 1)])
    share = (F.col("c0") + F.col("c1") + 1) / (F.col("s0") + F.col("s1") + 2)
    error = F.sqrt(share * (1 - share) * (1 / F.col("s0") + 1 / F.col("s1")))
    # A little below the bound: the driver repeats the comparison on what is left.
    told = counts.crossJoin(F.broadcast(size)).where(
        F.abs(F.col("c1") / F.col("s1") - F.col("c0") / F.col("s0")) >= Z * error * (1 - 1e-9)).select("bucket")
    entries = bags.select("doc_id", "y", F.inline(F.arrays_zip("buckets", "weights"))).join(
        F.broadcast(told), F.col("buckets") == F.col("bucket"), "left_semi")
    kept = entries.groupBy(F.col("doc_id").alias("of"), F.col("y").alias("as")).agg(
        F.array_sort(F.collect_list(F.struct("buckets", "weights"))).alias("bag"))
    return bags.select("doc_id", "y").join(
        kept, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("y") == F.col("as")), "left").select(
        "doc_id", "y", "bag.buckets", "bag.weights")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    bags = written(sample(docs, labels, label, rows).select(
        "doc_id", "y", _bags(F.col("text")).alias("bag")).select("doc_id", "y", "bag.*"))
    got = telling_bags(bags).toPandas().sort_values(["doc_id", "y"])
    return fit([(np.array([] if b is None else b, "i4"), np.array([] if w is None else w, "f4"))
                for b, w in zip(got["buckets"], got["weights"])], got["y"].to_numpy("i8"))


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs without the rows whose text scores `threshold` or more.

    Null, empty and blank texts cannot be toxic and stay; repeated rows share
    their verdict; other columns pass through unread.
    """
    blank = F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(" \t\n\u000b\f\r")) == ""
    model = train(docs, labels)
    return docs.where(blank | (model.score(docs.sparkSession, F.col("text")) < threshold))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs (doc_id, text)."""
    model = train(docs, labels)
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        model.score(docs.sparkSession, F.col("text")).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
