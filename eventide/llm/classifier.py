"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors: one per word, per character n-gram of
its words (hashed into ``BUCKETS`` rows) and per word that repeats the one before
it (a row of its own).  The mean goes through a softmax over the two labels.  It
is trained here with numpy, by stochastic gradient descent with a falling rate
over a bounded sample of labelled documents.

The sample has the ``TRAIN_ROWS`` labelled rows of smallest id hash outside the
held-out fold (crc32 of the id as text, modulo 5, is 0), of equal ids those of
smallest text hash; their ids, of that proven number, are broadcast to pick the
rows, the rows' hashes to pick the texts, and the driver gets counted features of
at most that many rows, never texts.  Scoring is one pass without a shuffle: as the
model is linear behind the mean, a word's vectors shrink to one number per label
difference and a count, which a task remembers per word.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from eventide.llm.common import checkpointed, fresh, ref

FOLDS, HELD_OUT = 5, 0
#: Bounds of the training sample: examples, and bytes of their features, by hash of the id.
TRAIN_ROWS, TRAIN_BYTES = 3000, 256 << 20
BUCKETS, DIMENSIONS, NGRAMS = 1 << 16, 8, (3, 4)
REPEAT = BUCKETS  # the row of a word that repeats the one before it
#: Passes over the examples: enough to see STEPS of them, and EPOCHS at least.
EPOCHS, STEPS, RATE, BATCH, SEED = 6, 18_000, 20.0, 32, 13
THRESHOLD = 0.3
#: Words that a task remembers, and the longest of them.
CACHE_WORDS, WORD_CHARS = 300_000, 40
WORDS = re.compile("[^\x20\x09-\x0d]+")


def fold(row_id: Column) -> Column:
    return F.crc32(row_id.cast("string").cast("binary")) % FOLDS


def held_out(row_id: Column) -> Column:
    """Rows without an id are held out: nothing is learnt from them."""
    return F.coalesce(fold(row_id) == HELD_OUT, F.lit(True))


def word_features(word: str) -> list[int]:
    """Rows of a word: its own and those of its character n-grams with the edges
    marked, however long it is."""
    digest, marked = xxhash.xxh32_intdigest, f"<{word}>"
    return [digest(marked) % BUCKETS,
            *[digest(marked[i:i + n], n) % BUCKETS for n in NGRAMS for i in range(len(marked) - n + 1)]]


def text_features(text: str | None) -> dict[int, int]:
    """Feature row -> times it occurs in the whole text."""
    counts: Counter[int] = Counter()
    words = WORDS.findall(text or "")
    for word, n in Counter(words).items():
        for f in word_features(word):
            counts[f] += n
    if again := repeats(words):
        counts[REPEAT] = again
    return counts


def repeats(words: list[str]) -> int:
    return sum(map(eq, words, words[1:]))


class Model(NamedTuple):
    """What scoring needs: per feature row the difference of the two logits."""

    gain: np.ndarray
    bias: float

    def word(self, word: str) -> complex:
        """The word's share of the logit, and its number of features beside it."""
        rows = word_features(word)
        return complex(self.gain[rows].sum(), len(rows))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = SEED) -> Model:
    """``examples``: feature rows, their counts, label 0 or 1.  With fewer than two
    labels the model says their share everywhere."""
    rng = np.random.default_rng(seed)
    labels = np.array([y for _, _, y in examples], np.float64)
    share = (labels.sum() + 1) / (len(labels) + 2)
    prior = float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(BUCKETS + 1, np.float32), prior)
    vectors = rng.uniform(-1, 1, (DIMENSIONS, BUCKETS + 1)) / DIMENSIONS
    out, bias = np.zeros((DIMENSIONS, 2)), np.array([0.0, prior])
    weights = [c / c.sum() if len(c) else c.astype(float) for _, c, _ in examples]
    # both labels weigh as they occur; steps see the documents in a new order each epoch
    epochs = max(EPOCHS, math.ceil(STEPS / len(examples)))
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        order = rng.permutation(len(examples))
        for s in range(0, len(order), BATCH):
            batch = order[s:s + BATCH]
            rate = RATE * max(0.02, 1 - done / steps)
            rows = np.concatenate([examples[i][0] for i in batch])
            weight = np.concatenate([weights[i] for i in batch])
            size = [len(weights[i]) for i in batch]
            own = np.repeat(np.arange(len(batch)), size)
            mean = np.stack([np.bincount(own, weight * vectors[k, rows], len(batch)) for k in range(DIMENSIONS)], 1)
            logits = mean @ out + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            error = p - np.eye(2)[labels[batch].astype(int)]
            back = error @ out.T
            out -= rate / len(batch) * mean.T @ error
            bias -= rate / len(batch) * 0.1 * error.sum(0)
            for k in range(DIMENSIONS):
                vectors[k] -= rate / len(batch) * np.bincount(rows, weight * back[own, k], BUCKETS + 1)
            done += len(batch)
    gain = (out[:, 1] - out[:, 0]) @ vectors
    return Model(gain.astype(np.float32), float(bias[1] - bias[0]))


def training_rows(docs: DataFrame, labels: DataFrame, row_id: str, text: str, label: str, rows: int) -> DataFrame:
    """(y, features, counts) of the sample; an id with several labels counts by the
    smallest, a null label not at all; of rows that share an id each is an example,
    up to ``rows`` examples in all."""
    own, digest = fresh(docs.columns, "id"), fresh(docs.columns, "hash")
    known = labels.select(ref(row_id).alias(own), ref(label).cast("int").alias("y")).where(
        ~held_out(F.col(own)) & F.col("y").isin(0, 1))
    known = known.groupBy(own).agg(F.min("y").alias("y"))
    known = known.orderBy(F.xxhash64(own), own).limit(rows)  # top k by hash: a few rows per task meet
    texts = docs.select(ref(row_id).alias(own), ref(text).alias("text"))
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    chosen = texts.join(F.broadcast(known), own).select(own, "y", hashed.alias(digest))
    chosen = chosen.orderBy(F.xxhash64(own), own, digest).limit(rows).groupBy(own, digest).agg(F.min("y").alias("y"), F.count("*").alias("times"))
    sample = texts.withColumn(digest, hashed).join(F.broadcast(chosen), [own, digest])
    # equal rows collapse by partial aggregation; each is an example as often as chosen
    sample = sample.groupBy(own, digest, "y", "times").agg(F.first("text").alias("text"))
    sample = sample.select(own, "y", "text", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("time")).drop("time")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [text_features(t) for t in batch["text"]]
            yield pd.DataFrame({"id": batch[own], "y": batch["y"],
                                "rows": [np.fromiter(f.keys(), "<i4", len(f)).tobytes() for f in found],
                                "n": [np.fromiter(f.values(), "<i4", len(f)).tobytes() for f in found]})

    return sample.mapInPandas(counted, f"id {dict(docs.dtypes)[row_id]}, y int, rows binary, n binary")


def fit(docs: DataFrame, labels: DataFrame, row_id: str = "doc_id", text: str = "text", label: str = "quality",
        rows: int = TRAIN_ROWS) -> Model:
    """Train on the bounded sample; examples are put in the order of their ids, so
    the model depends on the tables alone.  Where the features of very long texts would
    take more than ``TRAIN_BYTES``, examples that come later by the hash of their id are
    left out; the sizes of at most ``rows`` examples meet in one task for that."""
    sample = checkpointed(training_rows(docs, labels, row_id, text, label, rows).withColumn("size", F.length("rows") + F.length("n")))
    by_hash = Window.orderBy(F.xxhash64("id"), "id", F.xxhash64("rows", "n"))
    before = F.sum("size").over(by_hash.rowsBetween(Window.unboundedPreceding, -1))
    if (sample.agg(F.sum("size")).first()[0] or 0) > TRAIN_BYTES:
        sample = sample.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") + F.col("size") <= TRAIN_BYTES)
    found = sample.collect()
    found.sort(key=lambda r: (r["id"], r["y"], bytes(r["rows"]), bytes(r["n"])))
    return train([(np.frombuffer(r["rows"], "<i4"), np.frombuffer(r["n"], "<i4").astype(float), r["y"]) for r in found])


class Scorer(dict):
    """word -> its share of the logit and number of features, remembered as one
    complex number: a single sum adds up both."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> complex:
        told = self.model.word(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= WORD_CHARS:
            self[word] = told
        return told

    def score(self, text: str) -> float:
        words = WORDS.findall(text)
        told, again = sum(map(self.__getitem__, words), 0j), repeats(words)
        gain, n = told.real + again * float(self.model.gain[REPEAT]), told.imag + again
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, gain / max(n, 1.0) + self.model.bias))))


def scored(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Add the probability of label 1 for each whole text.

    A null or empty text has no features and gets the score of the bias.  Repeated
    rows get equal scores; an empty table gives an empty result; a column called
    ``name`` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return df.withColumn(name, score(F.coalesce(ref(text), F.lit(""))))
