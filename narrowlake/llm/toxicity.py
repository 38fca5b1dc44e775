"""Toxicity by FTRL-proximal logistic regression over hashed n-grams and skip-grams."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.llm.common import crc_fold, only_memory_of, remembers, ship_code, table

FOLDS = 5
# Features: 0 is the bias, the others are hashes; bounds the weights that are broadcast.
FEATURES = 1 << 20
# Labelled documents that the model is fitted on at most, and those of one fitting task.
MOST_ROWS = 24_000
SHARD_ROWS = 12_000
EPOCHS = 6
# Per-coordinate rate alpha / (beta + sqrt(sum of squared gradients)); L1 sets weights to zero.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 10.0, 0.1
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
REMEMBERED = 100_000


class _Words(dict):
    """Hash of each word, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = zlib.crc32(word)
        return value


_WORDS = _Words()
remembers("toxicity", _WORDS.clear)


def features(text: str | None) -> np.ndarray:
    """Distinct features of a whole text: words, pairs of neighbours, pairs with one word between."""
    words = WORD.findall((text or "").lower().encode())
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    pairs = _pair(h[:-1], h[1:], 1)
    skips = _pair(h[:-2], h[2:], 2)
    slots = (np.concatenate([_pair(h, h, 0), pairs, skips]) >> np.uint64(20)) % np.uint64(FEATURES - 1)
    return np.unique(slots).astype(np.int64) + 1


def _pair(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(kind * 7_919)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Model:
    """Weights that are not zero, by feature, and the bias."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(FEATURES)
        out[self.slots] = self.weights
        return out


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Fit on at most MOST_ROWS labelled documents outside the held-out fold.

    The sample is drawn by a hash of doc_id; texts become features in tasks, shards of
    SHARD_ROWS are fitted apart and their weights averaged, so the driver sees weights only.
    Labels other than 0 and 1 and documents without an id are left out; of several labels
    of one document the largest counts.  Without both classes the model scores all 0.
    """
    ship_code(docs.sparkSession)
    marked = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y"))
    marked = marked.where("y IN (0, 1) AND id IS NOT NULL").groupBy("id").agg(F.max("y").alias("y"))
    marked = marked.where(crc_fold(F.col("id"), FOLDS) != 0)
    found = dict(marked.groupBy("y").count().collect())
    if len(found) < 2:
        return Model(np.empty(0, np.int64), np.empty(0), -np.inf)
    rows = sum(found.values())
    share = min(1.0, MOST_ROWS / rows)
    place = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1 << 30).cast("long"))
    marked = marked.where(place < int(share * (1 << 30)))
    shards = max(1, round(rows * share / SHARD_ROWS))
    sampled = docs.select(F.col("doc_id").alias("id"), "text").join(marked, "id")

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        only_memory_of("toxicity")
        return texts.map(lambda t: features(t).astype(np.int32).tobytes())

    shard = F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(shards).cast("long")).alias("shard")
    rows = sampled.select(shard, "id", "y", packed("text").alias("slots"))
    parts = rows.groupBy("shard").applyInPandas(_fit, "slot int, weight double").groupBy("slot")
    mean = parts.agg((F.sum("weight") / shards).alias("weight")).toPandas().sort_values("slot")
    if mean.empty:  # none of the labels belongs to a document of the table
        return Model(np.empty(0, np.int64), np.empty(0), -np.inf)
    slots, weights = mean["slot"].to_numpy(np.int64), mean["weight"].to_numpy()
    return Model(slots[1:], weights[1:], float(weights[0]))


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """FTRL-proximal over the documents of one shard, in an order that their ids fix."""
    only_memory_of("toxicity")
    rows = rows.sort_values(["id", "y"])
    order = np.random.default_rng(len(rows)).permutation(len(rows))
    docs = [np.frombuffer(b, np.int32) for b in rows["slots"]]
    labels = rows["y"].to_numpy()
    z, n = np.zeros(FEATURES), np.zeros(FEATURES)
    strength = np.full(FEATURES, L1)
    strength[0] = 0.0  # the bias is not held back
    for _ in range(EPOCHS):
        for at in order:
            slots = np.concatenate([[0], docs[at]])
            w = _weights(z[slots], n[slots], strength[slots])
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[at]
            root = np.sqrt(n[slots])
            grown = np.sqrt(n[slots] + gradient * gradient)
            z[slots] += gradient - (grown - root) / ALPHA * w
            n[slots] += gradient * gradient
    w = _weights(z, n, strength)
    kept = np.flatnonzero(w)
    kept = kept if len(kept) and kept[0] == 0 else np.concatenate([[0], kept])
    return pd.DataFrame({"slot": kept.astype(np.int32), "weight": w[kept]})


def _weights(z: np.ndarray, n: np.ndarray, strength: np.ndarray) -> np.ndarray:
    w = -(z - np.sign(z) * strength) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= strength, 0.0, w)


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """Chance that a whole text is toxic; a null text counts as empty."""
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        only_memory_of("toxicity")
        model = shared.value
        weights = model.dense()
        for texts in batches:
            sums = np.array([weights[features(t)].sum() for t in texts], float) + model.bias
            yield pd.Series(np.where(sums < -700, 0.0, 1 / (1 + np.exp(-np.clip(sums, -700, 700)))))

    return scored(F.coalesce(text.cast("string"), F.lit("")))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; equal rows get equal scores.

    Only the text decides a score.  A null doc_id counts as an empty text for the fold.
    """
    model = train(docs, labels)
    held_out = crc_fold(F.col("doc_id"), FOLDS) == 0
    out = docs.select("doc_id", held_out.alias("held_out"), score(docs.sparkSession, model, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model does not call toxic, with their columns.

    Null and empty texts have the score of a text without features; equal rows stay or go
    together; rows without an id are scored as others.
    """
    chance = score(docs.sparkSession, train(docs, labels), F.col("text"))
    return docs.where(chance < 0.5)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scores(docs, table(spark, folder, "labels"))
