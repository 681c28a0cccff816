"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

1. Spark counts, per hashed n-gram, the training documents of either class that hold it (presence, not frequency).
   An n-gram is 3 to 5 characters of the lower-case text; its hash names one of 2^20 buckets, which bounds the counts
   whatever the table.
2. The log ratio of the smoothed class shares is the scale r of a bucket. The buckets with the largest weight of
   evidence, |r| times the square root of their documents, are kept as features.
3. Logistic regression with a ridge runs over the features present in each sampled document, each worth r.

What reaches the driver is bounded by `Settings`: the counts of the buckets, and the kept features that occur in at
most 2 x per_class documents. Scoring reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsieve.llm.shared import crc_of_id, release, sampled_labels, stored

LENGTHS = (3, 4, 5)
BITS = 20
FACTOR = np.uint32(0x01000193)
MIX = np.uint32(0x9E3779B1)
# log-odds of a model that has learned nothing: on the clean side, so that nobody is rejected
UNLEARNED = -1.0


@dataclass(frozen=True)
class Settings:
    per_class: int = 6000
    smoothing: float = 1.0
    features: int = 6000
    least_documents: int = 8
    ridge: float = 2e-4
    steps: int = 300
    rate: float = 0.05


def grams(text: str) -> np.ndarray:
    """Buckets of all character n-grams of a text, in order of length and place, with a blank on either side."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    running, found = points * MIX, []
    for length in range(2, LENGTHS[-1] + 1):
        running = (running[:-1] * FACTOR) ^ (points[length - 1 :] * MIX)
        if length in LENGTHS:
            mixed = (running ^ (running >> np.uint32(15))) * MIX + np.uint32(length)
            found.append(mixed >> np.uint32(32 - BITS))
        if len(running) < 2:
            break
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


@dataclass(frozen=True)
class Model:
    """`weights` by bucket, 0 for all that are no feature."""

    weights: np.ndarray
    bias: float

    def probability(self, text: str) -> float:
        """Each feature counts once however often it occurs."""
        buckets = grams(text)
        present = np.unique(buckets[self.weights[buckets] != 0])
        return float(1 / (1 + np.exp(-(self.weights[present].sum(dtype=np.float64) + self.bias))))


def training_texts(docs: DataFrame, labels: DataFrame, training: Column, settings: Settings) -> DataFrame:
    """doc_id, label, text of the sample; the ids are few enough to broadcast whatever the tables."""
    sample = sampled_labels(labels, "toxic", training, settings.per_class)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # a repeated id counts once, with the first of its texts in order, so the bound on ids is one on rows
    return texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def bucket_counts(texts: DataFrame) -> DataFrame:
    """bucket, toxic and clean documents that hold it."""

    def count(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((2, 1 << BITS), np.int64)
        for pdf in pdfs:
            for text, label in zip(pdf["text"], pdf["label"], strict=True):
                held[label, np.unique(grams(text))] += 1
        some = np.flatnonzero(held.sum(0))
        yield pd.DataFrame({"bucket": some, "clean": held[0, some], "toxic": held[1, some]})

    counted = texts.mapInPandas(count, "bucket long, clean long, toxic long")
    return counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def present_features(texts: DataFrame, chosen: np.ndarray) -> DataFrame:
    """label and the positions of its features for each document."""

    def find(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = np.full(1 << BITS, -1, np.int32)
        place[chosen] = np.arange(len(chosen))
        for pdf in pdfs:
            found = [np.unique(place[grams(text)]) for text in pdf["text"]]
            yield pdf[["doc_id", "label"]].assign(features=[f[f >= 0] for f in found])

    return texts.mapInPandas(find, "doc_id long, label int, features array<int>")


def fit(features: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, settings: Settings) -> tuple:
    """Weights of the ratio-scaled features and the bias: full-batch Adam on the ridge logistic loss."""
    rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
    columns = np.concatenate(features).astype(np.int64)
    values = ratios[columns]
    weights, bias = np.zeros(len(ratios) + 1), 0.0
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, settings.steps + 1):
        logits = np.bincount(rows, values * weights[columns], len(features)) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) / len(labels)
        slope = np.append(np.bincount(columns, values * error[rows], len(ratios)), error.sum())
        slope[:-1] += settings.ridge * weights[:-1]
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        weights -= settings.rate * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-12)
    return weights[:-1], weights[-1]


def train(docs: DataFrame, labels: DataFrame, training: Column, settings: Settings = Settings()) -> Model:
    """A model fitted to the labelled rows that `training` (a condition on doc_id) allows.

    Without labelled rows of both classes among `docs`, or without an n-gram that tells them apart, nothing can be
    learned: every score is the same and on the clean side, so no document is called toxic.
    """
    nothing = Model(np.zeros(1 << BITS), UNLEARNED)
    texts = stored(training_texts(docs, labels, training, settings))
    sizes = {row["label"]: row["n"] for row in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return nothing
    counts = bucket_counts(texts).toPandas().sort_values("bucket")
    clean = (counts["clean"].to_numpy() + settings.smoothing) / (sizes[0] + 2 * settings.smoothing)
    toxic = (counts["toxic"].to_numpy() + settings.smoothing) / (sizes[1] + 2 * settings.smoothing)
    ratio = np.log(toxic / clean)
    documents = (counts["clean"] + counts["toxic"]).to_numpy()
    evidence = np.where(documents >= min(settings.least_documents, min(sizes.values())), abs(ratio), 0)
    evidence = evidence * np.sqrt(documents)
    best = np.sort(np.argsort(-evidence, kind="stable")[: settings.features])
    best = best[evidence[best] > 0]
    if not len(best):
        return nothing
    chosen = counts["bucket"].to_numpy()[best]
    rows = present_features(texts, chosen).orderBy("doc_id").toPandas()
    learned, bias = fit(list(rows["features"]), rows["label"].to_numpy(float), ratio[best], settings)
    weights = np.zeros(1 << BITS)
    weights[chosen] = learned * ratio[best]
    return Model(weights, float(bias))


def toxicity(model: Model, text: Column) -> Column:
    """Probability that a text is toxic, as a column. Null counts as empty."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        scores = pd.Series([model.probability(t) for t in texts], index=texts.index, dtype="float64")
        release()
        return scores

    return score(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document, learned only from ids that are not held out.

    held_out: crc32 of the id as text leaves 0 on division by 5; false for a null id. Null and empty texts hold no
    feature and get the bias alone. Repeated rows give equal rows; further columns are ignored whatever their names.
    Where the training labels lack a class, every document is predicted 0.
    """
    held_out = F.coalesce(crc_of_id(F.col("doc_id")) % 5 == 0, F.lit(False))
    model = train(docs, labels, ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
