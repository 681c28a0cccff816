"""The classifiers against slow loops: convolution, pooling and gradients of one, counts, ratios and scores of the other."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsieve.llm import quality_cnn, toxicity
from tests.llm.cases import ODD, random_texts

SMALL = quality_cnn.Settings(chunk=24, step=20, width=4, stride=2, embedding=3, filters=5, seed=4)
TEXTS = ["", "x", "a" * 24, "one two three four five six seven eight", "日本語 " * 20] + [t for _, t in random_texts(20)]


def slow_chunks(text, s):
    data = text.encode()
    if len(data) <= s.chunk:
        return [list(data) + [0] * (s.chunk - len(data))]
    starts = [i for i in range(0, len(data), s.step) if i < len(data) - s.chunk] + [len(data) - s.chunk]
    return [list(data[i : i + s.chunk]) for i in starts]


def slow_logit(weights, chunk, s):
    total = float(weights["out bias"][0])
    for f in range(s.filters):
        answers = []
        for place in range(0, s.chunk - s.width + 1, s.stride):
            answer = 0.0
            for k in range(s.width):
                for e in range(s.embedding):
                    answer += float(weights["bytes"][chunk[place + k], e] * weights["filters"][k * s.embedding + e, f])
            answers.append(answer)
        total += max(max(answers) + float(weights["filter bias"][f]), 0) * float(weights["out"][f])
    return total


def test_network_scores_are_those_of_slow_loops():
    network = quality_cnn.ByteNetwork(SMALL)
    network.weights["filter bias"][:] = np.linspace(-0.3, 0.3, SMALL.filters)
    expected = []
    for text in TEXTS:
        logits = [slow_logit(network.weights, chunk, SMALL) for chunk in slow_chunks(text, SMALL)]
        expected.append(1 / (1 + math.exp(-sum(logits) / len(logits))))
    assert network.probabilities(TEXTS) == pytest.approx(expected, abs=1e-5)


def test_network_gradients_are_small_differences_of_the_loss():
    network = quality_cnn.ByteNetwork(SMALL)
    network.weights = {name: value.astype(np.float64) for name, value in network.weights.items()}
    chunks = np.concatenate([quality_cnn.cut_chunks(text, SMALL) for text in TEXTS])
    labels = np.arange(len(chunks)) % 2
    heavy = np.linspace(0.5, 1.5, len(chunks))

    def loss():
        logits = network.chunk_scores(chunks)
        return float(np.mean(heavy * (np.logaddexp(0, logits) - labels * logits)))

    rng, width = np.random.default_rng(2), 1e-6
    for name, slope in network.gradients(chunks, labels, heavy).items():
        values = network.weights[name].reshape(-1)
        used = np.flatnonzero(slope.reshape(-1))
        for at in rng.choice(used, min(len(used), 12), replace=False):
            before = values[at]
            values[at] = before + width
            above = loss()
            values[at] = before - width
            below = loss()
            values[at] = before
            assert slope.reshape(-1)[at] == pytest.approx((above - below) / (2 * width), rel=1e-2, abs=1e-6)


def slow_grams(text):
    """Character n-grams of each length, in order of length and place."""
    padded = f" {text.lower()} "
    return [padded[i : i + n] for n in toxicity.LENGTHS for i in range(len(padded) - n + 1)]


def test_equal_grams_share_a_bucket_and_others_do_not():
    texts = [text or "" for _, text in ODD[:7]] + [text for _, text in random_texts(100)]
    bucket_of = {}
    for text in texts:
        names, buckets = slow_grams(text), toxicity.grams(text).tolist()
        assert len(names) == len(buckets)
        for name, bucket in zip(names, buckets, strict=True):
            assert bucket_of.setdefault(name, bucket) == bucket
    # no more of them meet than by chance
    buckets = 1 << toxicity.BITS
    by_chance = buckets * (1 - math.exp(-len(bucket_of) / buckets))
    assert len(set(bucket_of.values())) >= 0.995 * by_chance


def test_counts_ratios_and_scores_are_those_of_slow_loops(spark):
    rows = [(i, f"you {word} thing {i % 7}", int(word == "rotten")) for i, word in enumerate(["rotten", "lovely", "fine"] * 12)]
    docs = spark.createDataFrame([row[:2] for row in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, _, label in rows], "doc_id long, toxic int")
    settings = toxicity.Settings()
    held = {}
    for _, text, label in rows:
        for gram, bucket in set(zip(slow_grams(text), toxicity.grams(text).tolist(), strict=True)):
            held.setdefault(bucket, [0, 0, gram])[label] += 1
    texts = toxicity.training_texts(docs, labels, F.lit(True), settings)
    counted = {row.bucket: [row.clean, row.toxic] for row in toxicity.bucket_counts(texts).collect()}
    assert counted == {bucket: some[:2] for bucket, some in held.items()}

    model = toxicity.train(docs, labels, F.lit(True), settings)
    sizes = [sum(label == value for _, _, label in rows) for value in (0, 1)]
    for bucket, (clean, toxic, _) in held.items():
        ratio = math.log((toxic + 1) / (sizes[1] + 2)) - math.log((clean + 1) / (sizes[0] + 2))
        # rare n-grams and those that tell nothing are no features
        if clean + toxic < settings.least_documents or ratio == 0:
            assert model.weights[bucket] == 0
    for _, text, label in rows:
        total = model.bias + sum(model.weights[bucket] for bucket in set(toxicity.grams(text).tolist()))
        assert model.probability(text) == pytest.approx(1 / (1 + math.exp(-total)))
        assert (model.probability(text) >= 0.5) == bool(label)


def test_fit_is_the_least_ridge_loss():
    rng = np.random.default_rng(1)
    features = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(40)]
    labels = (np.array([len(f) for f in features]) + rng.normal(0, 1, 40) > 3).astype(float)
    ratios = rng.normal(0, 1, 6)
    settings = toxicity.Settings(steps=4000, rate=0.01, ridge=0.05)
    weights, bias = toxicity.fit(features, labels, ratios, settings)

    def loss(w, b):
        total = 0.0
        for some, label in zip(features, labels, strict=True):
            logit = b + sum(w[f] * ratios[f] for f in some)
            total += math.log1p(math.exp(logit)) - label * logit
        return total / len(labels) + settings.ridge / 2 * float(np.dot(w, w))

    least = loss(weights, bias)
    for at in range(6):
        for move in (-0.02, 0.02):
            other = weights.copy()
            other[at] += move
            assert loss(other, bias) > least
    assert min(loss(weights, bias - 0.02), loss(weights, bias + 0.02)) > least
