"""Document quality by a small convolutional network over bytes, in numpy.

A text is UTF-8 bytes cut into overlapping chunks that cover all of it. In a chunk, learned filters slide over byte
embeddings, each filter keeps its largest answer (max pooling), and a linear layer turns these into a chunk score.
The chunk scores of a document, averaged, pass through a sigmoid: one probability, however long the text.

Training uses at most `Settings.per_class` labelled documents per class and at most `chunks_per_doc` evenly spread
chunks of each, so what reaches the driver is bounded: 2 x 1500 x 6 chunks of 512 bytes, 9 MB, whatever the table.
Scoring reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsieve.llm.shared import crc_of_id, release, sampled_labels

# log-odds of a network that has learned nothing: on the good side, so that nobody is rejected
UNLEARNED = 1.0


@dataclass(frozen=True)
class Settings:
    per_class: int = 1500
    chunks_per_doc: int = 6
    chunk: int = 512
    step: int = 448
    width: int = 8
    stride: int = 2
    embedding: int = 6
    filters: int = 32
    epochs: int = 14
    least_steps: int = 600
    rows: int = 256
    shortened: float = 0.4
    shortest: int = 16
    rate: float = 4e-3
    decay: float = 1e-4
    seed: int = 11


def cut_chunks(text: str, settings: Settings) -> np.ndarray:
    """(chunks, chunk size) bytes; the last chunk ends where the text ends, shorter texts are filled with 0."""
    data = np.frombuffer(text.encode(), np.uint8)
    size, step = settings.chunk, settings.step
    if len(data) <= size:
        return np.pad(data, (0, size - len(data)))[None, :]
    starts = np.append(np.arange(0, len(data) - size, step), len(data) - size)
    return np.lib.stride_tricks.sliding_window_view(data, size)[starts]


class ByteNetwork:
    """Weights, forward pass and training. Arrays are float32."""

    def __init__(self, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        s = self.settings = settings
        inputs = s.width * s.embedding
        self.weights = {
            "bytes": rng.normal(0, 0.5, (256, s.embedding)),
            "filters": rng.normal(0, 1 / np.sqrt(inputs), (inputs, s.filters)),
            "filter bias": np.zeros(s.filters),
            "out": rng.normal(0, 1 / np.sqrt(s.filters), s.filters),
            "out bias": np.zeros(1),
        }
        self.weights = {name: value.astype(np.float32) for name, value in self.weights.items()}

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, places, width) bytes under the filters."""
        s = self.settings
        return np.lib.stride_tricks.sliding_window_view(chunks, s.width, axis=1)[:, :: s.stride]

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest answer of each filter in each chunk, and where it was."""
        w, s = self.weights, self.settings
        embedded = w["bytes"][chunks].reshape(len(chunks), -1)
        spans = np.lib.stride_tricks.sliding_window_view(embedded, s.width * s.embedding, axis=1)
        spans = spans[:, :: s.stride * s.embedding]
        answers = (spans.reshape(-1, s.width * s.embedding) @ w["filters"]).reshape(len(chunks), -1, s.filters)
        places = answers.argmax(axis=1)
        best = np.take_along_axis(answers, places[:, None, :], axis=1)[:, 0, :]
        return np.maximum(best + w["filter bias"], 0), places

    def chunk_scores(self, chunks: np.ndarray) -> np.ndarray:
        parts = [self.pooled(chunks[i : i + 256])[0] for i in range(0, len(chunks), 256)]
        return np.concatenate(parts) @ self.weights["out"] + self.weights["out bias"]

    def gradients(self, chunks: np.ndarray, labels: np.ndarray, heavy: np.ndarray | float = 1.0) -> dict[str, np.ndarray]:
        """Of the mean logistic loss; only the place that won the pooling passes a gradient back."""
        w, s = self.weights, self.settings
        best, places = self.pooled(chunks)
        logits = best @ w["out"] + w["out bias"]
        error = (heavy * (1 / (1 + np.exp(-logits)) - labels)).astype(np.float32) / len(labels)
        back = error[:, None] * w["out"] * (best > 0)
        won = self.windows(chunks)[np.arange(len(chunks))[:, None], places]
        inputs = w["bytes"][won].reshape(len(chunks), s.filters, -1)
        to_bytes = (back[:, :, None] * w["filters"].T).reshape(len(chunks), s.filters, s.width, s.embedding)
        byte_gradient = np.zeros_like(w["bytes"])
        np.add.at(byte_gradient, won, to_bytes)
        return {
            "bytes": byte_gradient,
            "filters": np.einsum("nf,nfi->if", back, inputs),
            "filter bias": back.sum(0),
            "out": error @ best,
            "out bias": error.sum(keepdims=True),
        }

    def fit(self, chunks: np.ndarray, labels: np.ndarray) -> ByteNetwork:
        """Adam over shuffled rows; equal rows in equal order give equal weights.

        A share of the rows is cut to a random length each time, so that short texts are not strange to the network.
        Few rows are gone over more often, up to `least_steps`, and each class weighs the same however many rows it has.
        """
        s, rng = self.settings, np.random.default_rng(self.settings.seed)
        mean = {name: np.zeros_like(value) for name, value in self.weights.items()}
        square = {name: np.zeros_like(value) for name, value in self.weights.items()}
        steps = 0
        shares = np.bincount(labels.astype(int), minlength=2) / max(1, len(labels))
        heavy = (0.5 / np.maximum(shares, 1e-9)).astype(np.float32)[labels.astype(int)]
        for _ in range(max(s.epochs, -(-s.least_steps // max(1, -(-len(chunks) // s.rows))))):
            order = rng.permutation(len(chunks))
            for at in range(0, len(order), s.rows):
                rows = order[at : at + s.rows]
                steps += 1
                lengths = np.exp(rng.uniform(np.log(s.shortest), np.log(s.chunk), len(rows)))
                lengths[rng.random(len(rows)) >= s.shortened] = s.chunk
                seen = np.where(np.arange(s.chunk) < lengths[:, None], chunks[rows], 0)
                for name, slope in self.gradients(seen, labels[rows], heavy[rows]).items():
                    mean[name] = 0.9 * mean[name] + 0.1 * slope
                    square[name] = 0.99 * square[name] + 0.01 * slope * slope
                    move = mean[name] / (1 - 0.9**steps) / (np.sqrt(square[name] / (1 - 0.99**steps)) + 1e-8)
                    self.weights[name] -= np.float32(s.rate) * (move + s.decay * self.weights[name])
        return self

    def probabilities(self, texts: Iterable[str]) -> np.ndarray:
        """Of label 1, one per text; texts are taken together until a few thousand chunks are filled."""
        scores, waiting, count = [], [], 0

        def flush():
            nonlocal waiting, count
            if waiting:
                starts = np.cumsum([0] + [len(c) for c in waiting[:-1]])
                sums = np.add.reduceat(self.chunk_scores(np.concatenate(waiting)).astype(np.float64), starts)
                scores.append(sums / [len(c) for c in waiting])
            waiting, count = [], 0

        for text in texts:
            waiting.append(cut_chunks(text, self.settings))
            count += len(waiting[-1])
            if count > 4096:
                flush()
        flush()
        mean = np.concatenate(scores) if scores else np.zeros(0)
        # six digits: the last ones of a matrix product depend on the texts that share it
        return np.round(1 / (1 + np.exp(-mean)), 6)


def training_rows(docs: DataFrame, labels: DataFrame, training: Column, settings: Settings) -> DataFrame:
    """doc_id, label and chunks (binary) of the bounded training sample.

    The labels pick the ids, at most 2 x per_class of them, which are small enough to broadcast whatever the tables.
    """
    sample = sampled_labels(labels, "quality", training, settings.per_class)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def cut(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            kept = []
            for text in pdf["text"]:
                chunks = cut_chunks(text, settings)
                spread = np.linspace(0, len(chunks) - 1, min(len(chunks), settings.chunks_per_doc)).astype(int)
                kept.append(chunks[spread].tobytes())
            yield pdf[["doc_id", "label"]].assign(chunks=kept)

    chosen = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    rows = chosen.mapInPandas(cut, "doc_id long, label int, chunks binary")
    # a repeated id counts once, with the first of its texts in order, so the bound on ids is one on rows
    return rows.groupBy("doc_id", "label").agg(F.min("chunks").alias("chunks"))


def train(docs: DataFrame, labels: DataFrame, training: Column, settings: Settings = Settings()) -> ByteNetwork:
    """A network fitted to the labelled rows that `training` (a condition on doc_id) allows.

    Without labelled rows of both classes among `docs` nothing can be learned: every score is the same and on the good
    side, so no document is called bad.
    """
    rows = training_rows(docs, labels, training, settings).toPandas().sort_values("doc_id")
    network = ByteNetwork(settings)
    if rows["label"].nunique() < 2:
        network.weights["out"][:] = 0
        network.weights["out bias"][:] = UNLEARNED
        return network
    chunks = [np.frombuffer(c, np.uint8).reshape(-1, settings.chunk) for c in rows["chunks"]]
    of_chunk = np.repeat(rows["label"].to_numpy(np.float32), [len(c) for c in chunks])
    return network.fit(np.concatenate(chunks), of_chunk)


def quality(network: ByteNetwork, text: Column) -> Column:
    """Probability that a text is good, as a column. Null counts as empty."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        # the texts leave Arrow one by one: a batch is never there a second time as strings
        scores = pa.array(network.probabilities(text.as_py() for text in texts), pa.float64())
        release()
        return scores

    return score(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document, learned only from ids that are not held out.

    held_out: crc32 of the id as text leaves 1 on division by 3; false for a null id. Null and empty texts get the
    score of a chunk of zeros. Repeated rows give equal rows; further columns are ignored whatever their names.
    Where the training labels lack a class, every document is predicted 1.
    """
    held_out = F.coalesce(crc_of_id(F.col("doc_id")) % 3 == 1, F.lit(False))
    network = train(docs, labels, ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), quality(network, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
