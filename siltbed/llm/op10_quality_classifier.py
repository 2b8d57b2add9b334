"""Quality by a byte-level convolutional network in numpy.

The text's bytes are cut into overlapping chunks that cover the whole document.
Learned filters run over each chunk (a filter is one weight per byte value and
place, so a convolution is table lookups), rectified and max-pooled over the
chunk. A document's vector holds the mean and the maximum of its chunks; one
logistic unit gives the probability of label 1.

The network is fitted with Adam on the driver, on a bounded labelled sample
(``PER_CLASS`` texts of either label); scoring runs in Arrow batches on all rows.

Defined results: NULL and empty texts are one chunk of padding and get its
score; very long texts are scored over all their chunks; repeated rows get the same
score each; without labelled rows, or with one
label only, the score is that label's share (0.5 without any); an empty table
gives an empty result. No other column is an input of the score.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import crc_fold, with_text_columns
from siltbed.llm.labelled import labelled_sample

#: Fixed values of the contract.
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7

PER_CLASS = 800
CHUNK, OVERLAP = 512, 64
WIDTH, FILTERS = 5, 24
EPOCHS, BATCH, RATE = 8, 32, 0.02
FAVOUR = 2.0
#: Chunks that are convolved at once; their values fit a core's cache.
BLOCK = 32


def chunks(text: bytes) -> np.ndarray:
    """Overlapping chunks of the whole text, the last one padded with zeros."""
    step = CHUNK - OVERLAP
    count = max(1, -(-(len(text) - OVERLAP) // step))
    padded = np.zeros((count - 1) * step + CHUNK, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


@dataclass
class Network:
    """``filters``: place x byte x filter; ``head``: weights of the mean, then of the maximum, over chunks."""

    filters: np.ndarray
    bias: np.ndarray
    head: np.ndarray
    offset: float

    def pooled(self, x: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Per chunk and filter the largest rectified value, and the place it comes from."""
        values = np.empty((len(x), FILTERS), np.float32)
        places = np.empty((len(x), FILTERS), np.int64) if where else None
        last = CHUNK - WIDTH + 1
        for at in range(0, len(x), BLOCK):
            block = x[at : at + BLOCK]
            conv = self.filters[0][block[:, :last]]
            for place in range(1, WIDTH):
                conv += self.filters[place][block[:, place : place + last]]
            if places is None:
                values[at : at + BLOCK] = conv.max(1)
            else:
                places[at : at + BLOCK] = best = conv.argmax(1)
                values[at : at + BLOCK] = np.take_along_axis(conv, best[:, None, :], 1)[:, 0]
        return np.maximum(values + self.bias, 0), places

    def scores(self, texts: list[bytes]) -> np.ndarray:
        cut = [chunks(t) for t in texts]
        counts = np.array([len(c) for c in cut])
        pooled, _ = self.pooled(np.concatenate(cut))
        return _sigmoid(_vectors(pooled, counts) @ self.head + self.offset)


def _vectors(pooled: np.ndarray, counts: np.ndarray) -> np.ndarray:
    starts = np.cumsum(counts) - counts
    mean = np.add.reduceat(pooled, starts) / counts[:, None]
    return np.concatenate([mean, np.maximum.reduceat(pooled, starts)], 1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(sample: list[tuple[bytes, int]], seed: int = 10) -> Network:
    """Adam on the log loss. Label 1 weighs ``FAVOUR`` times label 0; half of its texts give a short piece too.

    Short texts are rare in the sample, and being short is no fault.
    """
    random = np.random.default_rng(seed)
    net = Network(
        random.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        random.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        0.0,
    )
    y = np.array([label for _, label in sample], np.float64)
    if len(set(y)) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        net.head[:] = 0
        net.offset = float(np.log(share / (1 - share)))
        return net
    good = [text for text, label in sample if label == 1 and text]
    starts = [(text, int(random.integers(len(text)))) for text in good[::2]]
    sample = sample + [(text[at : at + int(random.integers(20, 200))], 1) for text, at in starts]
    y = np.array([label for _, label in sample], np.float64)
    weight = np.where(y == 1, FAVOUR, 1.0)
    cut = [chunks(text) for text, _ in sample]
    params = [net.filters, net.bias, net.head, np.zeros(1, np.float32)]
    moments = [(np.zeros(p.shape), np.zeros(p.shape)) for p in params]
    turn = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(sample))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            counts = np.array([len(cut[i]) for i in batch])
            x = np.concatenate([cut[i] for i in batch])
            pooled, places = net.pooled(x, where=True)
            vectors = _vectors(pooled, counts)
            error = (_sigmoid(vectors @ net.head + params[3]) - y[batch]) * weight[batch] / len(batch)
            # Back through the pooling: to all chunks by the mean, to the largest by the maximum.
            owner = np.repeat(np.arange(len(batch)), counts)
            back = (error / counts)[owner][:, None] * net.head[:FILTERS]
            largest = pooled == vectors[owner, FILTERS:]
            back = (back + largest * error[owner][:, None] * net.head[FILTERS:]) * (pooled > 0)
            grad = np.empty((WIDTH, 256, FILTERS))
            chunk = np.arange(len(x))[:, None]
            for place in range(WIDTH):
                index = x[chunk, places + place].astype(np.int64) * FILTERS + np.arange(FILTERS)
                grad[place] = np.bincount(index.ravel(), back.ravel(), 256 * FILTERS).reshape(256, FILTERS)
            turn += 1
            for p, g, (m, v) in zip(params, [grad, back.sum(0), vectors.T @ error, error.sum(keepdims=True)], moments):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                step = RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
                p -= step.astype(np.float32)
    net.offset = float(params[3][0])
    return net


def score(docs: DataFrame, net: Network, column: str = "text") -> DataFrame:
    """The documents with a struct of one field, score."""

    def compute() -> Callable[[list[bytes]], list[list]]:
        def work(texts: list[bytes]) -> list[list]:
            return [[float(p) for at in range(0, len(texts), 256) for p in net.scores(texts[at : at + 256])]]

        return work

    return with_text_columns(docs, [T.StructField("score", T.DoubleType())], compute, column)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    net = fit(labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, PER_CLASS))
    scored = score(docs.select("doc_id", "text"), net)
    return scored.select(
        "doc_id",
        (crc_fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        F.col("_found.score").alias("score"),
        F.when(F.col("_found.score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
