"""Toxicity by multiple-instance learning.

Only documents are labelled, sentences give the score: a logistic model over the
words of a sentence, and a document is toxic if any of its sentences is (noisy-or
over the sentence probabilities). The gradient of the document's likelihood
reaches the sentences that explain it, so the model also locates them.

Features are the words of a sentence and their first letters (for inflected
words). The model is fitted on the driver with a bounded labelled sample
(``PER_CLASS`` texts of either label) over the features that occur in
``LEAST_DOCS`` of them and depend on the label (chi-square); they are compared
exactly, unknown ones weigh nothing. Scoring runs in Arrow batches on all rows.

Defined results: NULL and empty texts have no sentence, score 0; repeated rows
get the same score each; very long texts are scored whole, sentence by sentence;
without both labels the score is 0; an empty table gives
an empty result. No other column is an input of the score.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import crc_fold, free_name, with_text_columns
from siltbed.llm.labelled import labelled_sample

#: Fixed values of the contract.
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7

PER_CLASS = 2000
LEAST_DOCS = 4
#: Chi-square with one degree of freedom that one feature in 100,000 reaches by chance.
LEAST_CHI_SQUARE = 20.0
PREFIXES = (4, 5)
STEPS, RATE, RIDGE = 200, 0.1, 5e-5
REMEMBERED = 400_000
SENTENCE = re.compile(rb"[^.!?\n]+")
#: Sentences of this probability or more are offending.
LEAST = 0.5
EDGES = b".,;:!?\"'()[]{}*#$%&|<>-_=~"


def features(word: bytes) -> list[bytes]:
    """The plain word, and its first letters marked as such."""
    plain = word.lower().strip(EDGES)
    return ([plain] if plain else []) + [plain[:n] + b"-" for n in PREFIXES if len(plain) >= n]


def _probability(z: float) -> float:
    return float(1 / (1 + np.exp(-z))) if z > -30 else 0.0


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float

    def scorer(self, least: float = LEAST) -> Callable[[bytes], tuple[float, int, int, float, list[tuple[int, int, float]]]]:
        """Document probability; start, end (bytes) and probability of the worst sentence, then of all that reach ``least``."""
        known: dict[bytes, float] = {}

        def weight(word: bytes) -> float:
            if len(known) > REMEMBERED:
                known.clear()
            known[word] = found = sum(self.weights.get(f, 0.0) for f in features(word))
            return found

        def work(text: bytes) -> tuple[float, int, int, float, list[tuple[int, int, float]]]:
            none_toxic, worst, place, offending = 0.0, -np.inf, (0, 0), []
            for m in SENTENCE.finditer(text):
                words = set(m.group().split())
                if not words:
                    continue
                z = self.bias
                for w in words:
                    found = known.get(w)
                    z += weight(w) if found is None else found
                none_toxic -= float(np.logaddexp(0, z)) if z > -30 else 0.0
                if z > worst:
                    worst, place = z, m.span()
                probability = _probability(z)
                if probability >= least:
                    offending.append((*m.span(), probability))
            return -float(np.expm1(none_toxic)), *place, _probability(worst), offending

        return work


def _telling(with_: np.ndarray, without: np.ndarray, positives: int, negatives: int) -> np.ndarray:
    """Whether each feature, in so many texts of either label, occurs often enough and depends on the label."""
    total, n = with_ + without, positives + negatives
    gap = with_ * negatives - without * positives
    rest = np.maximum(total * (n - total) * (negatives * positives), 1)
    return (total >= LEAST_DOCS) & (n * gap * gap / rest >= LEAST_CHI_SQUARE)


def fit(sample: list[tuple[bytes, int]]) -> Model:
    """Adam on the noisy-or likelihood of the document labels, both labels weighing the same."""
    y = np.array([label for _, label in sample], np.float64)
    if len(set(y)) < 2:
        return Model({}, -30.0)
    number: dict[bytes, int] = {}
    rows, columns, owners = array("i"), array("i"), array("i")
    for text_number, (text, _) in enumerate(sample):
        for m in SENTENCE.finditer(text):
            own = {number.setdefault(f, len(number)) for w in set(m.group().split()) for f in features(w)}
            if own:
                rows.extend([len(owners)] * len(own))
                columns.extend(own)
                owners.append(text_number)
    owner, row, word = (np.array(values, np.int64) for values in (owners, rows, columns))
    once = np.unique(owner[row] * len(number) + word)
    labels, feature = y[once // len(number)], once % len(number)
    counts = [np.bincount(feature[labels == k], minlength=len(number)).astype(np.float64) for k in (1, 0)]
    kept = _telling(*counts, int(y.sum()), int(len(y) - y.sum()))
    place = np.cumsum(kept) - 1
    chosen = kept[word]
    row, word = row[chosen], place[word[chosen]]
    index = {f: int(place[k]) for f, k in number.items() if kept[k]}
    sentences = len(owner)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    params = np.zeros(len(index) + 1)
    params[-1] = -4.0
    m, v = np.zeros_like(params), np.zeros_like(params)
    for turn in range(1, STEPS + 1):
        z = params[-1] + np.bincount(row, params[word], sentences)
        # Minus the log probability that no sentence of the document is toxic.
        calm = np.bincount(owner, np.logaddexp(0, z), len(y))
        pull = np.where(y == 1, -1 / np.maximum(np.expm1(np.minimum(calm, 50)), 1e-9), 1.0) * weight
        back = pull[owner] / (1 + np.exp(-z))
        grad = np.append(np.bincount(word, back[row], len(index)) + RIDGE * params[:-1], back.sum())
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        params -= RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return Model({w: float(params[k]) for w, k in index.items()}, float(params[-1]))


FIELDS = [
    T.StructField("score", T.DoubleType()),
    T.StructField("worst_start", T.LongType()),
    T.StructField("worst_end", T.LongType()),
    T.StructField("worst_score", T.DoubleType()),
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())),
    T.StructField("scores", T.ArrayType(T.DoubleType())),
]


def _code_points(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Places in code points of spans in bytes, which are in order and do not overlap."""
    found, at, count = [], 0, 0
    for start, end in spans:
        first = count + len(text[at:start].decode("utf-8", "replace"))
        at, count = end, first + len(text[start:end].decode("utf-8", "replace"))
        found.append((first, count))
    return found


def score(docs: DataFrame, model: Model, column: str = "text", least: float = LEAST) -> DataFrame:
    """The documents with a struct: score, place (code points) and score of the worst sentence, then of all that reach ``least``."""

    def compute() -> Callable[[list[bytes]], list[list]]:
        work_on = model.scorer(least)

        def work(texts: list[bytes]) -> list[list]:
            found: list[list] = [[] for _ in FIELDS]
            for text in texts:
                total, start, end, worst, offending = work_on(text)
                [(before, after)] = _code_points(text, [(start, end)])
                places = _code_points(text, [o[:2] for o in offending])
                values_ = (total, before, after, worst, [p[0] for p in places], [p[1] for p in places], [o[2] for o in offending])
                for values, value in zip(found, values_):
                    values.append(value)
            return found

        return work

    return with_text_columns(docs, FIELDS, compute, column)


def offending_sentences(docs: DataFrame, model: Model, least: float = LEAST, column: str = "text") -> DataFrame:
    """A row per sentence that scores ``least`` or more: the document, with the sentence's place, score and ``sentence``."""
    scored = score(docs, model, column, least)
    found, one = scored.columns[-1], free_name(scored.columns, "_one")
    each = scored.withColumn(
        one, F.explode(F.arrays_zip(*(F.col(f"{found}.{c}").alias(c) for c in ("starts", "ends", "scores"))))
    )
    start, end = F.col(f"{one}.starts"), F.col(f"{one}.ends")
    cut = F.substring(F.col(column).cast("string"), (start + 1).cast("int"), (end - start).cast("int"))
    shown = F.col(found).dropFields("starts", "ends", "scores")
    for name, value in (("start", start), ("end", end), ("sentence_score", F.col(f"{one}.scores")), ("sentence", cut)):
        shown = shown.withField(name, value)
    return each.withColumn(found, shown).drop(one)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, PER_CLASS))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (crc_fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        F.col("_found.score").alias("score"),
        F.when(F.col("_found.score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
        F.col("_found.worst_start").alias("worst_start"),
        F.col("_found.worst_end").alias("worst_end"),
    )
