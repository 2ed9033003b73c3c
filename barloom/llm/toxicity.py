"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A text has an n-gram or not; each that it has weighs the log of how much commoner it is in texts of label 1, and the
weights of a text are scaled to length one. A logistic regression learns on these features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import bounded_batches, refuse_names, texts
from barloom.llm.training import blocked, fit, sigmoid, summed, with_labels

PRIME = np.uint64(0x100000001B3)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class NGrams:
    """Settings. ``most_rows``: about how many labelled rows are learned from; the model is as good as that sample, and
    training costs the same on tables of any size. ``prior``: counts that an n-gram has before any is seen."""

    sizes: tuple[int, ...] = (3, 4, 5)
    bits: int = 18
    most_rows: int = 6_000
    prior: float = 100.0
    rounds: int = 8
    rate: float = 1.0
    shrink: float = 1e-5


def features(text: str, settings: NGrams, stamp: np.ndarray) -> np.ndarray:
    """The n-grams of the lower-cased text, blanks at either end included, as distinct bucket numbers.

    ``stamp`` has a place for each bucket; what is in it does not matter.
    """
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    grams, found = points, []
    for size in range(2, max(settings.sizes) + 1):
        if len(points) < size:
            break
        grams = grams[:-1] * PRIME + points[size - 1 :]
        if size in settings.sizes:
            found.append(((grams + np.uint64(size)) * SPREAD >> np.uint64(64 - settings.bits)).astype(np.int64))
    if not found:
        return np.zeros(0, np.int64)
    each = np.concatenate(found)
    place = np.arange(len(each), dtype=np.int32)
    stamp[each] = place
    return each[stamp[each] == place]


def _examples(rows: pa.StructArray) -> Iterator[tuple[np.ndarray, int]]:
    grams = rows.field("grams")
    flat, bounds = grams.values.to_numpy(), grams.offsets.to_numpy()
    for k, label in enumerate(rows.field("label").to_pylist()):
        yield flat[bounds[k] : bounds[k + 1]], label


@dataclass(frozen=True)
class ToxicityModel:
    """``weights`` has the product of ratio and learned weight for each bucket, ``ratios`` the ratios, for the length."""

    settings: NGrams
    ratios: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, text: str, stamp: np.ndarray) -> float:
        at = features(text, self.settings, stamp)
        length = float(np.sqrt(np.square(self.ratios[at]).sum())) or 1.0
        return float(sigmoid(self.bias + self.weights[at].sum(dtype=np.float64) / length))

    def scored(self, docs: DataFrame, text: str = "text", into: str = "score") -> DataFrame:
        """``docs`` with the score (0 to 1, higher: label 1 likelier) of each row; null and empty texts get one too."""
        refuse_names(docs, into)
        sent = docs.sparkSession.sparkContext.broadcast(self)  # of 2 ** bits weights, whatever the data

        @F.arrow_udf("double")
        def score(column: pa.Array) -> pa.Array:
            model, stamp = sent.value, np.zeros(1 << self_bits, np.int32)
            return pa.array([model.score(t, stamp) for t in texts(column)], pa.float64())

        self_bits = self.settings.bits
        return bounded_batches(docs).withColumn(into, score(F.col(f"`{text}`")))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
          settings: NGrams = NGrams()) -> ToxicityModel:
    """Fits on the labelled rows that are not held out; only the text is looked at.

    With no labelled rows every score is one half; with one class, every score leans to it.
    """
    size, bits = 1 << settings.bits, settings.bits

    @F.arrow_udf("array<int>")
    def grams(column: pa.Array) -> pa.Array:
        stamp = np.zeros(1 << bits, np.int32)
        return pa.array([np.sort(features(t, settings, stamp)).astype(np.int32) for t in texts(column)], pa.list_(pa.int32()))

    known = bounded_batches(docs).select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    known = with_labels(known, labels, label, "doc_id", settings.most_rows)
    blocks = blocked(known.select("doc_id", F.col("__llm_label").alias("label"), grams("text").alias("grams")), "doc_id")

    def counts(rows: pa.StructArray) -> np.ndarray:
        out = np.zeros((2, size + 1))
        for at, y in _examples(rows):
            out[y, at] += 1
            out[y, size] += 1
        return out.ravel()

    seen = summed(blocks, counts)
    clean, toxic = (seen if seen is not None else np.zeros(2 * (size + 1))).reshape(2, -1)
    n = np.array([clean[-1], toxic[-1]])
    share = (n + 1) / (n.sum() + 2)
    ratios = np.log((toxic[:-1] + settings.prior * share[1]) / (n[1] + settings.prior * share[1]))
    ratios -= np.log((clean[:-1] + settings.prior * share[0]) / (n[0] + settings.prior * share[0]))
    ratios = ratios.astype(np.float32)
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def epoch(weights: np.ndarray, rows: pa.StructArray, number: int) -> None:
        r, squares, rate = sent.value, np.full(size + 1, 1e-2, np.float32), settings.rate / (1 + number)
        for at, y in _examples(rows):
            x = r[at]
            x = x / (float(np.sqrt(np.square(x).sum())) or 1.0)
            error = sigmoid(weights[size] + float(weights[at] @ x)) - y
            step = error * x + settings.shrink * weights[at]
            squares[at] += step * step
            weights[at] -= rate * step / np.sqrt(squares[at])
            squares[size] += error * error
            weights[size] -= rate * error / np.sqrt(squares[size])

    start = np.ones(size + 1, np.float32)
    start[size] = np.log(share[1] / share[0]) if n.sum() else 0.0
    fitted = fit(blocks, start, epoch, settings.rounds)
    return ToxicityModel(settings, ratios, ratios * fitted[:size], float(fitted[size]))
