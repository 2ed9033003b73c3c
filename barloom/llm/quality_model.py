"""Quality: a factorisation machine on hashed words, statistics of the text's structure, and metadata.

Score = bias + linear terms + all pairwise products, weighted by inner products of low-rank factors. The pairs cost
linear time: for each factor, half of (sum of v x) squared less the sum of (v x) squared.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import bounded_batches, refuse_names, slices
from barloom.llm.training import blocked, fit, sigmoid, with_labels


@dataclass(frozen=True)
class Machine:
    """Settings. ``most_rows``: about how many labelled rows are learned from; training costs the same on tables of any
    size. ``bits``: of the hash of words and metadata. ``steps``: buckets of each statistic."""

    bits: int = 16
    factors: int = 4
    steps: int = 12
    most_rows: int = 10_000
    rounds: int = 8
    rate: float = 0.1
    shrink: float = 1e-5

    @property
    def size(self) -> int:
        """Rows of the weights: hashed ones, statistics and their buckets, the bias."""
        return (1 << self.bits) + len(STATISTICS) * (1 + self.steps) + 1


STATISTICS = (
    "log words", "word length", "distinct words", "commonest word", "symbols", "capitals", "digits", "marks",
    "line length", "repeated lines", "bare lines", "long words", "two-word repeats",
)

_KIND = np.zeros((4, 256), np.float32)
_KIND[0, list(b"#*$%&|<>@^~=_+{}[]\\")] = 1
_KIND[1, ord("A") : ord("Z") + 1] = 1
_KIND[2, ord("0") : ord("9") + 1] = 1
_KIND[3, list(b".,;:!?'\"()-/")] = 1


def statistics(text: str, data: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """The :data:`STATISTICS`, each from 0 to about 1; zero for a text without words."""
    n, size = len(words), max(1, len(data))
    symbols, capitals, digits, marks = _KIND @ np.bincount(np.frombuffer(data, np.uint8), minlength=256) / size
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        min(1.0, np.log1p(n) / 10),
        min(1.0, size / max(1, n) / 20),
        len(counts) / max(1, n),
        max(counts.values(), default=0) / max(1, n),
        symbols, capitals, digits, marks,
        min(1.0, size / max(1, len(lines)) / 1000),
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        sum(x.rstrip()[-1] not in ".!?:" for x in lines) / max(1, len(lines)),
        sum(c for w, c in counts.items() if len(w) > 24) / max(1, n),
        1 - pairs / (n - 1) if n > 1 else 0.0,
    ]


def features(text: str, metadata: list[str | None], settings: Machine) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values: words (log count, scaled to length one), statistics twice over, metadata."""
    data = text.encode()
    words = data.split()
    counts = Counter(words)
    hashed, mask = 1 << settings.bits, (1 << settings.bits) - 1
    crc = zlib.crc32
    at = [crc(w) & mask for w in counts]
    values = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    values /= float(np.sqrt(np.square(values).sum())) or 1.0
    known = [f"{k}={m}" for k, m in enumerate(metadata) if m is not None]
    stats = statistics(text, data, words, counts)
    span = 1 + settings.steps
    own = [hashed + k * span for k in range(len(stats))]
    bucket = [hashed + k * span + 1 + min(settings.steps - 1, int(np.sqrt(s) * settings.steps)) for k, s in enumerate(stats)]
    rows = at + [crc(m.encode()) & mask for m in known] + own + bucket
    rest = [0.3] * len(known) + stats + [0.3] * len(bucket)
    return np.array(rows, np.int64), np.concatenate([values, np.array(rest, np.float32)]).astype(np.float32)


def raw_score(weights: np.ndarray, at: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The score before the sigmoid, each feature's v x, and their sums; linear in the features."""
    own = weights[at]
    vx = own[:, 1:] * x[:, None]
    sums = vx.sum(0)
    pairs = 0.5 * float((sums * sums).sum() - (vx * vx).sum())
    return float(weights[-1, 0] + own[:, 0] @ x + pairs), vx, sums


FEATURES = "struct<at:array<int>, x:array<float>>"


def _metadata(docs: DataFrame, metadata: dict[str, Column]) -> Column:
    return F.array(*[c.cast("string") for c in metadata.values()]) if metadata else F.lit(None).cast("array<string>")


@dataclass(frozen=True)
class QualityModel:
    settings: Machine
    weights: np.ndarray

    def scored(self, docs: DataFrame, text: str = "text", metadata: dict[str, Column] | None = None,
               into: str = "score") -> DataFrame:
        """``docs`` with the score (0 to 1, higher: label 1 likelier) of each row; null and empty texts get one too.

        ``metadata``: the same columns as in training; a null is no feature.
        """
        refuse_names(docs, into)
        sent = docs.sparkSession.sparkContext.broadcast(self)  # of a size that the settings fix

        @F.arrow_udf("double")
        def score(column: pa.Array, more: pa.Array) -> pa.Array:
            model, out, facts = sent.value, [], iter(more.to_pylist())
            for some in slices(column):
                for t in some:
                    out.append(sigmoid(raw_score(model.weights, *features(t, next(facts) or [], model.settings))[0]))
            return pa.array(out, pa.float64())

        return bounded_batches(docs).withColumn(into, score(F.col(f"`{text}`"), _metadata(docs, metadata or {})))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
          metadata: dict[str, Column] | None = None, settings: Machine = Machine()) -> QualityModel:
    """Fits on the labelled rows that are not held out; the text and ``metadata`` are all that is looked at.

    With no labelled rows every score is about one half; with one class, every score leans to it.
    """

    @F.arrow_udf(FEATURES)
    def made(column: pa.Array, more: pa.Array) -> pa.Array:
        facts = iter(more.to_pylist())
        rows = [features(t, next(facts) or [], settings) for some in slices(column) for t in some]
        at = pa.array([a.astype(np.int32) for a, _ in rows], pa.list_(pa.int32()))
        return pa.StructArray.from_arrays([at, pa.array([x for _, x in rows], pa.list_(pa.float32()))], ["at", "x"])

    known = bounded_batches(docs).select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), _metadata(docs, metadata or {}).alias("facts"))
    known = with_labels(known, labels, label, "doc_id", settings.most_rows)
    made_rows = known.select("doc_id", F.col("__llm_label").alias("label"), made("text", "facts").alias("f"))
    blocks = blocked(made_rows.select("doc_id", "label", "f.at", "f.x"), "doc_id")

    def epoch(weights: np.ndarray, rows: pa.StructArray, number: int) -> None:
        squares, rate = np.full_like(weights, 1e-2), settings.rate / (1 + 0.5 * number)
        bounds, values = rows.field("at").offsets.to_numpy(), rows.field("x").values.to_numpy()
        flat, first = rows.field("at").values.to_numpy(), rows.field("x").offsets.to_numpy()
        for k, label in enumerate(rows.field("label").to_pylist()):
            at, x = flat[bounds[k] : bounds[k + 1]], values[first[k] : first[k + 1]]
            raw, vx, sums = raw_score(weights, at, x)
            error = sigmoid(raw) - label
            step = np.empty((len(at), weights.shape[1]), np.float32)
            step[:, 0] = error * x
            step[:, 1:] = error * x[:, None] * (sums - vx)
            step += settings.shrink * weights[at]
            squares[at] += step * step
            weights[at] -= rate * step / np.sqrt(squares[at])
            squares[-1, 0] += error * error
            weights[-1, 0] -= rate * error / np.sqrt(squares[-1, 0])

    start = np.random.default_rng(5).normal(0, 0.05, (settings.size, 1 + settings.factors)).astype(np.float32)
    start[:, 0] = 0
    return QualityModel(settings, fit(blocks, start, epoch, settings.rounds))
