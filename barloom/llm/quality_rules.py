"""Quality rules on whole texts: counts of words, symbols and repeats, and bands of the zstandard ratio.

Text that repeats itself compresses too well, noise hardly at all. The ratio (compressed bytes over bytes) also
depends on the length, so each length has its own limits; they hold for the whole document and for its fixed chunks,
of which only a small share may fail.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import BLANK, bounded_batches, refuse_names, texts

SYMBOLS = b"#*$%&|<>"


class Band(NamedTuple):
    """Limits of the ratio for texts of at least so many bytes."""

    least_bytes: int
    low: float
    high: float


@dataclass(frozen=True)
class CompressionBands:
    """Settings. ``bands`` ascend by length and begin at 0; texts too short to tell have no limits.

    A document fails when its own ratio leaves its band, or when over ``bad_chunks`` of its chunks leave theirs.
    """

    bands: tuple[Band, ...] = (
        Band(0, 0.0, float("inf")),
        Band(100, 0.40, 1.10),
        Band(256, 0.38, 0.95),
        Band(512, 0.34, 0.85),
        Band(1024, 0.30, 0.80),
        Band(2048, 0.26, 0.75),
        Band(8192, 0.20, 0.70),
    )
    chunk_bytes: int = 4096
    bad_chunks: float = 0.25
    level: int = 3

    def fits(self, size: int, ratio: float) -> bool:
        band = self.bands[bisect_right(self.bands, size, key=lambda b: b.least_bytes) - 1]
        return band.low <= ratio <= band.high


MEASURES = (
    "struct<n_words:bigint, word_chars:bigint, n_symbols:bigint, n_dup_lines:bigint, n_repeat_words:bigint, "
    "n_bytes:bigint, ratio:double, n_chunks:bigint, n_bad_chunks:bigint, in_band:boolean>"
)
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "ratio", "n_chunks",
          "n_bad_chunks", "in_band")


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words that lie in a window of ``width`` words found twice or more, its first place included."""
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, upto = Counter(windows), 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + width - max(at, upto)
            upto = at + width
    return covered


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def measure(text: str, settings: CompressionBands, compressor: zstandard.ZstdCompressor) -> tuple:
    """The fields of :data:`MEASURES` for one text."""
    data = text.encode()
    words = data.split()
    blanks = len(data) - len(data.translate(None, BLANK))
    size, step = len(data), settings.chunk_bytes

    def ratio(piece: bytes) -> float:
        return len(compressor.compress(piece)) / len(piece)

    whole = ratio(data) if data else 0.0
    chunks = [data[i : i + step] for i in range(0, size, step)] if size > step else []
    bad = sum(not settings.fits(len(c), ratio(c)) for c in chunks)
    fits = settings.fits(size, whole) and bad <= settings.bad_chunks * len(chunks)
    return (len(words), len(text) - blanks, size - len(data.translate(None, SYMBOLS)), repeated_lines(text),
            repeated_words(words), size, whole, len(chunks), bad, fits)


def quality_measures(docs: DataFrame, text: str = "text", into: str = "quality_measures",
                     settings: CompressionBands = CompressionBands()) -> DataFrame:
    """``docs`` with a struct column ``into`` of :data:`MEASURES`; one pass, no shuffle.

    Every row stays, repeated rows too. A null or empty text has zero of everything and ratio 0; ``in_band`` is then
    true, as a text without words is for the word counts to judge.
    """

    refuse_names(docs, into)

    @F.arrow_udf(MEASURES)
    def measured(column: pa.Array) -> pa.Array:
        compressor = zstandard.ZstdCompressor(level=settings.level)
        rows = [measure(t, settings, compressor) for t in texts(column)]
        kinds = [pa.int64()] * 6 + [pa.float64()] + [pa.int64()] * 2 + [pa.bool_()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(FIELDS)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], FIELDS)

    return bounded_batches(docs).withColumn(into, measured(F.col(f"`{text}`")))


def with_verdict(docs: DataFrame, into: str = "quality_measures", least_words: int = 10,
                 repeat_percent: int = 20) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to the struct: too few words, too many repeated ones, or out of band."""
    m = F.col(into)
    failed = (m.n_words < least_words) | (100 * m.n_repeat_words > repeat_percent * m.n_words)
    return docs.withColumn(into, m.withField("base_failed", failed).withField("kept", ~failed & m.in_band))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes, with the columns of ``docs`` and no others."""
    own = "__llm_quality"
    judged = with_verdict(quality_measures(docs, text, own), own)
    return judged.filter(F.col(own).kept).select(*[F.col(f"`{c}`") for c in docs.columns])
