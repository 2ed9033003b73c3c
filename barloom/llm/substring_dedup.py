"""Repeated passages: texts cut where their own content says so, and the pieces compared by digest.

A gear hash rolls over the bytes; where it is low a piece ends. Such cuts depend on the 16 bytes before them alone, so a
passage is cut alike wherever it stands, and what is inserted before it changes no piece but the first. Pieces are
counted under a 128-bit digest; runs of neighbouring pieces that stand somewhere before are repeated passages.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import bounded_batches, texts, written


@dataclass(frozen=True)
class Chunking:
    """Settings: least and most bytes of a piece, one byte in ``spacing`` may end a piece, and the words that a run of
    repeated pieces holds at least to count as a passage (of which up to a piece is lost at either end)."""

    least: int = 16
    most: int = 512
    spacing: int = 24
    words: int = 16


#: A random number for each byte value.
GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) & 0xFFFF for b in range(256)], np.uint16)
_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))


def gear(data: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash after each byte: h = 2h + GEAR[byte]. Sums of 1, 2, 4, 8, then 16 bytes, not byte by byte."""
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        h[width:] += h[:-width] << np.uint16(width)
    return h


def cuts(data: np.ndarray, settings: Chunking) -> list[int]:
    """Ends of the pieces: the first low hash after ``least`` bytes, or after ``most`` bytes without one."""
    low = (np.flatnonzero(gear(data) < 65536 // settings.spacing) + 1).tolist()
    ends, at, size = [], 0, len(data)
    while at < size:
        k = bisect_left(low, at + settings.least)
        at = min(low[k] if k < len(low) else size, at + settings.most, size)
        ends.append(at)
    return ends


PIECES = "struct<high:array<bigint>, low:array<bigint>, start:array<int>, stop:array<int>, words:array<int>>"


def pieces(text: str, settings: Chunking) -> tuple[np.ndarray, ...]:
    """Digest halves, first and past-the-last character, and beginnings of words of each piece."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    ends = cuts(data, settings)
    stops = np.array(ends)
    starts = np.concatenate([[0], stops[:-1]])
    digest = b"".join(xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip([0, *ends], ends, strict=False))
    halves = np.frombuffer(digest, ">i8").reshape(-1, 2)
    character = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    blank = _BLANK[data]
    begins = ~blank
    begins[1:] &= blank[:-1]
    word = np.concatenate([[0], np.cumsum(begins)])
    return halves[:, 0], halves[:, 1], character[starts], character[stops], word[stops] - word[starts]


def chunked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Chunking = Chunking()) -> DataFrame:
    """Rows (doc_id, high, low, start, stop, words), one for each piece of each text."""

    @F.arrow_udf(PIECES)
    def cut(column: pa.Array) -> pa.Array:
        rows = [pieces(t, settings) for t in texts(column)]
        bounds = pa.array(np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])]).astype(np.int32))
        columns = []
        for k, kind in enumerate((np.int64, np.int64, np.int32, np.int32, np.int32)):
            flat = np.concatenate([r[k] for r in rows]) if rows else np.zeros(0)
            columns.append(pa.ListArray.from_arrays(bounds, pa.array(flat.astype(kind))))
        return pa.StructArray.from_arrays(columns, ["high", "low", "start", "stop", "words"])

    ids = bounded_batches(docs).select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).filter("doc_id IS NOT NULL")
    cut_up = ids.select("doc_id", cut("text").alias("p"))
    return cut_up.select("doc_id", F.explode(F.arrays_zip(*[F.col(f"p.{c}").alias(c) for c in ("high", "low", "start", "stop", "words")])).alias("c")).select("doc_id", "c.*")


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      settings: Chunking = Chunking()) -> DataFrame:
    """Rows (doc_id, start, stop, n_words, first_doc_id, first_start): passages that stand somewhere before.

    Occurrences are ordered by id, then by place, so a passage that a document repeats further down is found in it, and
    one that a document with a smaller id has too. ``start`` and ``stop`` are characters; ``first_doc_id`` and
    ``first_start`` tell where the longest piece of the passage stands first.
    Documents without such a passage, null and empty texts have no row; rows of one id are one document, so they do not
    repeat each other; rows without an id are not looked at. Other columns, whatever their names, do not matter.
    Texts are cut up once, into a written table. Hot pieces are counted before they are shuffled, and met again in a
    join whose large partitions Spark splits.
    """
    each = written(chunked(docs, doc_id, text, settings), "pieces")
    place = F.struct("doc_id", "start")
    shared = each.groupBy("high", "low").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    again = each.join(shared, ["high", "low"]).filter(F.col("first") < place)
    again = again.select("doc_id", "start", "stop", "words", F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start"))
    again = again.repartition("doc_id").distinct()  # one shuffle, for what follows too
    in_text = Window.partitionBy("doc_id").orderBy("start", "stop")
    begins = again.withColumn("begins", F.coalesce(F.col("start") > F.max("stop").over(in_text.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)))
    run = begins.withColumn("run", F.sum(F.col("begins").cast("int")).over(in_text))
    return (
        run.groupBy("doc_id", "run")
        .agg(
            F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("words").alias("n_words"),
            F.max_by(F.struct("first_doc_id", "first_start"), F.struct(F.col("stop") - F.col("start"), -F.col("start"))).alias("first"),
        )
        .filter(F.col("n_words") >= settings.words)
        .select("doc_id", "start", "stop", "n_words", "first.*")
    )


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Chunking = Chunking()) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; the first place of each keeps it. Every row stays."""
    spans = repeated_passages(docs, doc_id, text, settings).groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("__llm_spans"))

    @F.arrow_udf("string")
    def without(column: pa.Array, gone: pa.Array) -> pa.Array:
        out = []
        for t, spans in zip(column.to_pylist(), gone.to_pylist(), strict=True):
            for span in sorted(spans or [], key=lambda s: -s["start"]) if t is not None else []:
                t = t[: span["start"]] + t[span["stop"] :]
            out.append(t)
        return pa.array(out, pa.string())

    met = bounded_batches(docs).join(spans.withColumnRenamed("doc_id", "__llm_id"), F.col(f"`{doc_id}`") == F.col("__llm_id"), "left")
    cut = without(F.col(f"`{text}`"), F.col("__llm_spans"))
    return met.select(*[cut.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
