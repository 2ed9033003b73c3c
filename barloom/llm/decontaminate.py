"""Benchmark decontamination: passages of benchmark items found in documents, a few edits allowed.

Items are cut into pieces. By the q-gram lemma a piece of m characters that occurs with k edits or fewer shares
m + 1 - q(k + 1) of its q-grams with the text, and these lie within k neighbouring diagonals (place in the text less
place in the piece). So shared q-grams are counted in overlapping bands of diagonals, each wide enough to hold all of a
match; bands that reach the bound are verified by an alignment within the band. Nothing that matches is missed.

A block of items is sent to all tasks and every document is looked at where it lies; more items make more blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import bounded_batches, texts

FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class PassageSearch:
    """Settings. ``piece`` and ``stride``: characters of a piece and between pieces; a passage of both together always
    holds a whole piece. ``rate``: edits allowed for each character of a piece. Items with under ``least`` characters
    hold no passage. ``step``: diagonals from one band to the next. ``block``: characters of items in a block.
    """

    q: int = 12
    piece: int = 100
    stride: int = 50
    rate: float = 0.05
    least: int = 25
    step: int = 16
    block: int = 4_000_000

    def edits(self, length: int) -> int:
        """Edits allowed, and no more than leave the lemma a q-gram to count."""
        return max(0, min(int(self.rate * length), length // self.q - 1))


_SPACES = np.zeros(0x3002, bool)
_SPACES[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = True


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points, lower-cased and each run of white space one blank; and the place of each in ``text``."""
    low = text.lower()
    if len(low) != len(text):  # a few letters lower to two
        low = "".join(x if len(x) == 1 else c for c in text for x in [c.lower()])
    points = np.frombuffer(low.encode("utf-32-le"), np.uint32)
    blank = _SPACES[np.minimum(points, 0x3001)]
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    at = np.flatnonzero(keep)
    return np.where(blank[at], np.uint32(32), points[at]), at


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the ``q`` characters from each place on, by doubling."""
    n = len(points) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    doubled, width = (points.astype(np.uint64) + np.uint64(1)) * FACTOR, 1
    out, done, rest = None, 0, q
    while rest:
        if rest & 1:
            part = doubled[done : done + n]
            out = part.copy() if out is None else (out ^ (out >> np.uint64(29))) * FACTOR + part
            done += width
        rest >>= 1
        if rest:
            doubled = (doubled[:-width] ^ (doubled[:-width] >> np.uint64(31))) * FACTOR + doubled[width:]
            width *= 2
    return out


class Pieces:
    """A block of items made ready for search."""

    def __init__(self, items: list[tuple], settings: PassageSearch):
        s = self.settings = settings
        self.texts, self.item = [], []
        for k, (_, text) in enumerate(items):
            points, _ = normalised(text or "")
            if len(points) and points[0] == 32:
                points = points[1:]
            if len(points) and points[-1] == 32:
                points = points[:-1]
            if len(points) < s.least:
                continue
            last = max(0, len(points) - s.piece)
            for start in sorted({*range(0, last, s.stride), last}):
                self.texts.append(points[start : start + s.piece])
                self.item.append(k)
        self.ids = [i for i, _ in items]
        self.size = np.array([len(p) for p in self.texts], np.int64)
        self.edits = np.array([s.edits(n) for n in self.size], np.int64)
        self.bound = self.size + 1 - s.q * (self.edits + 1)
        hashes = [gram_hashes(p, s.q) for p in self.texts]
        own = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, np.int64)
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.piece, self.place = own[order], place[order]
        self.grams, self.first, self.many = np.unique(flat[order], return_index=True, return_counts=True)
        bits = min(26, max(16, int(np.ceil(np.log2(16 * len(self.grams) + 1)))))
        self.shift = np.uint64(64 - bits)
        self.sieve = np.zeros(1 << bits, bool)
        self.sieve[self.grams >> self.shift] = True
        self.widest = int(self.edits.max()) if len(self.edits) else 0

    def bands(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece, band) of the bands of diagonals with as many shared q-grams as the lemma asks for."""
        s, hashes = self.settings, gram_hashes(points, self.settings.q)
        at = np.flatnonzero(self.sieve[hashes >> self.shift])
        if not len(at):
            return at, at
        found = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
        hit = self.grams[found] == hashes[at]
        at, found = at[hit], found[hit]
        keys: list[np.ndarray] = []
        many = self.many[found]
        ends = np.cumsum(many)
        start = 0
        while start < len(at):  # some million pairs at a time
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + 2_000_000)))
            n = many[start:stop]
            own = np.repeat(np.arange(start, stop), n)
            k = self.first[found[own]] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            piece = self.piece[k]
            diagonal = at[own] - self.place[k] + self.settings.piece  # never negative
            band = diagonal // s.step
            both = diagonal - band * s.step < self.edits[piece]
            keys.append(np.concatenate([piece << 32 | band, (piece << 32 | band - 1)[both & (band > 0)]]))
            start = stop
        key, count = np.unique(np.concatenate(keys), return_counts=True) if keys else (at, at)
        piece = key >> 32
        enough = count >= self.bound[piece]
        return piece[enough], key[enough] & 0xFFFFFFFF

    def align(self, points: np.ndarray, piece: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each piece within its band, and where in ``points`` that alignment ends."""
        s = self.settings
        width, rows = s.step + self.widest, int(self.size[piece].max())
        lowest = band * s.step - s.piece
        padded = np.concatenate([np.zeros(s.piece + 1, np.uint32), points, np.zeros(2 * s.piece + width, np.uint32)])
        letters = np.zeros((len(piece), rows), np.uint32)
        for r, p in enumerate(piece):
            letters[r, : self.size[p]] = self.texts[p]
        slope = np.arange(width)
        cost = np.zeros((len(piece), width), np.int64)
        best, end = np.full(len(piece), 1 << 30), np.zeros(len(piece), np.int64)
        for i in range(rows):
            text = padded[(lowest + i + s.piece + 1)[:, None] + slope]
            down = np.full_like(cost, 1 << 30)
            down[:, :-1] = cost[:, 1:] + 1
            cost = np.minimum(cost + (text != letters[:, i : i + 1]), down)
            cost = np.minimum.accumulate(cost - slope, axis=1) + slope
            done = self.size[piece] == i + 1
            if done.any():
                d = cost[done].argmin(1)
                best[done], end[done] = cost[done].min(1), lowest[done] + i + 1 + d
        return best, end

    def search(self, text: str) -> Iterator[tuple]:
        """(item, pieces found, least edits, start, end) for each item; places are characters of ``text``."""
        points, origin = normalised(text)
        piece, band = self.bands(points)
        if not len(piece):
            return
        of_item: dict[int, list] = {}
        for at in range(0, len(piece), 1024):
            some = piece[at : at + 1024]
            edits, end = self.align(points, some, band[at : at + 1024])
            for p, e, x in zip(some.tolist(), edits.tolist(), end.tolist(), strict=True):
                if e <= self.edits[p]:
                    stop = min(max(x, 1), len(points))
                    of_item.setdefault(self.item[p], []).append((p, e, max(0, stop - int(self.size[p])), stop))
        for item, found in of_item.items():
            first, last = min(f[2] for f in found), max(f[3] for f in found)
            yield item, len({f[0] for f in found}), min(f[1] for f in found), int(origin[first]), int(origin[last - 1]) + 1


def blocks(items: DataFrame, item_id: str, text: str, size: int) -> Iterator[list[tuple]]:
    """The items, so many that a block stays under ``size`` characters or is one item."""
    block, held = [], 0
    for row in items.select(F.col(f"`{item_id}`"), F.col(f"`{text}`")).toLocalIterator():
        chars = len(row[1] or "")
        if block and held + chars > size:
            yield block
            block, held = [], 0
        block.append((row[0], row[1]))
        held += chars
    yield block


MATCH = pa.struct(
    [("item", pa.int32()), ("n_pieces", pa.int32()), ("edits", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
)


def finder(sent: Broadcast, settings: PassageSearch):
    """A function of a text column: the matches of the items that were sent."""

    @F.arrow_udf("array<struct<item:int, n_pieces:int, edits:int, start:bigint, end:bigint>>")
    def found(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces, names = Pieces(sent.value, settings), [f.name for f in MATCH]
        for column in columns:
            rows = [[dict(zip(names, x, strict=True)) for x in pieces.search(t)] for t in texts(column)]
            yield pa.array(rows, pa.list_(MATCH))

    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text",
                 settings: PassageSearch = PassageSearch()) -> DataFrame:
    """Rows (doc_id, item_id, n_pieces, edits, start, end): the items of which a document holds a passage.

    ``start`` and ``end`` are characters of the document's text, ``edits`` those of the best piece. A row for each row
    of ``docs`` and item; documents without a passage, and null or empty texts, have none. Null ids are carried, null or
    short items match nothing, items of equal text all match. Other columns, whatever their names, are not looked at.
    """
    spark = docs.sparkSession
    narrow = bounded_batches(docs).select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = benchmark.schema[item_id].dataType
    out = None
    for block in blocks(benchmark, item_id, item_text, settings.block):
        sent = spark.sparkContext.broadcast(block)  # settings.block characters at most, or one item

        ids = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], f"item int, item_id {kind.simpleString()}")
        hits = narrow.withColumn("found", finder(sent, settings)(F.col("text"))).filter(F.size("found") > 0).select("doc_id", F.explode("found").alias("x"))
        part = hits.select("doc_id", "x.*").join(F.broadcast(ids), "item").drop("item")
        out = part if out is None else out.unionAll(part)
    return out.select("doc_id", "item_id", "n_pieces", "edits", "start", "end")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                      item_text: str = "text", settings: PassageSearch = PassageSearch()) -> DataFrame:
    """The rows of ``docs`` that hold no passage of any item, with the columns of ``docs``; no shuffle."""
    spark, own, out = docs.sparkSession, [F.col(f"`{c}`") for c in docs.columns], bounded_batches(docs)
    for block in blocks(benchmark, item_id, item_text, settings.block):
        sent = spark.sparkContext.broadcast(block)  # settings.block characters at most, or one item

        out = out.filter(F.size(finder(sent, settings)(F.col(f"`{text}`"))) == 0).select(*own)
    return out
