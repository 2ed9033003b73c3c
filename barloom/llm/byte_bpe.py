"""Byte-level BPE: texts to token ids with character offsets, and ids back to bytes and text.

The tokenizers library does the merging, on Arrow batches. Its vocabulary is spelt in characters that stand for bytes
(the byte table), so ranks over bytes are respelt once, on the driver, and tasks load the finished tokenizer.
"""

from __future__ import annotations

import base64
import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import bounded_batches, refuse_names, slices

#: Words, and matches of the pattern in them, whose tokens a Python worker remembers: so many, and as many used before
#: those. About 200 bytes each, and a worker that waits for its next task keeps them.
WORDS, MATCHES = 50_000, 250_000

#: A cut before a blank that a non-blank follows never divides a match of the splitting pattern.
_CUT = re.compile(r"(?= \S)")
_ODD_BLANK = re.compile(r" (?:\s|$)")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b if b in set(plain) else next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens that merging by ranks below the token's own leaves of it."""
    parts, limit = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        best, at = min((ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if best >= limit:
            raise ValueError(f"token {limit} cannot be reached by merges")
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


def tokenizer_json(ranks: dict[bytes, int], pattern: str) -> str:
    """A tokenizers definition that merges by ``ranks`` within each match of ``pattern``; no special tokens."""
    letters = byte_characters()
    spell = {b: "".join(letters[x] for x in b) for b in ranks}
    merges = [last_merge(b, ranks) for b in sorted(ranks, key=ranks.__getitem__) if len(b) > 1]
    own_split = {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False}
    to_bytes = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
    model = {
        "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
        "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
        "vocab": {spell[b]: r for b, r in ranks.items()}, "merges": [[spell[a], spell[b]] for a, b in merges],
    }
    return json.dumps(
        {"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
         "pre_tokenizer": {"type": "Sequence", "pretokenizers": [own_split, to_bytes]},
         "post_processor": None, "decoder": None, "model": model}
    )


class Remembered:
    """A bounded dictionary: a full generation of keys becomes the older one, and what is used of it is kept on."""

    def __init__(self, most: int):
        self.most, self.now, self.before = most, {}, {}

    def missing(self, keys: set[str]) -> list[str]:
        """Those of ``keys`` that are not remembered; all others are in ``now`` afterwards."""
        if len(self.now) + len(keys) > self.most:
            self.now, self.before = {}, self.now
        new = []
        for key in keys.difference(self.now):
            if (value := self.before.get(key)) is None:
                new.append(key)
            else:
                self.now[key] = value
        return new


class Codec:
    """Encodes and decodes in a task. Tokens of words, and of matches of the pattern in them, seen before are looked up."""

    def __init__(self, definition: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        of_letter = {c: b for b, c in enumerate(byte_characters())}
        vocab = self.tokenizer.get_vocab()
        spelt = {i: bytes(map(of_letter.__getitem__, t)) for t, i in vocab.items()}
        table = [spelt.get(i, b"") for i in range(max(spelt) + 1)]
        self.known = np.array([i in spelt for i in range(len(table))])
        self.sizes = np.array([len(t) for t in table], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.seen, self.matches = Remembered(WORDS), Remembered(MATCHES)
        self.pattern = regex.compile(pattern)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Texts are cut into words where no token can lie across the cut."""
        words = [self.words(t) for t in texts]
        new = self.seen.missing(set().union(*words))
        parts = list(map(self.pattern.findall, new))
        fresh = self.matches.missing(set().union(*parts))
        found = self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)
        known = self.matches.now
        known.update(zip(fresh, (array("i", e.ids).tobytes() for e in found), strict=True))
        self.seen.now.update((w, b"".join(map(known.__getitem__, p))) for w, p in zip(new, parts, strict=True))
        known = self.seen.now
        return [np.frombuffer(b"".join(map(known.__getitem__, w)), np.int32) for w in words]

    @staticmethod
    def words(text: str) -> list[str]:
        if _ODD_BLANK.search(text):
            return _CUT.split(text)
        first, *rest = text.split(" ")
        return [first, *map(" ".__add__, rest)]

    def to_bytes(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, put together. An id outside of the vocabulary raises."""
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.known) and self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(total)]

    def offsets(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last character of each token; tokens that share a split character both cover it."""
        ends = np.cumsum(self.sizes[ids])
        character = np.cumsum((self.to_bytes(ids) & 0xC0) != 0x80) - 1
        return character[ends - self.sizes[ids]], character[ends - 1] + 1


@lru_cache(maxsize=2)
def codec(definition: str, pattern: str) -> Codec:
    return Codec(definition, pattern)


class ByteBPE:
    """The operator over DataFrames. ``rank_path`` is read on the driver only."""

    def __init__(self, spark, rank_path: str, pattern: str):
        # one vocabulary, of a size that does not depend on the data
        self.definition = spark.sparkContext.broadcast((tokenizer_json(read_ranks(rank_path), pattern), pattern))

    def encode(self, docs: DataFrame, text: str = "text", into: str = "ids", offsets: bool = False) -> DataFrame:
        """``docs`` with the ids in a column ``into`` (array of int), or with ``offsets`` a struct of ids, starts, ends.

        Offsets count characters. Every row stays; a null or empty text has no tokens. A column that is there already is
        not replaced: its name is refused.
        """
        refuse_names(docs, into)
        definition = self.definition
        kind = "struct<ids:array<int>, starts:array<int>, ends:array<int>>" if offsets else "array<int>"

        @F.arrow_udf(kind)
        def encoded(column: pa.Array) -> pa.Array:
            own = codec(*definition.value)
            parts = [x for some in slices(column) for x in own.encode(some)]
            ids = _lists(parts)
            if not offsets:
                return ids
            spans = [own.offsets(x) for x in parts]
            starts, ends = _lists([s for s, _ in spans]), _lists([e for _, e in spans])
            return pa.StructArray.from_arrays([ids, starts, ends], ["ids", "starts", "ends"])

        return bounded_batches(docs).withColumn(into, encoded(F.col(f"`{text}`")))

    def round_trip(self, docs: DataFrame, text: str = "text", into: str = "tokens") -> DataFrame:
        """``docs`` with a struct ``into`` of the ids and the bytes they decode to, as :meth:`encode` and :meth:`decode`.

        Both in one Python worker: two steps would run, and hold the vocabulary, in two workers for each core.
        """
        refuse_names(docs, into)
        definition = self.definition

        @F.arrow_udf("struct<ids:array<int>, decoded:binary>")
        def there_and_back(column: pa.Array) -> pa.Array:
            own = codec(*definition.value)
            parts = [x for some in slices(column) for x in own.encode(some)]
            decoded = pa.array([own.to_bytes(x).tobytes() for x in parts], pa.binary())
            return pa.StructArray.from_arrays([_lists(parts), decoded], ["ids", "decoded"])

        return bounded_batches(docs).withColumn(into, there_and_back(F.col(f"`{text}`")))

    def decode(self, tokens: DataFrame, ids: str = "ids", into: str = "decoded", as_text: bool = False) -> DataFrame:
        """``tokens`` with the decoded bytes in a binary column ``into``, or with ``as_text`` their text.

        Ids that end within a character give its bytes, and in a text a replacement character. Null ids decode to
        nothing; an id outside of the vocabulary fails the job.
        """
        refuse_names(tokens, into)
        definition = self.definition

        @F.arrow_udf("string" if as_text else "binary")
        def decoded(column: pa.Array) -> pa.Array:
            own, out = codec(*definition.value), []
            for k in range(len(column)):
                row = column[k].values
                out.append(own.to_bytes(row.to_numpy(zero_copy_only=False)).tobytes() if row is not None else b"")
            if as_text:
                return pa.array([data.decode("utf-8", "replace") for data in out], pa.string())
            return pa.array(out, pa.binary())

        return bounded_batches(tokens).withColumn(into, decoded(F.col(f"`{ids}`")))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    values = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))


def token_digests(bpe: ByteBPE, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  keep_ids: bool = False) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256), one for each row of ``docs``: a check of a round trip.

    ``keep_ids``: the ids come along as a column ``ids``.
    """
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    both = bpe.round_trip(texts).select("doc_id", "tokens.*")
    return both.select(
        "doc_id",
        *(["ids"] if keep_ids else []),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
