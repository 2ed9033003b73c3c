"""Phrases whose words stand together more often than apart, mined by dynamic itemset counting.

The corpus lies in a few shards that are scanned in a cycle, one at a stop. Words are counted from the first stop on. A
longer phrase becomes active at the stop after both of its subphrases (without its last, without its first word) have
been seen ``least`` times so far, joins the scan wherever that stands, and is counted until it has met every shard once.
Lengths are so counted side by side, and what cannot be frequent is never counted, shuffled or stored.

Since when a phrase is active is read off a table of stops, by a hash of each of its subphrases: an entry holds the stop
after which the first subphrase of that entry had been seen often enough. Every task has the same table, of a fixed size
whatever the corpus, so all agree on the first stop of any phrase and on the last. A subphrase that shares its entry
makes longer phrases active that need not be; they are counted over one whole cycle too, so every count is exact.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import bounded_batches, written
from barloom.sources.workdir import delete_folder, work_folder


@dataclass(frozen=True)
class Mining:
    """Settings: how often a phrase must occur, its most words, shards of the cycle (250 in ``words`` cycles at most),
    and the bits of a place in the tables of stops (a byte for each place and length, sent to every task)."""

    least: int = 10
    words: int = 3
    shards: int = 3
    bits: int = 23


#: Stop of an entry whose subphrases are not frequent so far.
NEVER = 255
#: Bytes of texts of one language that are counted together.
CHUNK = 1 << 23

_BREAK = b"."
_NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _BREAK * 9)
_STEP, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def normal(text: str) -> bytes:
    """A-Z lower-cased, blanks as spaces, every end of a piece as a full stop."""
    return text.encode().translate(_NORMAL)


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\t" + word)


def longer(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word."""
    return (hashes ^ hashes >> np.uint64(29)) * _STEP + word


def place(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes * _SPREAD >> np.uint64(64 - bits)).astype(np.int64)


def counted(lang: str, bodies: list[bytes], stop: int, stops: list[np.ndarray], mining: Mining) -> Iterator[pa.RecordBatch]:
    """Rows (key, since, n) of the phrases that are active at this stop, in the given texts.

    The key is the language, a tab and the phrase; that of the empty phrase counts all words.
    """
    whole = (b" " + _BREAK + b" ").join(b.replace(_BREAK, b" " + _BREAK + b" ") for b in bodies)
    tokens = pc.split_pattern(pa.array([whole], pa.large_binary()), pattern=b" ").flatten().dictionary_encode()
    words, code = tokens.dictionary, tokens.indices.to_numpy()
    spelt = words.to_pylist()
    known = {w: k for k, w in enumerate(spelt) if w in (b"", _BREAK)}
    code = code[code != known.get(b"", -1)].astype(np.int64)
    inside = code != known.get(_BREAK, -1)
    if not inside.any():
        return
    prefix = lang.encode() + b"\t"
    begun = pc.binary_join_element_wise(pa.scalar(prefix, pa.large_binary()), words, pa.scalar(b"", pa.large_binary()))
    hashes = np.array([word_hash(lang, w) for w in spelt], np.uint64)

    def rows(keys: pa.Array, since: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys = keys.cast(pa.large_string())
        for start in range(0, len(n), 1 << 16):
            some = slice(start, start + (1 << 16))
            columns = keys[some].cast(pa.string()), pa.array(since[some].astype(np.int32)), pa.array(n[some].astype(np.int64))
            yield pa.RecordBatch.from_arrays(list(columns), ["key", "since", "n"])

    if stop < mining.shards:
        n = np.bincount(code[inside], minlength=len(spelt))
        at = np.flatnonzero(n)
        yield from rows(begun.take(pa.array(at)), np.zeros(len(at)), n[at])
        yield from rows(pa.array([prefix], pa.large_binary()), np.zeros(1), np.array([n.sum()]))
    width, there, of_phrase = len(spelt), inside, hashes[code]
    for length in range(2, mining.words + 1):
        # at each position the phrase of so many words that begins there: since when, by its two subphrases
        sub = np.where(there, stops[length - 2][place(of_phrase, mining.bits)], np.uint8(NEVER))
        since = np.maximum(sub[:-1], sub[1:])
        there = there[:-1] & inside[length - 1 :]
        of_phrase = longer(of_phrase[:-1], hashes[code[length - 1 :]])
        at = np.flatnonzero(there & (since <= stop) & (since + np.int64(mining.shards) > stop))
        if not len(at):
            continue
        # phrases of one word more are numbered by (number of the phrase, last word) until all words are in
        number, spellings = code[at], [np.arange(width)]
        for k in range(1, length):
            pairs = number * width + code[at + k]
            if k < length - 1:
                distinct, number = np.unique(pairs, return_inverse=True)
            else:
                distinct, n = np.unique(pairs, return_counts=True)
            spellings = [x[distinct // width] for x in spellings] + [distinct % width]
        parts = [begun.take(pa.array(spellings[0])), *(words.take(pa.array(x)) for x in spellings[1:])]
        phrase = [hashes[x] for x in spellings]
        first, last = phrase[0], phrase[1]
        for more, h in enumerate(phrase[1:-1]):
            first, last = longer(first, h), longer(last, phrase[more + 2])
        begins = np.maximum(*(stops[length - 2][place(h, mining.bits)] for h in (first, last)))
        yield from rows(pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())), begins, n)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts by language, about ``CHUNK`` bytes at a time; a longer text is cut between pieces."""
    held, size = defaultdict(list), defaultdict(int)
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            lang, body = lang.as_py(), normal(text.as_py())
            while body:
                cut = body.find(_BREAK, CHUNK) if len(body) > CHUNK else -1
                some, body = (body, b"") if cut < 0 else (body[:cut], body[cut + 1 :])
                held[lang].append(some)
                size[lang] += len(some)
                if size[lang] >= CHUNK:
                    yield lang, held.pop(lang)
                    del size[lang]
    yield from held.items()


def _fresh(often: DataFrame, mining: Mining, shared) -> DataFrame:
    """Rows (words, place) of the entries that the frequent phrases ``often`` reach for the first time."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for key in batch["key"].to_pylist():
                lang, phrase = key.rsplit("\t", 1)
                hashes = [np.array([word_hash(lang, w)], np.uint64) for w in phrase.encode().split(b" ")]
                whole = hashes[0]
                for h in hashes[1:]:
                    whole = longer(whole, h)
                at = int(place(whole, mining.bits)[0])
                if shared.value[len(hashes) - 1][at] == NEVER:
                    found.add((len(hashes), at))
            columns = zip(*sorted(found), strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in columns], ["words", "place"])

    short = often.filter(F.col("words").between(1, mining.words - 1)).select("key")
    return short.mapInArrow(places, "words int, place int").distinct()


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text", mining: Mining = Mining()) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): rows (lang, phrase, words, n) of all phrases of up to ``mining.words`` words that occur
    ``mining.least`` times or more, words too, and rows (lang, n) of all occurrences of words, if so many.

    The corpus is copied once, by shard. Open counts are one written table after each stop; the one before is deleted
    then. The tables of stops change on the driver alone, by the places that became frequent, no more than they have.
    """
    spark, shards = docs.sparkSession, mining.shards
    if not 0 < shards * mining.words < 250:
        raise ValueError("a stop is a byte: shards times words must be under 250")
    # a whole number of rows for each shard, as they come: a table that is written first does not change
    copy = work_folder(spark, "corpus")
    own = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang")
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    dealt = docs.select(own, body, F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"))
    dealt.write.partitionBy("shard").parquet(copy)
    corpus = spark.read.schema("lang string, text string, shard int").parquet(copy)
    schema, phrase = "key string, since int, n bigint", F.substring_index("key", "\t", -1)
    words = F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " ")))

    stops = [np.full(1 << mining.bits, NEVER, np.uint8) for _ in range(mining.words - 1)]
    state, before, found, stop, end = None, None, [], 0, shards
    while stop < end:
        shared = spark.sparkContext.broadcast(stops)

        def scan(batches: Iterator[pa.RecordBatch], stop=stop, shared=shared) -> Iterator[pa.RecordBatch]:
            for of, bodies in _chunks(batches):
                yield from counted(of, bodies, stop, shared.value, mining)

        seen = bounded_batches(corpus).filter(F.col("shard") == stop % shards).select("lang", "text").mapInArrow(scan, schema)
        if state is not None:
            seen = seen.unionByName(state.filter(F.col("since") > stop - shards))
        # those that began a cycle ago have met every shard now: of these only the frequent stay
        whole = F.col("since") <= stop - shards + 1
        summed = seen.groupBy("key").agg(F.max("since").alias("since"), F.sum("n").alias("n"))
        folder = work_folder(spark, "counts")
        summed.filter(~whole | (F.col("n") >= mining.least)).write.parquet(folder)
        state = spark.read.schema(schema).parquet(folder)
        if before:
            delete_folder(spark, before)
        before = folder
        often = written(state.filter(F.col("n") >= mining.least).withColumns({"words": words, "whole": whole}), "often")
        found.append(often.filter("whole").select(
            F.expr("left(key, length(key) - length(substring_index(key, '\t', -1)) - 1)").alias("lang"), phrase.alias("phrase"), "words", "n"
        ))
        fresh = _fresh(often, mining, shared).toArrow()
        for length in range(1, mining.words):
            at = fresh.filter(pc.equal(fresh["words"], length))["place"].to_numpy()
            if len(at):
                stops[length - 1][at] = stop + 1
                end = max(end, stop + 1 + shards)
        shared.unpersist()
        stop += 1
    phrases = found[0]
    for more in found[1:]:
        phrases = phrases.unionByName(more)
    phrases = written(phrases, "phrases")
    delete_folder(spark, before)
    delete_folder(spark, copy)
    return phrases.filter("words > 0"), phrases.filter("words = 0").select("lang", "n")


def exact_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in 38 digits, which is exact for counts under 10**16; raises beyond."""
    wide = "CAST(`{}` AS DECIMAL(19, 0))"
    a, left, right = wide.format(a), wide.format(left), wide.format(right)
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * {a} * {a}) div ({left} * {right})")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", top: int = 2000, share: int = 50, mining: Mining = Mining()
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and these into words at spaces and tabs.
    A phrase of 2 words or more that occurs a >= ``mining.least`` times within pieces scores the least of
    floor(1000000 * a * a / (l * r)) over its cuts into a first part that occurs l and a rest that occurs r times, the
    earliest cut of equal ones. It is left out if a longer such phrase holds it and occurs ``share`` % as often or more.
    By falling score, then a, then by the phrase's bytes. ``n`` is all words of the language.

    A null language is "und"; null and empty texts, or pieces without a word, add nothing; repeated rows count as rows,
    and ids and other columns do not matter. A language without such a phrase, or a table without rows, has no row.
    """
    phrases, totals = phrase_counts(docs, lang, text, mining)
    phrases = phrases.withColumnRenamed("n", "a")
    long = phrases.filter("words > 1")
    pieces = F.split("phrase", " ")
    cuts = long.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("first", F.array_join(F.slice(pieces, F.lit(1), F.col("cut")), " "))
    cuts = cuts.withColumn("rest", F.array_join(F.slice(pieces, F.col("cut") + 1, F.col("words") - F.col("cut")), " "))
    first = phrases.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    scored = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).withColumn("score", exact_score("a", "l", "r"))
    least = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))

    # subphrases of two words or more of each longer phrase
    size = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    sized = long.filter("words > 2").select("lang", pieces.alias("w"), "a", "words", size)
    begun = sized.withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    within = begun.select("lang", F.array_join(F.slice("w", F.col("begin"), F.col("size")), " ").alias("phrase"), "a")
    around = within.groupBy("lang", "phrase").agg(F.max("a").alias("held"))
    own = least.join(around, ["lang", "phrase"], "left").filter("held IS NULL OR 100 * held < %d * a" % share)
    order = Window.partitionBy("lang").orderBy(F.desc("low.score"), F.desc("a"), F.asc("phrase"))
    ranked = own.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "low.l", "low.r", "n", "low.score")
