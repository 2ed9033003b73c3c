"""What each filter of a chain removes, in every order of the filters, counted for all orders at once.

Which filters a document fails is a mask of a few bits, and the mask settles what happens to it at every step of every
order. So each mask has one wide integer for each kind of outcome, with a field of 64 bits for each (order, step) that
holds 1 where that outcome happens; adding up the integers of a part counts all steps in one addition, and the fields
are cut out of the sum. A field counts rows of a table, which are fewer than 2**63, so none runs over into the next.

Equal rows are counted by Spark before they are shuffled, and their integer is added that often in one multiplication: a
part sends at most four rows for each mask to the task that adds them up, however hot it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import bounded_batches, texts

#: Bytes of a field.
FIELD = 8

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOL = re.compile(r"[#$%&*|]")
TEXT_FILTERS = "ABCD"
COPY_FILTER = "E"


def text_failures(text: str) -> int:
    """Bits of the filters that a text fails: A under 50 words, B under 65 % distinct words, C over 5 % capitals, D symbols."""
    raw = text.encode()
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, _UPPER))
    return (
        (len(words) < 50)
        | (100 * len(set(words)) < 65 * len(words)) << 1
        | (100 * capitals > 5 * len(text)) << 2
        | (_SYMBOL.search(text) is not None) << 3
    )


def outcomes(order: Sequence[int], mask: int) -> Iterator[tuple[bool, bool, bool]]:
    """(kept, removed, redundant) after each step for a document of that mask."""
    gone = False
    for f in order:
        fails = bool(mask >> f & 1)
        yield not (gone or fails), fails and not gone, fails and gone
        gone |= fails


def packed(filters: int) -> list[tuple[int, int, int]]:
    """For each mask the wide integers of kept, removed and redundant; field (order, step) stands at its number."""
    table = []
    for mask in range(1 << filters):
        fields = np.array([list(outcomes(order, mask)) for order in permutations(range(filters))], f"<u{FIELD}")
        table.append(tuple(int.from_bytes(fields[:, :, kind].tobytes(), "little") for kind in range(3)))
    return table


def unpacked(total: int, fields: int) -> np.ndarray:
    """The fields of a sum; raises if it does not fit."""
    return np.frombuffer(total.to_bytes(fields * FIELD, "little"), f"<u{FIELD}").astype(np.int64)


def audit(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows (part, mask, good, toxic, n) to one row for each part, order of the filters ``names`` and step.

    Bit f of ``mask`` says that filter f fails. ``filter_order`` joins the names in their order, ``step`` counts from 1;
    the counts are kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley.
    """
    filters, table = len(names), packed(len(names))
    orders = list(permutations(range(filters)))
    fields = len(orders) * filters
    at = np.array(orders).reshape(-1)
    spelt = ["".join(names[f] for f in order) for order in orders for _ in order]
    steps = np.tile(np.arange(1, filters + 1, dtype=np.int32), len(orders))

    def summed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        kept = removed = redundant = good = toxic = 0
        unique = np.zeros(filters, np.int64)
        for mask, n, is_good, is_toxic in zip(*(group[c].tolist() for c in ("mask", "n", "good", "toxic")), strict=True):
            stays, goes, gone = table[mask]
            kept, removed, redundant = kept + n * stays, removed + n * goes, redundant + n * gone
            good, toxic = good + n * is_good * goes, toxic + n * is_toxic * goes
            if mask.bit_count() == 1:
                unique[mask.bit_length() - 1] += n
        lost = unpacked(removed, fields)
        return pd.DataFrame({
            "part": key[0], "filter_order": spelt, "step": steps, "kept": unpacked(kept, fields), "removed": lost,
            "redundant": unpacked(redundant, fields), "unique_fails": unique[at], "good_lost": unpacked(good, fields),
            "toxic_lost": unpacked(toxic, fields), "shapley": np.array([lost[at == f].sum() for f in range(filters)])[at],
        })

    counted = ", ".join(f"{c} bigint" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    whole = counts.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    return whole.groupBy("part").applyInPandas(summed, f"part string, filter_order string, step int, {counted}")


def failing_masks(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, part: str) -> DataFrame:
    """Rows (part, mask, good, toxic, n) of the five filters: four of the text itself, and E for later copies of a text.

    A copy is later if its id is larger than the least id of that text anywhere in the table. Rows are first counted by
    id and text, then by text and part, so that a text's copies and repeated rows are few rows when they meet.
    """

    @F.arrow_udf("int")
    def failures(column: pa.Array) -> pa.Array:
        return pa.array([text_failures(t) for t in texts(column)], pa.int32())

    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    own = bounded_batches(docs).select(
        F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.concat(F.unhex(F.md5(body)), F.unhex(F.hex(F.octet_length(body)))).alias("digest"),
        failures(F.col(f"`{text}`")).alias("mask"),
    )
    rows = own.groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    known = labels.select(
        F.col(f"`{doc_id}`").alias("id"), F.col("quality").eqNullSafe(1).cast("int").alias("good"), F.col("toxic").eqNullSafe(1).cast("int").alias("toxic")
    ).filter("id IS NOT NULL").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    named = rows.filter("id IS NOT NULL").join(known, "id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})

    first = F.min(F.struct("id", "n")).alias("first")
    by_text = named.groupBy("digest", "mask", "part", "good", "toxic").agg(F.sum("n").alias("n"), first)
    least = by_text.groupBy("digest").agg(F.min("first.id").alias("least"))
    alone = F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = by_text.join(least, "digest").withColumn("alone", alone)
    either = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("alone").alias("n")),
        F.struct(F.col("mask").bitwiseOR(1 << len(TEXT_FILTERS)).alias("mask"), (F.col("n") - F.col("alone")).alias("n")),
    ))
    counted = split.select("part", "good", "toxic", either.alias("x")).select("part", "x.mask", "good", "toxic", "x.n").filter("n > 0")
    nameless = rows.filter("id IS NULL").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "n")
    return counted.unionByName(nameless)


def filter_interactions(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """One row for each part, order of the five filters ABCDE and step, zeros included: see :func:`audit`.

    A null text is empty; a null part is the part "". ``labels`` has the columns ``doc_id``, quality and toxic; of
    several rows of one id, any that says 1 counts. A row without an id is never a later copy, makes none, and has no
    labels; repeated rows of one id are copies of nothing but count as rows. A table without rows has no parts. Other
    columns do not matter. Copies are told by MD5 and length of the text.
    """
    return audit(failing_masks(docs, labels, doc_id, text, part), TEXT_FILTERS + COPY_FILTER)
