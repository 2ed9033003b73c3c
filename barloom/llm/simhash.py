"""SimHash near-duplicates: 64-bit fingerprints, and all pairs within a few bits by a self-join of their binary trie.

The trie of the distinct fingerprints is cut at a fixed depth into subtries, each held as one sorted array. Two
subtries meet in a task only when their prefixes differ in no more bits than allowed. There the two are walked down
together: pairs of nodes split into pairs of children, differing bits add up, and a pair over the budget is dropped
with everything below it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import ascii_lower, bounded_batches, refuse_names, texts, written
from barloom.llm.components import components

BITS = 64
SEED = 42

#: Node pairs that are held at once while two subtries are walked; the rest waits on a stack.
BLOCK = 1 << 18
#: A pair of nodes with at most so many pairs of leaves below is compared leaf by leaf.
FEW = 16
#: Distinct fingerprints of one prefix beyond which its subtrie is dealt out in parts.
PART = 1 << 18


def fingerprint(text: str, width: int) -> int:
    """SimHash of the ``width``-word shingles, repeats counted: bit set if it is in over half of their hashes."""
    words = ascii_lower(text.encode()).split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), "<u8")
    # every byte of the packed 64-bit lanes counts at most 255 hashes before it is added up
    counts = np.zeros(BITS, np.int64)
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    for start in range(0, len(lanes), 1 << 16):
        counts += np.unpackbits(lanes[start : start + (1 << 16)], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", into: str = "simhash", width: int = 3) -> DataFrame:
    """``docs`` with the fingerprint as a (signed) long column ``into``, a new name; null and wordless texts get zero."""
    refuse_names(docs, into)

    @F.arrow_udf("bigint")
    def hashed(column: pa.Array) -> pa.Array:
        values = np.fromiter((fingerprint(t, width) for t in texts(column)), np.uint64, len(column))
        return pa.array(values.view(np.int64))

    return bounded_batches(docs).withColumn(into, hashed(F.col(f"`{text}`")))


def as_hex(column: str) -> Column:
    """16 lower-case hex digits of a long."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def prefixes_near(prefix: int, depth: int, budget: int) -> list[int]:
    """All prefixes of ``depth`` bits that differ from ``prefix`` in ``budget`` bits or fewer."""
    flips = (sum(1 << b for b in bits) for n in range(budget + 1) for bits in itertools.combinations(range(depth), n))
    return [prefix ^ f for f in flips]


def _split(values: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
    """Where, in each range of equal upper bits, the values with ``bit`` set begin."""
    first = values[low] >> np.uint64(bit) << np.uint64(bit) | np.uint64(1 << bit)
    middle = np.searchsorted(values, first).astype(np.int64)
    return np.clip(middle, low, high)


def walk(left: np.ndarray, right: np.ndarray, same: bool, depth: int, budget: int) -> Iterator[tuple]:
    """Index pairs (into ``left``, into ``right``) of values within ``budget`` bits, in blocks.

    Both are sorted and share their first ``depth`` bits each. ``same``: both are one subtrie; then each pair comes
    once and no value meets itself.
    """
    if not len(left) or not len(right):
        return
    start = int(np.bitwise_count((left[0] ^ right[0]) >> np.uint64(BITS - depth))) if depth else 0
    one = np.ones(1, np.int64)
    stack = [(BITS - 1 - depth, one * 0, one * len(left), one * 0, one * len(right), one * start)]
    while stack:
        bit, a0, a1, b0, b1, spent = stack.pop()
        if len(a0) > BLOCK:
            for at in range(0, len(a0), BLOCK):
                stack.append((bit, *(x[at : at + BLOCK] for x in (a0, a1, b0, b1, spent))))
            continue
        few = (a1 - a0) * (b1 - b0) <= FEW
        if bit < 0:  # equal to the last bit: only a value and itself
            few[:] = True
        if few.any():
            yield from _leaves(left, right, same, a0[few], a1[few], b0[few], b1[few], budget)
            a0, a1, b0, b1, spent = (x[~few] for x in (a0, a1, b0, b1, spent))
        if not len(a0):
            continue
        am, bm = _split(left, a0, a1, bit), _split(right, b0, b1, bit)
        below = (
            (a0, am, b0, bm, spent),
            (am, a1, bm, b1, spent),
            (a0, am, bm, b1, spent + 1),
            (am, a1, b0, bm, spent + 1),
        )
        a0, a1, b0, b1, spent = (np.concatenate(x) for x in zip(*below, strict=True))
        keep = (a0 < a1) & (b0 < b1) & (spent <= budget)
        if same:
            keep &= a0 <= b0  # the mirrored pair of nodes is dropped
        stack.append((bit - 1, *(x[keep] for x in (a0, a1, b0, b1, spent))))


def _leaves(left, right, same, a0, a1, b0, b1, budget) -> Iterator[tuple]:
    """All pairs below few-leaved pairs of nodes, compared in full."""
    na, nb = a1 - a0, b1 - b0
    size = na * nb
    own = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
    i, j = a0[own] + at // nb[own], b0[own] + at % nb[own]
    near = np.bitwise_count(left[i] ^ right[j]) <= budget
    if same:
        near &= i < j
    if near.any():
        yield i[near], j[near]


class Forest:
    """Joins of the pairs seen so far; keeps what connects them, not the pairs."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up


def linked(left: np.ndarray, right: np.ndarray, same: bool, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what :func:`walk` pairs: one for each value that is not the first of its component."""
    both = left if same else np.concatenate([left, right])
    shift = 0 if same else len(left)
    forest = Forest(len(both))
    for i, j in walk(left, right, same, depth, budget):
        forest.join(i, j + shift)
    at = np.flatnonzero(forest.root != np.arange(len(both)))
    return both[at], both[forest.root[at]]


def links(values: DataFrame, budget: int = 3, depth: int | None = None, part: int = PART) -> DataFrame:
    """Distinct longs (fingerprint) to edges (a, b) that connect all within ``budget`` bits of each other.

    ``depth``: bits at which the trie is cut; by default as many as keep subtries under ``part`` values, 6 at least.
    A subtrie with more is dealt out in parts by a hash, and every two parts meet, so no task grows with a hot prefix.
    """
    if depth is None:
        depth = max(6, int(np.ceil(np.log2(max(1, values.count()) / part))))
    cut = values.select(
        F.col("fingerprint"),
        F.shiftrightunsigned("fingerprint", BITS - depth).alias("prefix") if depth else F.lit(0).cast("bigint").alias("prefix"),
    )
    # at most (number of values / part) prefixes are that large
    large = {r.prefix: -(-r.n // part) for r in cut.groupBy("prefix").agg(F.count("*").alias("n")).filter(f"n > {part}").collect()}

    @F.arrow_udf("bigint")
    def parts_of(prefix: pa.Array) -> pa.Array:
        return pa.array([large.get(p, 1) for p in prefix.to_pylist()], pa.int64())

    many = parts_of(F.col("prefix")) if large else F.lit(1)
    subtries = (
        cut.withColumn("part", F.pmod(F.xxhash64("fingerprint"), many))
        .groupBy("prefix", "part")
        .agg(F.collect_list("fingerprint").alias("values"))
    )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                prefix, own = batch["prefix"][k].as_py(), batch["part"][k].as_py()
                values = np.sort(batch["values"][k].values.to_numpy(zero_copy_only=False).view(np.uint64)).tobytes()
                keys = []
                for other in prefixes_near(prefix, depth, budget):
                    for theirs in range(large.get(other, 1)):
                        keys.append((*min((prefix, own), (other, theirs)), *max((prefix, own), (other, theirs))))
                for at in range(0, len(keys), 64):
                    some = keys[at : at + 64]
                    columns = [pa.array([x[i] for x in some], pa.int64()) for i in range(4)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([values] * len(some))], ["p", "s", "q", "t", "packed"])

    meet = subtries.mapInArrow(pairs, "p bigint, s bigint, q bigint, t bigint, packed binary")

    def joined(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sides = [np.frombuffer(x, np.uint64) for x in group["packed"]]
        same = key[:2] == key[2:]
        if len(sides) < 2 and not same:
            a = b = np.zeros(0, np.uint64)
        else:
            a, b = linked(sides[0], sides[0] if same else sides[1], same, depth, budget)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return meet.groupBy("p", "s", "q", "t").applyInPandas(joined, "a bigint, b bigint")


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, budget: int = 3) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id, group_fingerprint), one for each row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the least id reachable over links of ``budget``
    differing bits or fewer; ``group_fingerprint`` one fingerprint that stands for the component. Equal fingerprints are joined before the trie, so a group of copies is one leaf. Null ids
    take part but are never the least; a component of null ids only has a null ``component_id``. Rows of one id are
    as many rows; an empty table gives none. Other columns of ``docs``, whatever their names, are not looked at.
    """
    ids = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    each = written(fingerprints(ids, "text", "fingerprint", width).select("doc_id", "fingerprint"), "fingerprints")
    values = written(each.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "values")
    roots = components(links(values.select("fingerprint"), budget)).select(
        F.col("node").alias("fingerprint"), "root"
    )
    rooted = values.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_value = rooted.join(least, "root").select("fingerprint", "component_id", "root")
    return each.join(of_value, "fingerprint").select(
        "doc_id", as_hex("fingerprint").alias("fingerprint"), "component_id", as_hex("root").alias("group_fingerprint")
    )


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, budget: int = 3) -> DataFrame:
    """The document with the least id of each near-duplicate group, with the columns of ``docs``.

    Of several rows with that id in that group the least by all columns stays, also of a group without any id; rows of
    one id in other groups are chosen there, each group on its own. An id with a single row is looked up as it is; only
    rows that share their id, or have none, are fingerprinted again to tell which of them is meant.
    """
    groups = written(simhash_groups(docs, doc_id, text, width, budget), "groups")
    chosen = F.col("doc_id").eqNullSafe(F.col("component_id"))
    of_id = groups.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__llm_id")).agg(F.count("*").alias("n"), F.bool_or(chosen).alias("stays"))
    own_id, row = F.col(f"`{doc_id}`"), F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = of_id.filter("stays AND n = 1").select("__llm_id")
    # ids that repeat are few, as a rule: written first, their size decides how texts meet them
    often = written(of_id.filter("stays AND n > 1").select("__llm_id"), "ids")
    single = docs.join(once, own_id == F.col("__llm_id"), "left_semi")
    several = docs.join(often, own_id == F.col("__llm_id"), "left_semi").unionAll(docs.filter(own_id.isNull()))
    several = fingerprints(several.select(own_id.alias("__llm_id"), F.col(f"`{text}`").alias("__llm_text"), row.alias("row")), "__llm_text", "__llm_bits", width)
    meant = groups.filter(chosen).selectExpr("doc_id AS __llm_of", "fingerprint AS __llm_fp", "group_fingerprint AS __llm_group").distinct()
    met = several.join(meant, (as_hex("__llm_bits") == F.col("__llm_fp")) & F.col("__llm_id").eqNullSafe(F.col("__llm_of")))
    return single.unionAll(met.groupBy("__llm_group").agg(F.min("row").alias("row")).select("row.*"))
