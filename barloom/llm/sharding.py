"""Shards of near equal bytes: groups of equal texts, by falling size, each to the shard that is least loaded.

The longest groups go first, through a heap of shards. What the heap does depends only on how many groups there are of
each size, and sizes that differ are few: D of them add up to D * (D + 1) / 2 bytes at least, so there are at most the
square root of twice the corpus (fourteen million for 100 TB). One task reads them in falling order with sixteen loads
in memory. It deals groups of one size in turns: as long as the same shards stay the least loaded they take one group
each, in the same order, so a turn is worked out once and repeated. That gives what dealing group by group gives, and a
rule by which every group finds its shard from its rank among the groups of its size, where it is.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import written

#: Rows that are numbered in one go, by one task.
PART = 1 << 16
#: Groups that hold more than one in so many rows meet their rows by a broadcast, of so many groups at most.
HOT = 4096

TURNS = "array<struct<first: bigint, shards: array<int>>>"


class Loads:
    """Shards in a heap of (load, shard); the least loaded takes the next group, the lowest number of equal ones."""

    def __init__(self, shards: int):
        self.heap = [(0, shard) for shard in range(shards)]

    def deal(self, size: int, count: int) -> list[dict]:
        """Give out ``count`` groups of ``size`` (over 0); group r goes to ``shards[(r - first) % len(shards)]`` of the
        last turn whose ``first`` is r or less."""
        heap, turns, given = self.heap, [], 0
        while given < count:
            least, shard = heap[0]
            again = (least + size, shard)  # the first of the turn comes up once more
            turn = []
            while heap and heap[0] < again:
                turn.append(heapq.heappop(heap))
            rounds, rest = divmod(count - given, len(turn))
            if heap:  # the others wait until those of the turn have caught up with the least of them
                gap, over = divmod(heap[0][0] - least, size)
                alike = gap - (over == 0 and heap[0][1] < shard)
                if alike < rounds or alike == rounds and rest:
                    rounds, rest = alike, 0
            turns.append({"first": given, "shards": [s for _, s in turn]})
            given += rounds * len(turn) + rest
            for k, (load, s) in enumerate(turn):
                heapq.heappush(heap, (load + size * (rounds + (k < rest)), s))
        return turns


def dealt_sizes(sizes: DataFrame, shards: int) -> DataFrame:
    """Rows (total, n) of group sizes and how many groups have them, to (total, turns): see :meth:`Loads.deal`."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = Loads(shards)
        kind = pa.list_(pa.struct([("first", pa.int64()), ("shards", pa.list_(pa.int32()))]))
        for batch in batches:
            total, n = batch["total"].to_pylist(), batch["n"].to_pylist()
            turns = [loads.deal(t, c) for t, c in zip(total, n, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["total"], pa.array(turns, kind)], ["total", "turns"])

    in_turn = sizes.select("total", "n").repartition(1).sortWithinPartitions(F.desc("total"))
    return in_turn.mapInArrow(deal, f"total bigint, turns {TURNS}")


def numbered(rows: DataFrame, key: str, order: Sequence[str], parts: int, into: str, known: DataFrame | None = None) -> DataFrame:
    """``rows`` numbered without gaps from 0 within each ``key``, in a column ``into``.

    A key is dealt into ``parts`` by a hash of the last of the columns ``order``, which tells rows apart; parts are
    numbered each on their own and start where the parts before end, so that no task holds a key. ``known``: one row for each key, whose
    other columns are added; it meets the parts, not the rows.
    """
    dealt = rows.withColumn("__part", F.pmod(F.xxhash64(order[-1]), F.lit(parts)).cast("int"))
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(key, "__part").agg(F.count("*").alias("__n"))
    starts = starts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    if known is not None:
        starts = starts.join(known, key)
    within = F.row_number().over(Window.partitionBy(key, "__part").orderBy(*order)) - 1
    placed = dealt.withColumn("__at", within).join(starts, [key, "__part"])
    return placed.withColumn(into, F.col("__start") + F.col("__at")).drop("__part", "__start", "__at")


def turn_of(rank: Column, turns: Column) -> Column:
    """The shard of the group with that rank."""
    turn = F.element_at(F.filter(turns, lambda t: t["first"] <= rank), -1)
    return F.get(turn["shards"], ((rank - turn["first"]) % F.size(turn["shards"])).cast("int"))


def sharded(
    docs: DataFrame, text: str = "text", shards: int = 16, keep: Sequence[str] = ("doc_id",), part: int = PART
) -> DataFrame:
    """Rows (the columns ``keep``, size, text_crc32, shard, slot), one for each row of ``docs``.

    ``size`` is the bytes of the text and 1; a null text is an empty one, in the same group as empty texts. Rows of
    equal texts (by MD5 and size) stay together, also if they are a third of the corpus, which then is one shard's
    load. ``slot`` numbers the rows of a shard from 0: parts of ``part`` rows one after the other, in each by the columns
    ``keep``. Null and repeated ids are rows as any others; an empty table gives none. Other columns do not matter; a
    kept column may not bear the name of a new one. Which shard of equal loads and which group of equal sizes comes
    first is settled by number and by digest.

    Texts are read once and not shuffled, unless ``keep`` names them. What a row is known by, its place in a table that
    is written first, does not change when executors are lost.
    """
    if clash := {"size", "text_crc32", "shard", "slot"} & set(keep):
        raise ValueError(f"columns of these names are added: {sorted(clash)}")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    size = (F.octet_length(body) + 1).cast("bigint")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), size.alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.concat(F.unhex(F.md5(body.cast("binary"))), F.unhex(F.hex(size))).alias("digest"), F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows, "sized")
    groups = written(rows.groupBy("digest").agg(F.sum("size").alias("total"), F.count("*").alias("n")), "groups")
    n_rows, n_groups = rows.count(), groups.count()

    turns = dealt_sizes(groups.groupBy("total").agg(F.count("*").alias("n")), shards)
    ranked = numbered(groups, "total", ["digest"], -(-n_groups // part) or 1, "rank", turns)
    placed = written(ranked.select("digest", "n", turn_of(F.col("rank"), F.col("turns")).alias("shard")), "placed")

    # fewer than HOT groups can be that large
    hot = placed.filter(F.col("n") > max(part, n_rows // HOT)).select("digest", F.col("shard").alias("of_hot"))
    near = rows.join(F.broadcast(hot), "digest", "left")
    apart = near.filter("of_hot IS NULL").drop("of_hot").join(placed.drop("n"), "digest")
    met = near.filter("of_hot IS NOT NULL").withColumnRenamed("of_hot", "shard").unionByName(apart)
    slots = numbered(met.drop("digest"), "shard", ["kept", "row"], -(-n_rows // part) or 1, "slot")
    return slots.select(*[F.col("kept")[c].alias(c) for c in keep], "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, text: str = "text", shards: int = 16, part: int = PART) -> None:
    """All columns of ``docs`` as Parquet under ``path/shard=K``, each file a stretch of the shard's slots in order."""
    whole = sharded(docs, text, shards, docs.columns, part)
    stretch = F.floor(F.col("slot") / part)
    dealt = whole.withColumn("__stretch", stretch).repartition("shard", "__stretch").sortWithinPartitions("shard", "slot")
    dealt.drop("__stretch").write.partitionBy("shard").parquet(path)
