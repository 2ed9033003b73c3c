"""Fitting a model on a bounded sample of labelled rows: blocks train side by side, their weights are averaged."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import held_out, written

#: Blocks that train side by side in a round; the driver gets one vector from each.
BLOCKS = 8


def sample(labels: DataFrame, label: str, doc_id: str, most: int) -> DataFrame:
    """Rows (doc_id, label 0 or 1) to learn from: none held out, about ``most`` of them chosen by a hash of the id.

    Null ids and null labels teach nothing. Of several labels of a document the largest holds.
    """
    usable = (
        labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IS NOT NULL")
        .filter(~held_out("doc_id"))
    )
    share = min(1.0, most / max(1, usable.count()))
    chosen = usable.filter(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    return chosen.groupBy("doc_id").agg(F.max("label").alias("label"))


def with_labels(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, most: int) -> DataFrame:
    """The rows of ``docs`` in the sample, with their label as ``__llm_label``.

    The sample has about ``most`` rows of an id and a label, whatever the size of the tables, so it is broadcast.
    """
    chosen = sample(labels, label, doc_id, most).withColumnsRenamed({"doc_id": "__llm_id", "label": "__llm_label"})
    return docs.join(F.broadcast(chosen), F.col(f"`{doc_id}`") == F.col("__llm_id")).drop("__llm_id")


def blocked(rows: DataFrame, key: str) -> DataFrame:
    """The sample as a written table of :data:`BLOCKS` rows, each with its share of the sample in the order of ``key``.

    A block is a row, not a partition, so the model does not depend on how Spark reads the table.
    """
    block = F.pmod(F.xxhash64(F.lit("block"), key), F.lit(BLOCKS)).alias("block")
    each = F.struct(key, *[c for c in rows.columns if c != key])
    return written(rows.groupBy(block).agg(F.sort_array(F.collect_list(each)).alias("rows")), "blocks")


def summed(blocks: DataFrame, partial: Callable[[pa.StructArray], np.ndarray]) -> np.ndarray | None:
    """Sum of the vectors that ``partial`` makes of the blocks, of which one each reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                vector = partial(batch["rows"][k].values).astype(np.float32).tobytes()
                yield pa.RecordBatch.from_arrays([batch["block"].slice(k, 1), pa.array([vector])], ["block", "v"])

    total = None
    ordered = blocks.select("block", "rows").mapInArrow(run, "block bigint, v binary").collect()  # BLOCKS rows
    for row in sorted(ordered):
        vector = np.frombuffer(row.v, np.float32).astype(np.float64)
        total = vector if total is None else total + vector
    return total


def fit(blocks: DataFrame, start: np.ndarray, epoch: Callable, rounds: int) -> np.ndarray:
    """Weights after some rounds: in each, every block trains an epoch from the same weights, and each weight then
    moves by the mean over the blocks that moved it.

    ``epoch(weights, rows, round)`` changes its own copy of the weights. Without blocks the weights stay.
    """
    spark, weights = blocks.sparkSession, start.astype(np.float32)
    for number in range(rounds):
        sent = spark.sparkContext.broadcast(weights)

        def partial(rows: pa.StructArray, sent=sent, number=number) -> np.ndarray:
            own = sent.value.copy()
            epoch(own, rows, number)
            moved = (own - sent.value).ravel()
            return np.concatenate([moved, moved != 0])

        total = summed(blocks, partial)
        if total is None:
            break
        moved, by = total.reshape(2, -1)
        weights = (weights + (moved / np.maximum(by, 1)).reshape(weights.shape)).astype(np.float32)
        sent.destroy()
    return weights


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
