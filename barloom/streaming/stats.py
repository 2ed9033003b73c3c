"""Ten-minute statistics of a live stream of bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from barloom.functions.clock import hhmm, in_session
from barloom.operators.resample import MEAN_STD, inside_window, stat_columns, stat_names
from barloom.sources.sinks import write_by_date

LATENESS = "5 minutes"


def resample_stream(
    stream: DataFrame, bars: Sequence[str], ops: Sequence[str] = MEAN_STD, lateness: str = LATENESS
) -> DataFrame:
    """Streaming form of ``resample_long``: (date, symbol, slot, statistics, count).

    ``time`` must be a ``timestamp`` (watermarks do not take the zone-free
    type). A window is emitted once the watermark has passed it; bars that come
    after that are dropped, and the last windows stay open. State holds one row
    of partial sums per symbol and open window.
    """
    rows = stream.withWatermark("time", lateness).where(in_session("time") & inside_window("time"))
    window = F.window("time", "10 minutes", "10 minutes", "1 minute")
    stats = rows.groupBy(window, "symbol").agg(*stat_columns(bars, ops), F.count("time").alias("count"))
    last = F.col("window.start") + F.expr("INTERVAL 9 MINUTES")
    return stats.select(
        F.to_date("window.start").alias("date"), "symbol", hhmm(last).alias("slot"), *stat_names(bars, ops), "count"
    )


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(date, symbol, slot, count) of the windows that a stream of :func:`resample_stream` holds open, from its state.

    ``checkpoint`` is the folder of a query that has stopped; what is read is the state of its last batch. ``count`` is
    the bars that the window has so far: the last of the state's values, as the count is the last of the statistics.
    """
    state = spark.read.format("statestore").load(checkpoint)
    buffers = state.schema["value"].dataType.fields  # sums and counts of the statistics, several of one name
    numbered = ", ".join(f"v{i}: {f.dataType.simpleString()}" for i, f in enumerate(buffers))
    count = F.col("value").cast(f"struct<{numbered}>").getField(f"v{len(buffers) - 1}")
    window = F.col("key").getField(state.schema["key"].dataType.names[0])
    symbol = F.col("key").getField(state.schema["key"].dataType.names[1])
    last = window.start + F.expr("INTERVAL 9 MINUTES")
    return state.select(
        F.to_date(window.start).alias("date"), symbol.alias("symbol"), hhmm(last).alias("slot"), count.alias("count")
    )


def write_stream_by_date(stats: DataFrame, path: str, checkpoint: str, **trigger) -> DataStreamWriter:
    """Writer that appends finished windows to a date-partitioned table.

    Each micro-batch goes to its own ``batch`` folder under its dates, so a
    batch that is run again after a failure replaces its own rows and no others.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch", F.lit(batch_id))
        write_by_date(numbered, path, ("date", "batch"), ("symbol", "slot"))

    return (
        stats.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
