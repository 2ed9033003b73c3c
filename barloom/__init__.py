"""Intraday factor building and scoring on Spark DataFrames."""

from __future__ import annotations

# Settings a session for this work should have; the rest is up to the cluster.
SESSION_SETTINGS = {
    # Minute bars carry wall-clock times.
    "spark.sql.session.timeZone": "UTC",
    # Runtime coalescing, skew-join splitting and rebalancing of date partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wide rows (thousands of floats) make large vectors: keep a batch at some tens of megabytes.
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}
