import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators.resample import resample_long
from barloom.streaming import stats

DAY = dt.date(2024, 1, 8)
SCHEMA = "time timestamp, symbol string, x double"


def write(spark, folder, rows, name):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 8, h, m), s, x) for h, m, s, x in rows], "time timestamp_ntz, symbol string, x double")
    df.select(F.col("time").cast("timestamp").alias("time"), "symbol", "x").coalesce(1).write.parquet(f"{folder}/{name}")


def minutes(first, last, symbol):
    return [(t // 60, t % 60, symbol, float(t % 11)) for t in range(first, last + 1)]


def run(spark, source, target):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet").parquet(f"{source}/*")
    query = stats.write_stream_by_date(stats.resample_stream(stream, ["x"]), f"{target}/rows", f"{target}/state").start()
    query.awaitTermination()
    return spark.read.parquet(f"{target}/rows")


@pytest.fixture()
def source(spark, tmp_path):
    folder = str(tmp_path / "in")
    write(spark, folder, minutes(571, 600, "A") + minutes(571, 600, "B"), "a")
    write(spark, folder, minutes(601, 625, "A") + minutes(601, 625, "B"), "b")
    return folder


def test_stream_equals_batch_on_closed_windows(spark, source, tmp_path):
    got = run(spark, source, str(tmp_path / "out"))
    everything = spark.read.schema(SCHEMA).parquet(f"{source}/*")
    batch = resample_long(everything.select(F.to_date("time").alias("date"), F.col("time").cast("timestamp_ntz").alias("time"), "symbol", "x"), ["x"])
    # The watermark stands at 10:20; the window that ends before 10:21 is still open.
    closed = batch.where(F.col("slot") <= "1010")
    cols = ["date", "symbol", "slot", "x_mean", "x_std", "count"]
    assert got.count() == closed.count() == 2 * 4
    assert got.select(*cols).exceptAll(closed.select(*cols)).isEmpty()


def test_late_bars_are_dropped_and_open_windows_wait(spark, source, tmp_path):
    target = str(tmp_path / "out")
    first = run(spark, source, target).count()
    write(spark, source, [(9, 35, "A", 1e9)] + minutes(626, 640, "A"), "c")
    again = run(spark, source, target)
    assert again.count() > first
    assert again.where(F.col("x_mean") > 1000).isEmpty()
    counts = {(r["symbol"], r["slot"]): r["count"] for r in again.collect()}
    assert len(counts) == again.count()  # nothing is written twice
    assert counts[("A", "0940")] == 10 and counts[("A", "1030")] == 10 and ("B", "1020") in counts
