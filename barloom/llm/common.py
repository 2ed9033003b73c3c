"""Helpers the text operators share: written intermediate tables, and texts out of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.sources.workdir import work_folder

#: The bytes that separate words everywhere here; ``bytes.split()`` splits at exactly these.
BLANK = b" \t\n\x0b\x0c\r"

#: Rows of a batch that are held as Python strings at a time.
SLICE_ROWS = 256


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the shared work folder and read again.

    Cuts the lineage: what is lost with an executor is read again, not computed again.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches are small enough for long texts: 1024 rows, unless it says otherwise.

    The default of ten thousand rows is a gigabyte of texts of a hundred thousand characters, in each Python worker.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, "1024")
    return df


def refuse_names(df: DataFrame, *added: str) -> None:
    """Raises if ``df`` already has a column of a name that is to be added: none is ever replaced."""
    if clash := sorted(set(df.columns) & set(added)):
        raise ValueError(f"columns of these names are added, rename those that are there: {clash}")


def slices(array: pa.Array) -> Iterator[list[str]]:
    """The texts of an Arrow array, a few at a time; a null text is an empty one."""
    for start in range(0, len(array), SLICE_ROWS):
        yield [t or "" for t in array.slice(start, SLICE_ROWS).to_pylist()]


def texts(array: pa.Array) -> Iterator[str]:
    for some in slices(array):
        yield from some


def ascii_lower(text: bytes) -> bytes:
    """A-Z lower-cased, all other characters left alone (which ``bytes.lower`` does for UTF-8)."""
    return text.lower()


def held_out(doc_id) -> Column:
    """True for the fifth of the documents whose labels no training may see. False for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
