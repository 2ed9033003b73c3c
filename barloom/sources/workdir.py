"""A folder for written intermediate tables and streaming checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared ``spark.checkpoint.dir`` of the cluster.

    Only a local session without that setting gets a temporary folder; on a
    cluster every machine would write to a disk of its own, so that raises.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.conf.get("spark.master", "")
    if not shared and not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all of {master} shares")
    base = shared.rstrip("/") if shared else tempfile.mkdtemp(prefix="barloom-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a work folder that nothing reads any more, wherever Spark keeps it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to a work folder and read again: what is lost with an executor is read, not computed."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
