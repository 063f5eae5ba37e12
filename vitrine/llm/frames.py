"""Binary files through Spark's own writer and reader.

A file is a row of chunks.  Spark's text writer puts the bytes of a string column down as
they are and ends each with a line feed, so a chunk format that takes a closing line
feed as its own can be written by Spark: to any store, with its commit protocol, and
again from scratch after the loss of an executor.  Files are read whole as ``binaryFile``, so a
file must stay below 2 GB: token files are dealt by bytes, archives by partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_chunks(chunks: DataFrame, path: str, column: str = "chunk") -> None:
    """Write the binary ``column``; every partition becomes one file, chunks in their order."""
    chunks.select(F.col(column).cast("string").alias("value")).write.text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the files that hold something."""
    return spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "content")
