"""What the operators of this package share: reading, naming, hashing, block sums, connected components."""

from __future__ import annotations

import os
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import cut_lineage

#: Documents per Arrow batch; Spark also closes a batch at 64 MB.
BATCH_ROWS = 1000
ROOT = str(Path(__file__).resolve().parents[2])
#: Sums travel as rows of this many numbers.
BLOCK = 32


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the queries of this package run under.

    Python workers import this library from where the driver does, as well as from where it is installed.
    """
    paths = spark.sparkContext.environment
    if ROOT not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, paths.get("PYTHONPATH")) if p)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have yet."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def id_bucket(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; a null id is in no bucket (-1)."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus)), F.lit(-1)).cast("int")


def encoded(texts: pd.Series):
    """The UTF-8 bytes of each text; nothing for a null."""
    for text in texts:
        yield text.encode("utf-8", "replace") if isinstance(text, str) else b""


def block_schema() -> str:
    return "k int, " + ", ".join(f"c{i} double" for i in range(BLOCK))


def to_blocks(values: np.ndarray) -> pd.DataFrame:
    """The non-zero blocks of a flat array, a row each."""
    values = np.pad(values.astype(np.float64), (0, -len(values) % BLOCK)).reshape(-1, BLOCK)
    used = np.flatnonzero(values.any(axis=1))
    frame = pd.DataFrame(values[used], columns=[f"c{i}" for i in range(BLOCK)])
    frame.insert(0, "k", used.astype(np.int32))
    return frame


def summed_blocks(blocks: DataFrame, size: int) -> np.ndarray:
    """Sum of the flat arrays behind ``blocks``; ``size`` numbers, whatever the input, reach the driver."""
    total = np.zeros(-(-size // BLOCK) * BLOCK).reshape(-1, BLOCK)
    frame = blocks.groupBy("k").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(BLOCK)]).toPandas()
    total[frame["k"].to_numpy(dtype=np.int64)] = frame.drop(columns="k").to_numpy()
    return total.ravel()[:size]


def crc_of(ids: np.ndarray, before: int = 0) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes(), before)


def _digest(links: DataFrame) -> tuple:
    """What tells whether two sets of links are the same: their number, and 128 bits over all of them."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", F.lit(7), "a"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``links`` (a, b); root is the smallest node of its component.

    Alternating large-star and small-star steps.  Each step writes its links, so a lost
    executor costs at most one step, and rounds grow with the logarithm of the longest path.
    """
    links = cut_lineage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct(), "links")
    before = _digest(links)
    while True:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a != b").distinct()
        large = cut_lineage(large, "links")
        # Small star: every node is tied to its smallest neighbour, and so are its other smaller neighbours.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("x"), F.col("a").alias("y")).union(least.select("m", "b"))
        small = cut_lineage(small.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a != b").distinct(), "links")
        links, after = small, _digest(small)
        if after == before:
            break
        before = after
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(links.select("a", "a").distinct())
