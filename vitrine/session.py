"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One relation hub (a large group, an exhibition) may own a third of the
    # edges, so the join splits a partition well before it reaches the default.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    # Files of refnames and ids hold ten times their size or more; judged by it, tables far above the broadcast limit would go through the driver.
    "spark.sql.sources.fileCompressionFactor": "10",
    # An aggregate on the join key would otherwise keep the split from happening.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set how a running session treats skewed joins; nothing else is touched."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", memory: str = "16g") -> SparkSession:
    """A session for tests and the local benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("vitrine")
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    named = tempfile.mkdtemp(prefix="vitrine-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


_OPEN: ContextVar[list[str] | None] = ContextVar("scratch folders of the open scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the scratch folders that are made inside; for jobs whose results are written elsewhere.

    Nothing read from such a folder may be used after the scope.  Folders made with ``keep`` stay.
    """
    mine: list[str] = []
    token = _OPEN.set(mine)
    try:
        yield
    finally:
        _OPEN.reset(token)
        delete_folders(spark, mine)


def delete_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders through the store's own file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def scratch_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A path under the scratch folder that no other run uses."""
    path = f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not keep and _OPEN.get() is not None:
        _OPEN.get().append(path)
    return path


#: Setting of Spark 4.1 and later (older ones do without): whether a query's shuffle files go when it ends.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of what is run inside as soon as it ends; for plans that are run once, such as writes."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(REMOVE_SHUFFLES) if before is None else spark.conf.set(REMOVE_SHUFFLES, before)


def cut_lineage(df: DataFrame, label: str = "step", keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and go on from the written table.

    The copy outlives the loss of any executor, and later plans see its true size
    and read only the columns they need.  The shuffle files of the step go with its end.
    """
    path = scratch_path(df.sparkSession, label, keep)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
