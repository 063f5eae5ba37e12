"""The latest row of each key as a stored table that batches are merged into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from vitrine.operators.ordering import latest_by
from vitrine.sources.versions import PublishedTable


class LatestRows:
    """Stored state: one row for each ``key``, that of the greatest ``time``, then of the first in order of ``ties``.

    A batch is reduced on its own, then meets the state in the buckets it touches, so late and repeated rows
    change nothing they should not, and after any split into batches the state is that of all rows together.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, time: str, ties: Sequence[str], buckets: int = 64):
        self.table, self.key, self.time, self.ties = PublishedTable(spark, path, key, buckets), key, time, list(ties)

    def merge(self, batch: DataFrame) -> int:
        """Merge a batch; the version of the state that has it."""
        few = latest_by(batch, [self.key], self.time, *self.ties)
        return self.table.merge(few, lambda rows, new: latest_by(rows.unionByName(new), [self.key], self.time, *self.ties))

    def read(self) -> DataFrame:
        return self.table.read()
