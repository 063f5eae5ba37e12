"""The corpus pipeline as a query; its stages stand in ``corpus_pipeline`` at the top of the repository."""

from __future__ import annotations

from pyspark.sql import DataFrame


def pipeline(spark, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {"pipeline": pipeline}
ORACLES: dict[str, str] = {}
