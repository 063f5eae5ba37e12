"""From raw documents to token files, in five stages.

Each stage works on what the one before kept, written as a table in between.

Defined cases, beside those that each operator states: a null text is an empty one; an empty text has fewer words than the
first stage asks for, so it goes there; rows without an id stay as long as their texts do, and lose against rows
with one among near-duplicates; repeated rows are near-duplicates, so one stays; a null source is a source
of its own; an empty table gives empty stages; further columns, whatever their names, are carried
to the last stage, which returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import op2_mixing, op7_minhash, op8_decontaminate, op9_rules, op10_simple8b
from vitrine.llm.common import prepare, table
from vitrine.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules do not reject."""
    prepare(spark)
    return op9_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates (five words, 0.8)."""
    prepare(spark)
    return op7_minhash.keep_one(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return op8_decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Equal shares of all sources, by Poisson replication; as much text as came in, about."""
    prepare(spark)
    return op2_mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as files of token ids: per document its place in them."""
    prepare(spark)
    return op10_simple8b.encode(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("token_files", token_files)]

#: EM, MinHash and byte-pair encoding have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; a row for each text in the token files."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
