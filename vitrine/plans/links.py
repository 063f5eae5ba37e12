"""Tables that a collection stores in a layout of its own: relations by record ids, the hierarchy by list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.joins import LIST, related, with_id, with_lists
from vitrine.plans.model import Collection
from vitrine.session import scratch_path

TYPES = ("subjectdocumenttype", "objectdocumenttype")


def resolve_links(relations: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Relations with the record id of both ends; an edge with an unknown end drops."""
    return with_id(with_id(relations, hierarchy, "subjectcsid", "subjectid"), hierarchy, "objectcsid", "objectid")


def store_links(c: Collection, path: str | None = None) -> DataFrame:
    """The resolved links, written once and partitioned by both types, so a typed join reads its own folders only."""
    spark = c.relations.sparkSession
    path = path or scratch_path(spark, "edges", keep=True)
    rows = resolve_links(c.relations, c.hierarchy)
    rows.write.partitionBy(*TYPES).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def store_hierarchy(hierarchy: DataFrame, path: str | None = None) -> DataFrame:
    """The hierarchy written once, partitioned by list: a list is read without the others, records without any list."""
    spark = hierarchy.sparkSession
    path = path or scratch_path(spark, "hierarchy", keep=True)
    rows = with_lists(hierarchy)
    rows.hint("rebalance", LIST).write.partitionBy(LIST).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def links_of(c: Collection) -> DataFrame:
    """The collection's table of resolved links, or the links resolved on the way."""
    return c.edges if "edges" in c else resolve_links(c.relations, c.hierarchy)


def linked(
    df: DataFrame, links: DataFrame, out: str, doc_type: str | None = None, direction: str = "subject", id: str = "id", keep: Sequence[str] = (),
) -> DataFrame:
    """Adds the id of each linked record, a row an edge; as :func:`joins.related`, without a look at csids.

    ``subject``: ``df`` is the subject and the edge's object is the target; ``object``: the reverse.
    """
    here, there = ("subject", "object") if direction == "subject" else ("object", "subject")
    edges = links if doc_type is None else links.filter(F.col(f"{there}documenttype") == doc_type)
    edges = edges.select(F.col(f"{here}id").alias("_here"), F.col(f"{there}id").alias(out), *keep)
    return df.join(edges, F.col(id) == F.col("_here")).drop("_here")


def linked_in(
    c: Collection, df: DataFrame, out: str, doc_type: str | None = None, direction: str = "subject", id: str = "id", keep: Sequence[str] = (),
) -> DataFrame:
    """As :func:`linked` with the collection's own links; where they are not stored, only those of the rows are resolved."""
    if "edges" in c:
        return linked(df, c.edges, out, doc_type, direction, id, keep)
    return related(df, c.relations, c.hierarchy, out, doc_type, direction, id, keep=keep)
