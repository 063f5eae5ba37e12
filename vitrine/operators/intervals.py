"""Trees as intervals: a node's descendants are the nodes that are entered while it is open.

Every node gets the place at which a walk through its tree enters it, and the last place before the walk leaves it.
Sizes of subtrees and places are sums over (node, ancestor) pairs, which are made by doubling, so
labelling takes rounds by the logarithm of the depth, once; after that the descendants of any number of terms are one
range join, without rounds.

A node has one parent in its tree, the smallest; links to further parents, and one link of every cycle, are kept aside as ``more``.
Below a term is its own interval, and the intervals below all ``more`` links that hang under it; only
these links are followed in rounds, and a forest has none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.aggregates import union_all
from vitrine.operators.hierarchy import closure
from vitrine.operators.ordering import preceding_total
from vitrine.session import cut_lineage

#: Places of a bin: an interval meets nodes through the bins it covers.
BIN = 4096


@dataclass
class Intervals:
    """``nodes`` (key, term, enter, leave, depth), a row a node, and ``more`` (child_key, parent_key), the links outside the trees."""

    nodes: DataFrame
    more: DataFrame


def _trees(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with one parent each, without cycles (key, term, parent_key), and the links left aside."""
    names = edges.groupBy(F.col("child_key").alias("key")).agg(F.min("child").alias("term"))
    linked = edges.filter("parent_key IS NOT NULL").select("child_key", "parent_key").distinct()
    # A parent that is no node of its own is one without a name.
    above = edges.filter("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.min("parent").alias("_name"))
    names = names.join(above, "key", "full").select("key", F.coalesce("term", "_name").alias("term"))
    first = linked.filter("child_key != parent_key").groupBy("child_key").agg(F.min("parent_key").alias("parent_key"))
    single = cut_lineage(names.join(first, F.col("key") == F.col("child_key"), "left").select("key", "term", "parent_key"))
    up = closure(single.select(F.col("key").alias("child_key"), F.col("term").alias("child"), "parent_key", F.lit(None).cast("string").alias("parent")))
    pairs = cut_lineage(up.filter("level < 0").select("key", "ancestor_key"))
    # Two nodes above each other, or a node above itself by way of them, lie on a cycle; its smallest node gives up its parent.
    back = pairs.select(F.col("key").alias("ancestor_key"), F.col("ancestor_key").alias("key"))
    around = pairs.join(back, ["key", "ancestor_key"], "left_semi")
    cut = cut_lineage(around.groupBy("key").agg(F.min("ancestor_key").alias("least")).filter("key < least").select("key"))
    trees = single.join(cut.withColumn("_cut", F.lit(True)), "key", "left")
    trees = trees.select("key", "term", F.when(F.col("_cut").isNull(), F.col("parent_key")).alias("parent_key"))
    kept = trees.filter("parent_key IS NOT NULL").select(F.col("key").alias("child_key"), "parent_key")
    return trees, linked.join(kept, ["child_key", "parent_key"], "left_anti")


def intervals(edges: DataFrame) -> Intervals:
    """Label the nodes of ``edges`` (child, parent, child_key, parent_key); siblings are entered in order of their keys."""
    trees, more = _trees(edges)
    trees, more = cut_lineage(trees), cut_lineage(more)
    up = closure(trees.select(F.col("key").alias("child_key"), F.col("term").alias("child"), "parent_key", F.lit(None).cast("string").alias("parent")))
    pairs = cut_lineage(up.select("key", "ancestor_key", "level"))
    sizes = pairs.groupBy(F.col("ancestor_key").alias("key")).agg(F.count("*").alias("size"))
    sized = trees.join(sizes, "key")
    # Places that earlier siblings (for a root, earlier trees) take, and one for the parent itself.
    placed = preceding_total(sized, ["parent_key"], ["key"], "size", "before")
    steps = placed.select(F.col("key").alias("ancestor_key"), (F.col("before") + F.when(F.col("parent_key").isNull(), 0).otherwise(1)).alias("step"))
    entered = pairs.join(steps, "ancestor_key").groupBy("key").agg(F.sum("step").alias("enter"), (F.count("*") - 1).cast("int").alias("depth"))
    nodes = entered.join(sized.select("key", "term", "size"), "key")
    nodes = nodes.select("key", "term", "enter", (F.col("enter") + F.col("size") - 1).alias("leave"), "depth")
    return Intervals(cut_lineage(nodes.repartitionByRange("enter").sortWithinPartitions("enter"), "intervals"), more)


def _within(asked: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes entered inside each interval of ``asked`` (…, from, to): both sides meet in bins."""
    bins = F.sequence(F.floor(F.col("from") / BIN), F.floor(F.col("to") / BIN))
    wide = asked.withColumn("bin", F.explode(bins))
    return wide.join(nodes.withColumn("bin", F.floor(F.col("enter") / BIN)), "bin").filter("enter BETWEEN `from` AND `to`").drop("bin", "from", "to")


def _reach(tree: Intervals, starts: DataFrame) -> DataFrame:
    """``(asked, key, term, level)`` for each way that leads from an asked key to a node: itself at 0, and again if a cycle leads back."""
    at = tree.nodes.select(F.col("key").alias("_key"), F.col("enter").alias("from"), F.col("leave").alias("to"), F.col("depth").alias("_depth"))
    level = (F.col("depth") - F.col("base")).cast("int").alias("level")
    if tree.more.isEmpty():
        found = starts.join(at, F.col("asked") == F.col("_key")).select("asked", "from", "to", F.col("_depth").alias("base"))
        return _within(found, tree.nodes).select("asked", "key", "term", level)
    # A reached start (asked, key, distance) reaches every link that hangs in its interval, and so the link's child.
    links = tree.more.join(tree.nodes.select(F.col("key").alias("parent_key"), "enter", F.col("depth").alias("_at")), "parent_key")
    links = cut_lineage(links.select("enter", "_at", F.col("child_key").alias("to_key")))
    reached = new = cut_lineage(starts.select("asked", F.col("asked").alias("key"), F.lit(0).alias("distance")))
    back = []
    while not new.isEmpty():
        spans = new.join(at, F.col("key") == F.col("_key")).select("asked", "distance", "from", "to", "_depth")
        hops = _within(spans, links).select("asked", F.col("to_key").alias("key"), (F.col("distance") + F.col("_at") - F.col("_depth") + 1).alias("distance"))
        nearer = cut_lineage(hops.groupBy("asked", "key").agg(F.min("distance").alias("distance")))
        back.append(nearer.filter("key = asked"))
        known = reached.select("asked", "key", F.col("distance").alias("known"))
        new = cut_lineage(nearer.join(known, ["asked", "key"], "left").filter("known IS NULL OR distance < known").drop("known"))
        reached = cut_lineage(reached.union(new).groupBy("asked", "key").agg(F.min("distance").alias("distance")))
    found = reached.join(at, F.col("key") == F.col("_key")).select("asked", "from", "to", (F.col("_depth") - F.col("distance")).alias("base"))
    hits = _within(found, tree.nodes).select("asked", "key", "term", level)
    if not back:
        return hits
    again = union_all(back).join(tree.nodes.select("key", "term"), "key")
    return hits.union(again.select("asked", "key", "term", F.col("distance").cast("int")))


def below(tree: Intervals, asked: DataFrame) -> DataFrame:
    """``(asked, key, term, level)``: every node below each asked key, at its smallest distance; the keys themselves at 0.

    ``asked`` has one column of keys.
    """
    (name,) = asked.columns
    starts = asked.select(F.col(name).alias("asked")).filter("asked IS NOT NULL").distinct()
    hits = _reach(tree, starts)
    return hits if tree.more.isEmpty() else hits.groupBy("asked", "key").agg(F.min("term").alias("term"), F.min("level").alias("level"))


def descendants(tree: Intervals, term: str, max_depth: int | None = None, first_level: int = 1) -> DataFrame:
    """``(term, level)`` of everything below a term, as the walk of :func:`hierarchy.descendants` gives it.

    A term without children stands for itself, if it has a parent; the term itself is added at level 0 if no row names it.
    """
    tops = tree.nodes.filter(F.col("term") == term).select("key", "depth")
    hits = _reach(tree, tops.select(F.col("key").alias("asked")).distinct()).filter("level > 0")
    under = cut_lineage(hits.groupBy("key").agg(F.min("term").alias("term"), F.min("level").alias("level")))
    placed = tops.join(tree.more.select(F.col("child_key").alias("key")).distinct().withColumn("_more", F.lit(True)), "key", "left").filter("depth > 0 OR _more")
    alone = placed.filter(under.agg(F.count("*")).scalar() == 0).select(F.lit(term).alias("term"), F.lit(first_level).alias("level"))
    rows = under.select("term", (F.col("level") - 1 + first_level).alias("level")).union(alone)
    if max_depth is not None:
        rows = rows.filter(F.col("level") <= max_depth - 1 + first_level)
    absent = rows.filter(F.col("term") == term).agg(F.count("*")).scalar() == 0
    return rows.union(tree.nodes.sparkSession.range(1).filter(absent).select(F.lit(term).alias("term"), F.lit(0).alias("level")))


def place_descendants(tree: Intervals, place: str, max_depth: int | None = None) -> DataFrame:
    """Names of a place and the places below it, first children at level 0."""
    return descendants(tree, place, max_depth, first_level=0).select(F.col("term").alias("place"), "level")
