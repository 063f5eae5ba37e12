"""Authority trees: edges, closures, paths and headings.

Walks from a term go one level per round over the edge table; closures double their
reach in each.  Rounds are cut off through the shared scratch folder, so plans stay short
and a lost executor only repeats its own round.  A visited anti join ends cycles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import refname_display, tree_label
from vitrine.operators.aggregates import union_all
from vitrine.operators.filters import not_deleted, sort_keys
from vitrine.operators.joins import with_csid
from vitrine.operators.ordering import preceding_total
from vitrine.session import cut_lineage, scratch_path

ROOT = "ROOT"


def authority_edges(records: DataFrame, relations: DataFrame, hierarchy: DataFrame, misc: DataFrame, primarytype: str) -> DataFrame:
    """``(child, parent, child_key, parent_key)`` of an authority; a root's parent is null."""
    typed = hierarchy.filter(F.startswith("primarytype", F.lit(primarytype)))
    child = not_deleted(records.select("id", "refname"), misc)
    child = with_csid(child, typed, out="child_key").select(refname_display("refname").alias("child"), "child_key")
    parent = with_csid(records.select("id", "refname"), typed, out="parent_key")
    parent = parent.select(refname_display("refname").alias("parent"), "parent_key")
    edges = relations.filter("relationshiptype = 'hasBroader'").select("subjectcsid", "objectcsid").distinct()
    rows = child.join(edges, F.col("child_key") == F.col("subjectcsid"), "left")
    rows = rows.join(parent, F.col("objectcsid") == F.col("parent_key"), "left")
    return rows.select("child", "parent", "child_key", "parent_key").distinct()


def ordered_edges(edges: DataFrame) -> DataFrame:
    return edges.orderBy(*sort_keys("parent", "child", "child_key"))


def _linked(edges: DataFrame) -> DataFrame:
    """Edges that have a parent, stored once because every round joins them."""
    return cut_lineage(edges.filter("parent_key IS NOT NULL").select("child", "child_key", "parent", "parent_key").distinct())


def children(edges: DataFrame, term: str) -> DataFrame:
    return edges.filter(F.col("parent") == term).select(
        F.col("child").alias("term"), F.col("child_key").alias("key"), F.col("parent_key").alias("broader_key"), F.col("parent").alias("broader")
    )


def _walk(seed: DataFrame, step, key: list[str], max_depth: int | None = None) -> DataFrame:
    """Union of ``seed`` and the rows each round adds, until a round adds none (or after ``max_depth`` rounds).

    Rows whose key was seen are dropped, so cycles end.
    """
    path, folders = scratch_path(seed.sparkSession, "walk"), []
    stored = seed.sparkSession.read.schema(seed.schema)

    def add(rows: DataFrame) -> DataFrame:
        folders.append(f"{path}/{len(folders)}")
        rows.select(*seed.columns).write.parquet(folders[-1])
        return stored.parquet(folders[-1])

    frontier = add(seed)
    while not frontier.isEmpty() and (max_depth is None or len(folders) <= max_depth):
        seen = stored.parquet(*folders).select(*key)
        frontier = add(step(frontier).dropDuplicates(key).join(seen, key, "left_anti"))
    return stored.parquet(*folders)


def descendants(edges: DataFrame, term: str, max_depth: int | None = None, first_level: int = 1) -> DataFrame:
    """``(term, level)`` of everything below a term.

    A term without children stands for itself; the term itself is added at level 0
    if no row names it.
    """
    linked = _linked(edges)
    below = linked.filter(F.col("parent") == term)
    own = linked.filter(F.col("child") == term)
    none_below = below.agg(F.count("*")).scalar() == 0
    seed = below.union(own.filter(none_below)).select(
        F.col("child").alias("term"), F.col("child_key").alias("key"), F.lit(first_level).alias("level")
    ).distinct()

    def step(frontier: DataFrame) -> DataFrame:
        keys = frontier.select(F.col("key").alias("_from"), "level")
        found = linked.join(keys, F.col("parent_key") == F.col("_from"))
        return found.select(F.col("child").alias("term"), F.col("child_key").alias("key"), (F.col("level") + 1).alias("level"))

    walked = _walk(seed, step, ["key"], None if max_depth is None else max_depth - 1).select("term", "level")
    absent = walked.filter(F.col("term") == term).agg(F.count("*")).scalar() == 0
    itself = walked.sparkSession.range(1).filter(absent).select(F.lit(term).alias("term"), F.lit(0).alias("level"))
    return walked.union(itself)


def place_descendants(edges: DataFrame, place: str, max_depth: int | None = None) -> DataFrame:
    """Names of a place and the places below it, first children at level 0."""
    return descendants(edges, place, max_depth, first_level=0).select(F.col("term").alias("place"), "level")


def closure(edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``(key, ancestor_key, ancestor, level)`` for every node: itself at 0, parents at -1, …

    Steps double: pairs ``reach`` levels apart are joined with all pairs up to that far, so rounds
    grow with the logarithm of the depth, and a tree's pairs are made once each.  A pair keeps its
    nearest level, which ends cycles.
    """
    nodes = edges.select("child_key", "child").distinct()
    itself = nodes.select(F.col("child_key").alias("key"), F.col("child_key").alias("ancestor_key"), F.col("child").alias("ancestor"), F.lit(0).alias("level"))
    up = edges.filter("parent_key IS NOT NULL AND child_key != parent_key").dropDuplicates(["child_key", "parent_key"])
    new = cut_lineage(up.select(F.col("child_key").alias("key"), F.col("parent_key").alias("ancestor_key"), F.col("parent").alias("ancestor"), F.lit(-1).alias("level")))
    rounds, reach = [new], 1
    while not new.isEmpty() and (max_depth is None or reach < max_depth):
        pairs = union_all(rounds)
        far = pairs.filter(F.col("level") == -reach).select("key", F.col("ancestor_key").alias("_at"))
        on = pairs.select(F.col("key").alias("_from"), "ancestor_key", "ancestor", (F.col("level") - reach).alias("level"))
        found = far.join(on, F.col("_at") == F.col("_from")).filter("key != ancestor_key")
        nearest = found.groupBy("key", "ancestor_key").agg(F.min("ancestor").alias("ancestor"), F.max("level").alias("level"))
        new = cut_lineage(nearest.join(pairs, ["key", "ancestor_key"], "left_anti"))
        rounds.append(new)
        reach *= 2
    out = union_all([itself, *rounds])
    return out if max_depth is None else out.filter(F.col("level") >= -max_depth)


def ancestors(edges: DataFrame, key: str, max_depth: int | None = None) -> DataFrame:
    """A node (level 0) and what lies above it, root first."""
    up = _linked(edges).select(F.col("child_key").alias("_child"), "parent_key", "parent")
    seed = edges.filter(F.col("child_key") == key).select(F.col("child").alias("term"), F.col("child_key").alias("key"), F.lit(0).alias("level")).distinct()

    def step(frontier: DataFrame) -> DataFrame:
        found = frontier.select(F.col("key").alias("_at"), "level").join(up, F.col("_at") == F.col("_child"))
        return found.select(F.col("parent").alias("term"), F.col("parent_key").alias("key"), (F.col("level") - 1).alias("level"))

    return _walk(seed, step, ["key"], max_depth).orderBy(*sort_keys("level", "key"))


def tree_paths(edges: DataFrame, max_depth: int | None = None, sep: str = " > ") -> DataFrame:
    """One row per node reachable from a root: path of names, depth, leaf flag.

    A path that would come back to a node already on it ends there, so a cycle below a
    root is walked once; a cycle with no root above it does not appear.
    """
    linked = cut_lineage(edges.select("child", "child_key", "parent_key").distinct())
    below = linked.filter("parent_key IS NOT NULL")
    parents = below.select(F.col("parent_key").alias("_p")).distinct()
    seed = linked.filter("parent_key IS NULL").select(
        F.col("child_key").alias("key"), F.col("child").alias("label"), F.concat(F.lit(ROOT + sep), "child").alias("path"), F.lit(1).alias("depth"), F.array("child_key").alias("on_path")
    )

    def step(frontier: DataFrame) -> DataFrame:
        at = frontier.select(F.col("key").alias("_at"), "path", "depth", "on_path")
        found = below.join(at, F.col("parent_key") == F.col("_at")).filter(~F.array_contains("on_path", F.col("child_key")))
        return found.select(
            F.col("child_key").alias("key"), F.col("child").alias("label"), F.concat("path", F.lit(sep), "child").alias("path"), (F.col("depth") + 1).alias("depth"),
            F.concat("on_path", F.array("child_key")).alias("on_path"),
        )

    frontier = cut_lineage(seed)
    rounds = [frontier]
    while not frontier.isEmpty() and (max_depth is None or len(rounds) <= max_depth):
        frontier = cut_lineage(step(frontier))
        rounds.append(frontier)
    nodes = union_all(rounds)
    joined = nodes.join(parents, F.col("key") == F.col("_p"), "left")
    return joined.select("key", "label", "path", "depth", F.col("_p").isNull().alias("is_leaf"))


def child_lists(edges: DataFrame) -> DataFrame:
    """Children of each parent in label order, one row per child.

    A root that is a leaf is marked, and shown as ``no parent >> label``.  Long form,
    since one parent may own a third of all nodes.
    """
    rows = edges.select(F.coalesce("parent_key", F.lit(ROOT)).alias("parent_key"), "child_key", tree_label("child").alias("label")).distinct()
    parents = edges.filter("parent_key IS NOT NULL").select(F.col("parent_key").alias("_p")).distinct()
    rows = rows.join(parents, F.col("child_key") == F.col("_p"), "left").withColumn("is_leaf", F.col("_p").isNull()).drop("_p")
    lone = F.col("is_leaf") & (F.col("parent_key") == ROOT)
    rows = rows.withColumn("label", F.when(lone, F.concat(F.lit("no parent >> "), "label")).otherwise(F.col("label")))
    numbered = preceding_total(rows.withColumn("_one", F.lit(1).cast("bigint")), ["parent_key"], ["label", "child_key"], "_one", "pos")
    return numbered.drop("_one")


def closure_of(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """As :func:`closure`, for the given keys (one column) alone: pairs of other nodes are never made.

    Each round takes one step up from the pairs that the round before added.
    """
    asked = keys.select(F.col(keys.columns[0]).alias("key")).distinct()
    nodes = edges.select(F.col("child_key").alias("key"), F.col("child").alias("ancestor")).distinct().join(asked, "key", "left_semi")
    seed = nodes.select("key", F.col("key").alias("ancestor_key"), "ancestor", F.lit(0).alias("level"))
    up = _linked(edges).select(F.col("child_key").alias("_child"), "parent_key", "parent").dropDuplicates(["_child", "parent_key"])

    def step(frontier: DataFrame) -> DataFrame:
        found = frontier.select("key", F.col("ancestor_key").alias("_at"), "level").join(up, F.col("_at") == F.col("_child"))
        return found.select("key", F.col("parent_key").alias("ancestor_key"), F.col("parent").alias("ancestor"), (F.col("level") - 1).alias("level"))

    return _walk(seed, step, ["key", "ancestor_key"])


def headings(edges: DataFrame, sep: str = " :: ", keys: DataFrame | None = None) -> DataFrame:
    """``(key, term, heading)``: ancestor names root first, or ``No parent :: term``; of the given keys, or of all nodes."""
    up = closure(edges) if keys is None else closure_of(edges, keys)
    # levels fall from 0, and depth is bounded by the tree, so the cell stays short
    lists = up.groupBy("key").agg(
        F.expr(f"listagg(ancestor, '{sep}') WITHIN GROUP (ORDER BY level, ancestor_key)").alias("path"),
        F.count("*").alias("n"),
        F.max(F.when(F.col("level") == 0, F.col("ancestor"))).alias("term"),
    )
    alone = F.concat(F.lit("No parent :: "), "term")
    return lists.select("key", "term", F.when(F.col("n") == 1, alone).otherwise(F.col("path")).alias("heading"), (F.col("n") == 1).alias("alone"))


def culture_heading(df: DataFrame, refname: str, authority: DataFrame, hierarchy: DataFrame, edges: DataFrame, out: str = "heading") -> DataFrame:
    """Adds the heading of each row's term, and a key that sorts the unplaced ones last.

    Only terms that the rows name are looked up and walked from.
    """
    named = cut_lineage(df.select(F.col(refname).alias("_ref")).filter("_ref IS NOT NULL").distinct(), "terms")
    terms = authority.select("id", F.col("refname").alias("_ref")).join(named, "_ref", "left_semi")
    keys = cut_lineage(with_csid(terms, hierarchy, out="_key").select("_ref", "_key"), "terms")
    heads = keys.join(headings(edges, keys=keys.select("_key")), F.col("_key") == F.col("key")).select("_ref", "heading", "alone")
    heads = heads.groupBy("_ref").agg(F.min("heading").alias("_heading"), F.min("alone").alias("_alone"))
    joined = df.join(heads, F.col(refname) == F.col("_ref"), "left")
    unknown = F.concat(F.lit("No parent :: "), refname_display(refname))
    heading: Column = F.when(F.col(refname).isNull(), F.lit("No cultural group specified")).otherwise(F.coalesce("_heading", unknown))
    last = F.col(refname).isNull() | F.coalesce("_alone", F.lit(True))
    return joined.withColumn(out, heading).withColumn("sort_last", last).drop("_ref", "_heading", "_alone")
