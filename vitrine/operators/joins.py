"""Joins over records, lists and relations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.filters import not_deleted
from vitrine.session import cut_lineage


# ---- ids ------------------------------------------------------------------------------


# Member types whose list has no schema in its name.
BARE_PARTS = ["view", "content"]


#: Column that a stored hierarchy is partitioned by, and its value for rows of no list.
LIST, NO_LIST = "list", "-"


def with_lists(hierarchy: DataFrame) -> DataFrame:
    """The hierarchy with each member's list, its name without the schema before it; tables partitioned by it are read list by list."""
    return hierarchy.withColumn(LIST, F.when(F.col("name").contains(":"), F.substring_index("name", ":", -1)).otherwise(F.lit(NO_LIST)))


def records(hierarchy: DataFrame) -> DataFrame:
    """The rows of records.

    Rows of list members, which carry their list's name, are left out: they are most of
    the table, share a few names, and would meet in a few tasks of any join by name.
    """
    if LIST in hierarchy.columns:
        rows = hierarchy.filter(F.col(LIST) == NO_LIST)
    else:
        rows = hierarchy.filter(F.col("name").isNull() | ~F.col("name").contains(":"))
    if "primarytype" in hierarchy.columns:
        rows = rows.filter(F.col("primarytype").isNull() | ~F.col("primarytype").isin(BARE_PARTS))
    return rows


def csids(hierarchy: DataFrame, id: str = "id", csid: str = "csid") -> DataFrame:
    """``(id, csid)`` of the records."""
    return records(hierarchy).select(F.col("id").alias(id), F.col("name").alias(csid))


def with_csid(df: DataFrame, hierarchy: DataFrame, id: str = "id", out: str = "csid", how: str = "inner") -> DataFrame:
    """Adds the external id of each record."""
    return df.join(csids(hierarchy, "_hid", out), F.col(id) == F.col("_hid"), how).drop("_hid")


def with_id(df: DataFrame, hierarchy: DataFrame, csid: str, out: str, how: str = "inner") -> DataFrame:
    """Adds the record id of each external id."""
    return df.join(csids(hierarchy, out, "_csid"), F.col(csid) == F.col("_csid"), how).drop("_csid")


# ---- repeating groups ------------------------------------------------------------------


def list_named(name: Column, wanted: str) -> Column:
    """Whether a member belongs to the list; lists are stored as ``schema:list``."""
    return F.substring_index(name, ":", -1) == wanted


def in_list(hierarchy: DataFrame, wanted: str) -> Column:
    """Whether a row of the hierarchy belongs to the list."""
    return F.col(LIST) == wanted if LIST in hierarchy.columns else list_named(F.col("name"), wanted)


def members(
    hierarchy: DataFrame, list_name: str | None = None, primarytype: str | None = None, pos: int | None = None, or_null: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(parentid, member_id, pos)`` of a repeating group, by list name or member type; ``keep`` names further columns of its rows."""
    rows = hierarchy
    if list_name is not None:
        rows = rows.filter(in_list(rows, list_name))
    if primarytype is not None:
        rows = rows.filter(F.col("primarytype") == primarytype)
    if pos is not None:
        at = F.col("pos") == pos
        rows = rows.filter(at | F.col("pos").isNull() if or_null else at)
    return rows.select("parentid", F.col("id").alias("member_id"), "pos", *keep)


def first_of_group(
    df: DataFrame, hierarchy: DataFrame, group: DataFrame, fields: Mapping[str, str] | Sequence[str],
    list_name: str | None = None, primarytype: str | None = None, pos: int = 0, or_null: bool = False, id: str = "id",
) -> DataFrame:
    """Left join of one member of a repeating group, by default the first.

    The list is filtered before the join, so only its own rows are shuffled.
    ``fields`` names the group's columns, or maps them to output names.
    """
    named = dict(fields) if isinstance(fields, Mapping) else {f: f for f in fields}
    at = members(hierarchy, list_name, primarytype, pos, or_null).drop("pos")
    value = group.select(F.col("id").alias("_gid"), *[F.col(f).alias(out) for f, out in named.items()])
    one = at.join(value, F.col("member_id") == F.col("_gid"), "left").drop("member_id", "_gid")
    return df.join(one, F.col(id) == F.col("parentid"), "left").drop("parentid")


def nth_of_group(df, hierarchy, group, fields, pos: int, **kw) -> DataFrame:
    return first_of_group(df, hierarchy, group, fields, pos=pos, **kw)


def first_item(df: DataFrame, items: DataFrame, out: str, pos: int = 0, or_null: bool = False, id: str = "id") -> DataFrame:
    """Left join of one element of a list of scalars."""
    at = F.col("pos") == pos
    one = items.filter(at | F.col("pos").isNull() if or_null else at).select(F.col("id").alias("_iid"), F.col("item").alias(out))
    return df.join(one, F.col(id) == F.col("_iid"), "left").drop("_iid")


def group_values(
    hierarchy: DataFrame, groups: Mapping[str, tuple[str, DataFrame, Column]], pos: int | None = 0, or_null: bool = False,
    by: str = "name", ids: DataFrame | None = None,
) -> DataFrame:
    """Long form ``(id, field, pos, value)`` of many groups, with one pass over ``hierarchy``.

    ``groups`` maps an output field to (list, group table, value), where the list is
    a list name or, with ``by="primarytype"``, a member type.  ``ids`` keeps only the
    members of those parents.
    """
    # Fields of one table and list are read in one pass over the table, and lie in one row until the members are found.
    tables: dict[tuple[str, int], tuple[DataFrame, list[Column]]] = {}
    for field, (list_name, table, value) in groups.items():
        cells = tables.setdefault((list_name, id(table)), (table, []))[1]
        cells.append(F.struct(F.lit(field).alias("field"), value.cast("string").alias("value")))
    values = None
    for (list_name, _), (table, cells) in tables.items():
        one = table.select(F.col("id").alias("_gid"), F.lit(list_name).alias("_list"), F.array(*cells).alias("_cells"))
        values = one if values is None else values.unionByName(one)
    rows = hierarchy
    if pos is not None:
        at = F.col("pos") == pos
        rows = rows.filter(at | F.col("pos").isNull() if or_null else at)
    name = F.col(LIST) if LIST in hierarchy.columns else F.substring_index("name", ":", -1)
    tag = name if by == "name" else F.col("primarytype")
    rows = rows.withColumn("_tag", tag).filter(F.col("_tag").isin(sorted({list_name for list_name, *_ in groups.values()})))
    rows = rows.select("parentid", F.col("id").alias("member_id"), "pos", "_tag")
    if ids is not None:
        rows = rows.join(ids.select(F.col("id").alias("_want")).distinct(), F.col("parentid") == F.col("_want"), "left_semi")
    joined = rows.join(values, (F.col("member_id") == F.col("_gid")) & (F.col("_tag") == F.col("_list")))
    return joined.select(F.col("parentid").alias("id"), "pos", F.inline("_cells")).select("id", "field", "pos", "value")


def cell_maps(long: DataFrame, key: str = "id", *more: Column) -> DataFrame:
    """``(key, cells)``: the ``(field, value)`` rows of each key as a map; of a repeated field the greatest value counts.

    Rows are dealt by key once, for both the fields and the map.  ``more`` adds aggregates over the fields' rows (field, value).
    """
    single = long.repartition(key).groupBy(key, "field").agg(F.max("value").alias("value"))
    return single.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("cells"), *more)


def pivot_fields(long: DataFrame, fields: Sequence[str], key: str = "id", *more: Column) -> DataFrame:
    """``(key, field, value)`` as one row per key."""
    maps = cell_maps(long, key, *more)
    rest = [c for c in maps.columns if c not in (key, "cells")]
    return maps.select(key, *[F.col("cells")[f].alias(f) for f in fields], *rest)


def long_form(fields: Sequence[str]) -> Column:
    """Generator of ``(field, value)`` rows from columns of one row."""
    cells = ", ".join(f"struct('{f}' AS field, CAST(`{f}` AS STRING) AS value)" for f in fields)
    return F.expr(f"inline(array({cells}))")


# ---- relations ----------------------------------------------------------------------------


def related(
    df: DataFrame, relations: DataFrame, hierarchy: DataFrame, out: str,
    doc_type: str | None = None, direction: str = "subject", id: str = "id", csid: str | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Adds the id of each related record, one row per edge.

    ``subject``: ``df`` is the subject and the edge's object is the target;
    ``object``: the reverse.  ``doc_type`` filters on the target's type.  A hub
    record makes its edges one hot key; the engine splits such a join partition.
    ``keep`` names edge columns to carry along.
    """
    here, there = ("subject", "object") if direction == "subject" else ("object", "subject")
    edges = relations
    if doc_type is not None:
        edges = edges.filter(F.col(f"{there}documenttype") == doc_type)
    edges = edges.select(F.col(f"{here}csid").alias("_here"), F.col(f"{there}csid").alias("_there"), *keep)
    rows = df if csid else with_csid(df, hierarchy, id, "_csid0")
    joined = rows.join(edges, F.col(csid or "_csid0") == F.col("_here"))
    joined = with_id(joined, hierarchy, "_there", out)
    return joined.drop("_here", "_there", "_csid0")


def self_related(
    records: DataFrame, flags: DataFrame, relations: DataFrame, hierarchy: DataFrame,
    this_component: str | None, other_component: str | None,
) -> DataFrame:
    """Pairs of related records of one table: ``id``, ``other_id``, by component flag of each side."""

    def wanted(value: str | None, alias: str) -> DataFrame:
        rows = flags if value is None else flags.filter(F.col("iscomponent") == value)
        return rows.select(F.col("id").alias(alias))

    pairs = related(records.select("id"), relations, hierarchy, "other_id", "CollectionObject")
    pairs = pairs.join(records.select(F.col("id").alias("_o")), F.col("other_id") == F.col("_o"), "left_semi")
    pairs = pairs.join(wanted(this_component, "_a"), F.col("id") == F.col("_a"), "left_semi")
    return pairs.join(wanted(other_component, "_b"), F.col("other_id") == F.col("_b"), "left_semi")


def join_on_expression(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, how: str = "inner") -> DataFrame:
    """Equi-join on computed keys."""
    joined = left.withColumn("_lk", left_key).join(right.withColumn("_rk", right_key), F.col("_lk") == F.col("_rk"), how)
    return joined.drop("_lk", "_rk")


def two_way_edges(df: DataFrame, subject: str, subject_type: str, object: str, object_type: str, relation: str = "affects") -> DataFrame:
    """Each link as an edge and its reverse, from one pass over the rows."""

    def edge(s: str, st: str, o: str, ot: str) -> Column:
        return F.struct(
            F.col(s).alias("subjectcsid"), F.lit(st).alias("subjectdocumenttype"),
            F.col(o).alias("objectcsid"), F.lit(ot).alias("objectdocumenttype"), F.lit(relation).alias("relationshiptype"),
        )

    both = F.array(edge(subject, subject_type, object, object_type), edge(object, object_type, subject, subject_type))
    return df.select(F.inline(both))


# ---- membership ------------------------------------------------------------------------------


def semi_in(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    keys = ref.select(F.col(ref_col).alias("_in"))
    return df.join(keys, F.col(col) == F.col("_in"), "left_semi")


def anti_not_in(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """SQL ``NOT IN``: nothing when the list holds a null, everything when it is empty.

    Written as a shuffled anti join and two scalar subqueries, because the
    built-in null-aware join must broadcast the list whatever its size.
    """
    stats = ref.agg(F.count("*").alias("n"), F.count(ref_col).alias("known"))
    n, known = stats.select("n").scalar(), stats.select("known").scalar()
    keys = ref.filter(F.col(ref_col).isNotNull()).select(F.col(ref_col).alias("_out"))
    rest = df.join(keys, F.col(col) == F.col("_out"), "left_anti")
    return rest.filter((n == 0) | ((n == known) & F.col(col).isNotNull()))


def scalar_row(spark: SparkSession, **totals: DataFrame) -> DataFrame:
    """One row of independent one-value aggregates, each a scalar subquery."""
    return spark.range(1).select(*[frame.scalar().alias(name) for name, frame in totals.items()])


# ---- stitching ------------------------------------------------------------------------------


def last_of_key(base: DataFrame, key: str, arrival: str | None) -> DataFrame:
    """One row per key: the last to arrive, or any one of equal standing."""
    if arrival is None:
        return base.dropDuplicates([key])
    from vitrine.operators.ordering import distinct_on

    return distinct_on(base, [key], f"-{arrival}")


def stitch(base: DataFrame, frames: Sequence[DataFrame], key: str = "id", arrival: str | None = None, blank: str = "") -> DataFrame:
    """Adds the columns of each frame to the base rows.

    Keys the base does not know are dropped, missing values become blanks, and the
    base never gains or loses a key.  Of a frame's rows that repeat a key the greatest counts.
    """
    out = last_of_key(base, key, arrival) if arrival else base
    for frame in frames:
        rest = [c for c in frame.columns if c != key]
        one = frame.groupBy(key).agg(F.max(F.struct(*rest)).alias("_cells")).select(key, "_cells.*")
        out = out.join(one, key, "left")
    added = [c for frame in frames for c in frame.columns if c != key]
    return out.select(*base.columns, *[F.coalesce(F.col(c).cast("string"), F.lit(blank)).alias(c) for c in added])


def stitch_long(base: DataFrame, cells: DataFrame, fields: Sequence[str], key: str = "id", blank: str = "") -> DataFrame:
    """As :func:`stitch`, for cells in long form ``(key, field, value)``.

    One pivot by key and one join, whatever the number of fields.
    """
    joined = base.join(pivot_fields(cells, fields, key), key, "left")
    return joined.select(*base.columns, *[F.coalesce(F.col(f), F.lit(blank)).alias(f) for f in fields])


def duplicate_keys(frame: DataFrame, key: str = "id") -> DataFrame:
    """Keys that a frame repeats; such rows would make a stitched row too wide."""
    return frame.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def match_counts(base: DataFrame, frame: DataFrame, key: str = "id", frame_key: str | None = None) -> DataFrame:
    """Rows of both inputs, and how many frame rows found their key in the base."""
    known = base.select(F.col(key).alias("_k")).distinct()
    probe = frame.select(F.col(frame_key or key).alias("_f"))
    hits = probe.join(known, F.col("_f") == F.col("_k"), "left")
    counts = hits.agg(
        F.count("*").alias("frame_rows"), F.count("_k").alias("matched"), (F.count("*") - F.count("_k")).alias("unmatched")
    )
    return counts.withColumn("base_rows", base.agg(F.count("*")).scalar())


def merge_list(
    base: DataFrame, many: DataFrame, key: str, value: str, out: str, sep: str = ",", many_key: str | None = None, order: str | None = None
) -> DataFrame:
    """Adds the joined list of child values of each key; a key without any gets a blank."""
    lists = many.groupBy(F.col(many_key or key).alias("_mk")).agg(
        F.expr(f"listagg(`{value}`, '{sep}') WITHIN GROUP (ORDER BY `{order or value}`)").alias(out)
    )
    joined = base.join(lists, F.col(key) == F.col("_mk"), "left").drop("_mk")
    return joined.withColumn(out, F.coalesce(out, F.lit("")))


# ---- media ---------------------------------------------------------------------------------


def media_rows(c) -> DataFrame:
    """Media that some record points at, with the object if there is one, and the blob's name.

    The ids of the media are stored before they meet the links, so their size is known, and where they are few the links need not be dealt.
    """
    live = not_deleted(c.media.select(F.col("id").alias("_media")).distinct(), c.misc, "_media")
    known = cut_lineage(with_csid(live, c.hierarchy, "_media", "mediacsid"), "media")
    edges = c.relations.select("subjectcsid", F.col("objectcsid").alias("_m"))
    linked = known.join(edges, F.col("mediacsid") == F.col("_m")).drop("_m")
    rows = c.media.join(linked, F.col("id") == F.col("_media")).drop("_media")

    objects = csids(c.hierarchy, "_oid", "objectcsid")
    rows = rows.join(objects, F.col("subjectcsid") == F.col("objectcsid"), "left")
    numbers = c.objects.select(F.col("id").alias("_n"), "objectnumber")
    rows = rows.join(numbers, F.col("_oid") == F.col("_n"), "left")

    rows = with_id(rows, c.hierarchy, "blobcsid", "_bid")
    names = c.blobs.select(F.col("id").alias("_b"), F.col("name").alias("filename"))
    rows = rows.join(names, F.col("_bid") == F.col("_b"), "left")
    return rows.select(
        "objectcsid", "objectnumber", "mediacsid", "description", "filename", F.col("creator").alias("creatorrefname"), "creator",
        "blobcsid", "copyrightstatement", "identificationnumber", F.col("rightsholder").alias("rightsholderrefname"),
        "rightsholder", "contributor",
    )


def blob_digest(c) -> DataFrame:
    """Content digest and audit columns of each blob's original view."""
    views = members(c.hierarchy, primarytype="view").select(F.col("parentid").alias("_pic"), F.col("member_id").alias("_view"))
    parts = members(c.hierarchy, primarytype="content").select(F.col("parentid").alias("_v"), F.col("member_id").alias("_content"))
    original = c.view.filter(F.col("tag") == "original").select(F.col("id").alias("_vid"))
    data = c.content.select(F.col("id").alias("_cid"), F.col("data").alias("md5"))
    core = c.core.select("id", "updatedat", "updatedby")
    rows = c.blobs.select(F.col("id").alias("_b"), "name", "repositoryid")
    rows = rows.join(c.picture.select(F.col("id").alias("_p")), F.col("repositoryid") == F.col("_p"), "left_semi")
    rows = rows.join(views, F.col("repositoryid") == F.col("_pic")).join(original, F.col("_view") == F.col("_vid"), "left_semi")
    rows = rows.join(parts, F.col("_view") == F.col("_v")).join(data, F.col("_content") == F.col("_cid"))
    return rows.join(core, F.col("_b") == F.col("id")).select("id", "updatedat", "updatedby", "name", "md5")


# Handling codes whose media stand alone.
UNLINKED_HANDLING = ["slide", "borndigital", "mediaonly"]


def attach_object_id(manifest: DataFrame, objects: DataFrame, hierarchy: DataFrame, misc: DataFrame) -> DataFrame:
    """Adds ``objectcsid`` to media rows: the object's, a note when none is wanted, or a blank."""
    live = with_csid(not_deleted(objects.select("id", "objectnumber"), misc), hierarchy, out="_csid")
    known = live.groupBy(F.col("objectnumber").alias("_number")).agg(F.min("_csid").alias("_csid"))
    joined = manifest.join(known, F.col("objectnumber") == F.col("_number"), "left")
    alone = F.col("handling").isin(UNLINKED_HANDLING)
    value = F.when(alone, F.concat(F.lit("N/A: "), "handling")).otherwise(F.coalesce("_csid", F.lit("")))
    return joined.withColumn("objectcsid", value).drop("_number", "_csid")
