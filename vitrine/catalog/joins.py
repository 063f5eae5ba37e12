"""Joins and aggregates (survey sections 2.4, 2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.catalog.filters import LIVE
from vitrine.catalog.registry import query
from vitrine.catalog.text import cleaned, display
from vitrine.functions import text as tx
from vitrine.operators import aggregates as ag
from vitrine.operators import joins as jn
from vitrine.operators import ordering as od

S = "␥"


@query("d01_with_csid", "SELECT o.id, o.objectnumber, h.name AS csid FROM {objects} o JOIN {hierarchy} h ON h.id = o.id")
def _d01(c):
    return jn.with_csid(c.objects.select("id", "objectnumber"), c.hierarchy)


def _first(alias: str, list_name: str, table: str, pos: int = 0, parent: str = "o.id") -> str:
    return (f"LEFT JOIN (SELECT h.parentid, g.* FROM {{hierarchy}} h LEFT JOIN {{{table}}} g ON g.id = h.id "
            f"WHERE h.name LIKE '%:{list_name}' AND h.pos = {pos}) {alias} ON {alias}.parentid = {parent}")


@query("d02_first_of_group", f"""SELECT o.id, n.objectname, p.assocpeople FROM {{objects}} o {_first('n', 'objectNameList', 'objectnamegroup')}
    LEFT JOIN (SELECT h.parentid, g.assocpeople FROM {{hierarchy}} h LEFT JOIN {{assocpeoplegroup}} g ON g.id = h.id
      WHERE h.primarytype = 'assocPeopleGroup' AND (h.pos = 0 OR h.pos IS NULL)) p ON p.parentid = o.id""")
def _d02(c):
    named = jn.first_of_group(c.objects.select("id"), c.hierarchy, c.objectnamegroup, ["objectname"], list_name="objectNameList")
    return jn.first_of_group(named, c.hierarchy, c.assocpeoplegroup, ["assocpeople"], primarytype="assocPeopleGroup", or_null=True)


@query("d03_nth_of_group", f"SELECT o.id, t.taxon FROM {{objects}} o {_first('t', 'taxonomicIdentGroupList', 'taxonomicidentgroup', 1)}")
def _d03(c):
    return jn.nth_of_group(c.objects.select("id"), c.hierarchy, c.taxonomicidentgroup, ["taxon"], 1, list_name="taxonomicIdentGroupList")


@query("d04_first_item", """SELECT o.id, a.item AS comments, b.item AS photo FROM {objects} o LEFT JOIN {comments} a ON a.id = o.id AND a.pos = 0
    LEFT JOIN {photos} b ON b.id = o.id AND b.pos = 0""")
def _d04(c):
    return jn.first_item(jn.first_item(c.objects.select("id"), c.comments, "comments"), c.photos, "photo")


@query("d05_related", """SELECT 'typed' AS how, o.id, g.id AS other FROM {objects} o JOIN {hierarchy} h ON h.id = o.id JOIN {relations} r ON r.subjectcsid = h.name
      AND r.objectdocumenttype = 'Group' JOIN {hierarchy} h2 ON h2.name = r.objectcsid JOIN {groups} g ON g.id = h2.id
    UNION ALL SELECT 'reverse', o.id, l.id FROM {loansin} l JOIN {hierarchy} h ON h.id = l.id JOIN {relations} r ON r.objectcsid = h.name
      JOIN {hierarchy} h2 ON h2.name = r.subjectcsid JOIN {objects} o ON o.id = h2.id""")
def _d05(c):
    typed = jn.related(c.objects.select("id"), c.relations, c.hierarchy, "other", "Group").join(
        c.groups.select(F.col("id").alias("other")), "other", "left_semi")
    loans = jn.related(c.loansin.select(F.col("id").alias("other")), c.relations, c.hierarchy, "id", direction="object", id="other")
    loans = loans.join(c.objects.select("id"), "id", "left_semi")
    return typed.select(F.lit("typed").alias("how"), "id", "other").union(loans.select(F.lit("reverse"), "id", "other"))


@query("d06_self_related", """SELECT o.id, p.id AS other_id FROM {objects} o JOIN {objects_ext} e ON e.id = o.id AND e.iscomponent = 'yes'
    JOIN {hierarchy} h ON h.id = o.id JOIN {relations} r ON r.subjectcsid = h.name AND r.objectdocumenttype = 'CollectionObject'
    JOIN {hierarchy} h2 ON h2.name = r.objectcsid JOIN {objects} p ON p.id = h2.id JOIN {objects_ext} f ON f.id = p.id AND f.iscomponent = 'no'""")
def _d06(c):
    return jn.self_related(c.objects, c.objects_ext, c.relations, c.hierarchy, "yes", "no")


@query("d07_full_outer_then_inner", f"""SELECT o.id, a.acquisitionreferencenumber FROM {{objects}} o
    FULL OUTER JOIN {{hierarchy}} h ON h.id = o.id
    FULL OUTER JOIN {{relations}} r ON r.subjectcsid = h.name AND r.objectdocumenttype = 'Acquisition'
    FULL OUTER JOIN {{hierarchy}} h2 ON h2.name = r.objectcsid FULL OUTER JOIN {{acquisitions}} a ON a.id = h2.id
    JOIN {LIVE} m ON m.id = o.id""")
def _d07(c):
    from vitrine.operators.filters import not_deleted

    base = jn.with_csid(not_deleted(c.objects.select("id"), c.misc), c.hierarchy, how="left")
    edges = c.relations.filter("objectdocumenttype = 'Acquisition'").select("subjectcsid", "objectcsid")
    rows = base.join(edges, F.col("csid") == F.col("subjectcsid"), "left")
    rows = jn.with_id(rows, c.hierarchy, "objectcsid", "acq", how="left")
    acquisitions = c.acquisitions.select(F.col("id").alias("acq"), "acquisitionreferencenumber")
    return rows.join(acquisitions, "acq", "left").select("id", "acquisitionreferencenumber")


@query("d08_join_on_expression", f"""SELECT m.id, t.termname FROM {{movements}} m LEFT JOIN {{location_terms}} t ON t.termdisplayname = {display('m.currentlocation')}""")
def _d08(c):
    joined = jn.join_on_expression(
        c.movements.select("id", "currentlocation"), c.location_terms.select("termdisplayname", "termname"),
        tx.refname_display("currentlocation"), F.col("termdisplayname"), "left")
    return joined.select("id", "termname")


@query("d09_comma_join", """SELECT o.id, d.dimension, d.value FROM {hierarchy} h, {dimensionsubgroup} d, {measuredpartgroup} p, {hierarchy} h2, {objects} o
    WHERE d.id = h.id AND p.id = h.parentid AND p.id = h2.id AND o.id = h2.parentid""")
def _d09(c):
    from vitrine.plans.extract import object_dimensions

    return object_dimensions(c).select("id", "dimension", "value")


@query("d10_left_then_inner", f"""SELECT o.id, g.title FROM {{objects}} o JOIN {{hierarchy}} h ON h.id = o.id
    JOIN {{relations}} r ON r.subjectcsid = h.name AND r.objectdocumenttype = 'Group' JOIN {{hierarchy}} h2 ON h2.name = r.objectcsid
    LEFT JOIN {{groups}} g ON g.id = h2.id JOIN {LIVE} m ON m.id = g.id""")
def _d10(c):
    from vitrine.operators.filters import not_deleted

    pairs = jn.related(c.objects.select("id"), c.relations, c.hierarchy, "gid", "Group")
    groups = not_deleted(c.groups.select(F.col("id").alias("gid"), "title"), c.misc, "gid")
    return pairs.join(groups, "gid").select("id", "title")


@query("d11_stitch", """WITH a AS (SELECT o_custkey AS k, count(*) AS n_orders FROM {orders} GROUP BY 1),
    b AS (SELECT s_suppkey * 20 AS k, s_name FROM {supplier}), c AS (SELECT o_custkey AS k, max(o_orderpriority) AS priority FROM {orders} GROUP BY 1)
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name, coalesce(CAST(n_orders AS VARCHAR), '') AS n_orders, coalesce(s_name, '') AS s_name, coalesce(priority, '') AS priority
    FROM {customer} LEFT JOIN a ON a.k = c_custkey LEFT JOIN b ON b.k = c_custkey LEFT JOIN c ON c.k = c_custkey""")
def _d11(c):
    """The last frame repeats its keys: a row an order."""
    base = c.customer.select(F.col("c_custkey").cast("string").alias("id"), "c_name")
    a = c.orders.groupBy(F.col("o_custkey").cast("string").alias("id")).agg(F.count("*").alias("n_orders"))
    b = c.supplier.select((F.col("s_suppkey") * 20).cast("string").alias("id"), "s_name")
    return jn.stitch(base, [a, b, c.orders.select(F.col("o_custkey").cast("string").alias("id"), F.col("o_orderpriority").alias("priority"))])


@query("d12_merge_list", """SELECT p_partkey, p_name, coalesce(o, '') AS orders FROM {part} LEFT JOIN (
    SELECT l_partkey, string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY l_orderkey) AS o FROM {lineitem} GROUP BY 1) l ON l_partkey = p_partkey""")
def _d12(c):
    many = c.lineitem.select("l_partkey", F.col("l_orderkey").cast("string").alias("o"), "l_orderkey")
    return jn.merge_list(c.part.select("p_partkey", "p_name"), many, "p_partkey", "o", "orders", many_key="l_partkey", order="l_orderkey")


@query("d13_media_rows", f"""SELECT h2.name AS objectcsid, o.objectnumber, h1.name AS mediacsid, d.description, b.name AS filename, d.creator AS creatorrefname,
      d.creator, d.blobcsid, d.copyrightstatement, d.identificationnumber, d.rightsholder AS rightsholderrefname, d.rightsholder, d.contributor
    FROM {{media}} d JOIN {LIVE} m ON m.id = d.id LEFT JOIN {{hierarchy}} h1 ON h1.id = d.id JOIN {{relations}} r ON r.objectcsid = h1.name
    LEFT JOIN {{hierarchy}} h2 ON h2.name = r.subjectcsid LEFT JOIN {{objects}} o ON o.id = h2.id
    JOIN {{hierarchy}} h3 ON h3.name = d.blobcsid LEFT JOIN {{blobs}} b ON b.id = h3.id""")
def _d13(c):
    return jn.media_rows(c)


@query("d14_blob_digest", """SELECT k.id, k.updatedat, k.updatedby, b.name, t.data AS md5 FROM {blobs} b JOIN {picture} p ON p.id = b.repositoryid
    JOIN {hierarchy} h ON h.parentid = p.id AND h.primarytype = 'view' JOIN {view} v ON v.id = h.id AND v.tag = 'original'
    JOIN {hierarchy} g ON g.parentid = v.id AND g.primarytype = 'content' JOIN {content} t ON t.id = g.id JOIN {core} k ON k.id = b.id""")
def _d14(c):
    return jn.blob_digest(c)


@query("d15_semi_in", "SELECT o_orderkey FROM {orders} WHERE o_orderkey IN (SELECT l_orderkey FROM {lineitem} WHERE l_quantity > 45)")
def _d15(c):
    return jn.semi_in(c.orders.select("o_orderkey"), "o_orderkey", c.lineitem.filter("l_quantity > 45"), "l_orderkey")


@query("d16_anti_not_in", """SELECT 'plain' AS how, id FROM {movements} WHERE reasonformove NOT IN (SELECT o_orderpriority FROM {orders} WHERE o_orderpriority LIKE '1%')
    UNION ALL SELECT 'with null', id FROM {movements} WHERE reasonformove NOT IN (SELECT reasonformove FROM {movements} WHERE reasonformove IS NULL)
    UNION ALL SELECT 'empty', id FROM {movements} WHERE reasonformove NOT IN (SELECT o_orderpriority FROM {orders} WHERE o_orderpriority = 'none')""")
def _d16(c):
    m = c.movements.select("id", "reasonformove")
    refs = [
        ("plain", c.orders.filter("o_orderpriority LIKE '1%'"), "o_orderpriority"),
        ("with null", c.movements.filter("reasonformove IS NULL"), "reasonformove"),
        ("empty", c.orders.filter("o_orderpriority = 'none'"), "o_orderpriority"),
    ]
    return ag.union_all([jn.anti_not_in(m, "reasonformove", ref, col).select(F.lit(how).alias("how"), "id") for how, ref, col in refs])


@query("d17_scalar_cross", """SELECT * FROM (SELECT count(*) AS n_orders FROM {orders}) a, (SELECT CAST(sum(p_size) AS BIGINT) AS total_size FROM {part}) b,
    (SELECT max(event_id) AS last_event FROM {events}) c""")
def _d17(c):
    return jn.scalar_row(
        c.orders.sparkSession, n_orders=c.orders.agg(F.count("*")), total_size=c.part.agg(F.sum("p_size")), last_event=c.events.agg(F.max("event_id")))


@query("d18_site_owner_join", f"""SELECT f.id, {display('f.item')} AS site, {display('g.placeowner')} AS owner FROM {{contentplaces}} f
    JOIN {{places}} p ON p.refname = f.item JOIN {LIVE} m ON m.id = p.id
    JOIN {{hierarchy}} h ON h.parentid = p.id AND h.name = 'places:placeOwnerGroupList' JOIN {{placeownergroup}} g ON g.id = h.id""")
def _d18(c):
    from vitrine.plans.reports import site_owners

    sites = c.contentplaces.select("id", "item")
    joined = sites.join(site_owners(c), F.col("item") == F.col("site_refname"))
    return joined.select("id", tx.refname_display("item").alias("site"), tx.refname_display("placeowner").alias("owner"))


@query("d19_attach_object_id", f"""SELECT name, objectnumber, handling, CASE WHEN handling IN ('slide', 'borndigital', 'mediaonly') THEN 'N/A: ' || handling
    ELSE coalesce((SELECT min(h.name) FROM {{objects}} o JOIN {{hierarchy}} h ON h.id = o.id JOIN {LIVE} m ON m.id = o.id
      WHERE o.objectnumber = x.objectnumber), '') END AS objectcsid FROM {{manifest}} x""")
def _d19(c):
    return jn.attach_object_id(c.manifest.select("name", "objectnumber", "handling"), c.objects, c.hierarchy, c.misc)


@query("d20_two_way_edges", """SELECT 'd-' || doc_id AS subjectcsid, 'Media' AS subjectdocumenttype, 'p-' || (doc_id % 50) AS objectcsid, 'CollectionObject' AS objectdocumenttype,
      'affects' AS relationshiptype FROM {documents}
    UNION ALL SELECT 'p-' || (doc_id % 50), 'CollectionObject', 'd-' || doc_id, 'Media', 'affects' FROM {documents}""")
def _d20(c):
    links = c.documents.select(
        F.concat(F.lit("d-"), F.col("doc_id").cast("string")).alias("m"), F.concat(F.lit("p-"), (F.col("doc_id") % 50).cast("string")).alias("o"))
    return jn.two_way_edges(links, "m", "Media", "o", "CollectionObject")


# ---- aggregates ------------------------------------------------------------------------------


@query("e01_multi_value", f"SELECT id, string_agg({cleaned('item')}, '{S}' ORDER BY pos, {cleaned('item')}) AS comments_ss FROM {{comments}} GROUP BY id")
def _e01(c):
    return ag.multi_value(c.comments, "id", {"comments_ss": tx.collapse_ctrl_ws("item")})


@query("e02_multi_value_distinct", f"""SELECT k, string_agg(DISTINCT flag, '{S}' ORDER BY flag) AS flags, string_agg(DISTINCT st, '{S}' ORDER BY st) AS states
    FROM {{member}} GROUP BY k""")
def _e02(c):
    return ag.multi_value_distinct(c.member, "k", {"flags": F.col("flag"), "states": F.col("st")})


@query("e03_multi_value_then_clean", f"""SELECT id, string_agg(DISTINCT {display('item')}, '{S}' ORDER BY {display('item')}) AS places,
    {display(f"string_agg(DISTINCT item, '{S}' ORDER BY item)")} AS last_place FROM {{contentplaces}} GROUP BY id""")
def _e03(c):
    clean = ag.multi_value_then_clean(c.contentplaces, "id", "item", "places")
    return clean.join(ag.multi_value_then_clean(c.contentplaces, "id", "item", "last_place", compat=True), "id")


@query("e05_distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM {lineitem}")
def _e05(c):
    return c.lineitem.select("l_partkey", "l_suppkey").distinct()


@query("e06_basic_aggs", """SELECT l_returnflag, l_linestatus, count(*) AS row_count, count(l_linenumber) AS value_count, CAST(sum(l_linenumber) AS BIGINT) AS total,
    max(l_linenumber) AS greatest FROM {lineitem} GROUP BY 1, 2""")
def _e06(c):
    return ag.basic_aggs(c.lineitem, ["l_returnflag", "l_linestatus"], "l_linenumber")


@query("e07_value_counts", "SELECT objectdocumenttype, count(*) AS n FROM {relations} GROUP BY 1")
def _e07(c):
    return ag.value_counts(c.relations, "objectdocumenttype")


@query("e15_profile_columns", r"""WITH t AS (SELECT 1 AS col, 'c_mktsegment' AS fieldname, c_mktsegment AS v FROM {customer}
    UNION ALL SELECT 2, 'tags', unnest(string_split(c_mktsegment || '|' || (c_custkey % 40) || '||' || (c_custkey % 7), '|')) FROM {customer}
    UNION ALL SELECT 3, 'blank', '' FROM {customer})
    SELECT col, fieldname, count(DISTINCT CASE WHEN v <> '' THEN v END) AS types, count(CASE WHEN v <> '' THEN 1 END) AS tokens FROM t GROUP BY 1, 2""")
def _e15(c):
    k = F.col("c_custkey")
    tags = F.concat("c_mktsegment", F.lit("|"), (k % 40).cast("string"), F.lit("||"), (k % 7).cast("string"))
    return ag.profile_columns(c.customer.select("c_mktsegment", tags.alias("tags"), F.lit("").alias("blank")))


@query("e16_width_histogram", "SELECT CAST(len(string_split(text, ' ')) AS INT) AS fields, count(*) AS n_lines FROM {documents} GROUP BY 1")
def _e16(c):
    return ag.width_histogram(c.documents, " ", "text")


@query("e17_counter", "SELECT l_suppkey AS key, count(*) AS n FROM {lineitem} GROUP BY 1 ORDER BY n DESC, key LIMIT 10")
def _e17(c):
    return ag.most_common(ag.counter(c.lineitem, "l_suppkey"), 10)


@query("e18_counter_combine", """WITH a AS (SELECT l_suppkey AS key, count(*) AS n FROM {lineitem} WHERE l_returnflag = 'R' GROUP BY 1),
    b AS (SELECT l_suppkey + 5 AS key, count(*) AS n FROM {lineitem} WHERE l_returnflag = 'A' GROUP BY 1),
    j AS (SELECT coalesce(a.key, b.key) AS key, coalesce(a.n, 0) AS x, coalesce(b.n, 0) AS y FROM a FULL JOIN b ON a.key = b.key)
    SELECT '+' AS op, key, x + y AS n FROM j WHERE x + y > 0 UNION ALL SELECT '-', key, x - y FROM j WHERE x - y > 0
    UNION ALL SELECT '|', key, greatest(x, y) FROM j WHERE greatest(x, y) > 0 UNION ALL SELECT '&', key, least(x, y) FROM j WHERE least(x, y) > 0""")
def _e18(c):
    a = ag.counter(c.lineitem.filter("l_returnflag = 'R'"), "l_suppkey")
    b = ag.counter(c.lineitem.filter("l_returnflag = 'A'").withColumn("key", F.col("l_suppkey") + 5), "key")
    return ag.union_all([ag.counter_combine(a, b, op).select(F.lit(op).alias("op"), "key", "n") for op in "+-|&"])


@query("e19_counter_elements", "SELECT p_partkey AS key FROM (SELECT p_partkey, unnest(generate_series(1, p_size - 10)) AS i FROM {part} WHERE p_size > 10) t")
def _e19(c):
    return ag.counter_elements(c.part.select(F.col("p_partkey").alias("key"), (F.col("p_size") - 10).cast("bigint").alias("n")), chunk=16)


@query("e20_holding_summary", """WITH t AS (SELECT p_brand, CASE p_partkey % 3 WHEN 0 THEN p_name || ' ex ' || p_type WHEN 1 THEN p_name || ' var. ' || p_brand ELSE p_name END AS n FROM {part})
    SELECT count(*) AS items, count(DISTINCT p_brand) AS accessions, count(DISTINCT n) AS names,
    count(DISTINCT split_part(split_part(n, ' ex ', 1), ' var. ', 1)) AS species, count(DISTINCT split_part(n, ' ', 1)) AS genera FROM t""")
def _e20(c):
    from vitrine.catalog.text import _taxon_text

    rows = _taxon_text(c).join(c.part.select("p_partkey", "p_brand"), "p_partkey")
    return ag.holding_summary(rows, "p_brand", "t")


@query("e21_report_totals", "SELECT count(*) AS objects, count(DISTINCT l_suppkey) AS locations, count(DISTINCT l_partkey) AS headings FROM {lineitem}")
def _e21(c):
    return ag.report_totals(c.lineitem, "l_suppkey", "l_partkey")


@query("e24_cumulative_counts", """SELECT event_type, period, n, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY period) AS BIGINT) AS cumulative FROM (
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS period, count(*) AS n FROM {events} GROUP BY 1, 2) t""")
def _e24(c):
    return od.cumulative_counts(c.events, "event_type", tx.plain_date("ts"))


@query("e25_match_counts", """SELECT count(*) AS frame_rows, count(c_custkey) AS matched, count(*) - count(c_custkey) AS unmatched, (SELECT count(*) FROM {customer}) AS base_rows
    FROM (SELECT l_orderkey FROM {lineitem}) f LEFT JOIN {customer} ON c_custkey = l_orderkey""")
def _e25(c):
    return jn.match_counts(c.customer, c.lineitem, "c_custkey", "l_orderkey")
