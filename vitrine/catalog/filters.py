"""Filters, searches, sorts and limits (survey sections 2.3, 2.6, 2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.catalog.registry import query
from vitrine.catalog.text import display
from vitrine.functions import text as tx
from vitrine.operators import aggregates as ag
from vitrine.operators import filters as fl
from vitrine.operators import joins as jn
from vitrine.operators import ordering as od
from vitrine.session import cut_lineage

LIVE = "(SELECT id FROM {misc} WHERE lifecyclestate <> 'deleted')"


@query("c01_not_deleted", f"SELECT o.id, o.objectnumber FROM {{objects}} o JOIN {LIVE} m ON m.id = o.id")
def _c01(c):
    return fl.not_deleted(c.objects.select("id", "objectnumber"), c.misc)


@query("c02_both_not_deleted", f"""SELECT h.id AS object_id, h2.id AS procedure_id FROM {{relations}} r JOIN {{hierarchy}} h ON h.name = r.subjectcsid
    JOIN {{hierarchy}} h2 ON h2.name = r.objectcsid JOIN {LIVE} a ON a.id = h.id JOIN {LIVE} b ON b.id = h2.id
    WHERE r.objectdocumenttype = 'Exhibition'""")
def _c02(c):
    pairs = jn.related(c.objects.select(F.col("id").alias("object_id")), c.relations, c.hierarchy, "procedure_id", "Exhibition", id="object_id")
    return fl.both_not_deleted(pairs, c.misc, "object_id", "procedure_id")


@query("c03_non_blank", """SELECT 'null' AS rule, id, objectname AS v FROM {objectnamegroup} WHERE objectname IS NOT NULL
    UNION ALL SELECT 'blank', id, condition FROM {conditionchecks_ext} WHERE condition IS NOT NULL AND condition <> ''""")
def _c03(c):
    a = fl.non_null(c.objectnamegroup, "objectname").select(F.lit("null").alias("rule"), "id", F.col("objectname").alias("v"))
    return a.union(fl.non_blank(c.conditionchecks_ext, "condition").select(F.lit("blank"), "id", "condition"))


KEYED = "(SELECT termdisplayname, replace(termdisplayname, ' ', '0') AS locationkey FROM {location_terms})"


@query("c04_key_search", f"""
    SELECT 'set' AS mode, * FROM (SELECT * FROM {KEYED} WHERE locationkey >= 'Bay03' ORDER BY locationkey LIMIT 5)
    UNION ALL SELECT 'exact', * FROM {KEYED} WHERE locationkey = 'Bay03,0Shelf03'
    UNION ALL SELECT 'prefix', * FROM {KEYED} WHERE locationkey LIKE 'Bay02%'
    UNION ALL SELECT 'range', * FROM {KEYED} WHERE locationkey >= 'Bay01' AND locationkey <= 'Bay04'""")
def _c04(c):
    t = c.location_terms.select("termdisplayname")
    runs = [("set", "Bay 3", "", 5), ("exact", "Bay 3, Shelf 3", "", 10), ("prefix", "Bay 2", "", None), ("range", "Bay 1", "Bay 4", None)]
    return ag.union_all([
        fl.key_search(t, "termdisplayname", mode, lo, hi, n).select(F.lit(mode).alias("mode"), "termdisplayname", "locationkey")
        for mode, lo, hi, n in runs
    ])


NUMBERED = f"(SELECT o.objectnumber, e.sortableobjectnumber FROM {{objects}} o JOIN {{objects_ext}} e ON e.id = o.id JOIN {LIVE} m ON m.id = o.id)"


def _numbered(c):
    return fl.not_deleted(c.objects.select("id", "objectnumber"), c.misc).join(c.objects_ext.select("id", "sortableobjectnumber"), "id").select(
        "objectnumber", "sortableobjectnumber")


@query("c05_object_range", f"""WITH t AS (SELECT * FROM {NUMBERED}),
    ends AS (SELECT (SELECT min(sortableobjectnumber) FROM t WHERE objectnumber = (SELECT min(objectnumber) FROM t)) AS a,
                    (SELECT min(sortableobjectnumber) FROM t WHERE objectnumber = (SELECT max(objectnumber) FROM t)) AS b)
    SELECT t.* FROM t, ends WHERE sortableobjectnumber BETWEEN a AND b ORDER BY sortableobjectnumber, objectnumber""")
def _c05(c):
    t = _numbered(c)
    ends = t.agg(F.min("objectnumber").alias("a"), F.max("objectnumber").alias("b"))
    lo, hi = ends.select("a").scalar(), ends.select("b").scalar()
    return fl.object_range(t, "objectnumber", "sortableobjectnumber", lo, hi)


@query("c06_nearest_bounds", f"""WITH t AS (SELECT * FROM {NUMBERED}),
    ends AS (SELECT min(CASE WHEN sortableobjectnumber >= '0000001995' THEN sortableobjectnumber END) AS a,
                    max(CASE WHEN sortableobjectnumber <= '0000002003.5' THEN sortableobjectnumber END) AS b FROM t)
    SELECT t.* FROM t, ends WHERE sortableobjectnumber BETWEEN a AND b ORDER BY sortableobjectnumber""")
def _c06(c):
    return fl.nearest_bounds(_numbered(c), "sortableobjectnumber", "0000001995", "0000002003.5")


@query("c07_in_or_all", """SELECT 'listed' AS rule, p_partkey FROM {part} WHERE p_type IN ('PROMO', 'LARGE')
    UNION ALL SELECT 'all', p_partkey FROM {part}""")
def _c07(c):
    listed = fl.in_or_all(c.part, "p_type", ["PROMO", "LARGE"]).select(F.lit("listed").alias("rule"), "p_partkey")
    return listed.union(fl.in_or_all(c.part, "p_type", []).select(F.lit("all"), "p_partkey"))


@query("c09_alive_dead", f"""WITH t AS (SELECT h.id, h2.id AS movement_id, m.reasonformove, h2.isversion FROM {{relations}} r
      JOIN {{hierarchy}} h ON h.name = r.subjectcsid JOIN {{hierarchy}} h2 ON h2.name = r.objectcsid
      JOIN {{movements}} m ON m.id = h2.id WHERE r.objectdocumenttype = 'Movement'),
    live AS (SELECT * FROM {LIVE} x)
    SELECT 'bed alive' AS rule, id, movement_id FROM t WHERE isversion IS NOT TRUE AND reasonformove <> 'Dead'
      AND id IN (SELECT id FROM live) AND movement_id IN (SELECT id FROM live)
    UNION ALL SELECT 'bed dead', id, movement_id FROM t WHERE isversion IS TRUE AND reasonformove = 'Dead' AND movement_id IN (SELECT id FROM live)
    UNION ALL SELECT 'taxa alive', id, movement_id FROM t WHERE isversion IS NOT TRUE AND id IN (SELECT id FROM live) AND movement_id IN (SELECT id FROM live)
    UNION ALL SELECT 'taxa dead', id, movement_id FROM t WHERE isversion IS NOT TRUE AND id IN (SELECT id FROM live) AND reasonformove = 'Dead'
    UNION ALL SELECT 'taxa both', id, movement_id FROM (SELECT DISTINCT * FROM t WHERE isversion IS NOT TRUE AND id IN (SELECT id FROM live)
      AND (reasonformove = 'Dead' OR movement_id IN (SELECT id FROM live))) d""")
def _c09(c):
    moves = jn.related(c.objects.select("id"), c.relations, c.hierarchy, "movement_id", "Movement")
    moves = moves.join(c.movements.select(F.col("id").alias("movement_id"), "reasonformove"), "movement_id")
    moves = moves.join(jn.records(c.hierarchy).select(F.col("id").alias("movement_id"), "isversion"), "movement_id")
    moves = cut_lineage(moves, "moves")
    runs = [("bed alive", "alive", "beds"), ("bed dead", "dead", "beds"), ("taxa alive", "alive", "taxa"), ("taxa dead", "dead", "taxa"),
            ("taxa both", "dead or alive", "taxa")]
    return ag.union_all([
        fl.alive_dead(moves, c.misc, mode, rules).select(F.lit(name).alias("rule"), "id", "movement_id") for name, mode, rules in runs
    ])


@query("c10_term_lookup", f"""WITH t AS (SELECT n_nationkey AS k, lower(n_name) AS term FROM {{nation}}
      UNION ALL SELECT c_custkey + 1000000, c_mktsegment FROM {{customer}} UNION ALL SELECT -1, ''),
    a AS (SELECT lower({display('refname')}) AS shown, min(refname) AS refname FROM {{places}} GROUP BY 1)
    SELECT k, term, CASE WHEN term = '' THEN '' ELSE coalesce(refname, term) END AS found,
      CASE WHEN term = '' THEN '' ELSE coalesce(refname, '') END AS found_or_blank FROM t LEFT JOIN a ON a.shown = lower(term)""")
def _c10(c):
    terms = c.nation.select(F.col("n_nationkey").cast("bigint").alias("k"), F.lower("n_name").alias("term")).union(
        c.customer.select(F.col("c_custkey") + 1000000, "c_mktsegment"))
    terms = terms.union(c.nation.filter("n_nationkey = 0").select(F.lit(-1).cast("bigint"), F.lit("")))
    found = fl.term_lookup(terms, "term", c.places)
    return fl.term_lookup(found, "term", c.places, missing="blank", out="found_or_blank")


@query("c11_exists_check", f"""SELECT name, objectnumber, objectnumber IN (SELECT o.objectnumber FROM {{objects}} o JOIN {LIVE} m ON m.id = o.id) AS found FROM {{manifest}}""")
def _c11(c):
    known = fl.not_deleted(c.objects.select("id", "objectnumber"), c.misc)
    return fl.exists_check(c.manifest.select("name", "objectnumber"), "objectnumber", known, "objectnumber")


@query("c12_exclude_listed", f"""SELECT id, termdisplayname FROM {{location_terms}} WHERE termdisplayname NOT IN
    (SELECT computedcurrentlocationdisplay FROM {{objects_ext}})""")
def _c12(c):
    return fl.exclude_listed(c.location_terms.select("id", "termdisplayname"), "termdisplayname", c.objects_ext, "computedcurrentlocationdisplay")


WIDTH_LINE = "id || '|' || objectnumber || '|' || physicaldescription"


def _lines(c):
    return c.objects.select(F.concat_ws("|", "id", "objectnumber", "physicaldescription", F.when(F.col("numberofobjects") % 4 == 0, F.lit("more"))).alias("value"))


@query("c13_split_by_width", f"""WITH t AS (SELECT {WIDTH_LINE} || CASE WHEN numberofobjects % 4 = 0 THEN '|more' ELSE '' END AS value FROM {{objects}})
    SELECT CASE WHEN len(string_split(value, '|')) = 4 THEN 'good' ELSE 'error' END AS outcome, value FROM t""")
def _c13(c):
    good, bad = fl.split_by_width(_lines(c), 4, "|")
    return good.select(F.lit("good").alias("outcome"), "value").union(bad.select(F.lit("error"), "value"))


LATLONG = """CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN 'N ' || c_custkey || ',5'
    ELSE (c_custkey % 120) || '.5, -' || (c_custkey % 200) || '.25' END"""


@query("c14_split_latlong", f"""WITH t AS (SELECT c_custkey, {LATLONG} AS latlong FROM {{customer}})
    SELECT c_custkey, latlong, CASE WHEN latlong = '' OR (regexp_full_match(latlong, '[0-9, .-]*')
      AND abs(CAST(split_part(latlong, ',', 1) AS DOUBLE)) < 90 AND abs(CAST(trim(split_part(latlong, ',', 2)) AS DOUBLE)) < 180) THEN 'good' ELSE 'error' END AS outcome FROM t""")
def _c14(c):
    k = F.col("c_custkey")
    value = F.when(k % 11 == 0, "").when(k % 13 == 0, F.concat(F.lit("N "), k.cast("string"), F.lit(",5"))).otherwise(
        F.concat((k % 120).cast("string"), F.lit(".5, -"), (k % 200).cast("string"), F.lit(".25")))
    good, bad = fl.split_latlong(c.customer.select("c_custkey", value.alias("latlong")), "latlong")
    return good.withColumn("outcome", F.lit("good")).union(bad.withColumn("outcome", F.lit("error")))


@query("c15_suggest", f"""
    SELECT * FROM (SELECT DISTINCT 'location' AS kind, termdisplayname AS v FROM {{location_terms}} t JOIN {{hierarchy}} h ON h.id = t.id
       JOIN {LIVE} m ON m.id = h.parentid WHERE lower(termdisplayname) LIKE 'bay 1%' ORDER BY replace(termdisplayname, ' ', '0') LIMIT 30) a
    UNION ALL SELECT * FROM (SELECT 'object', objectnumber FROM {NUMBERED} n WHERE objectnumber LIKE '199%' ORDER BY sortableobjectnumber, objectnumber LIMIT 30) b
    UNION ALL SELECT * FROM (SELECT DISTINCT 'group', title FROM {{groups}} g JOIN {LIVE} m ON m.id = g.id WHERE title LIKE '1%' ORDER BY title LIMIT 30) c
    UNION ALL SELECT * FROM (SELECT DISTINCT 'place', termname FROM {{place_terms}} t JOIN {{hierarchy}} h ON h.id = t.id JOIN {LIVE} m ON m.id = h.parentid
       WHERE termname ILIKE '%tion_1%' AND termtype = 'descriptor' ORDER BY termname LIMIT 30) d""")
def _c15(c):
    def live_terms(terms, list_name, *cols):
        parent = jn.members(c.hierarchy, list_name).select(F.col("member_id").alias("id"), "parentid")
        return fl.not_deleted(terms.select("id", *cols).join(parent, "id"), c.misc, "parentid")

    location = live_terms(c.location_terms, "locTermGroupList", "termdisplayname").withColumn("key", tx.location_key("termdisplayname"))
    location = fl.suggest(location, "termdisplayname", "Bay 1", ignore_case=True, n=30, order="key")
    number = fl.suggest(_numbered(c), "objectnumber", "199", n=30, order="sortableobjectnumber")
    group = fl.suggest(fl.not_deleted(c.groups, c.misc), "title", "1", n=30)
    place = live_terms(c.place_terms.filter("termtype = 'descriptor'"), "placeTermGroupList", "termname")
    place = fl.suggest(place, "termname", "tion_1", how="infix", ignore_case=True, n=30)
    parts = [("location", location, "termdisplayname"), ("object", number, "objectnumber"), ("group", group, "title"), ("place", place, "termname")]
    return ag.union_all([df.select(F.lit(kind).alias("kind"), F.col(col).alias("v")) for kind, df, col in parts])


@query("c16_dedupe_handled", """SELECT o_orderpriority, o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER (
    PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey) AS n FROM {orders}) t WHERE n = 1""")
def _c16(c):
    first = od.distinct_on(c.orders, ["o_orderpriority", "o_orderstatus"], "-o_orderdate", "o_orderkey")
    return first.select("o_orderpriority", "o_orderstatus", "o_orderkey")


@query("c17_keyword_match", r"""SELECT 'keyword' AS how, doc_id FROM {documents} WHERE regexp_matches(lower(text), '(^|\W)the(\W|$)')
    UNION ALL SELECT 'phrase', doc_id FROM {documents} WHERE contains(lower(text), 'on the')
    UNION ALL SELECT 'exact', doc_id FROM {documents} WHERE lang = 'fr'""")
def _c17(c):
    d = c.documents
    runs = [("keyword", "text", "The"), ("phrase", "text", "on the"), ("exact", "lang", "fr")]
    return ag.union_all([fl.keyword_match(d, col, term, how).select(F.lit(how).alias("how"), "doc_id") for how, col, term in runs])


@query("c18_blocked_labels", """SELECT c_custkey, c_mktsegment FROM {customer} WHERE c_mktsegment NOT IN ('MACHINERY') AND c_mktsegment NOT LIKE '%HOLD%'""")
def _c18(c):
    return fl.blocked_labels(c.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", ["MACHINERY"], ["HOLD"])


@query("c19_skip_moved", f"""SELECT id, {display('computedcrate')} AS crate FROM {{objects_ext}}
    WHERE art <> 'yes' AND {display('computedcrate')} = 'Crate 4'""")
def _c19(c):
    rows = c.objects_ext.select(
        "id", tx.refname_display("computedcrate").alias("crate"),
        F.when(F.col("art") == "yes", "do not move").otherwise("moved").alias("objectstatus"))
    return fl.skip_moved(rows, "Crate 4").select("id", "crate")


# ---- sorts, limits, sets ---------------------------------------------------------------------


@query("g01_order_by", "SELECT id, creditline FROM {acquisitions} ORDER BY creditline DESC NULLS FIRST, id")
def _g01(c):
    return fl.order_by(c.acquisitions.select("id", "creditline"), "-creditline", "id")


@query("g02_limit_n", "SELECT c_custkey, c_name FROM {customer} ORDER BY c_name, c_custkey LIMIT 500")
def _g02(c):
    return fl.limit_n(c.customer.select("c_custkey", "c_name"), 500, "c_name", "c_custkey")


@query("g03_top_n", "SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 25")
def _g03(c):
    return fl.top_n(ag.value_counts(c.orders, "o_custkey"), "n", 25, "o_custkey")


@query("g04_tail_n", "SELECT event_id, ts, event_type, props FROM {events} ORDER BY ts DESC, event_id LIMIT 100")
def _g04(c):
    return fl.tail_n(c.events.select("event_id", "ts", "event_type", "props"), "ts", 100, "event_id")


@query("g05_union_distinct", """SELECT l_partkey, l_returnflag AS flag FROM {lineitem} WHERE l_returnflag <> 'N'
    UNION SELECT l_partkey, l_linestatus FROM {lineitem} WHERE l_linestatus = 'O'""")
def _g05(c):
    a = c.lineitem.filter("l_returnflag <> 'N'").select("l_partkey", F.col("l_returnflag").alias("flag"))
    return fl.union_distinct(a, c.lineitem.filter("l_linestatus = 'O'").select("l_partkey", F.col("l_linestatus").alias("flag")))


@query("g06_reverse_order", "SELECT termdisplayname FROM {location_terms} ORDER BY termdisplayname DESC")
def _g06(c):
    return fl.reverse_order(c.location_terms.select("termdisplayname"), "termdisplayname")


# ---- first rows, ranks, numbers -------------------------------------------------------------


@query("f01_rank_in_list", """SELECT l_partkey, l_linenumber, l_returnflag, l_orderkey,
    rank() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_returnflag DESC) AS rank FROM {lineitem}""")
def _f01(c):
    rows = c.lineitem.select("l_partkey", "l_linenumber", "l_returnflag", "l_orderkey")
    return od.rank_in_list(rows, ["l_partkey"], ["l_linenumber", "-l_returnflag"])


@query("f02_distinct_on", """SELECT l_suppkey, l_returnflag, l_shipdate, l_orderkey FROM (SELECT *, row_number() OVER (
    PARTITION BY l_suppkey, l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber) AS n FROM {lineitem}) t WHERE n = 1""")
def _f02(c):
    first = od.distinct_on(c.lineitem, ["l_suppkey", "l_returnflag"], "l_shipdate", "l_orderkey", "l_linenumber")
    return first.select("l_suppkey", "l_returnflag", "l_shipdate", "l_orderkey")


@query("f03_latest_by", f"""SELECT id, locationdate, movement_id, currentlocation FROM (SELECT h.id, m.id AS movement_id, m.locationdate,
      {display('m.currentlocation')} AS currentlocation, row_number() OVER (PARTITION BY h.id ORDER BY m.locationdate DESC, m.id) AS n
    FROM {{relations}} r JOIN {{hierarchy}} h ON h.name = r.subjectcsid JOIN {{hierarchy}} h2 ON h2.name = r.objectcsid
    JOIN {{movements}} m ON m.id = h2.id WHERE r.objectdocumenttype = 'Movement') t WHERE n = 1""")
def _f03(c):
    moves = jn.related(c.objects.select("id"), c.relations, c.hierarchy, "movement_id", "Movement")
    m = c.movements.select(F.col("id").alias("movement_id"), "locationdate", tx.refname_display("currentlocation").alias("currentlocation"))
    return od.latest_by(moves.join(m, "movement_id"), ["id"], "locationdate", "movement_id").select(
        "id", "locationdate", "movement_id", "currentlocation")


@query("f04_sequence_id", "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS seq FROM {orders}")
def _f04(c):
    return od.sequence_id(c.orders.select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey")


@query("f05_first_match", "SELECT l_partkey, min(l_orderkey) AS l_orderkey FROM {lineitem} GROUP BY l_partkey")
def _f05(c):
    return od.first_match(c.lineitem, "l_partkey", "l_orderkey")
