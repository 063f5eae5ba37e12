"""User-level reports (survey section 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.catalog.extracts import LIVE_OBJECTS, first
from vitrine.catalog.filters import LIVE, NUMBERED
from vitrine.catalog.registry import query
from vitrine.catalog.text import display, display_first
from vitrine.catalog.trees import CLOSURE, down, place_edges, place_tree
from vitrine.operators import aggregates as ag
from vitrine.operators import intervals as iv
from vitrine.plans import reports as rp


def located(movement: str = "subject") -> str:
    other = "object" if movement == "subject" else "subject"
    return f"""SELECT t.termdisplayname, lc.refname AS movementrefname, m.id AS moveid, h2.name AS movementcsid, m.locationdate, m.movementnote,
      r.subjectdocumenttype, r.objectdocumenttype, h3.name AS objectcsid, o.*,
      e.sortableobjectnumber, e.computedcrate, e.inventorycount,
      CASE WHEN e.computedcrate IS NULL THEN t.termdisplayname ELSE concat(t.termdisplayname, ': ', {display('e.computedcrate')}) END AS storagelocation,
      replace(concat(t.termdisplayname, ': ', {display('e.computedcrate')}), ' ', '0') AS locationkey, {display('e.computedcrate')} AS crate
    FROM {{location_terms}} t JOIN {{hierarchy}} h1 ON h1.id = t.id JOIN {{locations}} lc ON lc.id = h1.parentid
    JOIN {{movements}} m ON m.currentlocation = lc.refname JOIN {{hierarchy}} h2 ON h2.id = m.id JOIN {{relations}} r ON r.{movement}csid = h2.name
    JOIN {{hierarchy}} h3 ON h3.name = r.{other}csid JOIN {LIVE_OBJECTS} o ON o.id = h3.id AND o.computedcurrentlocation = lc.refname
    LEFT JOIN {{objects_ext}} e ON e.id = o.id"""


def pick(sql: str, keys: str, order: str) -> str:
    return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS pick FROM ({sql}) p) q WHERE pick = 1"


INVENTORY = pick(f"SELECT o.*, n.objectname FROM ({located()}) o {first('n', 'objectNameList', 'objectnamegroup')}",
                 "locationkey, sortableobjectnumber, objectcsid", "moveid")


@query("r17_inventory", f"""SELECT storagelocation, locationkey, locationdate, objectnumber, numberofobjects AS objectcount, coalesce({display('objectname')}, '') AS objectname,
    movementcsid, movementrefname, objectcsid, moveid, subjectdocumenttype, objectdocumenttype, sortableobjectnumber, computedcrate AS craterefname, crate FROM ({INVENTORY}) z""")
def _r17(c):
    return rp.inventory(c)


@query("r17_inventory_titles", f"""SELECT storagelocation, locationkey, locationdate, objectnumber, numberofobjects AS objectcount, title, movementcsid, movementrefname, objectcsid, moveid,
    subjectdocumenttype, objectdocumenttype, computedcrate AS craterefname, crate, {display('artist')} AS artist FROM (
    {pick(f"SELECT o.*, n.title, g.objectproductionperson AS artist FROM ({located('object')}) o {first('n', 'titleGroupList', 'titlegroup')} {first('g', 'objectProductionPersonGroupList', 'objectproductionpersongroup')}",
          'locationkey, objectnumber, objectcsid', 'moveid')}) z""")
def _r17_titles(c):
    return rp.inventory(c, variant="titles")


ACQUIRED = f"""(SELECT r.subjectcsid, a.id AS accid, a.acquisitionreferencenumber AS accnum, h.name AS acccsid, w.item AS pdrefname FROM {{relations}} r
    JOIN {{hierarchy}} h ON h.name = r.objectcsid JOIN {{acquisitions}} a ON a.id = h.id LEFT JOIN {{owners}} w ON w.id = a.id AND (w.pos = 0 OR w.pos IS NULL)
    WHERE r.objectdocumenttype = 'Acquisition')"""
ETHNO_JOINS = f"""{first('n', 'objectNameList', 'objectnamegroup')} {first('x', 'altNumGroupList', 'othernumber')} {first('f', 'fieldCollectionDateGroup', 'structureddategroup')}
    {first('ap', 'assocPeopleGroupList', 'assocpeoplegroup')}
    LEFT JOIN {{contentplaces}} pl ON pl.id = o.id AND pl.pos = 0 LEFT JOIN {{contentconcepts}} ec ON ec.id = o.id AND ec.pos = 0
    LEFT JOIN {{briefdescriptions}} bd ON bd.id = o.id AND bd.pos = 0 LEFT JOIN {{fieldcollectors}} fc ON fc.id = o.id AND fc.pos = 0
    LEFT JOIN {{responsibledepartments}} rd ON rd.id = o.id AND rd.pos = 0 LEFT JOIN {ACQUIRED} aq ON aq.subjectcsid = o.objectcsid"""
ETHNO_SELECT = f"""n.objectname, x.numbervalue, x.numbertype, f.datedisplaydate AS fieldcollectiondate, ap.assocpeople AS cgrefname, pl.item AS fcprefname, ec.item AS efcrefname,
    bd.item AS brief, fc.item AS pcrefname, rd.item AS department, aq.accid, aq.accnum, aq.acccsid, aq.pdrefname"""
ETHNO_OUT = f"""objectnumber, coalesce({display('objectname')}, '') AS objectname, numberofobjects AS objectcount, {display_first('fcprefname')} AS fieldcollectionplace,
    {display_first('cgrefname')} AS culturalgroup, objectcsid, {display_first('efcrefname')} AS ethnographicfilecode, fcprefname, cgrefname, efcrefname, computedcrate, crate,
    CASE WHEN brief <> '' THEN brief END AS briefdescription, {display_first('pcrefname')} AS fieldcollector, {display_first('pdrefname')} AS donor,
    CASE WHEN numbervalue <> '' THEN numbervalue END AS altnum, CASE WHEN numbertype <> '' THEN numbertype END AS altnumtype, pcrefname, accnum, pdrefname, accid, acccsid,
    inventorycount, collection, department, '' AS fieldlocverbatim, fieldcollectiondate"""
REVIEW = pick(f"SELECT o.*, {ETHNO_SELECT} FROM ({located()}) o {ETHNO_JOINS}", "locationkey, sortableobjectnumber, objectcsid", "moveid, accid NULLS LAST")


@query("r18_key_info", f"SELECT storagelocation, locationkey, locationdate, {ETHNO_OUT} FROM ({REVIEW}) z")
def _r18(c):
    return rp.key_info(c)


GENERAL_JOINS = " ".join(
    [first(f"g{i}", tag, table) for i, (tag, table, _) in enumerate(rp.GENERAL_BY_NAME.values())]
    + [first("gt", "techniqueGroupList", "techniquegroup"), "LEFT JOIN {photos} ph ON ph.id = o.id AND ph.pos = 0",
       "LEFT JOIN {fieldcollectors} co ON co.id = o.id AND co.pos = 0 JOIN {objects_ext} e ON e.id = o.id"])
NAMED = {out: f"g{i}.{col}" for i, (out, (_, _, col)) in enumerate(rp.GENERAL_BY_NAME.items())}
GENERAL = f"""e.computedcurrentlocationdisplay AS computedcurrentlocation, {display(NAMED['objectname'])} AS objectname, o.objectnumber, {display('o.fieldcollectionplace')} AS fieldcollectionplace,
    {NAMED['fieldcollectiondate']} AS fieldcollectiondate, {display('co.item')} AS fieldcollector, o.computedcurrentlocation AS computedcurrentlocationrefname, e.sortableobjectnumber,
    o.csid, e.argusdescription, {', '.join(f"{display(NAMED[n])} AS {n}" for n in ('dhname', 'materials', 'objectproductionperson', 'objectproductionorganization', 'objectproductionplace'))},
    {NAMED['objectproductiondate']} AS objectproductiondate, CASE WHEN e.donotpublishonweb THEN 'true' ELSE 'false' END AS donotpublishonweb, {display('o.collection')} AS collection,
    {display('e.ipaudit')} AS ipaudit, ph.item AS photo, {display('e.copyrightholder')} AS copyrightholder, gt.technique"""
WITH_CSID = f"(SELECT o.*, h.name AS csid FROM {LIVE_OBJECTS} o JOIN {{hierarchy}} h ON h.id = o.id)"


@query("r18_key_info_general", "SELECT * EXCLUDE (pick) FROM (" + pick(
    f"SELECT {GENERAL} FROM {WITH_CSID} o {GENERAL_JOINS} WHERE o.id IN (SELECT id FROM ({located()}) l)", "computedcurrentlocation, objectnumber", "csid") + ") z")
def _r18_general(c):
    return rp.key_info(c, variant="general")


ART = pick(f"""SELECT o.storagelocation AS location, o.objectnumber, o.objectcsid, o.moveid, n.title, o.physicaldescription AS medium, mp.dimensionsummary AS measurement, cl.item AS collectionrefname,
    x.creditline, x.legalstatus, CASE WHEN bd.item <> '' THEN bd.item END AS briefdescription, o.movementnote, x.accnumberprefix, x.accnumberpart1, x.accnumberpart2, x.accnumberpart3,
    x.accnumberpart4, x.accnumberpart5, pp.objectproductionperson AS artistrefname, pp.objectproductionpersonrole AS artistrolerefname
    FROM ({located('object')}) o JOIN {{objects_ext}} x ON x.id = o.id LEFT JOIN {{collectionlists}} cl ON cl.id = o.id JOIN {{briefdescriptions}} bd ON bd.id = o.id AND bd.pos = 0
    {first('n', 'titleGroupList', 'titlegroup')} {first('pp', 'objectProductionPersonGroupList', 'objectproductionpersongroup')} {first('mp', 'measuredPartGroupList', 'measuredpartgroup')}""",
    "location, objectnumber", "objectcsid, moveid")


@query("r18_key_info_art", f"""SELECT * EXCLUDE (pick, moveid), {display('artistrefname')} AS artist, {display('artistrolerefname')} AS artistrole, {display('collectionrefname')} AS collection,
    'dd MM YYYY' AS acqdate FROM ({ART}) z""")
def _r18_art(c):
    return rp.key_info(c, variant="art")


@query("r19_group_members", "SELECT * EXCLUDE (pick) FROM (" + pick(f"""SELECT {GENERAL} FROM {WITH_CSID} o {GENERAL_JOINS} WHERE o.id IN (SELECT h2.id FROM {{groups}} g JOIN {LIVE} m ON m.id = g.id
    JOIN {{hierarchy}} h ON h.id = g.id JOIN {{relations}} r ON r.subjectcsid = h.name JOIN {{hierarchy}} h2 ON h2.name = r.objectcsid WHERE g.title = '2-HIGH 8')""",
    "computedcurrentlocation, objectnumber", "csid") + ") z")
def _r19(c):
    return rp.group_members(c, "2-HIGH 8")


ENDS = f"""SELECT (SELECT min(sortableobjectnumber) FROM {NUMBERED} a WHERE objectnumber = (SELECT min(objectnumber) FROM {{objects}} WHERE id IN (SELECT id FROM {LIVE} b))) AS a,
    (SELECT min(sortableobjectnumber) FROM {NUMBERED} a WHERE objectnumber = (SELECT max(objectnumber) FROM {{objects}} WHERE id IN (SELECT id FROM {LIVE} b))) AS b"""
IN_RANGE = f"""(SELECT o.id, e.sortableobjectnumber FROM {LIVE_OBJECTS} o JOIN {{objects_ext}} e ON e.id = o.id, ({ENDS}) x WHERE e.sortableobjectnumber BETWEEN x.a AND x.b
   )"""


def _range_ends(c):
    ends = rp.numbered_objects(c).agg(F.min("objectnumber").alias("a"), F.max("objectnumber").alias("b"))
    return ends.select("a").scalar(), ends.select("b").scalar()


@query("r20_object_rows", f"SELECT {GENERAL} FROM {WITH_CSID} o {GENERAL_JOINS} WHERE o.id IN (SELECT id FROM {IN_RANGE} r)")
def _r20(c):
    return rp.object_rows(c, *_range_ends(c))


OBJECTS_WITH_EXT = f"(SELECT o.*, h.name AS objectcsid, e.computedcrate, e.sortableobjectnumber, e.inventorycount, {display('e.computedcrate')} AS crate FROM {LIVE_OBJECTS} o JOIN {{hierarchy}} h ON h.id = o.id JOIN {{objects_ext}} e ON e.id = o.id)"


@query("r20_object_rows_review", f"""SELECT CASE WHEN computedcrate IS NULL THEN {display('computedcurrentlocation')} ELSE concat({display('computedcurrentlocation')}, ': ', {display('computedcrate')}) END AS storagelocation,
    computedcurrentlocation AS locrefname, '' AS locdate, {ETHNO_OUT} FROM ({pick(f"SELECT o.*, {ETHNO_SELECT} FROM {OBJECTS_WITH_EXT} o {ETHNO_JOINS} WHERE o.id IN (SELECT id FROM {IN_RANGE} r)",
    'sortableobjectnumber', 'id, accid NULLS LAST')}) z""")
def _r20_review(c):
    return rp.object_rows(c, *_range_ends(c), variant="review")


@query("r21_location_list", f"""SELECT termdisplayname, replace(termdisplayname, ' ', '0') AS locationkey FROM {{location_terms}} t JOIN {{hierarchy}} h ON h.id = t.id JOIN {LIVE} m ON m.id = h.parentid
    WHERE replace(termdisplayname, ' ', '0') >= 'Bay02' ORDER BY locationkey LIMIT 40""")
def _r21(c):
    return rp.location_list(c, "set", "Bay 2", n=40)


@query("r22_object_list", f"""WITH k AS (SELECT o.id, o.objectnumber, e.sortableobjectnumber FROM {LIVE_OBJECTS} o JOIN {{objects_ext}} e ON e.id = o.id),
    ends AS (SELECT min(CASE WHEN sortableobjectnumber >= '0000002000' THEN sortableobjectnumber END) AS a, max(CASE WHEN sortableobjectnumber <= '0000002010' THEN sortableobjectnumber END) AS b FROM k)
    SELECT o.objectnumber, o.sortableobjectnumber, coalesce({display('g.objectname')}, '') AS objectname, h.name AS objectcsid FROM k o, ends
    LEFT JOIN {{hierarchy}} h ON h.parentid = o.id AND h.name LIKE '%:objectNameList' AND h.pos = 0 LEFT JOIN {{objectnamegroup}} g ON g.id = h.id
    WHERE o.sortableobjectnumber BETWEEN a AND b""")
def _r22(c):
    return rp.object_list(c, "0000002000", "0000002010")


# ---- plants ------------------------------------------------------------------------------------

PLANT = """SELECT o.id, o.objectnumber, o.recordstatus, h.name AS objectcsid, h2.id AS movement_id, h2.isversion, m.currentlocation, m.reasonformove, m.locationdate,
    m.previouslocation, e.rare, e.deadflag FROM {plants} o JOIN {hierarchy} h ON h.id = o.id JOIN {relations} r ON r.subjectcsid = h.name AND r.objectdocumenttype = 'Movement'
    JOIN {hierarchy} h2 ON h2.name = r.objectcsid JOIN {movements} m ON m.id = h2.id JOIN {objects_ext} e ON e.id = o.id"""
LIVE_BOTH = f"id IN (SELECT id FROM {LIVE} a) AND movement_id IN (SELECT id FROM {LIVE} b)"


def _plants(c):
    return c.with_tables(objects=c.plants)


def bed(condition: str) -> str:
    rows = f"""SELECT o.*, {display('o.currentlocation')} AS gardenlocation, l.termname AS shortgardenlocation, {display('k.locationtype')} AS locationtype, t.taxon, x.family,
      CAST(TRY_CAST(o.objectnumber AS DECIMAL(8,4)) AS DOUBLE) AS number FROM ({PLANT}) o {first('t', 'taxonomicIdentGroupList', 'taxonomicidentgroup')}
      LEFT JOIN {{taxa}} x ON x.refname = t.taxon LEFT JOIN {{location_terms}} l ON l.termdisplayname = {display('o.currentlocation')}
      LEFT JOIN {{locations}} k ON k.refname = o.currentlocation WHERE {condition}"""
    return f"""SELECT gardenlocation, shortgardenlocation, locationtype, recordstatus, objectnumber, {display('taxon')} AS determination, {display('family')} AS family, objectcsid, rare, deadflag,
      strftime(locationdate + INTERVAL 8 HOUR, '%Y-%m-%d') AS actiondate, reasonformove AS actionreason, {display('previouslocation')} AS previouslocation
      FROM ({pick(rows, 'gardenlocation, number', 'objectcsid, movement_id')}) z"""


ALIVE = f"o.isversion IS NOT TRUE AND o.reasonformove <> 'Dead' AND o.id IN (SELECT id FROM {LIVE} a) AND o.movement_id IN (SELECT id FROM {LIVE} b)"
DEAD = f"o.isversion IS TRUE AND o.reasonformove = 'Dead' AND o.movement_id IN (SELECT id FROM {LIVE} b)"


@query("r23_bed_list", f"""SELECT 'alive' AS mode, * FROM ({bed(ALIVE)}) a WHERE (rare = 'false' AND deadflag = 'false') OR actionreason = 'Dead'
    UNION ALL SELECT 'dead', * FROM ({bed(DEAD)}) b WHERE (deadflag = 'true') OR actionreason = 'Dead'""")
def _r23(c):
    p = _plants(c)
    return _day_text(_bed_lists(p))


def _day_text(df):
    return df.withColumn("actiondate", F.col("actiondate").cast("string"))


def _bed_lists(p):
    alive = rp.bed_list(p, "alive", rare=["false"], dead=["false"]).select(F.lit("alive").alias("mode"), "*")
    return alive.unionByName(rp.bed_list(p, "dead", dead=["true"]).select(F.lit("dead").alias("mode"), "*"))


def taxa(condition: str, distinct: str = "") -> str:
    return f"""SELECT {distinct} o.objectnumber, {display('t.taxon')} AS determination, {display('x.family')} AS family, {display('o.currentlocation')} AS gardenlocation, o.recordstatus AS dataquality,
      CASE WHEN g.fieldlocplace <> '' THEN {display('g.fieldlocplace')} WHEN g.fieldlocplace IS NULL AND g.taxonomicrange IS NOT NULL THEN 'Geographic range: ' || g.taxonomicrange END AS locality,
      o.objectcsid, o.rare, o.deadflag, {display('u.taxon')} AS determinationnoauth, o.reasonformove, strftime(o.locationdate + INTERVAL 8 HOUR, '%Y-%m-%d') AS actiondate,
      {display('o.previouslocation')} AS previouslocation FROM ({PLANT}) o {first('t', 'taxonomicIdentGroupList', 'taxonomicidentgroup')}
      LEFT JOIN (SELECT h.parentid, y.taxon FROM {{hierarchy}} h LEFT JOIN {{taxonomicidentgroup}} y ON y.id = h.id WHERE h.name LIKE '%:taxonomicIdentGroupList' AND h.pos = 1) u ON u.parentid = o.id
      {first('g', 'localityGroupList', 'localitygroup')} LEFT JOIN {{taxa}} x ON x.refname = t.taxon
      WHERE o.isversion IS NOT TRUE AND o.id IN (SELECT id FROM {LIVE} a) AND {condition}"""


T_ALIVE = f"o.movement_id IN (SELECT id FROM {LIVE} b)"
T_DEAD = "o.reasonformove = 'Dead'"


@query("r24_all_taxa", f"SELECT 'dead' AS mode, * FROM ({taxa(T_DEAD)}) a UNION ALL SELECT 'both', * FROM ({taxa(T_ALIVE)} UNION {taxa(T_DEAD)}) b")
def _r24(c):
    return _day_text(rp.taxa_lists(_plants(c)))


@query("r25_authority_scan", down("AFRICA", 1) + f""", terms AS (SELECT term FROM down UNION SELECT 'AFRICA')
    SELECT * REPLACE (CASE WHEN deadflag = 'true' OR deadflag IS NULL THEN coalesce(previouslocation, 'None') || ' [' || coalesce(CAST(actiondate AS VARCHAR), 'None') || ']' ELSE gardenlocation END AS gardenlocation)
    FROM ({taxa(T_ALIVE)}) t WHERE locality IN (SELECT term FROM terms) AND rare = 'false'""")
def _r25(c):
    terms = iv.descendants(place_tree(c), "AFRICA").select("term")
    return _day_text(rp.authority_scan(rp.all_taxa(_plants(c), "alive"), terms, "locality", rare=["false"]))


@query("r26_advanced_search", f"""SELECT * FROM ({taxa(T_ALIVE)}) t WHERE determination IN ('Brand#3', 'Brand#7', 'Brand#9') AND locality IN ('NATION_2', 'NATION_6', 'NATION_8') AND deadflag = 'false'""")
def _r26(c):
    plants = rp.all_taxa(_plants(c), "alive")
    return _day_text(rp.advanced_search(plants, taxa=["Brand#3", "Brand#7", "Brand#9"], places=["NATION_2", "NATION_6", "NATION_8"], dead=["false"]))


# ---- lists over a range of locations ------------------------------------------------------------

RANGED = f"""(SELECT termdisplayname FROM {{location_terms}} t JOIN {{hierarchy}} h ON h.id = t.id JOIN {LIVE} m ON m.id = h.parentid
    WHERE replace(termdisplayname, ' ', '0') BETWEEN 'Bay00' AND 'Bay05')"""
REVIEWED = f"(SELECT storagelocation, locationkey, termdisplayname, {ETHNO_OUT} FROM ({REVIEW}) z WHERE termdisplayname IN (SELECT termdisplayname FROM {RANGED} r))"


@query("r27_packing_list", down("AMERICA", 1) + f""", terms AS (SELECT term FROM down UNION SELECT 'AMERICA')
    SELECT storagelocation AS heading, locationkey, objectnumber, objectname, objectcount, fieldcollectionplace, culturalgroup, objectcsid FROM {REVIEWED} v
      WHERE fieldcollectionplace IN (SELECT term FROM terms)
    UNION ALL SELECT termdisplayname, replace(termdisplayname, ' ', '0'), NULL, NULL, NULL, NULL, NULL, NULL FROM {RANGED} r WHERE termdisplayname NOT IN (SELECT termdisplayname FROM ({located()}) l)""")
def _r27(c):
    terms = iv.descendants(place_tree(c), "AMERICA").select("term")
    return rp.packing_list(c, "Bay 0", "Bay 5", terms)


@query("r28_packing_list_by_culture", CLOSURE + f""", n AS (SELECT key, string_agg(ancestor, ' :: ' ORDER BY level, ancestor_key) AS path, count(*) AS n,
      max(CASE WHEN level = 0 THEN ancestor END) AS term FROM up GROUP BY key),
    g AS (SELECT p.refname, CASE WHEN n.n = 1 THEN 'No parent :: ' || n.term ELSE n.path END AS heading, n.n = 1 AS alone FROM {{places}} p JOIN {{hierarchy}} h ON h.id = p.id JOIN n ON n.key = h.name)
    SELECT CASE WHEN cgrefname IS NULL THEN 'No cultural group specified' ELSE coalesce(g.heading, 'No parent :: ' || {display('cgrefname')}) END AS heading,
      cgrefname IS NULL OR coalesce(g.alone, true) AS sort_last, storagelocation AS location, objectnumber, objectname, objectcount, fieldcollectionplace, objectcsid
    FROM {REVIEWED} v LEFT JOIN g ON g.refname = v.cgrefname""")
def _r28(c):
    return rp.packing_list_by_culture(c, "Bay 0", "Bay 5", place_edges(c))


@query("r29_enumerate_locations", f"""WITH t AS (SELECT storagelocation, count(*) AS objects FROM ({INVENTORY}) z WHERE termdisplayname IN (SELECT termdisplayname FROM {RANGED} r) GROUP BY 1)
    SELECT storagelocation, objects, (SELECT CAST(sum(objects) AS BIGINT) FROM t) AS totalobjects FROM t""")
def _r29(c):
    return rp.enumerate_locations(c, "Bay 0", "Bay 5")


# ---- owners ---------------------------------------------------------------------------------------

OWNED = f"""SELECT f.id, f.item, g.placeowner, g.ownershipnote, p.placenote FROM {{contentplaces}} f JOIN {{places}} p ON p.refname = f.item JOIN {LIVE} m ON m.id = p.id
    JOIN {{hierarchy}} h ON h.parentid = p.id AND h.name LIKE '%:placeOwnerGroupList' JOIN {{placeownergroup}} g ON g.id = h.id"""


@query("r30_sites_by_owner", f"""SELECT DISTINCT {display('item')} AS site, {display('placeowner')} AS site_owner, ownershipnote AS ownership_note, placenote AS place_note FROM ({OWNED}) w
    WHERE placeowner LIKE '%Agency 2%'""")
def _r30(c):
    return rp.sites_by_owner(c, "Agency 2")


@query("r31_objects_by_owner", f"""SELECT o.objectnumber AS museum_no, e.sortableobjectnumber AS sort_number, o.numberofobjects AS pieces, {display('n.objectname')} AS object_name,
      d.datedisplaydate AS collection_date, string_agg(DISTINCT a.acquisitionreferencenumber, ', ' ORDER BY a.acquisitionreferencenumber) AS acc_no, {display('w.item')} AS site,
      {display('w.placeowner')} AS site_owner, w.ownershipnote AS ownership_note, w.placenote AS place_note
    FROM ({OWNED}) w JOIN {LIVE_OBJECTS} o ON o.id = w.id JOIN {{objects_ext}} e ON e.id = o.id {first('n', 'objectNameList', 'objectnamegroup')} {first('d', 'fieldCollectionDateGroup', 'structureddategroup')}
    JOIN {{hierarchy}} h ON h.id = o.id LEFT JOIN {{relations}} r ON r.subjectcsid = h.name AND r.objectdocumenttype = 'Acquisition' LEFT JOIN {{hierarchy}} h2 ON h2.name = r.objectcsid
    LEFT JOIN {{acquisitions}} a ON a.id = h2.id
    WHERE {display('w.placeowner')} ILIKE '%agency 3%' OR (w.placeowner IS NULL AND w.ownershipnote ILIKE '%agency 3%')
    GROUP BY o.objectnumber, e.sortableobjectnumber, o.numberofobjects, n.objectname, d.datedisplaydate, w.item, w.placeowner, w.ownershipnote, w.placenote""")
def _r31(c):
    return rp.objects_by_owner(c, "agency 3")


@query("e22_owner_objects_agg", """SELECT l_returnflag, l_linestatus, l_linenumber, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ', ' ORDER BY CAST(l_suppkey AS VARCHAR)) AS suppliers
    FROM {lineitem} GROUP BY 1, 2, 3""")
def _e22(c):
    rows = c.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", F.col("l_suppkey").cast("string").alias("s")).distinct()
    return rows.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.expr("listagg(s, ', ') WITHIN GROUP (ORDER BY s)").alias("suppliers"))


# ---- one object, many at a time --------------------------------------------------------------------

DETAIL_JOINS = """LEFT JOIN {fieldcollectors} fc ON fc.id = o.id AND fc.pos = 0 LEFT JOIN {contentconcepts} ec ON ec.id = o.id AND ec.pos = 0
    LEFT JOIN {contentplaces} pl ON pl.id = o.id AND pl.pos = 0 LEFT JOIN {responsibledepartments} rd ON rd.id = o.id AND rd.pos = 0 JOIN {objects_ext} e ON e.id = o.id"""
DETAIL = f"{display_first('fc.item')} AS collector, {display_first('ec.item')} AS filecode, {display_first('pl.item')} AS site, rd.item AS department, n.objectname, e.legacydepartment, e.fieldlocverbatim"


@query("r32_object_detail", f"""SELECT o.objectnumber, o.collection, o.numberofobjects, o.distinguishingfeatures, o.recordstatus, {DETAIL}, e.inventoryname, bd.item AS briefdescription, e.iscomponent,
    h.name AS csid, o.id, {display('o.computedcurrentlocation')} AS location, o.computedcurrentlocation FROM {{objects}} o JOIN {{hierarchy}} h ON h.id = o.id
    {first('n', 'objectNameList', 'objectnamegroup')} LEFT JOIN {{briefdescriptions}} bd ON bd.id = o.id {DETAIL_JOINS}""")
def _r32(c):
    return rp.object_detail(c)


@query("r32_object_summary", f"""SELECT o.objectnumber, n.objectname, o.numberofobjects, {display('pl.item')} AS fieldcollectionplace, {display('ap.assocpeople')} AS culturalgroup,
    {display('ec.item')} AS ethnographicfilecode FROM {LIVE_OBJECTS} o {first('n', 'objectNameList', 'objectnamegroup')} {first('ap', 'assocPeopleGroupList', 'assocpeoplegroup')} {DETAIL_JOINS}""")
def _r32_summary(c):
    return rp.object_summary(c)


PAIRS = """SELECT c1.objectnumber, c1.id AS this_id, h2.id AS other_id, h2.name AS other_csid FROM {objects} c1 JOIN {hierarchy} h1 ON h1.id = c1.id
    JOIN {relations} r ON r.subjectcsid = h1.name AND r.objectdocumenttype = 'CollectionObject' JOIN {hierarchy} h2 ON h2.name = r.objectcsid"""


@query("r33_parent_info", f"""SELECT p.objectnumber, o.objectnumber AS parent, p.other_csid AS parentcsid, o.collection, o.distinguishingfeatures, {DETAIL}, o.id AS parent_id
    FROM ({PAIRS}) p JOIN {{objects}} o ON o.id = p.other_id {first('n', 'objectNameList', 'objectnamegroup')} {DETAIL_JOINS} WHERE e.iscomponent = 'no'""")
def _r33_parent(c):
    return rp.parent_info(c)


@query("r33_child_info", f"""SELECT p.objectnumber, o.objectnumber AS child, p.other_csid AS childcsid, o.id AS childid FROM ({PAIRS}) p JOIN {{objects}} o ON o.id = p.other_id
    JOIN {{objects_ext}} e ON e.id = o.id JOIN {{objects_ext}} t ON t.id = p.this_id WHERE e.iscomponent = 'yes' AND t.iscomponent = 'no'""")
def _r33_child(c):
    return rp.child_info(c)


@query("r33_current_locations", f"""SELECT csid, objectnumber, locationdate, reasonformove, location FROM (SELECT h.name AS csid, o.objectnumber, m.locationdate, m.reasonformove,
      {display_first('m.currentlocation')} AS location, row_number() OVER (PARTITION BY h.name ORDER BY m.locationdate DESC, m.id) AS n FROM {{objects}} o JOIN {{hierarchy}} h ON h.id = o.id
    JOIN {{relations}} r ON r.subjectcsid = h.name AND r.objectdocumenttype = 'Movement' JOIN {{hierarchy}} h2 ON h2.name = r.objectcsid JOIN {{movements}} m ON m.id = h2.id) t WHERE n = 1""")
def _r33_current(c):
    return rp.current_locations(c)


@query("r34_accession_info", f"""SELECT r.subjectcsid AS object, a.acquisitionreferencenumber, {display_first('w.item')} AS donor, h.name AS csid FROM {{relations}} r JOIN {{hierarchy}} h ON h.name = r.objectcsid
    JOIN {{acquisitions}} a ON a.id = h.id JOIN {{owners}} w ON w.id = a.id AND w.pos = 0""")
def _r34(c):
    return rp.accession_info(c)


@query("r35_alt_numbers", """SELECT o.id, o.objectnumber, g.numbervalue AS altnum, g.numbertype AS altnumtype, g.numbervaluenote AS altnumnote FROM {objects} o
    JOIN {hierarchy} h ON h.parentid = o.id AND h.name LIKE '%:altNumGroupList' AND h.pos = 0 JOIN {othernumber} g ON g.id = h.id""")
def _r35(c):
    return rp.alt_numbers(c)


@query("r36_cultures", f"""SELECT h.parentid AS id, h.pos, {display_first('g.assocpeople')} AS culturalgroup, g.assocpeopletype, g.assocpeoplenote FROM {{hierarchy}} h
    LEFT JOIN {{assocpeoplegroup}} g ON g.id = h.id WHERE h.name LIKE '%:assocPeopleGroupList'""")
def _r36(c):
    return rp.cultures(c)


@query("r37_production_dates", f"SELECT o.objectnumber, g.datedisplaydate, g.dateassociation FROM {{objects}} o {first('g', 'objectProductionDateGroupList', 'structureddategroup')}")
def _r37(c):
    return rp.production_dates(c)


@query("r38_object_media", """SELECT o.objectnumber, d.blobcsid, d.primarydisplay, d.approvedforweb, d.description FROM {objects} o JOIN {hierarchy} h ON h.id = o.id
    JOIN {relations} r ON r.subjectcsid = h.name JOIN {hierarchy} h2 ON h2.name = r.objectcsid JOIN {media} d ON d.id = h2.id""")
def _r38(c):
    return rp.object_media(c)


@query("r39_csid_lookup", f"""SELECT 'objectnumber' AS kind, objectnumber AS value, h.name AS csid FROM (SELECT DISTINCT objectnumber FROM {{manifest}}) v JOIN {{objects}} o USING (objectnumber) JOIN {{hierarchy}} h ON h.id = o.id
    UNION ALL SELECT 'crate', value, h.name FROM (SELECT DISTINCT 'CRATE ' || (s_suppkey % 20) AS value FROM {{supplier}}) v JOIN {{objects_ext}} e ON lower({display('e.computedcrate')}) = lower(value) JOIN {{hierarchy}} h ON h.id = e.id
    UNION ALL SELECT 'place', n_name, h.name FROM {{nation}} JOIN {{places}} p ON lower({display('p.refname')}) = lower(n_name) JOIN {{hierarchy}} h ON h.id = p.id""")
def _r39(c):
    crates = c.supplier.select(F.concat(F.lit("CRATE "), (F.col("s_suppkey") % 20).cast("string")).alias("value"))
    runs = [("objectnumber", c.manifest.select("objectnumber")), ("crate", crates), ("place", c.nation.select("n_name"))]
    return ag.union_all([rp.csid_lookup(c, kind, values).select(F.lit(kind).alias("kind"), "value", "csid") for kind, values in runs])


@query("r39_csid_detail", f"""SELECT 'objNumber' AS detail, h.name AS csid, o.objectnumber AS value FROM {{objects}} o JOIN {{hierarchy}} h ON h.id = o.id
    UNION ALL SELECT 'objcount', h.name, CAST(o.numberofobjects AS VARCHAR) FROM {{objects}} o JOIN {{hierarchy}} h ON h.id = o.id
    UNION ALL SELECT 'fieldcollectionplace', h.name, {display_first('p.item')} FROM {{contentplaces}} p JOIN {{hierarchy}} h ON h.id = p.id WHERE p.pos = 0
    UNION ALL SELECT 'assocpeoplegroup', h.name, {display_first('g.assocpeople')} FROM {{objects}} o JOIN {{hierarchy}} h ON h.id = o.id {first('g', 'assocPeopleGroupList', 'assocpeoplegroup')}""")
def _r39_detail(c):
    details = ["objNumber", "objcount", "fieldcollectionplace", "assocpeoplegroup"]
    return ag.union_all([rp.csid_detail(c, d).select(F.lit(d).alias("detail"), "csid", "value") for d in details])
