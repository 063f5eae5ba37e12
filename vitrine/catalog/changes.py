"""Moves, edits, numbers, intake and labels (survey section 2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.catalog.extracts import to_objects
from vitrine.catalog.filters import LIVE
from vitrine.catalog.registry import query
from vitrine.catalog.reports import RANGED, REVIEWED
from vitrine.catalog.text import display
from vitrine.functions import text as tx
from vitrine.operators.aggregates import union_all
from vitrine.plans import changes as ch
from vitrine.plans import reports as rp
from vitrine.session import scratch_path
from vitrine.sources import readers as rd
from vitrine.sources.versions import PublishedTable

NOW = "2024-02-03 04:05:06"
LOST = "urn:x:location:name(location):item:name(l0)''unlocated''"
TO = "urn:x:location:name(location):item:name(l1)''Bay 1, Shelf 1''"


def _to_move(c):
    size = F.col("numberofobjects")
    status = F.when(size % 5 == 0, "do not move").when(size % 7 == 0, "not found").otherwise("moved")
    rows = rp.with_csid(c.objects.select("id", "objectnumber", "numberofobjects", F.col("computedcurrentlocation").alias("locationrefname")), c.hierarchy, out="objectcsid")
    rows = rows.join(c.objects_ext.select("id", tx.blank_if_null(tx.refname_display("computedcrate")).alias("crate")), "id")
    return rows.select("objectcsid", "objectnumber", status.alias("objectstatus"), "locationrefname", "crate")


def _moves(c, app="powermove"):
    reason = "urn:x:reason:name(reason):item:name(r1)'Inventory'"
    return ch.move_records(_to_move(c), app, TO.replace("''", "'"), "Bay 1, Shelf 1: Crate 2", reason, NOW, LOST.replace("''", "'"), "Crate 2")


MOVING = f"""(SELECT h.name AS objectcsid, o.objectnumber, CASE WHEN o.numberofobjects % 5 = 0 THEN 'do not move' WHEN o.numberofobjects % 7 = 0 THEN 'not found' ELSE 'moved' END AS objectstatus,
    o.computedcurrentlocation AS locationrefname, coalesce({display('e.computedcrate')}, '') AS crate, row_number() OVER (ORDER BY h.name) AS n
    FROM {{objects}} o JOIN {{hierarchy}} h ON h.id = o.id JOIN {{objects_ext}} e ON e.id = o.id)"""
MOVED = f"""SELECT *, CASE objectstatus WHEN 'do not move' THEN locationrefname WHEN 'not found' THEN '{LOST}' ELSE '{TO}' END AS tolocation,
    CASE objectstatus WHEN 'do not move' THEN crate WHEN 'not found' THEN '' ELSE 'Crate 2' END AS tocrate,
    CASE objectstatus WHEN 'do not move' THEN 'kept in place' WHEN 'not found' THEN 'marked as lost' ELSE 'object now at Bay 1, Shelf 1: Crate 2' END AS message,
    'LOC2024-02-03-04-05-' || n AS referencenumber, '2024-02-03T00:00:00Z' AS locationdate, 'Webapp move (Inventory)' AS summary, objectstatus <> 'do not move' AS moved,
    CASE WHEN objectstatus <> 'do not move' THEN 'mv-' || substr(sha256('LOC2024-02-03-04-05-' || n || '|' || objectcsid), 1, 24) END AS movementcsid FROM {MOVING} v"""


@query("k07_move_records", f"SELECT * EXCLUDE (n) FROM ({MOVED}) m")
def _k07(c):
    return _moves(c)


@query("k07_movement_edges", f"""SELECT movementcsid AS subjectcsid, 'Movement' AS subjectdocumenttype, objectcsid, 'CollectionObject' AS objectdocumenttype, 'affects' AS relationshiptype FROM ({MOVED}) m WHERE moved
    UNION ALL SELECT objectcsid, 'CollectionObject', movementcsid, 'Movement', 'affects' FROM ({MOVED}) m WHERE moved""")
def _k07_edges(c):
    return ch.movement_edges(_moves(c))


@query("k07_move_counts", f"SELECT count(CASE WHEN moved THEN 1 END) AS updated, count(*) AS requested FROM ({MOVED}) m")
def _k07_counts(c):
    return ch.move_counts(_moves(c))


# What each branch does with an object that is found, in SQL: place, crate, message.
BRANCHES = {
    "movecrate": (f"'{TO}'", "crate", "'crate now at Bay 1, Shelf 1: Crate 2'"),
    "grpmove": (f"CASE objectstatus WHEN 'do not move' THEN locationrefname ELSE '{TO}' END", "CASE objectstatus WHEN 'do not move' THEN crate ELSE 'Crate 2' END",
                "CASE objectstatus WHEN 'do not move' THEN 'kept in place' ELSE 'object now at Bay 1, Shelf 1: Crate 2' END"),
    "inventory": ("locationrefname", "crate", "'place confirmed'"),
}
STATUS = "CASE WHEN o.numberofobjects % 5 = 0 THEN 'do not move' WHEN o.numberofobjects % 7 = 0 THEN 'not found' ELSE 'moved' END"


def branch_sql(app: str, chosen: str) -> str:
    """Moves of the live objects whose id is in ``chosen``."""
    place, crate, message = BRANCHES[app]
    rows = f"""(SELECT h.name AS objectcsid, o.objectnumber, {STATUS} AS objectstatus, o.computedcurrentlocation AS locationrefname, coalesce({display('e.computedcrate')}, '') AS crate,
      row_number() OVER (ORDER BY h.name) AS n FROM {{objects}} o JOIN {LIVE} m ON m.id = o.id JOIN {{hierarchy}} h ON h.id = o.id JOIN {{objects_ext}} e ON e.id = o.id WHERE o.id IN ({chosen}))"""
    return f"""SELECT '{app}' AS app, objectcsid, objectnumber, CASE objectstatus WHEN 'not found' THEN '{LOST}' ELSE {place} END AS tolocation, CASE objectstatus WHEN 'not found' THEN '' ELSE {crate} END AS tocrate,
      CASE objectstatus WHEN 'not found' THEN 'marked as lost' ELSE {message} END AS message, 'LOC2024-02-03-04-05-' || n AS referencenumber FROM {rows} v"""


AT_PLACES = f"""SELECT h2.id FROM {{movements}} x JOIN {{hierarchy}} h1 ON h1.id = x.id JOIN {{relations}} r ON r.subjectcsid = h1.name JOIN {{hierarchy}} h2 ON h2.name = r.objectcsid
    JOIN {{objects}} o ON o.id = h2.id AND o.computedcurrentlocation = x.currentlocation JOIN {{locations}} l ON l.refname = x.currentlocation JOIN {{hierarchy}} h3 ON h3.parentid = l.id
    JOIN {{location_terms}} t ON t.id = h3.id WHERE t.termdisplayname IN (SELECT termdisplayname FROM {RANGED} z)"""


@query("k07_other_moves", " UNION ALL ".join([
    branch_sql("movecrate", f"SELECT id FROM {{objects_ext}} WHERE {display('computedcrate')} = 'Crate 4'"),
    branch_sql("grpmove", f"SELECT o.id FROM {to_objects('groups', 'CollectionObject')} WHERE x.title = '1-URGENT 24'"), branch_sql("inventory", AT_PLACES)]))
def _k07_other(c):
    """Crate, group and inventory moves, each fed from the rows its preview shows."""
    chosen = {"movecrate": ch.crate_rows(c, "Crate 4"), "grpmove": ch.group_rows(c, "1-URGENT 24"),
              "inventory": ch.inventory_rows(c, rp.location_list(c, "range", "Bay 0", "Bay 5").select("termdisplayname"))}
    size = F.col("numberofobjects")
    status = F.when(size % 5 == 0, "do not move").when(size % 7 == 0, "not found").otherwise("moved").alias("objectstatus")
    reason = "urn:x:reason:name(reason):item:name(r1)'Inventory'"
    parts = []
    for app, ids in chosen.items():
        rows = ch.move_rows(c, ids.join(c.objects.select("id", status), "id"))
        moves = ch.move_records(rows, app, TO.replace("''", "'"), "Bay 1, Shelf 1: Crate 2", reason, NOW, LOST.replace("''", "'"), "Crate 2")
        parts.append(moves.select(F.lit(app).alias("app"), "objectcsid", "objectnumber", "tolocation", "tocrate", "message", "referencenumber"))
    return union_all(parts)


HANDLERS = "(SELECT DISTINCT 'A' || (user_id % 8) AS handler, 'urn:x:person:name(person):item:name(u' || (user_id % 8) || ')''User ' || (user_id % 8) || '''' AS handlerrefname FROM {events})"


def _handlers(c):
    k = (F.col("user_id") % 8).cast("string")
    ref = F.concat(F.lit("urn:x:person:name(person):item:name(u"), k, F.lit(")'User "), k, F.lit("'"))
    return c.events.select(F.concat(F.lit("A"), k).alias("handler"), ref.alias("handlerrefname")).distinct()


CRATES = f"(SELECT DISTINCT {display('computedcrate')} FROM {{objects_ext}} WHERE computedcrate IS NOT NULL)"
PLACES = f"(SELECT {display('l.refname')} FROM {{locations}} l JOIN {LIVE} m ON m.id = l.id)"
NUMBERS = f"(SELECT o.objectnumber FROM {{objects}} o JOIN {LIVE} m ON m.id = o.id)"
CHECKED = f"""SELECT *, CASE WHEN handlerrefname IS NULL THEN 'unknown handler'
      WHEN code <> 'M' AND moved_at IS NULL THEN 'bad date'
      WHEN code <> 'R' AND objectnumber NOT IN {NUMBERS} THEN 'unknown object'
      WHEN code <> 'M' AND crate NOT IN {CRATES} THEN 'unknown crate'
      WHEN location NOT IN {PLACES} THEN 'unknown location'
      WHEN moved_at IS NULL THEN 'bad date' END AS error
    FROM (SELECT line, code, p.handler, date, objectnumber, crate, location, try_strptime(date, '%m/%d/%Y %H:%M') AS moved_at, u.handlerrefname FROM (
      SELECT line, f[1] AS code, f[2] AS handler, CASE f[1] WHEN 'M' THEN f[5] ELSE f[3] END AS date, CASE f[1] WHEN 'M' THEN f[3] WHEN 'C' THEN f[4] END AS objectnumber,
        CASE f[1] WHEN 'C' THEN f[5] WHEN 'R' THEN f[4] END AS crate, CASE f[1] WHEN 'M' THEN f[4] WHEN 'C' THEN f[6] ELSE f[5] END AS location
      FROM (SELECT line, string_split(substr(line, 2, length(line) - 2), '","') AS f FROM (SELECT DISTINCT rtrim(value) AS line FROM {{scan_lines}} WHERE value LIKE '"%') a) b) p
      LEFT JOIN {HANDLERS} u ON u.handler = p.handler) w"""


CHECKED_FILES = CHECKED.replace("SELECT line, code, p.handler", "SELECT upload, line, code, p.handler").replace("SELECT line, f[1] AS code", "SELECT upload, line, f[1] AS code").replace(
    "SELECT line, string_split", "SELECT upload, line, string_split").replace("SELECT DISTINCT rtrim(value) AS line", "SELECT DISTINCT upload, rtrim(value) AS line")


@query("k08_check_scans", CHECKED)
def _k08_check(c):
    return ch.check_scans(c, c.scan_lines.select("value"), _handlers(c))


def _uploads(c):
    """Scanner lines dropped as files, one for each upload, and read back."""
    spark = c.scan_lines.sparkSession
    folder = scratch_path(spark, "scans")
    c.scan_lines.select("upload", "value").repartition(60, "upload").write.partitionBy("upload").text(folder)
    return rd.read_scanner_drop(spark, folder)


def _upload_of(file: str):
    return F.regexp_extract(file, r"upload=([0-9]+)/", 1).cast("bigint").alias("upload")


OBJECT_CSIDS = "(SELECT o.id, o.objectnumber, h.name AS objectcsid FROM {objects} o JOIN {hierarchy} h ON h.id = o.id)"
ACCEPTED = f"(SELECT w.* FROM ({CHECKED_FILES}) w WHERE upload NOT IN (SELECT upload FROM ({CHECKED_FILES}) z WHERE error IS NOT NULL))"


@query("k08_scanner_moves", f"""WITH found AS (SELECT good.*, l.refname AS locationrefname FROM {ACCEPTED} good
      LEFT JOIN (SELECT lower({display('refname')}) AS shown, min(refname) AS refname FROM {{locations}} GROUP BY 1) l ON l.shown = lower(good.location)),
    boxes AS (SELECT DISTINCT upload, code, crate, moved_at, locationrefname, handlerrefname FROM found WHERE code = 'R'),
    hit AS (SELECT f.upload, f.code, o.objectcsid, f.objectnumber, coalesce(f.crate, '') AS crate, f.locationrefname, f.moved_at, f.handlerrefname FROM found f
        JOIN (SELECT objectnumber, min(objectcsid) AS objectcsid FROM {OBJECT_CSIDS} x GROUP BY 1) o ON o.objectnumber = f.objectnumber WHERE f.code <> 'R'
      UNION ALL SELECT f.upload, f.code, o.objectcsid, o.objectnumber, f.crate, f.locationrefname, f.moved_at, f.handlerrefname FROM boxes f JOIN {{objects_ext}} e ON {display('e.computedcrate')} = f.crate
        JOIN {OBJECT_CSIDS} o ON o.id = e.id)
    SELECT upload, code, objectcsid, objectnumber, crate, locationrefname, strftime(moved_at, '%Y-%m-%dT%H:%M:%SZ') AS locationdate, handlerrefname, 'Inventory' AS reason,
      strftime(moved_at, '%Y-%m-%d') || ' (Inventory)' AS summary FROM hit""")
def _k08_moves(c):
    moves = ch.scanner_moves(c, ch.check_scans(c, _uploads(c), _handlers(c)), "Inventory")
    return moves.withColumn("upload", _upload_of("file")).drop("file")


@query("k08_file_verdicts", f"SELECT upload, count(*) AS lines, count(error) AS errors, count(error) = 0 AS accepted FROM ({CHECKED_FILES}) w GROUP BY 1")
def _k08_verdicts(c):
    verdicts = ch.file_verdicts(ch.check_scans(c, _uploads(c), _handlers(c)))
    return verdicts.withColumn("upload", _upload_of("file")).drop("file")


@query("k08_scanner_rejects", f"SELECT count(CASE WHEN error IS NOT NULL THEN 1 END) AS errors, 0 AS moves FROM ({CHECKED}) w")
def _k08_rejects(c):
    """All lines as one upload: one error, and nothing moves."""
    from vitrine.operators.joins import scalar_row

    checked = ch.check_scans(c, c.scan_lines.select("value"), _handlers(c))
    moves = ch.scanner_moves(c, checked, "Inventory")
    return scalar_row(checked.sparkSession, errors=checked.filter("error IS NOT NULL").agg(F.count("*")), moves=moves.agg(F.count("*").cast("int")))


# ---- edits -------------------------------------------------------------------------------------

LISTS = """(SELECT o.id, l.items FROM {objects} o LEFT JOIN (SELECT id, list(item ORDER BY pos) AS items FROM {contentplaces} GROUP BY id) l ON l.id = o.id)"""


def _lists(c):
    """Every object's places in order, nulls among them; null for an object without a list."""
    lists = c.contentplaces.groupBy("id").agg(F.expr("transform(array_sort(collect_list(struct(pos, item))), x -> x.item)").alias("items"))
    return c.objects.select("id").join(lists, "id", "left")


def _shown_list(items):
    return F.array_join(items, "|", "-")


def _edit_sql(v: str, rule: str) -> str:
    """A list after an edit, an empty one for none."""
    old = "coalesce(items, [])"
    rest = f"list_filter({old}, lambda x: x IS DISTINCT FROM {v})"
    same = f"{v} IS NULL OR {old}[1] IS NOT DISTINCT FROM {v}"
    if rule == "date":
        return f"CASE WHEN {v} IS NULL OR list_contains({old}, {v}) THEN {old} ELSE list_concat([{v}], {old}) END"
    if rule == "insert":
        return f"CASE WHEN {same} THEN {old} ELSE list_concat([{v}], {old}) END"
    return f"""CASE WHEN {same} THEN {old} WHEN list_contains({old}, {v}) THEN list_concat([{v}], {rest}) WHEN len({old}) = 1 AND coalesce({old}[1], '') = '' THEN [{v}]
      ELSE list_concat([{v}], {old}) END"""


def _shown_sql(items: str) -> str:
    return f"array_to_string(list_transform({items}, lambda x: coalesce(x, '-')), '|')"


@query("k10_prefer_value", f"""SELECT id, {_shown_sql(_edit_sql('v', 'prefer'))} AS prefer, {_shown_sql(_edit_sql('v', 'date'))} AS dated, {_shown_sql(_edit_sql('v', 'insert'))} AS inserted
    FROM (SELECT l.id, l.items, o.fieldcollectionplace AS v FROM {LISTS} l JOIN {{objects}} o ON o.id = l.id) t""")
def _k10(c):
    rows = _lists(c).join(c.objects.select("id", F.col("fieldcollectionplace").alias("v")), "id")
    return rows.select("id", *[_shown_list(ch.prefer_value("items", "v", rule)).alias(out) for rule, out in (("prefer", "prefer"), ("date", "dated"), ("insert", "inserted"))])


CHANGES = """(SELECT id, CASE WHEN numberofobjects % 3 = 0 THEN 'nation_' || (numberofobjects % 30) ELSE '' END AS items, CASE numberofobjects % 4 WHEN 0 THEN numberofobjects || 'x' WHEN 1 THEN '' ELSE CAST(numberofobjects + 100 AS VARCHAR) END AS n,
    CASE WHEN numberofobjects % 2 = 0 THEN 'new ' || objectnumber ELSE '' END AS features FROM {objects})"""


def _changes(c):
    k = F.col("numberofobjects")
    number = F.when(k % 4 == 0, F.concat(k.cast("string"), F.lit("x"))).when(k % 4 == 1, "").otherwise((k + 100).cast("string"))
    return c.objects.select(
        "id", F.when(k % 3 == 0, F.concat(F.lit("nation_"), (k % 30).cast("string"))).otherwise("").alias("items"), number.alias("n"),
        F.when(k % 2 == 0, F.concat(F.lit("new "), "objectnumber")).otherwise("").alias("features"))


RESOLVED = f"""(SELECT t.id, t.items AS term, CASE WHEN t.items = '' THEN '' ELSE coalesce(a.refname, '') END AS items, t.n AS typed,
    CASE WHEN regexp_matches(t.n, '^[0-9]+$') OR t.n = '' THEN t.n END AS n, t.features FROM {CHANGES} t
    LEFT JOIN (SELECT lower({display('refname')}) AS shown, min(refname) AS refname FROM {{places}} GROUP BY 1) a ON a.shown = lower(t.items))"""
MESSAGE = """trim(CASE WHEN items = '' AND term <> '' THEN 'items: unknown term "' || term || '"' ELSE '' END || ' ' ||
    CASE WHEN n IS NULL THEN 'not a count: "' || typed || '"' ELSE '' END)"""


@query("k09_resolve_terms", f"SELECT id, items, n, features, {MESSAGE} AS message FROM {RESOLVED} r")
def _k09_resolve(c):
    return ch.check_count(ch.resolve_terms(_changes(c), {"items": c.places}), "n")


EDITED = f"""(SELECT l.id, {_shown_sql("CASE WHEN coalesce(new, '') = '' THEN coalesce(l.items, []) ELSE " + _edit_sql("new", "prefer").replace("items", "l.items") + " END")} AS items,
    CASE WHEN r.n <> '' THEN CAST(r.n AS INT) ELSE o.numberofobjects END AS n, CASE WHEN r.features <> '' THEN r.features ELSE o.distinguishingfeatures END AS features,
    coalesce(new <> '', false) OR coalesce(r.n <> '', false) OR coalesce(r.features <> '', false) AS edited
    FROM {LISTS} l JOIN {{objects}} o ON o.id = l.id JOIN (SELECT id, items AS new, n, features FROM {RESOLVED} r0) r ON r.id = l.id)"""
RULES = {"items": "prefer", "n": "replace", "features": "replace"}


def _records(c):
    return _lists(c).join(c.objects.select("id", F.col("numberofobjects").alias("n"), F.col("distinguishingfeatures").alias("features")), "id")


def _resolved(c):
    return ch.check_count(ch.resolve_terms(_changes(c), {"items": c.places}), "n")


@query("k09_bulk_edit", f"SELECT * FROM {EDITED} e")
def _k09(c):
    edited = ch.bulk_edit(_records(c), _resolved(c), "id", RULES)
    return edited.withColumn("items", _shown_list(F.coalesce("items", F.array().cast("array<string>"))))


@query("k09_stored_edit", f"SELECT id, items, n, features FROM {EDITED} e")
def _k09_stored(c):
    """The same edits, made in a published table of the records: the version after them."""
    spark = c.objects.sparkSession
    table = PublishedTable(spark, scratch_path(spark, "records"), "id", 16)
    table.publish(_records(c))
    changes = _resolved(c)
    table.edit(changes.select("id"), lambda rows: ch.bulk_edit(rows, changes, "id", RULES).drop("edited"))
    return table.read().withColumn("items", _shown_list(F.coalesce("items", F.array().cast("array<string>"))))


# ---- numbers, intake, labels -----------------------------------------------------------------------

REQUESTS = """(SELECT s_suppkey AS request_id, CAST(1991 + s_suppkey % 60 AS INT) AS year, CAST(s_suppkey % 25 AS INT) AS accession, CAST(s_suppkey % 7 * 15 AS INT) AS sequence,
    CAST(CASE s_suppkey % 11 WHEN 0 THEN 150 WHEN 1 THEN 0 ELSE 1 + s_suppkey % 9 END AS INT) AS n FROM {supplier})"""


def _requests(c):
    k = F.col("s_suppkey")
    n = F.when(k % 11 == 0, 150).when(k % 11 == 1, 0).otherwise(k % 9 + 1)
    return c.supplier.select(
        k.alias("request_id"), (k % 60 + 1991).cast("int").alias("year"), (k % 25).cast("int").alias("accession"), (k % 7 * 15).cast("int").alias("sequence"), n.cast("int").alias("n"))


def _sortable(seq: str) -> str:
    return f"lpad(CAST(year AS VARCHAR), 10, '0') || '.' || lpad(CAST(accession AS VARCHAR), 10, '0') || '.' || lpad(CAST({seq} AS VARCHAR), 10, '0')"


JUDGED = f"""(SELECT q.*, CASE WHEN n > 100 THEN 'more than 100 numbers' WHEN n < 1 THEN 'nothing requested' WHEN taken > 0 THEN 'numbers taken: ' || taken END AS reason
    FROM (SELECT r.*, (SELECT count(*) FROM {{objects_ext}} e WHERE e.sortableobjectnumber BETWEEN {_sortable('r.sequence').replace('year', 'r.year').replace('accession', 'r.accession')}
      AND {_sortable('(r.sequence + r.n - 1)').replace('year', 'r.year').replace('accession', 'r.accession')}) AS taken FROM {REQUESTS} r) q)"""


@query("k11_create_numbers", f"""SELECT request_id, year || '.' || accession || '.' || seq AS objectnumber, {_sortable('seq')} AS sortableobjectnumber FROM (
    SELECT request_id, year, accession, unnest(generate_series(sequence, sequence + n - 1)) AS seq FROM {JUDGED} j WHERE reason IS NULL) t""")
def _k11(c):
    return ch.create_numbers(_requests(c), c.objects_ext)[0]


@query("k11_refused_numbers", f"SELECT request_id, reason FROM {JUDGED} j WHERE reason IS NOT NULL")
def _k11_refused(c):
    return ch.create_numbers(_requests(c), c.objects_ext)[1]


INTAKE = f"""(SELECT name, size, objectnumber, date, creator, contributor, handling, CASE WHEN approvedforweb = 'on' THEN 'true' ELSE 'false' END AS approvedforweb,
    CASE WHEN handling IN ('slide', 'borndigital', 'mediaonly') THEN 'N/A: ' || handling ELSE coalesce(k.csid, '') END AS objectcsid,
    'md-' || substr(sha256(name || '|' || objectnumber || '|' || handling || '|BMU20240203040506'), 1, 24) AS mediacsid, 'BMU20240203040506' AS referencenumber FROM {{manifest}}
    LEFT JOIN (SELECT o.objectnumber AS number, min(h.name) AS csid FROM {{objects}} o JOIN {{hierarchy}} h ON h.id = o.id JOIN {LIVE} m ON m.id = o.id GROUP BY 1) k ON k.number = objectnumber)"""


@query("k12_media_intake", f"SELECT * FROM {INTAKE} i")
def _k12(c):
    return ch.media_intake(c, c.manifest, NOW)


@query("k12_media_edges", f"""SELECT mediacsid AS subjectcsid, 'Media' AS subjectdocumenttype, objectcsid, 'CollectionObject' AS objectdocumenttype, 'affects' AS relationshiptype FROM {INTAKE} i
      WHERE objectcsid <> '' AND objectcsid NOT LIKE 'N/A: %'
    UNION ALL SELECT objectcsid, 'CollectionObject', mediacsid, 'Media', 'affects' FROM {INTAKE} i WHERE objectcsid <> '' AND objectcsid NOT LIKE 'N/A: %'""")
def _k12_edges(c):
    return ch.media_edges(ch.media_intake(c, c.manifest, NOW))


@query("k14_label_rows", f"""SELECT storagelocation, locationkey, objectnumber, objectname, objectcount, fieldcollectionplace, culturalgroup, ethnographicfilecode FROM (
    SELECT *, row_number() OVER (PARTITION BY objectnumber || objectname ORDER BY locationkey DESC, objectcsid) AS n FROM {REVIEWED} v) t WHERE n = 1""")
def _k14(c):
    return ch.label_rows(c, rp.location_list(c, "range", "Bay 0", "Bay 5").select("termdisplayname")).drop("locationdate")


TYPED = "CASE WHEN user_id % 3 = 0 THEN 'Bay ' || ((user_id % 40) % 7) || ', Shelf ' || (user_id % 40) WHEN user_id % 3 = 1 THEN replace('Bay ' || ((user_id % 40) % 7) || ', Shelf ' || (user_id % 40), ' ', '0') ELSE 'nowhere' END"


@query("k15_check_locations", f"""SELECT event_id, typed, CASE WHEN t.termdisplayname = typed THEN typed WHEN t.termdisplayname IS NOT NULL THEN '' END AS verified
    FROM (SELECT event_id, {TYPED} AS typed FROM {{events}}) e LEFT JOIN {{location_terms}} t ON replace(t.termdisplayname, ' ', '0') = replace(typed, ' ', '0')""")
def _k15(c):
    k = F.col("user_id") % 40
    name = F.concat(F.lit("Bay "), (k % 7).cast("string"), F.lit(", Shelf "), k.cast("string"))
    r = F.col("user_id") % 3
    typed = F.when(r == 0, name).when(r == 1, tx.location_key(name)).otherwise("nowhere")
    return ch.check_locations(c.events.select("event_id", typed.alias("typed")), "typed", c.location_terms)
