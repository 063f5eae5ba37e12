"""Bulk moves, scanner uploads, edits, new numbers, media intake, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import (
    blank_if_null, flag_on, location_key, object_number, parse_date, reference_number, refname_display, sortable_number, urn_display, valid_count,
)
from vitrine.operators.filters import exists_check, not_deleted, term_lookup
from vitrine.operators.joins import attach_object_id, two_way_edges, with_csid
from vitrine.operators.ordering import distinct_on, sequence_id
from vitrine.plans.links import linked_in
from vitrine.plans.model import Collection
from vitrine.plans.reports import key_info, located_objects
from vitrine.sources.readers import parse_scanner_lines

# Applications that move objects to a chosen place.
MOVE_TO = ["moveobject", "powermove", "grpmove"]


def _new_id(prefix: str, *parts: Column | str) -> Column:
    """An id that depends only on the row, so that a retried task gives the same one."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 24))


# ---- moves -------------------------------------------------------------------------------


def move_records(
    objects: DataFrame, app: str, to_refname: str, to_label: str, reason: str, now: str, not_located: str, to_crate: str = "", order: Sequence[str] = ("objectcsid",)
) -> DataFrame:
    """Outcome of a bulk move for rows ``(objectcsid, objectnumber, objectstatus, locationrefname, crate)``.

    Adds where each object goes, a message, whether it moves, and the movement
    record's fields.  Rows are numbered in ``order``, which must be total.
    """
    rows = sequence_id(objects, *order, out="_row")
    status = F.col("objectstatus")
    missing = status.eqNullSafe("not found")
    if app == "movecrate":
        place, crate, message = F.lit(to_refname), F.col("crate"), F.lit(f"crate now at {to_label}")
    elif app in MOVE_TO:
        stays = status.eqNullSafe("do not move")
        place = F.when(stays, F.col("locationrefname")).otherwise(F.lit(to_refname))
        crate = F.when(stays, F.col("crate")).otherwise(F.lit(to_crate))
        message = F.when(stays, F.lit("kept in place")).otherwise(F.lit(f"object now at {to_label}"))
    else:
        place, crate, message = F.col("locationrefname"), F.col("crate"), F.lit("place confirmed")
    time = F.lit(now).cast("timestamp_ntz")
    rows = rows.withColumns({
        "tolocation": F.when(missing, F.lit(not_located)).otherwise(place),
        "tocrate": F.when(missing, F.lit("")).otherwise(crate),
        "message": F.when(missing, F.lit("marked as lost")).otherwise(message),
        "referencenumber": reference_number("LOC", time, F.col("_row")),
        "locationdate": F.date_format(time, "yyyy-MM-dd'T'00:00:00'Z'"),
        "summary": F.concat(F.lit("Webapp move ("), urn_display(F.lit(reason)), F.lit(")")),
    })
    rows = rows.withColumn("moved", F.col("message") != "kept in place")
    return rows.withColumn("movementcsid", F.when(F.col("moved"), _new_id("mv-", "referencenumber", "objectcsid"))).drop("_row")


def move_rows(c: Collection, ids: DataFrame) -> DataFrame:
    """What a move needs of the live objects among ``ids`` (id, and perhaps objectstatus): the rows of :func:`move_records`."""
    rows = not_deleted(ids.distinct(), c.misc).join(c.objects.select("id", "objectnumber", F.col("computedcurrentlocation").alias("locationrefname")), "id")
    rows = rows.join(c.objects_ext.select("id", blank_if_null(refname_display("computedcrate")).alias("crate")), "id")
    rows = with_csid(rows, c.hierarchy, out="objectcsid")
    status = F.col("objectstatus") if "objectstatus" in ids.columns else F.lit("found")
    return rows.select("objectcsid", "objectnumber", status.alias("objectstatus"), "locationrefname", "crate")


def crate_rows(c: Collection, crate: str) -> DataFrame:
    """``(id)`` of the objects in a crate."""
    return c.objects_ext.filter(refname_display("computedcrate") == crate).select("id")


def group_rows(c: Collection, title: str) -> DataFrame:
    """``(id)`` of the objects in a titled group."""
    groups = not_deleted(c.groups.filter(F.col("title") == title).select(F.col("id").alias("gid")), c.misc, "gid")
    return linked_in(c, groups, "id", "CollectionObject", id="gid").select("id").distinct()


def inventory_rows(c: Collection, locations: DataFrame) -> DataFrame:
    """``(id)`` of the objects that a movement puts at the locations, where they are now."""
    return located_objects(c, locations).select("id").distinct()


def movement_rows(moves: DataFrame, reason: str, handler: str) -> DataFrame:
    """New movement records of the objects that moved."""
    return moves.filter("moved").select(
        "movementcsid", "referencenumber", F.lit(reason).alias("reasonformove"), F.col("tolocation").alias("currentlocation"), "locationdate",
        F.lit(handler).alias("movementcontact"), F.col("summary").alias("computedmovementsummary"))


def movement_edges(moves: DataFrame) -> DataFrame:
    return two_way_edges(moves.filter("moved"), "movementcsid", "Movement", "objectcsid", "CollectionObject")


def move_counts(moves: DataFrame) -> DataFrame:
    return moves.agg(F.count_if(F.col("moved")).alias("updated"), F.count("*").alias("requested"))


# ---- scanner uploads ----------------------------------------------------------------------

# Position of each part in the cells after code and handler, by move code.
SCAN_PARTS = {
    "C": {"date": 2, "objectnumber": 3, "crate": 4, "location": 5},
    "M": {"objectnumber": 2, "location": 3, "date": 4},
    "R": {"date": 2, "crate": 3, "location": 4},
}
# Message of each check; a code makes its checks in the order of its parts.
SCAN_ERRORS = {
    "date": "bad date", "objectnumber": "unknown object", "crate": "unknown crate", "location": "unknown location",
}


def check_scans(c: Collection, lines: DataFrame, handlers: DataFrame) -> DataFrame:
    """Scanner lines by part, each with its first error or null.

    ``handlers`` has ``(handler, handlerrefname)``.  A known name is an exact display
    name among the crates, or among the live locations.
    """
    scans = parse_scanner_lines(lines)
    cells = F.col("cells")

    def part(name: str) -> Column:
        value = F
        for code, places in SCAN_PARTS.items():
            if name in places:
                value = value.when(F.col("code") == code, F.get(cells, F.lit(places[name])))
        return value

    rows = scans.withColumns({"code": F.get(cells, F.lit(0)), "handler": F.get(cells, F.lit(1))})
    rows = rows.withColumns({n: part(n) for n in ("date", "objectnumber", "crate", "location")}).drop("cells")
    rows = rows.withColumn("moved_at", parse_date("date"))
    rows = rows.join(handlers, "handler", "left")

    live_numbers = not_deleted(c.objects.select("id", "objectnumber"), c.misc)
    crates = c.objects_ext.select(refname_display("computedcrate").alias("name")).filter("name IS NOT NULL").distinct()
    places = not_deleted(c.locations.select("id", refname_display("refname").alias("name")), c.misc)
    rows = exists_check(rows, "objectnumber", live_numbers, "objectnumber", "_objectnumber")
    rows = exists_check(rows, "crate", crates, "name", "_crate")
    rows = exists_check(rows, "location", places, "name", "_location")
    rows = rows.withColumn("_date", F.col("moved_at").isNotNull())

    error = F.when(~F.coalesce(F.col("code").isin(list(SCAN_PARTS)), F.lit(False)), F.lit("unknown move code"))
    error = error.when(F.col("handlerrefname").isNull(), F.lit("unknown handler"))
    for code, checks in SCAN_PARTS.items():
        for name in checks:
            error = error.when((F.col("code") == code) & ~F.col(f"_{name}"), F.lit(SCAN_ERRORS[name]))
    return rows.withColumn("error", error).drop("_objectnumber", "_crate", "_location", "_date")


def file_verdicts(checked: DataFrame) -> DataFrame:
    """``(file, lines, errors, accepted)`` of each uploaded file."""
    counts = checked.groupBy("file").agg(F.count("*").alias("lines"), F.count("error").alias("errors"))
    return counts.withColumn("accepted", F.col("errors") == 0)


def scanner_moves(c: Collection, checked: DataFrame, reason: str) -> DataFrame:
    """Moves of checked uploads; one error anywhere rejects the whole file it is in, and no other.

    Lines that carry no ``file`` are one upload.  ``R`` lines move every object of the crate; such lines that say
    the same of a crate, time, place and handler count once.
    """
    if "file" in checked.columns:
        bad = checked.filter("error IS NOT NULL").select("file").distinct()
        good = checked.join(bad, "file", "left_anti")
    else:
        errors = checked.filter("error IS NOT NULL").agg(F.count("*")).scalar()
        good = checked.filter(errors == 0)
    found = term_lookup(good, "location", c.locations, out="locationrefname")
    numbered = with_csid(c.objects.select("id", "objectnumber"), c.hierarchy, out="objectcsid")
    by_number = numbered.groupBy("objectnumber").agg(F.min("objectcsid").alias("objectcsid"))
    single = found.filter("code <> 'R'").join(by_number, "objectnumber")
    boxed = numbered.join(c.objects_ext.select("id", refname_display("computedcrate").alias("crate")), "id").drop("id")
    of = [n for n in ("file",) if n in checked.columns]
    boxes = found.filter("code = 'R'").drop("objectnumber").dropDuplicates([*of, "crate", "moved_at", "locationrefname", "handlerrefname"])
    crates = boxes.join(boxed, "crate")
    shown = F.concat(F.date_format("moved_at", "yyyy-MM-dd"), F.lit(" ("), urn_display(F.lit(reason)), F.lit(")"))
    columns = [
        *of, "code", "objectcsid", "objectnumber", F.coalesce("crate", F.lit("")).alias("crate"), "locationrefname",
        F.date_format("moved_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("locationdate"), "handlerrefname", F.lit(reason).alias("reason"), shown.alias("summary"),
    ]
    return single.select(*columns).union(crates.select(*columns))


# ---- edits ----------------------------------------------------------------------------------


def _holds(values: Column, value: Column) -> Column:
    return F.coalesce(F.array_contains(values, value), F.lit(False))


def prefer_value(values: Column | str, value: Column | str, rule: str = "prefer") -> Column:
    """A list with ``value`` put in by one of the edit rules.

    ``prefer``: first, moved there if present, replacing a single empty element.
    ``date``: first, if absent.  ``insert``: first, unless it is first already.  A null value changes
    nothing; null elements stay where they are.
    """
    v = F.col(value) if isinstance(value, str) else value
    old = F.coalesce(F.col(values) if isinstance(values, str) else values, F.array().cast("array<string>"))
    first = F.get(old, F.lit(0))
    added = F.concat(F.array(v), old)
    if rule == "date":
        return F.when(v.isNull() | _holds(old, v), old).otherwise(added)
    if rule == "insert":
        return F.when(v.isNull() | first.eqNullSafe(v), old).otherwise(added)
    if rule != "prefer":
        raise ValueError(f"unknown edit rule: {rule}")
    empty = (F.size(old) == 1) & (F.coalesce(first, F.lit("")) == "")
    moved = F.concat(F.array(v), F.filter(old, lambda x: ~x.eqNullSafe(v)))
    return F.when(v.isNull() | first.eqNullSafe(v), old).when(_holds(old, v), moved).when(empty, F.array(v)).otherwise(added)


def resolve_terms(changes: DataFrame, authorities: Mapping[str, DataFrame]) -> DataFrame:
    """Typed terms as refnames; a term that is not found blanks the field and is reported."""
    notes = []
    for field, authority in authorities.items():
        found = term_lookup(changes, field, authority, missing="blank", out="_found")
        unknown = (F.col("_found") == "") & (F.coalesce(F.col(field), F.lit("")) != "")
        note = F.when(unknown, F.concat(F.lit(f'{field}: unknown term "'), F.col(field), F.lit('"')))
        changes = found.withColumn(f"_note_{field}", note).withColumn(field, F.col("_found")).drop("_found")
        notes.append(f"_note_{field}")
    return changes.withColumn("message", F.concat_ws(" ", *notes)).drop(*notes)


def check_count(changes: DataFrame, field: str) -> DataFrame:
    """Drops a count that is no number, and reports it."""
    bad = valid_count(field).isNull() & (F.coalesce(F.col(field), F.lit("")) != "")
    note = F.when(bad, F.concat(F.lit('not a count: "'), F.col(field), F.lit('"')))
    message = F.concat_ws(" ", F.nullif("message", F.lit("")), note) if "message" in changes.columns else F.concat_ws("", note)
    return changes.withColumn("message", message).withColumn(field, F.when(~bad, F.col(field)))


def bulk_edit(records: DataFrame, changes: DataFrame, key: str, rules: Mapping[str, str]) -> DataFrame:
    """Records with the changes of their key; a blank value changes nothing.

    Of changes that repeat a key the greatest row counts, so records never multiply.

    ``rules`` says per field how a value goes in: ``replace`` a single value, a list
    rule of :func:`prefer_value`, or ``clear`` for a structured date, whose other
    parts become blank and whose display date becomes the value.
    """
    cells = F.struct(*[F.col(f).cast("string").alias(f"_new_{f}") for f in rules])
    new = changes.groupBy(key).agg(F.max(cells).alias("_new")).select(key, "_new.*")
    joined = records.join(new, key, "left")
    out = {}
    for field, rule in rules.items():
        value, old = F.col(f"_new_{field}"), F.col(field)
        if rule == "replace":
            edited = value.cast(records.schema[field].dataType)
        elif rule == "clear":
            parts = records.schema[field].dataType.fieldNames()
            edited = F.struct(*[(value if p == "display" else F.lit("")).alias(p) for p in parts])
        else:
            edited = prefer_value(old, value, rule)
        out[field] = F.when(value.isNotNull() & (value != ""), edited).otherwise(old)
    touched = F.lit(False)
    for field in rules:
        touched = touched | F.coalesce(F.col(f"_new_{field}") != "", F.lit(False))
    return joined.withColumns({**out, "edited": touched}).select(*records.columns, "edited")


# ---- new numbers ---------------------------------------------------------------------------------


def create_numbers(requests: DataFrame, known: DataFrame, limit: int = 100) -> tuple[DataFrame, DataFrame]:
    """New consecutive numbers, and the requests that are refused.

    ``requests`` has ``(request_id, year, accession, sequence, n)``, ``known`` the
    existing ``sortableobjectnumber``.  More than ``limit`` numbers, or one existing
    key in the range, refuses a request.  The range check is a join on key prefixes:
    every prefix of a hundred numbers between the ends.
    """
    stem = 30  # year, accession and all but two digits of the sequence
    year, accession, sequence, n = (F.col(x) for x in ("year", "accession", "sequence", "n"))
    asked = requests.withColumns({
        "_lo": sortable_number(year, accession, sequence), "_hi": sortable_number(year, accession, sequence + n - 1),
    })
    sized = asked.filter((n >= 1) & (n <= limit))
    probes = sized.select("request_id", "_lo", "_hi", F.explode(F.transform(F.sequence(F.floor(sequence / 100), F.floor((sequence + n - 1) / 100)), lambda h: F.substring(sortable_number(year, accession, h * 100), 1, stem))).alias("_stem"))
    keys = known.select("sortableobjectnumber", F.substring("sortableobjectnumber", 1, stem).alias("_stem"))
    hits = probes.join(keys, "_stem").filter(F.col("sortableobjectnumber").between(F.col("_lo"), F.col("_hi")))
    taken = hits.groupBy("request_id").agg(F.count("*").alias("taken"))
    judged = asked.join(taken, "request_id", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    reason = F.when(n > limit, F.lit(f"more than {limit} numbers")).when(
        n < 1, F.lit("nothing requested")).when(F.col("taken") > 0, F.concat(F.lit("numbers taken: "), F.col("taken").cast("string")))
    judged = judged.withColumn("reason", reason)
    number = F.explode(F.sequence(sequence, sequence + n - 1)).alias("_seq")
    made = judged.filter("reason IS NULL").select("request_id", "year", "accession", number)
    seq = F.col("_seq")
    created = made.select("request_id", object_number(year, accession, seq).alias("objectnumber"), sortable_number(year, accession, seq).alias("sortableobjectnumber"))
    return created, judged.filter("reason IS NOT NULL").select("request_id", "reason")


# ---- media intake -----------------------------------------------------------------------------------


def media_intake(c: Collection, manifest: DataFrame, now: str) -> DataFrame:
    """Manifest rows with their media id, object id, flag and reference number."""
    rows = manifest.withColumn("approvedforweb", flag_on("approvedforweb"))
    rows = attach_object_id(rows, c.objects, c.hierarchy, c.misc)
    rows = rows.withColumn("referencenumber", reference_number("BMU", F.lit(now).cast("timestamp_ntz")))
    # A name that is taken in again later is another medium.
    return rows.withColumn("mediacsid", _new_id("md-", "name", "objectnumber", "handling", "referencenumber"))


def media_edges(intake: DataFrame) -> DataFrame:
    """Both directions of the links of media whose object was found."""
    linked = intake.filter((F.col("objectcsid") != "") & ~F.col("objectcsid").startswith("N/A: "))
    return two_way_edges(linked, "mediacsid", "Media", "objectcsid", "CollectionObject")


# ---- labels and checks ---------------------------------------------------------------------------------


def label_rows(c: Collection, locations: DataFrame) -> DataFrame:
    """Label data of the objects at the locations, each object once.

    Locations are taken from the last, as the printer stacks labels.
    """
    rows = key_info(c, locations).withColumn("_label", F.concat(F.coalesce("objectnumber", F.lit("")), F.coalesce("objectname", F.lit(""))))
    first = distinct_on(rows, ["_label"], "-locationkey", "objectcsid", "locationdate")
    return first.select(
        "storagelocation", "locationkey", "locationdate", "objectnumber", "objectname", "objectcount", "fieldcollectionplace", "culturalgroup",
        "ethnographicfilecode")


def check_locations(df: DataFrame, col: str, terms: DataFrame, term: str = "termdisplayname", out: str = "verified") -> DataFrame:
    """The location if it is spelled as stored, a blank if only its key matches, null if unknown."""
    keyed = terms.select(location_key(term).alias("_key"), F.col(term).alias("_term")).groupBy("_key").agg(F.min("_term").alias("_term"))
    joined = df.join(keyed, location_key(col) == F.col("_key"), "left")
    value = F.when(F.col("_term") == F.col(col), F.col(col)).when(F.col("_term").isNotNull(), F.lit(""))
    return joined.withColumn(out, value).drop("_key", "_term")
