"""Location, number, group, plant, owner and object reports, all set-based.

Where the source runs one query per location or per object, these take a frame of
keys (or none, for all) and answer for all of them in one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import (
    blank_if_null, bool_text, local_day, locality_text, null_if_blank, numeric_sort, refname_display, refname_display_first,
    storage_key, storage_location,
)
from vitrine.operators.aggregates import union_all
from vitrine.operators.filters import (
    alive_dead, in_or_all, key_search, limit_n, nearest_bounds, not_deleted, object_range, sort_keys, under_place,
)
from vitrine.operators.hierarchy import culture_heading
from vitrine.operators.joins import first_of_group, group_values, members, pivot_fields, records, with_csid
from vitrine.operators.ordering import distinct_on, latest_by
from vitrine.plans.links import linked_in, links_of
from vitrine.plans.model import Collection
from vitrine.session import cut_lineage

Keys = DataFrame | None


def _only(df: DataFrame, keys: Keys, col: str) -> DataFrame:
    """Rows whose ``col`` is among the keys; without keys, all rows."""
    return in_or_all(df, col, keys)


def _items(c: Collection, ids: DataFrame, tables: Mapping[str, str], pos: int = 0) -> DataFrame:
    """Long form of several lists of scalars at one position, for the given ids."""
    rows = union_all([c[table].filter(F.col("pos") == pos).select("id", F.lit(out).alias("field"), F.col("item").alias("value")) for out, table in tables.items()])
    return rows.join(ids.select("id").distinct(), "id", "left_semi")


def _lookups(
    c: Collection, rows: DataFrame, by_name: Mapping[str, tuple[str, str, str]] = {}, by_type: Mapping[str, tuple[str, str, str]] = {},
    items: Mapping[str, str] = {}, or_null: bool = False,
) -> DataFrame:
    """Adds first-of-list values, one column each.

    Groups are given as output: (list name or member type, group table, column).
    Everything is read in long form and pivoted once.  The rows are stored first:
    they are read for each kind of lookup, and their true size decides how the
    lists are narrowed to them.
    """
    rows = cut_lineage(rows, "report")
    ids = rows.select("id")
    parts = []
    for by, groups in (("name", by_name), ("primarytype", by_type)):
        if groups:
            tables = {out: (tag, c[table], F.col(col)) for out, (tag, table, col) in groups.items()}
            parts.append(group_values(c.hierarchy, tables, 0, or_null, by, ids).select("id", "field", "value"))
    if items:
        parts.append(_items(c, ids, items))
    return rows.join(pivot_fields(union_all(parts), [*by_name, *by_type, *items]), "id", "left")


# ---- objects at locations ------------------------------------------------------------------


def location_terms(c: Collection) -> DataFrame:
    """``(termdisplayname, location_id)`` of every live location."""
    owner = members(c.hierarchy, "locTermGroupList").select(F.col("member_id").alias("id"), F.col("parentid").alias("location_id"))
    terms = c.location_terms.select("id", "termdisplayname").join(owner, "id")
    return not_deleted(terms, c.misc, "location_id").select("termdisplayname", "location_id")


def location_list(c: Collection, mode: str, lo: str, hi: str = "", n: int | None = None) -> DataFrame:
    return key_search(location_terms(c).select("termdisplayname"), "termdisplayname", mode, lo, hi, n)


def located_objects(c: Collection, locations: DataFrame | str | None = None, movement: str = "subject") -> DataFrame:
    """Every object that a movement puts at a location, if the object's own current location agrees.

    ``movement`` says on which side of the relation the movement stands; the two
    tenants that differ here differ only in that.
    """
    terms = c.location_terms.select("id", "termdisplayname")
    if isinstance(locations, str):
        terms = terms.filter(F.col("termdisplayname") == locations)
    else:
        terms = _only(terms, locations, "termdisplayname")
    owner = members(c.hierarchy, "locTermGroupList").select(F.col("member_id").alias("id"), F.col("parentid").alias("lid"))
    terms = terms.join(owner, "id").drop("id")
    places = terms.join(c.locations.select(F.col("id").alias("lid"), F.col("refname").alias("movementrefname")), "lid").drop("lid")
    # Objects that are there now come first: they are few beside all movements ever made to the places.
    objects = not_deleted(c.objects.select("id", F.col("computedcurrentlocation").alias("movementrefname")), c.misc).join(places, "movementrefname")
    here, there = ("subject", "object") if movement == "subject" else ("object", "subject")
    types = ["subjectdocumenttype", "objectdocumenttype"]
    csids = [F.col(f"{here}csid").alias("movementcsid"), F.col(f"{there}csid").alias("objectcsid")]
    moves = c.movements.select(F.col("id").alias("moveid"), F.col("currentlocation").alias("movementrefname"), "locationdate", "movementnote")
    if "edges" in c:
        edges = c.edges.select(F.col(f"{there}id").alias("id"), F.col(f"{here}id").alias("moveid"), *csids, *types)
        return objects.join(edges, "id").join(moves, ["moveid", "movementrefname"])
    # Relations meet the movements first, by csid: what is left of them is few, and no other link is resolved.
    moved = c.relations.select(*csids, *types).join(with_csid(moves, c.hierarchy, "moveid", "movementcsid"), "movementcsid")
    return with_csid(objects, c.hierarchy, out="objectcsid").join(moved, ["objectcsid", "movementrefname"])


def _with_storage(rows: DataFrame, c: Collection, extra: Sequence[str] = ()) -> DataFrame:
    ext = c.objects_ext.select("id", "computedcrate", "sortableobjectnumber", *extra)
    rows = rows.join(ext, "id", "left")
    return rows.withColumns({
        "storagelocation": storage_location("termdisplayname", "computedcrate"),
        "locationkey": storage_key("termdisplayname", "computedcrate"),
        "crate": refname_display("computedcrate"),
    })


def inventory(c: Collection, locations: DataFrame | str | None = None, variant: str = "names") -> DataFrame:
    """Objects at a location with their crate, one row per (place, number, object).

    ``names`` shows the object's name, ``titles`` its title and maker and takes the
    movement from the other side of the relation.
    """
    number = c.objects.select("id", "objectnumber", F.col("numberofobjects").alias("objectcount"))
    if variant == "titles":
        rows = _with_storage(located_objects(c, locations, "object"), c).join(number, "id")
        rows = _lookups(c, rows, by_name={
            "title": ("titleGroupList", "titlegroup", "title"),
            "artist": ("objectProductionPersonGroupList", "objectproductionpersongroup", "objectproductionperson"),
        })
        rows = distinct_on(rows, ["termdisplayname", "locationkey", "objectnumber", "objectcsid"], "moveid")
        return rows.select(
            "storagelocation", "locationkey", "locationdate", "objectnumber", "objectcount", "title", "movementcsid", "movementrefname",
            "objectcsid", "moveid", "subjectdocumenttype", "objectdocumenttype", F.col("computedcrate").alias("craterefname"), "crate",
            refname_display("artist").alias("artist"))
    rows = _with_storage(located_objects(c, locations), c).join(number, "id")
    rows = _lookups(c, rows, by_name={"objectname": ("objectNameList", "objectnamegroup", "objectname")})
    rows = distinct_on(rows, ["termdisplayname", "locationkey", "sortableobjectnumber", "objectcsid"], "moveid")
    return rows.select(
        "storagelocation", "locationkey", "locationdate", "objectnumber", "objectcount",
        blank_if_null(refname_display("objectname")).alias("objectname"), "movementcsid", "movementrefname", "objectcsid", "moveid",
        "subjectdocumenttype", "objectdocumenttype", "sortableobjectnumber", F.col("computedcrate").alias("craterefname"), "crate")


# Lists behind the general object row.
GENERAL_BY_NAME = {
    "objectname": ("objectNameList", "objectnamegroup", "objectname"),
    "dhname": ("determinationHistoryGroupList", "determinationhistorygroup", "dhname"),
    "materials": ("materialGroupList", "materialgroup", "material"),
    "objectproductionperson": ("objectProductionPersonGroupList", "objectproductionpersongroup", "objectproductionperson"),
    "objectproductionorganization": ("objectProductionOrganizationGroupList", "objectproductionorganizationgroup", "objectproductionorganization"),
    "objectproductionplace": ("objectProductionPlaceGroupList", "objectproductionplacegroup", "objectproductionplace"),
    "objectproductiondate": ("objectProductionDateGroupList", "structureddategroup", "datedisplaydate"),
    "fieldcollectiondate": ("fieldCollectionDateGroup", "structureddategroup", "datedisplaydate"),
}
GENERAL_BY_TYPE = {"technique": ("techniqueGroup", "techniquegroup", "technique")}
GENERAL_ITEMS = {"photo": "photos", "fieldcollector": "fieldcollectors"}


def _general_columns(c: Collection, rows: DataFrame) -> DataFrame:
    """The 22 columns of the general object row, for rows ``(id, csid)``."""
    objects = c.objects.select("id", "objectnumber", "fieldcollectionplace", F.col("computedcurrentlocation").alias("computedcurrentlocationrefname"), "collection")
    ext = c.objects_ext.select(
        "id", F.col("computedcurrentlocationdisplay").alias("computedcurrentlocation"), "sortableobjectnumber", "argusdescription", "donotpublishonweb",
        "ipaudit", "copyrightholder")
    full = _lookups(c, rows.join(objects, "id").join(ext, "id"), GENERAL_BY_NAME, GENERAL_BY_TYPE, GENERAL_ITEMS)

    def shown(*names: str) -> list[Column]:
        return [refname_display(n).alias(n) for n in names]

    return full.select(
        "id", "computedcurrentlocation", *shown("objectname"), "objectnumber", *shown("fieldcollectionplace"), "fieldcollectiondate", *shown("fieldcollector"),
        "computedcurrentlocationrefname", "sortableobjectnumber", "csid", "argusdescription",
        *shown("dhname", "materials", "objectproductionperson", "objectproductionorganization", "objectproductionplace"), "objectproductiondate",
        bool_text("donotpublishonweb").alias("donotpublishonweb"), *shown("collection", "ipaudit"), "photo", *shown("copyrightholder"), "technique")


def _acquired(c: Collection, rows: DataFrame) -> DataFrame:
    """Adds each object's acquisitions (number, id, csid, first owner); an object without keeps nulls."""
    owner = c.owners.filter("pos = 0 OR pos IS NULL").select(F.col("id").alias("accid"), F.col("item").alias("pdrefname"))
    acquisitions = c.acquisitions.select(F.col("id").alias("accid"), F.col("acquisitionreferencenumber").alias("accnum"))
    edges = links_of(c).filter("objectdocumenttype = 'Acquisition'").select(F.col("subjectid").alias("id"), F.col("objectid").alias("accid"), F.col("objectcsid").alias("acccsid"))
    wanted = edges.join(rows.select("id").distinct(), "id", "left_semi")
    return rows.join(wanted.join(acquisitions.join(owner, "accid", "left"), "accid"), "id", "left")


ETHNO_BY_NAME = {
    "objectname": ("objectNameList", "objectnamegroup", "objectname"),
    "altnum": ("altNumGroupList", "othernumber", "numbervalue"),
    "altnumtype": ("altNumGroupList", "othernumber", "numbertype"),
    "fieldcollectiondate": ("fieldCollectionDateGroup", "structureddategroup", "datedisplaydate"),
}
ETHNO_BY_TYPE = {"cgrefname": ("assocPeopleGroup", "assocpeoplegroup", "assocpeople")}
ETHNO_ITEMS = {
    "fcprefname": "contentplaces", "efcrefname": "contentconcepts", "briefdescription": "briefdescriptions",
    "pcrefname": "fieldcollectors", "department": "responsibledepartments",
}


def _ethno_columns(c: Collection, rows: DataFrame) -> DataFrame:
    """Adds the columns of the ethnographic review row, for rows ``(id, objectcsid, …)``."""
    objects = c.objects.select("id", "objectnumber", F.col("numberofobjects").alias("objectcount"), "collection")
    full = _lookups(c, rows.join(objects, "id"), ETHNO_BY_NAME, ETHNO_BY_TYPE, ETHNO_ITEMS, or_null=True)
    full = _acquired(c, full)
    first = {"fieldcollectionplace": "fcprefname", "culturalgroup": "cgrefname", "ethnographicfilecode": "efcrefname", "fieldcollector": "pcrefname", "donor": "pdrefname"}
    return full.withColumns({
        "objectname": blank_if_null(refname_display("objectname")),
        **{out: refname_display_first(ref) for out, ref in first.items()},
        **{n: null_if_blank(n) for n in ("briefdescription", "altnum", "altnumtype")},
        "fieldlocverbatim": F.lit(""),
    })


ETHNO_OUT = """objectnumber objectname objectcount fieldcollectionplace culturalgroup objectcsid ethnographicfilecode fcprefname cgrefname efcrefname
computedcrate crate briefdescription fieldcollector donor altnum altnumtype pcrefname accnum pdrefname accid acccsid inventorycount collection department
fieldlocverbatim fieldcollectiondate""".split()


def key_info(
    c: Collection, locations: DataFrame | str | None = None, variant: str = "ethnographic", with_location: bool = False
) -> DataFrame:
    """Review rows of the objects at a location, in the columns of one of three collections.

    ``with_location`` adds the location's own name to the ethnographic rows.
    """
    if variant == "general":
        at = located_objects(c, locations).select("id", F.col("objectcsid").alias("csid")).distinct()
        rows = _general_columns(c, at)
        return distinct_on(rows, ["computedcurrentlocation", "objectnumber"], "csid").drop("id")
    if variant == "art":
        ext = ["creditline", "legalstatus", "accnumberprefix", *[f"accnumberpart{i}" for i in range(1, 6)]]
        rows = _with_storage(located_objects(c, locations, "object"), c, ext)
        rows = rows.join(c.objects.select("id", "objectnumber", F.col("physicaldescription").alias("medium")), "id")
        lists = c.collectionlists.select("id", F.col("item").alias("collectionrefname"))
        brief = c.briefdescriptions.filter("pos = 0").select("id", null_if_blank("item").alias("briefdescription"))
        rows = rows.join(lists, "id", "left").join(brief, "id")
        person = ("objectProductionPersonGroupList", "objectproductionpersongroup")
        rows = _lookups(c, rows, by_name={
            "title": ("titleGroupList", "titlegroup", "title"),
            "artistrefname": (*person, "objectproductionperson"),
            "artistrolerefname": (*person, "objectproductionpersonrole"),
            "measurement": ("measuredPartGroupList", "measuredpartgroup", "dimensionsummary"),
        })
        rows = distinct_on(rows, ["storagelocation", "objectnumber"], "objectcsid", "moveid")
        return rows.select(
            F.col("storagelocation").alias("location"), "objectnumber", "objectcsid", "title", refname_display("artistrefname").alias("artist"),
            refname_display("artistrolerefname").alias("artistrole"), "medium", "measurement", refname_display("collectionrefname").alias("collection"),
            "creditline", "legalstatus", F.lit("dd MM YYYY").alias("acqdate"), "briefdescription", "movementnote", *ext[2:],
            "artistrefname", "artistrolerefname", "collectionrefname")
    rows = _ethno_columns(c, _with_storage(located_objects(c, locations), c, ["inventorycount"]))
    rows = distinct_on(rows, ["termdisplayname", "locationkey", "sortableobjectnumber", "objectcsid"], "moveid", "accid")
    return rows.select("storagelocation", "locationkey", "locationdate", *ETHNO_OUT, *(["termdisplayname"] if with_location else []))


def group_members(c: Collection, title: str, n: int | None = None) -> DataFrame:
    """General rows of the objects in a titled group."""
    groups = not_deleted(c.groups.filter(F.col("title") == title).select(F.col("id").alias("gid")), c.misc, "gid")
    pairs = linked_in(c, groups, "id", id="gid").select("id").distinct()
    rows = _general_columns(c, with_csid(not_deleted(pairs, c.misc), c.hierarchy))
    first = distinct_on(rows, ["computedcurrentlocation", "objectnumber"], "csid").drop("id")
    return limit_n(first, n, "computedcurrentlocation", "objectnumber")


def numbered_objects(c: Collection) -> DataFrame:
    """``(id, objectnumber, sortableobjectnumber)`` of live objects."""
    return not_deleted(c.objects.select("id", "objectnumber"), c.misc).join(c.objects_ext.select("id", "sortableobjectnumber"), "id")


def object_rows(c: Collection, lo: str | Column, hi: str | Column | None = None, mode: str = "range", n: int | None = None, variant: str = "general") -> DataFrame:
    """Rows of the objects between two known numbers."""
    found = object_range(numbered_objects(c), "objectnumber", "sortableobjectnumber", lo, hi, mode, n).select("id")
    if variant == "general":
        return _general_columns(c, with_csid(found, c.hierarchy)).drop("id")
    ext = c.objects_ext.select("id", "computedcrate", "sortableobjectnumber", "inventorycount")
    rows = with_csid(found, c.hierarchy, out="objectcsid").join(ext, "id")
    rows = rows.join(c.objects.select("id", F.col("computedcurrentlocation").alias("locrefname")), "id")
    rows = rows.withColumn("crate", refname_display("computedcrate"))
    rows = distinct_on(_ethno_columns(c, rows), ["sortableobjectnumber"], "id", "accid")
    return rows.select(
        storage_location(refname_display("locrefname"), "computedcrate").alias("storagelocation"), "locrefname", F.lit("").alias("locdate"), *ETHNO_OUT)


def object_list(c: Collection, lo: str, hi: str, mode: str = "range", n: int | None = None) -> DataFrame:
    """Existing objects between the nearest sort keys: the collision check of new numbers."""
    known = numbered_objects(c)
    found = nearest_bounds(distinct_on(known, ["sortableobjectnumber"], "id"), "sortableobjectnumber", lo, hi, mode, n, known=known)
    found = cut_lineage(found, "found")  # the few numbers in the range, for their names and their members
    named = _lookups(c, found, by_name={"objectname": ("objectNameList", "objectnamegroup", "objectname")}, or_null=True)
    member = members(c.hierarchy, "objectNameList", pos=0, or_null=True, keep=["name"]).select(F.col("parentid").alias("id"), F.col("name").alias("membername"))
    member = member.join(found.select("id"), "id", "left_semi")
    rows = distinct_on(named.join(member, "id", "left"), ["sortableobjectnumber"], "id", "membername")
    return rows.select("objectnumber", "sortableobjectnumber", blank_if_null(refname_display("objectname")).alias("objectname"), F.col("membername").alias("objectcsid"))


# ---- plants ---------------------------------------------------------------------------------


def _plant_moves(c: Collection) -> DataFrame:
    """Every plant with every movement: ids, version flag, reason, places, date."""
    edges = links_of(c).filter("objectdocumenttype = 'Movement'").select(F.col("subjectid").alias("id"), F.col("subjectcsid").alias("objectcsid"), F.col("objectid").alias("movement_id"))
    versions = records(c.hierarchy).select(F.col("id").alias("movement_id"), "isversion")
    moves = c.movements.select(F.col("id").alias("movement_id"), "currentlocation", "reasonformove", "locationdate", "previouslocation").join(versions, "movement_id")
    rows = c.objects.select("id", "objectnumber", "recordstatus").join(edges, "id").join(moves, "movement_id")
    return rows.join(c.objects_ext.select("id", "rare", "deadflag"), "id")


def _shown(col: str) -> Column:
    return refname_display(null_if_blank(col))


def bed_list(
    c: Collection, mode: str, locations: Sequence[str] | DataFrame | None = None, taxa: Sequence[str] | DataFrame | None = None,
    rare: Sequence[str] = (), dead: Sequence[str] = (), n: int | None = None,
) -> DataFrame:
    """Living (or dead) plants by bed or by taxon, one row per bed and accession number."""
    rows = alive_dead(_plant_moves(c), c.misc, mode, "beds")
    rows = first_of_group(rows, c.hierarchy, c.taxonomicidentgroup, ["taxon"], list_name="taxonomicIdentGroupList")
    rows = in_or_all(rows, "taxon", taxa)
    rows = rows.join(c.taxa.select(F.col("refname").alias("taxon"), "family"), "taxon", "left")
    rows = rows.withColumn("gardenlocation", _shown("currentlocation"))
    terms = c.location_terms.select(F.col("termdisplayname").alias("gardenlocation"), F.col("termname").alias("shortgardenlocation"))
    rows = in_or_all(rows.join(terms, "gardenlocation", "left"), "gardenlocation", locations)
    kinds = c.locations.select(F.col("refname").alias("currentlocation"), "locationtype")
    rows = rows.join(kinds, "currentlocation", "left").withColumn("number", numeric_sort("objectnumber"))
    # A number that is no number is its own key, so such plants stay apart.
    rows = rows.withColumn("numberkey", F.coalesce(F.col("number").cast("string"), "objectnumber"))
    rows = distinct_on(rows, ["gardenlocation", "numberkey"], "objectcsid", "movement_id")
    rows = rows.select(
        "gardenlocation", "shortgardenlocation", _shown("locationtype").alias("locationtype"), "recordstatus", "objectnumber",
        refname_display("taxon").alias("determination"), _shown("family").alias("family"), "objectcsid", "rare", "deadflag",
        local_day("locationdate").alias("actiondate"), F.col("reasonformove").alias("actionreason"), _shown("previouslocation").alias("previouslocation"))
    if rare or dead:
        listed = F.lit(True)
        for col, values in (("rare", rare), ("deadflag", dead)):
            listed = listed & (F.col(col).isin(list(values)) if values else F.lit(True))
        rows = rows.filter(listed | (F.col("actionreason") == "Dead"))
    return rows if n is None else limit_n(rows, n, "gardenlocation", "objectnumber")


def _taxa_rows(c: Collection, mode: str) -> DataFrame:
    """The rows of :func:`all_taxa`, repeated ones too.

    What belongs to a plant meets the plants, what belongs to a movement the movements, each by its own
    key; the wide rows of both together are dealt once.
    """
    versions = records(c.hierarchy).select(F.col("id").alias("movement_id"), "isversion")
    moves = c.movements.select(F.col("id").alias("movement_id"), "currentlocation", "reasonformove", "locationdate", "previouslocation").join(versions, "movement_id")
    moves = moves.filter(~F.col("isversion").eqNullSafe(True)).drop("isversion")
    dead = F.col("reasonformove") == "Dead"
    if mode == "alive":
        moves = not_deleted(moves, c.misc, "movement_id")
    elif mode == "dead":
        moves = moves.filter(dead)
    elif mode == "dead or alive":
        live = c.misc.filter(F.col("lifecyclestate") != "deleted").select(F.col("id").alias("_live")).distinct()
        moves = moves.join(live, F.col("movement_id") == F.col("_live"), "left").filter(F.col("_live").isNotNull() | dead).drop("_live")
    else:
        raise ValueError(f"unknown mode: {mode}")
    plants = c.objects.select("id", "objectnumber", "recordstatus").join(c.objects_ext.select("id", "rare", "deadflag"), "id")
    plants = not_deleted(plants, c.misc)
    for pos, out in ((0, "taxon"), (1, "taxon2")):
        plants = first_of_group(plants, c.hierarchy, c.taxonomicidentgroup, {"taxon": out}, list_name="taxonomicIdentGroupList", pos=pos)
    plants = first_of_group(plants, c.hierarchy, c.localitygroup, ["fieldlocplace", "taxonomicrange"], list_name="localityGroupList")
    plants = plants.join(c.taxa.select(F.col("refname").alias("taxon"), "family"), "taxon", "left")
    edges = links_of(c).filter("objectdocumenttype = 'Movement'").select(F.col("subjectid").alias("id"), F.col("subjectcsid").alias("objectcsid"), F.col("objectid").alias("movement_id"))
    rows = edges.join(moves, "movement_id").join(plants, "id")
    return rows.select(
        "objectnumber", refname_display("taxon").alias("determination"), _shown("family").alias("family"), _shown("currentlocation").alias("gardenlocation"),
        F.col("recordstatus").alias("dataquality"), locality_text("fieldlocplace", "taxonomicrange").alias("locality"), "objectcsid", "rare", "deadflag",
        refname_display("taxon2").alias("determinationnoauth"), "reasonformove", local_day("locationdate").alias("actiondate"),
        _shown("previouslocation").alias("previouslocation"))


def all_taxa(c: Collection, mode: str) -> DataFrame:
    """Every plant and movement, living, dead or both (then without repeated rows)."""
    rows = _taxa_rows(c, mode)
    return rows.distinct() if mode == "dead or alive" else rows


def taxa_lists(c: Collection) -> DataFrame:
    """The lists ``dead`` and ``both`` of :func:`all_taxa` under each other, told apart by ``mode``, in one pass over the rows."""
    rows = _taxa_rows(c, "dead or alive")
    # Equal rows have one reason, so all of them or none are dead.
    counted = rows.groupBy(*rows.columns).agg(F.count_if(F.col("reasonformove") == "Dead").cast("int").alias("_dead"))
    modes = F.concat(F.array(F.lit("both")), F.array_repeat(F.lit("dead"), F.col("_dead")))
    return counted.select(F.explode(modes).alias("mode"), *rows.columns)


def authority_scan(plants: DataFrame, terms: DataFrame, column: str, rare: Sequence[str] = (), dead: Sequence[str] = ()) -> DataFrame:
    """Plants whose taxon or place is one of the terms; dead ones show where they were."""
    rows = under_place(plants, column, terms)
    rows = in_or_all(in_or_all(rows, "rare", list(rare)), "deadflag", list(dead))
    gone = F.coalesce(F.col("deadflag") == "true", F.lit(True))
    was = F.concat(F.coalesce("previouslocation", F.lit("None")), F.lit(" ["), F.coalesce(F.col("actiondate").cast("string"), F.lit("None")), F.lit("]"))
    return rows.withColumn("gardenlocation", F.when(gone, was).otherwise(F.col("gardenlocation")))


def advanced_search(
    plants: DataFrame, taxa: Sequence[str] = (), beds: Sequence[str] = (), places: Sequence[str] = (), rare: Sequence[str] = (), dead: Sequence[str] = (),
) -> DataFrame:
    """Plants that are in every given list; an empty list does not restrict."""
    for col, values in (("determination", taxa), ("gardenlocation", beds), ("locality", places), ("rare", rare), ("deadflag", dead)):
        plants = in_or_all(plants, col, list(values))
    return plants


# ---- lists over a range of locations -------------------------------------------------------------


def _ranged(c: Collection, lo: str, hi: str) -> DataFrame:
    return location_list(c, "range", lo, hi).select("termdisplayname")


def packing_list(c: Collection, lo: str, hi: str, terms: Keys = None) -> DataFrame:
    """Objects by storage heading over a range of locations.

    ``terms`` keeps objects collected at one of the places.  A location without any
    object stays as an empty heading, one whose objects the places exclude does not.
    """
    locations = _ranged(c, lo, hi)
    found = cut_lineage(key_info(c, locations, with_location=True), "packing")
    kept = under_place(found, "fieldcollectionplace", terms)
    kept = kept.select(F.col("storagelocation").alias("heading"), "locationkey", "objectnumber", "objectname", "objectcount", "fieldcollectionplace", "culturalgroup", "objectcsid")
    empty = locations.join(found.select("termdisplayname"), "termdisplayname", "left_anti")
    blanks = empty.select(
        F.col("termdisplayname").alias("heading"), F.replace("termdisplayname", F.lit(" "), F.lit("0")).alias("locationkey"),
        *[F.lit(None).cast(kept.schema[n].dataType).alias(n) for n in kept.columns[2:]])
    return kept.unionByName(blanks).orderBy(*sort_keys("heading", "objectnumber", "objectcsid"))


def packing_list_by_culture(c: Collection, lo: str, hi: str, edges: DataFrame, terms: Keys = None) -> DataFrame:
    """As :func:`packing_list`, under the path of the object's cultural group; unplaced groups last."""
    # stored: the terms that the rows name are looked up before the rows are read again for their headings
    kept = cut_lineage(under_place(key_info(c, _ranged(c, lo, hi)), "fieldcollectionplace", terms), "packing")
    rows = culture_heading(kept, "cgrefname", c.places, c.hierarchy, edges)
    rows = rows.select("heading", "sort_last", F.col("storagelocation").alias("location"), "objectnumber", "objectname", "objectcount", "fieldcollectionplace", "objectcsid")
    return rows.orderBy(*sort_keys("sort_last", "heading", "objectnumber", "objectcsid"))


def enumerate_locations(c: Collection, lo: str, hi: str) -> DataFrame:
    """Objects per storage heading over a range of locations, and the number of all."""
    counts = inventory(c, _ranged(c, lo, hi)).groupBy("storagelocation").agg(F.count("*").alias("objects"))
    total = counts.agg(F.sum("objects")).scalar()
    return counts.withColumn("totalobjects", total)


# ---- owners ----------------------------------------------------------------------------------


def site_owners(c: Collection) -> DataFrame:
    """Live places with each of their owner groups."""
    places = not_deleted(c.places.select("id", F.col("refname").alias("site_refname"), "placenote"), c.misc)
    owners = members(c.hierarchy, "placeOwnerGroupList").join(c.placeownergroup.withColumnRenamed("id", "_gid"), F.col("member_id") == F.col("_gid"))
    return places.join(owners, F.col("id") == F.col("parentid")).select("site_refname", "placenote", "placeowner", "ownershipnote")


def sites_by_owner(c: Collection, owner: str) -> DataFrame:
    wanted = site_owners(c).filter(F.col("placeowner").contains(owner))
    sites = wanted.join(c.contentplaces.select(F.col("item").alias("site_refname")), "site_refname", "left_semi")
    rows = sites.select(
        refname_display("site_refname").alias("site"), refname_display("placeowner").alias("site_owner"),
        F.col("ownershipnote").alias("ownership_note"), F.col("placenote").alias("place_note")).distinct()
    return rows.orderBy(*sort_keys("site", "site_owner"))


def objects_by_owner(c: Collection, owner: str) -> DataFrame:
    """Objects from an owner's sites (or, for unnamed owners, by the note), with their accession numbers."""
    named = F.lower(refname_display("placeowner")).contains(owner.lower())
    by_note = F.col("placeowner").isNull() & F.lower("ownershipnote").contains(owner.lower())
    sites = site_owners(c).filter(named | by_note)
    rows = c.contentplaces.select("id", F.col("item").alias("site_refname")).join(sites, "site_refname")
    rows = not_deleted(rows, c.misc).join(c.objects.select("id", "objectnumber", "numberofobjects"), "id")
    rows = rows.join(c.objects_ext.select("id", "sortableobjectnumber"), "id")
    rows = _lookups(c, rows, by_name={
        "objectname": ("objectNameList", "objectnamegroup", "objectname"),
        "collectiondate": ("fieldCollectionDateGroup", "structureddategroup", "datedisplaydate"),
    })
    rows = cut_lineage(rows, "owned")  # the owner's few objects, before their acquisitions
    acquisitions = linked_in(c, rows.select("id").distinct(), "aid", "Acquisition").join(
        c.acquisitions.select(F.col("id").alias("aid"), "acquisitionreferencenumber"), "aid").select("id", "acquisitionreferencenumber").distinct()
    keys = ["objectnumber", "sortableobjectnumber", "numberofobjects", "objectname", "collectiondate", "site_refname", "placeowner", "ownershipnote", "placenote"]
    joined = rows.select("id", *keys).join(acquisitions, "id", "left")
    # duplicates go before the list is made: one row per group and number
    numbers = joined.select(*keys, "acquisitionreferencenumber").distinct()
    grouped = numbers.groupBy(*keys).agg(F.expr("listagg(acquisitionreferencenumber, ', ') WITHIN GROUP (ORDER BY acquisitionreferencenumber)").alias("acc_no"))
    out = grouped.select(
        F.col("objectnumber").alias("museum_no"), F.col("sortableobjectnumber").alias("sort_number"), F.col("numberofobjects").alias("pieces"),
        refname_display("objectname").alias("object_name"), F.col("collectiondate").alias("collection_date"), "acc_no",
        refname_display("site_refname").alias("site"), refname_display("placeowner").alias("site_owner"),
        F.col("ownershipnote").alias("ownership_note"), F.col("placenote").alias("place_note"))
    return out.orderBy(*sort_keys("site", "ownership_note", "sort_number"))


# ---- one object, many at a time -------------------------------------------------------------------


def _numbered(c: Collection, numbers: Keys, *columns: str) -> DataFrame:
    return _only(c.objects.select("id", "objectnumber", *columns), numbers, "objectnumber")


DETAIL_ITEMS = {"collector": "fieldcollectors", "filecode": "contentconcepts", "site": "contentplaces", "department": "responsibledepartments"}


def object_detail(c: Collection, numbers: Keys = None) -> DataFrame:
    """Header row of each object; every brief description gives a row of its own."""
    rows = _numbered(c, numbers, "collection", "numberofobjects", "distinguishingfeatures", "recordstatus", "computedcurrentlocation")
    rows = with_csid(rows, c.hierarchy, how="left")
    rows = _lookups(c, rows, by_type={"objectname": ("objectNameGroup", "objectnamegroup", "objectname")}, items=DETAIL_ITEMS)
    rows = rows.join(c.briefdescriptions.select("id", F.col("item").alias("briefdescription")), "id", "left")
    rows = rows.join(c.objects_ext.select("id", "iscomponent", "legacydepartment", "fieldlocverbatim", "inventoryname"), "id")
    return rows.select(
        "objectnumber", "collection", refname_display_first("collector").alias("collector"), "numberofobjects", "distinguishingfeatures", "recordstatus",
        "objectname", "inventoryname", "briefdescription", refname_display_first("filecode").alias("filecode"), "iscomponent", "legacydepartment",
        "fieldlocverbatim", refname_display_first("site").alias("site"), "department", "csid", "id",
        refname_display("computedcurrentlocation").alias("location"), "computedcurrentlocation")


def object_summary(c: Collection, numbers: Keys = None) -> DataFrame:
    """Short header of each live object."""
    rows = not_deleted(_numbered(c, numbers, "numberofobjects"), c.misc)
    rows = _lookups(
        c, rows,
        by_type={"objectname": ("objectNameGroup", "objectnamegroup", "objectname"), "people": ("assocPeopleGroup", "assocpeoplegroup", "assocpeople")},
        items={"place": "contentplaces", "concept": "contentconcepts"})
    return rows.select(
        "objectnumber", "objectname", "numberofobjects", refname_display("place").alias("fieldcollectionplace"), refname_display("people").alias("culturalgroup"),
        refname_display("concept").alias("ethnographicfilecode"))


def parent_info(c: Collection, numbers: Keys = None) -> DataFrame:
    """The whole that each object is related to, where that is no component itself."""
    pairs = _related_pairs(c, numbers, None, "no")
    child = c.objects.select("id", "objectnumber")
    rows = child.join(pairs.withColumnRenamed("other_id", "parentid"), "id").drop("id").withColumnRenamed("parentid", "id")
    rows = with_csid(rows, c.hierarchy, out="parentcsid")
    rows = rows.join(c.objects.select("id", F.col("objectnumber").alias("parent"), "collection", "distinguishingfeatures"), "id")
    rows = rows.join(c.objects_ext.select("id", "legacydepartment", "fieldlocverbatim"), "id")
    rows = _lookups(c, rows, by_type={"objectname": ("objectNameGroup", "objectnamegroup", "objectname")}, items=DETAIL_ITEMS)
    return rows.select(
        "objectnumber", "parent", "parentcsid", "collection", "distinguishingfeatures", refname_display_first("collector").alias("collector"), "objectname",
        refname_display_first("filecode").alias("filecode"), "legacydepartment", "fieldlocverbatim", refname_display_first("site").alias("site"), "department",
        F.col("id").alias("parent_id"))


def _related_pairs(c: Collection, numbers: Keys, this: str | None, other: str | None) -> DataFrame:
    records = c.objects.select("id")
    asked = records if numbers is None else _numbered(c, numbers).select("id").distinct()
    pairs = linked_in(c, asked, "other_id", "CollectionObject").join(records.withColumnRenamed("id", "other_id"), "other_id", "left_semi")
    for flag, side in ((this, "id"), (other, "other_id")):
        wanted = c.objects_ext if flag is None else c.objects_ext.filter(F.col("iscomponent") == flag)
        pairs = pairs.join(wanted.select(F.col("id").alias(side)), side, "left_semi")
    return pairs.select("id", "other_id")


def child_info(c: Collection, numbers: Keys = None) -> DataFrame:
    """Components of each whole object."""
    pairs = _related_pairs(c, numbers, "no", "yes")
    rows = c.objects.select("id", "objectnumber").join(pairs, "id").drop("id")
    child = with_csid(c.objects.select(F.col("id").alias("other_id"), F.col("objectnumber").alias("child")), c.hierarchy, "other_id", "childcsid")
    return rows.join(child, "other_id").select("objectnumber", "child", "childcsid", F.col("other_id").alias("childid"))


def current_locations(c: Collection, csids: Keys = None) -> DataFrame:
    """Latest movement of each object."""
    objects = _only(with_csid(c.objects.select("id", "objectnumber"), c.hierarchy), csids, "csid")
    moves = linked_in(c, objects, "mid", "Movement")
    moves = moves.join(c.movements.select(F.col("id").alias("mid"), "locationdate", "reasonformove", "currentlocation"), "mid")
    return latest_by(moves, ["csid"], "locationdate", "mid").select(
        "csid", "objectnumber", "locationdate", "reasonformove", refname_display_first("currentlocation").alias("location"))


def accession_info(c: Collection, csids: Keys = None) -> DataFrame:
    """Accession number and first owner of each object's acquisitions."""
    edges = _only(links_of(c).select("subjectcsid", F.col("objectcsid").alias("csid"), F.col("objectid").alias("id")), csids, "subjectcsid")
    owners = c.owners.filter("pos = 0").select("id", F.col("item").alias("owner"))
    rows = edges.join(c.acquisitions.select("id", "acquisitionreferencenumber").join(owners, "id"), "id")
    return rows.select(F.col("subjectcsid").alias("object"), "acquisitionreferencenumber", refname_display_first("owner").alias("donor"), "csid")


def alt_numbers(c: Collection, numbers: Keys = None) -> DataFrame:
    first = members(c.hierarchy, "altNumGroupList", pos=0).join(c.othernumber.withColumnRenamed("id", "_gid"), F.col("member_id") == F.col("_gid"))
    rows = _numbered(c, numbers).join(first, F.col("id") == F.col("parentid"))
    return rows.select(
        "id", "objectnumber", F.col("numbervalue").alias("altnum"), F.col("numbertype").alias("altnumtype"), F.col("numbervaluenote").alias("altnumnote"))


def cultures(c: Collection, ids: Keys = None) -> DataFrame:
    """All cultural groups of each object, in list order."""
    rows = members(_only(c.hierarchy, ids, "parentid"), "assocPeopleGroupList")
    groups = c.assocpeoplegroup.withColumnRenamed("id", "_gid")
    rows = rows.join(groups, F.col("member_id") == F.col("_gid"), "left")
    return rows.select(
        F.col("parentid").alias("id"), "pos", refname_display_first("assocpeople").alias("culturalgroup"), "assocpeopletype", "assocpeoplenote"
    ).orderBy(*sort_keys("id", "pos"))


def production_dates(c: Collection, numbers: Keys = None) -> DataFrame:
    rows = first_of_group(
        _numbered(c, numbers), c.hierarchy, c.structureddategroup, ["datedisplaydate", "dateassociation"], list_name="objectProductionDateGroupList")
    return rows.select("objectnumber", "datedisplaydate", "dateassociation")


def object_media(c: Collection, numbers: Keys = None) -> DataFrame:
    """Media of each object, the primary image first."""
    pairs = linked_in(c, _numbered(c, numbers), "mid")
    media = c.media.select(F.col("id").alias("mid"), "blobcsid", "primarydisplay", "approvedforweb", "description")
    rows = pairs.join(media, "mid").select("objectnumber", "blobcsid", "primarydisplay", "approvedforweb", "description")
    return rows.orderBy(*sort_keys("objectnumber", "-primarydisplay", "blobcsid"))


def csid_lookup(c: Collection, kind: str, values: DataFrame) -> DataFrame:
    """External ids of numbers, crate names or place names (first column of ``values``).

    A crate or place matches by its display name without regard to case.
    """
    wanted = values.select(F.col(values.columns[0]).alias("value")).distinct()
    if kind == "objectnumber":
        source, key, probe = c.objects, F.col("objectnumber"), F.col("value")
    elif kind == "crate":
        source, key, probe = c.objects_ext, F.lower(refname_display("computedcrate")), F.lower("value")
    elif kind == "place":
        source, key, probe = c.places, F.lower(refname_display("refname")), F.lower("value")
    else:
        raise ValueError(f"unknown lookup: {kind}")
    keyed = with_csid(source.select("id", key.alias("_key")), c.hierarchy)
    return wanted.withColumn("_probe", probe).join(keyed, F.col("_probe") == F.col("_key")).select("value", "csid")


def csid_detail(c: Collection, detail: str, csids: Keys = None) -> DataFrame:
    """``(csid, value)``: one field of each object."""
    objects = _only(with_csid(c.objects.select("id", "objectnumber", "numberofobjects"), c.hierarchy), csids, "csid")
    if detail == "objNumber":
        return objects.select("csid", F.col("objectnumber").alias("value"))
    if detail == "objcount":
        return objects.select("csid", F.col("numberofobjects").cast("string").alias("value"))
    if detail == "fieldcollectionplace":
        first = c.contentplaces.filter("pos = 0").select("id", "item")
        return objects.join(first, "id").select("csid", refname_display_first("item").alias("value"))
    if detail == "assocpeoplegroup":
        rows = first_of_group(objects, c.hierarchy, c.assocpeoplegroup, ["assocpeople"], primarytype="assocPeopleGroup", or_null=True)
        return rows.select("csid", refname_display_first("assocpeople").alias("value"))
    raise ValueError(f"unknown detail: {detail}")
