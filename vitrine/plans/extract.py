"""The nightly extract: field frames, special frames, and the two wide outputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import (
    MULTI, blank_if_null, collapse_ctrl_ws, dimension_text, escape_backslash, local_date, plain_date, refname_display,
    replace_delim, scrub_newlines, strip_field_quotes,
)
from vitrine.operators.aggregates import multi_value, multi_value_distinct, union_all
from vitrine.operators.filters import non_blank, non_null, not_deleted
from vitrine.operators.joins import (
    csids, first_of_group, group_values, in_list, media_rows, members, merge_list, pivot_fields, records, with_csid,
)
from vitrine.operators.ordering import sequence_id
from vitrine.plans.links import linked
from vitrine.plans.model import Collection
from vitrine.session import cut_lineage

# The table and field pairs of each template kind.  The two pairs
# whose output a special frame repeats under the same name (lender, credit line)
# are left out, since they are keyed by the loan and never match an object.
FIELD_PAIRS: dict[int, list[tuple[str, str]]] = {
    1: [
        ("objects", "assocCulturalContext"), ("objects", "assocOrganization"), ("objects", "assocPerson"), ("objects", "assocPlace"),
        ("objects", "material"), ("objects", "measuredPart"), ("objects", "objectProductionOrganization"),
        ("objects", "objectProductionPerson"), ("objects", "objectProductionPlace"), ("objects", "title"), ("objects", "technique"),
        ("loansout", "loanStatus"),
    ],
    2: [
        ("objects", "comments"), ("objects", "styles"), ("objects", "colors"), ("objects", "contentconcepts"), ("objects", "contentplaces"),
        ("objects", "contentpersons"), ("objects", "contentorganizations"), ("objects", "exhibitionhistories"), ("objects", "photos"),
    ],
    3: [("loansout", "loanoutnumber"), ("loansout", "borrower"), ("loansin", "loaninnumber"), ("objectexit", "exitnumber")],
    5: [("loansout", "loanoutdate"), ("loansin", "loanindate")],
}


# ---- field templates ------------------------------------------------------------------


def _group_rows(c: Collection, table: str, field: str) -> DataFrame:
    """``(id, pos, value)`` of a record table's repeating group, live records, no nulls."""
    group = c[f"{field.lower()}group"].select(F.col("id").alias("_gid"), F.col(field.lower()).alias("value"))
    rows = members(c.hierarchy, primarytype=f"{field}Group").join(group, F.col("member_id") == F.col("_gid"))
    live = not_deleted(c[table].select("id"), c.misc)
    joined = rows.join(live, F.col("parentid") == F.col("id"), "left_semi")
    return non_null(joined, "value").select(F.col("parentid").alias("id"), "pos", "value")


def object_links(c: Collection) -> DataFrame:
    """``(id, pid, side, doctype)``: each edge that touches an object, by record ids.

    ``side`` says whether the object is the edge's subject or object, ``doctype`` is
    the type of the edge's object.
    """
    if "edges" in c:
        records, keep = c.objects.select("id"), ["objectdocumenttype"]
        both = [("subject", linked(records, c.edges, "pid", keep=keep)), ("object", linked(records, c.edges, "pid", direction="object", keep=keep))]
        return union_all([df.select("id", "pid", F.lit(side).alias("side"), F.col("objectdocumenttype").alias("doctype")) for side, df in both])
    # Ends know whether they are objects, so the edges are dealt by each csid once and not again by id.
    objects = c.objects.select(F.col("id").alias("_object"))
    ends = csids(c.hierarchy, "_id", "_csid").join(objects, F.col("_id") == F.col("_object"), "left")
    rows = c.relations.select("subjectcsid", "objectcsid", F.col("objectdocumenttype").alias("doctype"))
    for end in ("subject", "object"):
        named = ends.select(F.col("_csid").alias(f"{end}csid"), F.col("_id").alias(f"{end}id"), F.col("_object").alias(f"{end}own"))
        rows = rows.join(named, f"{end}csid").drop(f"{end}csid")
    sides = [F.struct(F.lit(here).alias("side"), F.col(f"{here}own").alias("id"), F.col(f"{there}id").alias("pid"))
             for here, there in (("subject", "object"), ("object", "subject"))]
    return rows.select("doctype", F.inline(F.array(*sides))).filter("id IS NOT NULL").select("id", "pid", "side", "doctype")


def _links(c: Collection, side: str, doc_type: str | None) -> DataFrame:
    links = object_links(c).filter(F.col("side") == side)
    return (links if doc_type is None else links.filter(F.col("doctype") == doc_type)).select("id", "pid")


def _to_objects(c: Collection, table: str, columns: list[str], doc_type: str | None = None) -> DataFrame:
    """Live rows of a procedure table, once per live object they point at."""
    rows = not_deleted(c[table].select(F.col("id").alias("pid"), *columns), c.misc, "pid")
    return not_deleted(_links(c, "object", doc_type).join(rows, "pid"), c.misc)


def _from_objects(c: Collection, doc_type: str | None) -> DataFrame:
    """``(id, pid)``: every object and the records it points at."""
    return _links(c, "subject", doc_type)


def field_extract(c: Collection, table: str, field: str, kind: int, compat: bool = False) -> DataFrame:
    """``(id, <field>_ss)``: one multi-valued field, by template kind.

    1 repeating group, 2 repeating scalar, 3 field of a related procedure, 4 date of
    a repeating group, 5 date of a related procedure, 6 field over a typed relation.
    Values are cleaned and then joined; ``compat`` cleans kinds 3 and 6 after joining.
    """
    out = f"{field.lower()}_ss"
    if kind == 1:
        return multi_value(_group_rows(c, table, field), "id", {out: collapse_ctrl_ws(refname_display("value"))})
    if kind == 2:
        live = not_deleted(c[table].select("id"), c.misc)
        items = non_null(c[field.lower()], "item").join(live, "id", "left_semi")
        return multi_value(items, "id", {out: collapse_ctrl_ws(refname_display("item"))})
    if kind == 4:
        return multi_value(_group_rows(c, table, field), "id", {out: plain_date("value")})
    value = field.lower()
    if kind == 5:
        return multi_value_distinct(_to_objects(c, table, [value]), "id", {out: local_date(value)})
    if kind == 3:
        rows, rule = _to_objects(c, table, [value]), refname_display
    elif kind == 6:
        target = not_deleted(c[table].select(F.col("id").alias("pid"), value), c.misc, "pid")
        rows, rule = _from_objects(c, doc_type_of(table)).join(target, "pid"), collapse_ctrl_ws
    else:
        raise ValueError(f"unknown field kind: {kind}")
    if compat:
        return multi_value_distinct(rows, "id", {out: F.col(value)}).withColumn(out, rule(out))
    return multi_value_distinct(rows, "id", {out: rule(value)})


# Document type of a procedure table.
DOC_TYPES = {
    "groups": "Group", "acquisitions": "Acquisition", "exhibitions": "Exhibition", "loansin": "Loanin", "loansout": "Loanout",
    "conditionchecks": "Conditioncheck", "conservation": "Conservation", "movements": "Movement",
}


def doc_type_of(table: str) -> str:
    return DOC_TYPES[table]


# ---- base rows ---------------------------------------------------------------------------


def _base(c: Collection, columns: list[str], ext: list[str]) -> DataFrame:
    rows = with_csid(not_deleted(c.objects.select("id", *columns), c.misc), c.hierarchy)
    return rows.join(c.objects_ext.select("id", *ext), "id")


def basic_extract(c: Collection) -> DataFrame:
    """Base wide row of every live object (22 columns)."""
    plain = ["objectnumber", "numberofobjects", "computedcurrentlocation"]
    names = ["recordstatus", "fieldcollectionplace", "collection"]
    texts = ["physicaldescription", "contentdescription", "contentnote"]
    flags = ["sortableobjectnumber", "art", "history", "science", "donotpublishonweb", "computedcurrentlocationdisplay"]
    notes = ["argusremarks", "argusdescription"]
    rows = _base(c, plain + names + texts, [*flags, "ipaudit", *notes])
    rows = first_of_group(rows, c.hierarchy, c.objectnamegroup, ["objectname"], list_name="objectNameList")
    rows = first_of_group(rows, c.hierarchy, c.determinationhistorygroup, ["dhname"], list_name="determinationHistoryGroupList")
    return rows.select(
        "id", F.col("csid").alias("csid_s"), refname_display("objectname").alias("objectname_s"),
        F.col("objectnumber").alias("objectnumber_s"), F.col("numberofobjects").alias("numberofobjects_s"),
        F.col("computedcurrentlocation").alias("computedcurrentlocationrefname_s"), refname_display("dhname").alias("dhname_s"),
        *[F.col(n).alias(f"{n}_s") for n in flags[:-1]], F.col("computedcurrentlocationdisplay").alias("computedcurrentlocation_s"),
        *[refname_display(n).alias(f"{n}_s") for n in [*names, "ipaudit"]],
        *[collapse_ctrl_ws(n).alias(f"{n}_s") for n in texts + notes],
    )


def _raw(name: str) -> Column:
    return F.col(name)


# Single-valued lookups of the full metadata row, as output field:
# (list name, group table, column, whether the column is a refname).
GROUP_LOOKUPS: dict[str, tuple[str, str, str, bool]] = {
    "objectname_s": ("objectNameList", "objectnamegroup", "objectname", True),
    "exhibitionobjectnumber_s": ("exhibitionobjectGroupList", "exhibitionobjectgroup", "exhibitionobjectnumber", False),
    "exhibitionobjectnumberlocal_s": ("exhibitionObjectLocalGroupList", "exhibitionobjectlocalgroup", "exhibitionobjectnumberlocal", False),
    "grouptitle_s": ("Groups_CommonList", "groups", "title", False),
    "title_s": ("titleGroupList", "titlegroup", "title", False),
    "responsibledepartment_s": ("Groups_CommonList", "groups", "responsibledepartment", False),
    "dimensionsummary_s": ("measuredPartGroupList", "measuredpartgroup", "dimensionsummary", False),
    "mmeasuredpart_s": ("measuredPartGroupList", "measuredpartgroup", "measuredpart", True),
    "dhname_s": ("determinationHistoryGroupList", "determinationhistorygroup", "dhname", True),
    "materials_s": ("materialGroupList", "materialgroup", "materialsource", False),
    "objectcomponentname_s": ("objectComponentGroupList", "objectcomponentgroup", "objectcomponentname", False),
    "objectcomponentinformation_s": ("objectComponentGroupList", "objectcomponentgroup", "objectcomponentinformation", False),
    "dimension_s": ("dimensionsubGroupList", "dimensionsubgroup", "dimension", False),
    "objectproductionperson_s": ("objectProductionPersonGroupList", "objectproductionpersongroup", "objectproductionperson", True),
    "objectproductionorganization_s": ("objectProductionOrganizationGroupList", "objectproductionorganizationgroup", "objectproductionorganization", True),
    "objectproductionplace_s": ("objectProductionPlaceGroupList", "objectproductionplacegroup", "objectproductionplace", True),
    "objectproductionplacerole_s": ("objectProductionPlaceGroupList", "objectproductionplacegroup", "objectproductionplacerole", False),
    "assocperson_s": ("assocPersonGroupList", "assocpersongroup", "assocperson", True),
    "assocorganization_s": ("assocOrganizationGroupList", "assocorganizationgroup", "assocorganization", True),
    "assocplace_s": ("assocPlaceGroupList", "assocplacegroup", "assocplace", True),
    "assocculturalcontext_s": ("assocCulturalContextGroupList", "assocculturalcontextgroup", "assocculturalcontext", False),
    "lender_s": ("lenderGroupList", "lendergroup", "lender", False),
    "loanstatusnote_s": ("loanStatusGroupList", "loanstatusgroup", "loanstatusnote", False),
    "loanstatus_s": ("loanStatusGroupList", "loanstatusgroup", "loanstatus", False),
    "loanstatusdate_s": ("loanStatusGroupList", "loanstatusgroup", "loanstatusdate", False),
    "condition_s": ("conditioncheckGroupList", "conditioncheckgroup", "condition", False),
    "conditiondate_s": ("conditioncheckGroupList", "conditioncheckgroup", "conditiondate", False),
    "hazardnote_s": ("hazardGroupList", "hazardgroup", "hazardnote", False),
    "hazard_s": ("hazardGroupList", "hazardgroup", "hazard", False),
    "hazarddate_s": ("hazardGroupList", "hazardgroup", "hazarddate", False),
    "conservationstatus_s": ("conservationstatusGroupList", "conservationstatusgroup", "status", False),
    "conservationstatusdate_s": ("conservationstatusGroupList", "conservationstatusgroup", "statusdate", False),
}
ITEM_LOOKUPS: dict[str, tuple[str, bool]] = {
    "comments_s": ("comments", False),
    "styles_s": ("styles", True),
    "colors_s": ("colors", True),
    "contentconcept_s": ("contentconcepts", True),
    "contentplace_s": ("contentplaces", True),
    "contentperson_s": ("contentpersons", True),
    "contentorganization_s": ("contentorganizations", True),
}
# Column order of the full metadata row.
METADATA_COLUMNS = """csid_s objectcsid_s objectname_s objectnumber_s recordstatus_s comments_s styles_s colors_s physicaldescription_s
contentdescription_s contentconcept_s contentplace_s contentperson_s contentorganization_s contentnote_s fieldcollectionplace_s collection_s
numberofobjects_s computedcurrentlocationrefname_s sortableobjectnumber_s art_s history_s science_s ipaudit_s computedcurrentlocation_s
argusremarks_s argusdescription_s exhibitionobjectnumber_s exhibitionobjectnumberlocal_s grouptitle_s title_s responsibledepartment_s
dimensionsummary_s mmeasuredpart_s dhname_s materials_s objectcomponentname_s objectcomponentinformation_s dimension_s objectproductionperson_s
objectproductionorganization_s objectproductionplace_s objectproductionplacerole_s assocperson_s assocorganization_s assocplace_s
assocculturalcontext_s lender_s loanstatusnote_s loanstatus_s loanstatusdate_s condition_s conditiondate_s hazardnote_s hazard_s hazarddate_s
conservationstatus_s conservationstatusdate_s""".split()


def _metadata_parts(c: Collection) -> tuple[DataFrame, DataFrame]:
    """Base columns per live object, and all lookups in long form ``(id, field, value)``."""
    plain = ["objectnumber", "physicaldescription", "contentdescription", "contentnote", "numberofobjects", "computedcurrentlocation"]
    names = ["recordstatus", "fieldcollectionplace", "collection"]
    flags = ["sortableobjectnumber", "art", "history", "science"]
    notes = ["argusremarks", "argusdescription"]
    base = _base(c, plain + names, [*flags, "computedcurrentlocationdisplay", "ipaudit", *notes])
    base = base.select(
        F.col("csid").alias("csid_s"), F.col("id").alias("objectcsid_s"),
        *[F.col(n).alias(f"{n}_s") for n in [*plain[:-1], *flags]], F.col("computedcurrentlocation").alias("computedcurrentlocationrefname_s"),
        F.col("computedcurrentlocationdisplay").alias("computedcurrentlocation_s"),
        *[refname_display(n).alias(f"{n}_s") for n in [*names, "ipaudit"]],
        *[replace_delim(n, "|", " ").alias(f"{n}_s") for n in notes],
    )
    groups = {
        out: (list_name, c[table], refname_display(col) if is_ref else _raw(col))
        for out, (list_name, table, col, is_ref) in GROUP_LOOKUPS.items()
        if c.has(table)
    }
    long = group_values(c.hierarchy, groups).select("id", "field", "value")
    items = union_all([
        c[table].filter("pos = 0").select("id", F.lit(out).alias("field"), (refname_display("item") if is_ref else _raw("item")).alias("value"))
        for out, (table, is_ref) in ITEM_LOOKUPS.items() if c.has(table)
    ])
    return base, long.union(items)


def metadata_extract(c: Collection) -> DataFrame:
    """Full single-valued row of every live object (58 columns).

    All first-of-list lookups are read in long form with one pass over the hierarchy
    and pivoted once, in place of one self-join per list.  A list whose table the
    collection is declared to lack gives nulls.
    """
    base, lookups = _metadata_parts(c)
    wide = pivot_fields(lookups, [*GROUP_LOOKUPS, *ITEM_LOOKUPS])
    joined = base.join(wide, F.col("objectcsid_s") == F.col("id"), "left")
    return joined.select(*METADATA_COLUMNS)


# ---- special frames --------------------------------------------------------------------------


def dimension_summary(c: Collection) -> DataFrame:
    rows = _base(c, [], [])
    return first_of_group(rows, c.hierarchy, c.measuredpartgroup, {"dimensionsummary": "dimensionsummary_s"}, list_name="measuredPartGroupList").select(
        "id", "dimensionsummary_s")


def other_number(c: Collection) -> DataFrame:
    rows = _base(c, [], [])
    return first_of_group(rows, c.hierarchy, c.othernumber, {"numbervalue": "othernumber_s"}, list_name="otherNumberList").select("id", "othernumber_s")


def group_titles(c: Collection) -> DataFrame:
    groups = not_deleted(c.groups.select(F.col("id").alias("pid"), "title"), c.misc, "pid")
    return multi_value_distinct(_from_objects(c, "Group").join(groups, "pid"), "id", {"grouptitle_ss": F.col("title")})


ACQUISITION_FIELDS = ["acquisitionreferencenumber", "accessiondate", "acquisitiondate", "creditline"]


def _acquired(c: Collection) -> DataFrame:
    """Acquisitions with the first of each of their two dates."""
    acquired = c.acquisitions.select(F.col("id").alias("pid"), "acquisitionreferencenumber", "creditline")
    for name, list_name in (("accessiondate", "accessionDateGroup"), ("acquisitiondate", "acquisitionDateGroupList")):
        acquired = first_of_group(
            acquired, c.hierarchy.filter("primarytype = 'structuredDateGroup'"), c.structureddategroup, {"datedisplaydate": name},
            list_name=list_name, or_null=True, id="pid")
    record = records(c.hierarchy).filter("pos = 0 OR pos IS NULL").select(F.col("id").alias("pid"))
    return acquired.join(record, "pid", "left_semi")


def acquisition_fields(c: Collection) -> DataFrame:
    """Reference numbers, both dates and credit lines, each list distinct."""
    rows = _from_objects(c, "Acquisition").join(_acquired(c), "pid")
    return multi_value_distinct(rows, "id", {f"{f}_ss": F.col(f) for f in ACQUISITION_FIELDS})


def exhibition_fields(c: Collection) -> DataFrame:
    """Numbers and titles; the joins that cannot change a distinct list are left out."""
    shown = c.exhibitions.select(F.col("id").alias("pid"), F.col("exhibitionnumber"), F.col("title").alias("exhibitiontitle"))
    rows = _from_objects(c, "Exhibition").join(shown, "pid", "left")
    return multi_value_distinct(rows, "id", {f"{f}_ss": F.col(f) for f in ("exhibitionnumber", "exhibitiontitle")})


def procedure_list(c: Collection, table: str, primarytype: str, group: str, values: Mapping[str, Column], required: str) -> DataFrame:
    """Lists of a procedure's repeating group, per object the procedure points at."""
    columns = c[group].withColumnRenamed("id", "_gid").filter(F.col(required).isNotNull())
    rows = members(c.hierarchy, primarytype=primarytype).join(columns, F.col("member_id") == F.col("_gid"))
    pairs = _to_objects(c, table, [], "CollectionObject")
    joined = pairs.join(rows, F.col("pid") == F.col("parentid"))
    return multi_value(joined, "id", values)


def lender(c: Collection) -> DataFrame:
    value = collapse_ctrl_ws(refname_display("lender"))
    return procedure_list(c, "loansin", "lenderGroup", "lendergroup", {"lender_ss": value}, "lender")


def loan_status(c: Collection, table: str, out: str) -> DataFrame:
    value = collapse_ctrl_ws(refname_display("loanstatus"))
    return procedure_list(c, table, "loanStatusGroup", "loanstatusgroup", {out: value}, "loanstatus")


def loan_in_status(c: Collection) -> DataFrame:
    return loan_status(c, "loansin", "loaninstatus_ss")


def loan_out_status(c: Collection) -> DataFrame:
    return loan_status(c, "loansout", "loanoutstatus_ss")


def loan_return(c: Collection, table: str, out: str) -> DataFrame:
    return multi_value_distinct(_to_objects(c, table, ["loanreturndate"]), "id", {out: local_date("loanreturndate")})


def loan_in_return(c: Collection) -> DataFrame:
    return loan_return(c, "loansin", "loaninreturndate_ss")


def loan_out_return(c: Collection) -> DataFrame:
    return loan_return(c, "loansout", "loanoutreturndate_ss")


def hazard(c: Collection) -> DataFrame:
    value = collapse_ctrl_ws(refname_display("hazard"))
    return procedure_list(c, "conditionchecks", "hazardGroup", "hazardgroup", {"hazard_ss": value}, "hazard")


def conservation(c: Collection) -> DataFrame:
    values = {"conservationstatus_ss": refname_display("status"), "conservationstatusdate_ss": local_date("statusdate")}
    return procedure_list(c, "conservation", "conservationStatusGroup", "conservationstatusgroup", values, "status")


def _dimension_rows(c: Collection) -> DataFrame:
    """``(id, pos, dimension, value, measurementunit)`` of each measured part, under its parent.

    Parts and their dimensions are both members: one pass over the hierarchy finds them, and they meet by the part.
    """
    columns = ["dimension", "value", "measurementunit"]
    found = c.dimensionsubgroup.select(F.col("id").alias("_gid"), F.struct(*columns).alias("_sub"))
    found = found.unionByName(c.measuredpartgroup.select(F.col("id").alias("_gid")), allowMissingColumns=True)
    rows = members(c.hierarchy).join(found, F.col("member_id") == F.col("_gid"))
    is_part = F.col("_sub").isNull()
    parts = rows.groupBy(F.when(is_part, F.col("member_id")).otherwise(F.col("parentid")).alias("_part")).agg(
        F.max(F.when(is_part, F.col("parentid"))).alias("id"), F.collect_list(F.when(~is_part, F.struct("pos", "_sub"))).alias("_subs"))
    return parts.filter("id IS NOT NULL").select("id", F.inline("_subs")).select("id", "pos", "_sub.*")


def object_dimensions(c: Collection) -> DataFrame:
    """``(id, pos, dimension, value, measurementunit)`` over the measured parts of each object."""
    return _dimension_rows(c).join(c.objects.select("id"), "id", "left_semi")


def dimensions(c: Collection) -> DataFrame:
    """All dimension texts of an object, by position and then unit from the highest."""
    text = dimension_text("dimension", "value", "measurementunit")
    rows = object_dimensions(c).withColumn("txt", text)
    cell = F.expr(f"listagg(txt, '{MULTI}') WITHIN GROUP (ORDER BY pos, measurementunit DESC NULLS FIRST, txt)")
    return rows.groupBy("id").agg(cell.alias("dimensions_ss"))


def _condition_values() -> dict[str, Column]:
    return {
        "condition_ss": refname_display("condition"), "conditiondate_ss": local_date("conditiondate"),
        "conditioncheckrefnumber_ss": refname_display("conditioncheckrefnumber"),
    }


def condition_checks(c: Collection) -> DataFrame:
    """``(pid, condition, conditiondate, conditioncheckrefnumber)`` of the checks that are not deleted and say something."""
    checks = non_blank(c.conditionchecks_ext, "condition").select(F.col("id").alias("pid"), "condition", "conditiondate")
    checks = not_deleted(checks, c.misc, "pid")
    numbers = c.conditionchecks.select(F.col("id").alias("pid"), "conditioncheckrefnumber")
    return checks.join(numbers, "pid", "left")


def condition(c: Collection) -> DataFrame:
    """Condition, date and reference number over any relation; deleted checks drop."""
    rows = _from_objects(c, None).join(condition_checks(c), "pid")
    return multi_value(rows, "id", _condition_values(), order=["conditiondate", "pid"])


def _structured_dates(c: Collection, rows: DataFrame) -> DataFrame:
    dates = c.structureddategroup.withColumnRenamed("id", "_gid")
    live = not_deleted(c.objects.select("id"), c.misc)
    joined = rows.join(dates, F.col("member_id") == F.col("_gid"))
    return joined.join(live, F.col("parentid") == F.col("id"), "left_semi").withColumnRenamed("parentid", "id")


def field_collection_date(c: Collection) -> DataFrame:
    rows = non_blank(_structured_dates(c, members(c.hierarchy, "fieldCollectionDateGroup")), "datedisplaydate")
    rows = rows.join(c.objects_ext.select("id"), "id", "left_semi")
    return multi_value_distinct(rows, "id", {"fieldcollectiondate_ss": F.col("datedisplaydate")})


def production_date(c: Collection) -> DataFrame:
    """Every structured date of the record, as the source has it, not only production dates."""
    rows = non_null(_structured_dates(c, members(c.hierarchy, primarytype="structuredDateGroup")), "datedisplaydate")
    values = {"objectproductiondate_ss": F.col("datedisplaydate"), "objectproductionscalardate_ss": local_date("dateearliestscalarvalue")}
    return multi_value(rows, "id", values, order=["pos", "member_id"])


# ---- outputs ---------------------------------------------------------------------------------


# Fields of the special frames, in the order the frames are added.
SPECIAL_FIELDS = """dimensionsummary_s grouptitle_ss othernumber_s acquisitionreferencenumber_ss accessiondate_ss acquisitiondate_ss creditline_ss
exhibitionnumber_ss exhibitiontitle_ss lender_ss loaninreturndate_ss loanoutreturndate_ss dimensions_ss loaninstatus_ss loanoutstatus_ss hazard_ss
conservationstatus_ss conservationstatusdate_ss condition_ss conditiondate_ss conditioncheckrefnumber_ss fieldcollectiondate_ss objectproductiondate_ss
objectproductionscalardate_ss""".split()


def frame_fields(c: Collection) -> list[str]:
    """Fields that the frames add to the base row, without those of tables the collection is declared to lack."""
    named = []
    for kind, pairs in FIELD_PAIRS.items():
        for table, field in pairs:
            source = {1: f"{field.lower()}group", 2: field.lower()}.get(kind, table)
            if c.has(table) and c.has(source):
                named.append(f"{field.lower()}_ss")
    return named + SPECIAL_FIELDS


def _clean(col: str) -> Column:
    return collapse_ctrl_ws(refname_display(col))


def _values(frame: DataFrame, values: Mapping[str, Column], key: str = "id", pos: Column | None = None, tie: Column | None = None, *more: str) -> DataFrame:
    """``(key, field, pos, tie, value, more…)`` of some columns, nulls left out; ``pos`` and ``tie`` order a cell's values."""
    pairs = F.array(*[F.struct(F.lit(out).alias("field"), v.cast("string").alias("value")) for out, v in values.items()])
    none = F.lit(None)
    rows = frame.select(key, (none if pos is None else pos).cast("int").alias("pos"), (none if tie is None else tie).cast("string").alias("tie"), F.inline(pairs), *more)
    return rows.filter("value IS NOT NULL").select(key, "field", "pos", "tie", "value", *more)


def _group_values(c: Collection) -> DataFrame:
    """``(id, field, pos, value)`` of every repeating group of the objects and loans."""
    groups = {
        f"{field.lower()}_ss": (f"{field}Group", c[f"{field.lower()}group"], _clean(field.lower()))
        for table, field in FIELD_PAIRS[1] if c.has(table) and c.has(f"{field.lower()}group")
    }
    return group_values(c.hierarchy, groups, pos=None, by="primarytype")


def _item_values(c: Collection) -> DataFrame:
    """``(id, field, pos, value)`` of every list of the objects."""
    return union_all([
        c[field].select("id", F.lit(f"{field}_ss").alias("field"), "pos", _clean("item").alias("value"))
        for _, field in FIELD_PAIRS[2] if c.has(field)
    ])


def _single_values(c: Collection) -> DataFrame:
    """``(id, field, pos, value)`` of the fields that hold the first of a list."""
    return group_values(c.hierarchy, {
        "dimensionsummary_s": ("measuredPartGroupList", c.measuredpartgroup, F.col("dimensionsummary")),
        "othernumber_s": ("otherNumberList", c.othernumber, F.col("numbervalue")),
    })


def _date_values(c: Collection) -> DataFrame:
    """Values of the structured dates: of a record's own lists for production, of one list for collection."""
    dates = c.structureddategroup.select(F.col("id").alias("_gid"), "datedisplaydate", "dateearliestscalarvalue").filter("datedisplaydate IS NOT NULL")
    made, found = F.col("primarytype") == "structuredDateGroup", in_list(c.hierarchy, "fieldCollectionDateGroup")
    rows = c.hierarchy.filter(made | found).select(F.col("parentid").alias("id"), F.col("id").alias("member_id"), "pos", made.alias("_made"), found.alias("_found"))
    rows = rows.join(dates, F.col("member_id") == F.col("_gid"))
    production = {"objectproductiondate_ss": F.col("datedisplaydate"), "objectproductionscalardate_ss": local_date("dateearliestscalarvalue")}
    collected = F.when(F.col("_found") & (F.col("datedisplaydate") != ""), F.col("datedisplaydate"))
    values = {n: F.when(F.col("_made"), v) for n, v in production.items()} | {"fieldcollectiondate_ss": collected}
    return _values(rows, values, "id", F.col("pos"), F.col("member_id"))


def _procedure_values(c: Collection) -> DataFrame:
    """``(pid, field, pos, tie, value, side, wanted)`` of every related procedure's fields.

    ``side`` and ``wanted`` say which links the value follows: the object's side of the edge, and the type of the edge's object.
    """

    def long(frame: DataFrame, values: Mapping[str, Column], side: str, doc_type: str | None, pos: Column | None = None, tie: Column | None = None) -> DataFrame:
        tagged = frame.withColumns({"side": F.lit(side), "wanted": F.lit(doc_type).cast("string")})
        return _values(tagged, values, "pid", pos, tie, "side", "wanted")

    fields: dict[str, dict[str, Column]] = {}
    for kind, rule in ((3, refname_display), (5, local_date)):
        for table, field in FIELD_PAIRS[kind]:
            if c.has(table):
                fields.setdefault(table, {})[f"{field}_ss"] = rule(field)
    fields["loansin"]["loaninreturndate_ss"] = local_date("loanreturndate")
    fields["loansout"]["loanoutreturndate_ss"] = local_date("loanreturndate")
    live = [long(c[table].withColumnRenamed("id", "pid"), values, "object", None) for table, values in fields.items()]
    live.append(long(c.groups.withColumnRenamed("id", "pid"), {"grouptitle_ss": F.col("title")}, "subject", "Group"))
    checks = condition_checks(c)
    at = F.coalesce(F.lpad((F.unix_micros(F.col("conditiondate").cast("timestamp")) + F.lit(1 << 62)).cast("string"), 20, "0"), F.lit(""))
    rest = [
        long(checks, _condition_values(), "subject", None, tie=F.concat(at, "pid")),
        long(_acquired(c), {f"{f}_ss": F.col(f) for f in ACQUISITION_FIELDS}, "subject", "Acquisition"),
        long(c.exhibitions.select(F.col("id").alias("pid"), "exhibitionnumber", "title"),
             {"exhibitionnumber_ss": F.col("exhibitionnumber"), "exhibitiontitle_ss": F.col("title")}, "subject", "Exhibition"),
        long(_procedure_list_values(c).withColumnRenamed("field", "_field"), {"": F.col("value")}, "object", "CollectionObject", F.col("pos"), F.col("_field"))
        .select("pid", F.col("tie").alias("field"), "pos", F.lit(None).cast("string").alias("tie"), "value", "side", "wanted"),
    ]
    return union_all([not_deleted(union_all(live), c.misc, "pid"), *rest])


def _procedure_list_values(c: Collection) -> DataFrame:
    """``(pid, field, pos, value)`` of every live procedure's repeating groups."""
    # output: procedure table, member type, group table, value, column that must be there
    specs = {
        "lender_ss": ("loansin", "lenderGroup", "lendergroup", _clean("lender"), "lender"),
        "loaninstatus_ss": ("loansin", "loanStatusGroup", "loanstatusgroup", _clean("loanstatus"), "loanstatus"),
        "loanoutstatus_ss": ("loansout", "loanStatusGroup", "loanstatusgroup", _clean("loanstatus"), "loanstatus"),
        "hazard_ss": ("conditionchecks", "hazardGroup", "hazardgroup", _clean("hazard"), "hazard"),
        "conservationstatus_ss": ("conservation", "conservationStatusGroup", "conservationstatusgroup", refname_display("status"), "status"),
        "conservationstatusdate_ss": ("conservation", "conservationStatusGroup", "conservationstatusgroup", local_date("statusdate"), "status"),
    }
    tables = {group: c[group].filter(F.col(needed).isNotNull()) for _, _, group, _, needed in specs.values()}
    groups = {out: (kind, tables[group], value) for out, (_, kind, group, value, _) in specs.items()}
    values = group_values(c.hierarchy, groups, pos=None, by="primarytype").withColumnRenamed("id", "pid")
    owners = union_all([c[table].select(F.col("id").alias("pid"), F.lit(out).alias("field")) for out, (table, *_) in specs.items()])
    return values.join(not_deleted(owners, c.misc, "pid"), ["pid", "field"], "left_semi").select("pid", "field", "pos", "value")


# Fields of one value, and fields whose cell holds each value once; the cells of all others are lists.
SINGLE_FIELDS = ["dimensionsummary_s", "othernumber_s"]


def _distinct_fields() -> list[str]:
    related = [f"{field}_ss" for kind in (3, 5) for _, field in FIELD_PAIRS[kind]]
    return [*related, "loaninreturndate_ss", "loanoutreturndate_ss", "grouptitle_ss", *[f"{f}_ss" for f in ACQUISITION_FIELDS],
            "exhibitionnumber_ss", "exhibitiontitle_ss", "fieldcollectiondate_ss"]


def _cells(values: DataFrame) -> DataFrame:
    """``(id, field, value)``: the cells of values ``(id, field, pos, tie, value)``, which are dealt by id once."""
    return _dealt_cells(values.repartition("id"))


def _dealt_cells(values: DataFrame, key: str = "id") -> DataFrame:
    """``(key, field, value)``: the cells of values ``(key, field, pos, tie, value)`` that are dealt by key.

    Lists go by pos, tie and value, dimensions by pos and from the highest tie, distinct values by themselves.
    """
    field, value = F.col("field"), F.col("value")
    single, distinct, sized = field.isin(SINGLE_FIELDS), field.isin(_distinct_fields()), field == "dimensions_ss"
    kinds = values.select(
        key, "field", "pos", "tie", F.when(single, value).alias("_one"), F.when(distinct, value).alias("_each"), F.when(sized, value).alias("_size"),
        F.when(~single & ~distinct & ~sized, value).alias("_listed"))
    made = kinds.groupBy(key, "field").agg(
        F.max("_one").alias("_one"), F.collect_set("_each").alias("_each"),
        F.expr(f"listagg(_size, '{MULTI}') WITHIN GROUP (ORDER BY pos, tie DESC NULLS FIRST, _size)").alias("_size"),
        F.expr(f"listagg(_listed, '{MULTI}') WITHIN GROUP (ORDER BY pos, tie, _listed)").alias("_listed"))
    each = F.when(F.size("_each") > 0, F.array_join(F.array_sort("_each"), MULTI))
    return made.select(key, "field", F.coalesce("_one", each, "_size", "_listed").alias("value"))


def _given(c: Collection) -> DataFrame:
    """``(there, side, wanted, entries)``: what each related procedure gives, a row for each kind of link that it follows.

    ``there`` is the procedure's csid, or its record id where the links are stored by ids.
    """
    entries = F.collect_list(F.struct("field", "pos", "tie", "value")).alias("entries")
    given = _procedure_values(c).repartition("pid").groupBy("pid", "side", "wanted").agg(entries)
    if "edges" in c:
        return given.withColumnRenamed("pid", "there")
    return with_csid(given, c.hierarchy, "pid", "there").drop("pid")


def _related_cells(c: Collection, given: DataFrame, side: str) -> DataFrame:
    """``(id, field, value)``: the cells that procedures fill whose links have the object on ``side``.

    A procedure's values stay in one row until they are with its objects; an object is known by its csid until then.
    """
    edges, key = (c.edges, "id") if "edges" in c else (c.relations, "csid")
    other = "object" if side == "subject" else "subject"
    links = edges.select(F.col(f"{side}{key}").alias("here"), F.col(f"{other}{key}").alias("there"), F.col("objectdocumenttype").alias("doctype"))
    rows = links.join(given.filter(F.col("side") == side), "there").filter("wanted IS NULL OR wanted = doctype")
    cells = _dealt_cells(rows.select("here", "entries").repartition("here").select("here", F.inline("entries")), "here")
    if "edges" in c:
        return cells.withColumnRenamed("here", "id")
    objects = with_csid(c.objects.select("id"), c.hierarchy, out="here")
    return cells.join(objects, "here").select("id", "field", "value")


def public_cells(c: Collection) -> DataFrame:
    """``(id, field, value)``: every cell of the wide rows but those of the base rows.

    A field has one source, so the sources are worked off one by one and their cells stored: what one shuffles is gone
    before the next.  Cells of ids that are no live object find no base row.
    """
    size = {"dimensions_ss": dimension_text("dimension", "value", "measurementunit")}
    untied = {"groups": _group_values(c), "items": _item_values(c), "singles": _single_values(c)}
    values = {name: rows.withColumn("tie", F.lit(None).cast("string")) for name, rows in untied.items()}
    values |= {"dates": _date_values(c), "sizes": _values(_dimension_rows(c), size, "id", F.col("pos"), F.col("measurementunit"))}
    stored = [cut_lineage(_cells(rows.filter("value IS NOT NULL")), name) for name, rows in values.items()]
    given = cut_lineage(_given(c), "given")
    return union_all(stored + [cut_lineage(_related_cells(c, given, side), side) for side in ("subject", "object")])


def public_parts(c: Collection) -> tuple[DataFrame, DataFrame, list[str]]:
    """Base rows; every other cell ``(id, field, value)`` of the wide rows; and the fields of these cells in order."""
    return basic_extract(c), public_cells(c), frame_fields(c)


def blob_lists(c: Collection) -> DataFrame:
    return media_rows(c).filter("objectcsid IS NOT NULL").select("objectcsid", "blobcsid")


def wide_rows(base: DataFrame, cells: DataFrame, fields: Sequence[str], sep: str, clean: Callable[[Column, Column], Column], key: str = "id") -> DataFrame:
    """A row for each base row: its columns, then ``fields``, then ``broken``: whether a cell holds ``sep``.

    Cells meet in one map for each key, and the base rows take theirs from it.  Line ends go from all cells; those of whole
    rows are cleaned by ``clean(field, value)``.  A missing cell is blank.
    """
    single = cells.withColumn("value", scrub_newlines("value")).filter("value IS NOT NULL").repartition(key).groupBy(key, "field").agg(F.max("value").alias("value"))
    both = F.struct("value", clean(F.col("field"), F.col("value")).alias("clean"))
    maps = single.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("field", both))).alias("_cells"), F.bool_or(F.col("value").contains(sep)).alias("_split"))
    joined = base.join(maps, key, "left")
    own = [n for n in base.columns if n != key]
    given = {n: scrub_newlines(F.col(n).cast("string")) for n in own}
    broken = F.coalesce("_split", F.lit(False))
    for n in own:
        broken = broken | F.coalesce(given[n].contains(sep), F.lit(False))
    rows = joined.withColumn("broken", broken)
    out = {n: F.when(F.col("broken"), value).otherwise(clean(F.lit(n), value)) for n, value in given.items()}
    out |= {f: F.when(F.col("broken"), F.col("_cells")[f]["value"]).otherwise(F.col("_cells")[f]["clean"]) for f in fields}
    return rows.select(key, *[F.coalesce(value, F.lit("")).alias(n) for n, value in out.items()], "broken")


def public_wide(c: Collection) -> DataFrame:
    """Every live object's wide row, whole or broken by a tab inside a cell."""
    base, cells, fields = public_parts(c)

    def clean(field: Column, value: Column) -> Column:
        # quotes go before and again after the blob list is added, so the last field of
        # the row is an inner cell only the second time
        once = F.when(field == fields[-1], strip_field_quotes(value, last=True, pairs=False)).otherwise(strip_field_quotes(value, pairs=False))
        return strip_field_quotes(replace_delim(once, MULTI, "|"))

    return wide_rows(base, cells, fields, "\t", clean)


def internal_wide(c: Collection) -> DataFrame:
    """Every live object's full metadata row, whole or broken by a pipe inside a cell."""
    base, lookups = _metadata_parts(c)
    key = "objectcsid_s"
    cells = lookups.withColumnRenamed("id", key)
    rows = wide_rows(base, cells, [*GROUP_LOOKUPS, *ITEM_LOOKUPS], "|", lambda field, value: escape_backslash(value), key)
    return rows.select(*METADATA_COLUMNS, "broken")


def public_errors(c: Collection) -> DataFrame:
    """Rows that a tab inside a cell would make too wide."""
    return public_wide(c).filter("broken").drop("broken")


def with_blobs(rows: DataFrame, c: Collection) -> DataFrame:
    return merge_list(rows, cut_lineage(blob_lists(c), "blobs"), "csid_s", "blobcsid", "blob_ss", many_key="objectcsid")


def public_extract(c: Collection) -> DataFrame:
    """One wide row per live object: base row, all field frames, blob list."""
    return with_blobs(public_wide(c).filter("NOT broken").drop("broken"), c)


def internal_extract(c: Collection) -> DataFrame:
    """Full metadata row, blob list and a running id; backslashes doubled."""
    merged = with_blobs(internal_wide(c).filter("NOT broken").drop("broken"), c)
    numbered = sequence_id(merged, "objectcsid_s", out="id")
    return numbered.select(F.col("id").cast("string").alias("id"), *METADATA_COLUMNS, "blob_ss")
