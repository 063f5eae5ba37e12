"""Field frames, special frames and the two wide outputs (survey sections 2.5, 2.9, 2.10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from vitrine.catalog.filters import LIVE
from vitrine.catalog.fixtures import with_stored_members
from vitrine.catalog.registry import query
from vitrine.catalog.text import cleaned, display
from vitrine.plans import extract as ex
from vitrine.plans.nightly import nightly
from vitrine.session import scratch_path

S = "␥"
LIVE_OBJECTS = f"(SELECT o.* FROM {{objects}} o JOIN {LIVE} m ON m.id = o.id)"


def local_day(expr: str) -> str:
    return f"strftime({expr} + INTERVAL 8 HOUR, '%Y-%m-%d')"


def agg(value: str, out: str, order: str = "pos", distinct: bool = False) -> str:
    if distinct:
        return f"string_agg(DISTINCT {value}, '{S}' ORDER BY {value}) AS {out}"
    return f"string_agg({value}, '{S}' ORDER BY {order}, {value}) AS {out}"


def group_sql(field: str, value: str | None = None) -> str:
    """Template kinds 1 and 4."""
    f = field.lower()
    value = value or cleaned(display(f"g.{f}"))
    return f"""SELECT h.parentid AS id, {agg(value, f + '_ss', 'h.pos')} FROM {{hierarchy}} h JOIN {{{f}group}} g ON g.id = h.id
      JOIN {LIVE_OBJECTS} o ON o.id = h.parentid WHERE h.primarytype = '{field}Group' AND g.{f} IS NOT NULL GROUP BY h.parentid"""


def list_sql(field: str) -> str:
    return f"""SELECT x.id, {agg(cleaned(display('x.item')), field + '_ss', 'x.pos')} FROM {{{field}}} x JOIN {LIVE_OBJECTS} o ON o.id = x.id
      WHERE x.item IS NOT NULL GROUP BY x.id"""


def to_objects(table: str, doc_type: str | None = None) -> str:
    typed = f" AND r.objectdocumenttype = '{doc_type}'" if doc_type else ""
    return f"""{{{table}}} x JOIN {LIVE} mx ON mx.id = x.id JOIN {{hierarchy}} h1 ON h1.id = x.id JOIN {{relations}} r ON r.subjectcsid = h1.name{typed}
      JOIN {{hierarchy}} h2 ON h2.name = r.objectcsid JOIN {LIVE_OBJECTS} o ON o.id = h2.id"""


def procedure_sql(table: str, field: str, value: str) -> str:
    """Template kinds 3 and 5."""
    return f"SELECT o.id, {agg(value, field + '_ss', distinct=True)} FROM {to_objects(table)} GROUP BY o.id"


def from_objects(doc_type: str | None) -> str:
    typed = f" AND r.objectdocumenttype = '{doc_type}'" if doc_type else ""
    return f"""{{objects}} o JOIN {{hierarchy}} h1 ON h1.id = o.id JOIN {{relations}} r ON r.subjectcsid = h1.name{typed}
      JOIN {{hierarchy}} h2 ON h2.name = r.objectcsid"""


def first(alias: str, list_name: str, table: str, parent: str = "o.id", null_pos: bool = False) -> str:
    at = "(h.pos = 0 OR h.pos IS NULL)" if null_pos else "h.pos = 0"
    return f"""LEFT JOIN (SELECT h.parentid, g.* FROM {{hierarchy}} h LEFT JOIN {{{table}}} g ON g.id = h.id
      WHERE h.name LIKE '%:{list_name}' AND {at}) {alias} ON {alias}.parentid = {parent}"""


BASE = f"""SELECT o.id, h.name AS csid_s, {display('n.objectname')} AS objectname_s, o.objectnumber AS objectnumber_s, o.numberofobjects AS numberofobjects_s,
    o.computedcurrentlocation AS computedcurrentlocationrefname_s, {display('d.dhname')} AS dhname_s, e.sortableobjectnumber AS sortableobjectnumber_s,
    e.art AS art_s, e.history AS history_s, e.science AS science_s, e.donotpublishonweb AS donotpublishonweb_s,
    e.computedcurrentlocationdisplay AS computedcurrentlocation_s, {display('o.recordstatus')} AS recordstatus_s,
    {display('o.fieldcollectionplace')} AS fieldcollectionplace_s, {display('o.collection')} AS collection_s, {display('e.ipaudit')} AS ipaudit_s,
    {cleaned('o.physicaldescription')} AS physicaldescription_s, {cleaned('o.contentdescription')} AS contentdescription_s,
    {cleaned('o.contentnote')} AS contentnote_s, {cleaned('e.argusremarks')} AS argusremarks_s, {cleaned('e.argusdescription')} AS argusdescription_s
    FROM {LIVE_OBJECTS} o JOIN {{hierarchy}} h ON h.id = o.id JOIN {{objects_ext}} e ON e.id = o.id
    {first('n', 'objectNameList', 'objectnamegroup')} {first('d', 'determinationHistoryGroupList', 'determinationhistorygroup')}"""


@query("r01_basic_extract", BASE)
def _r01(c):
    return ex.basic_extract(c)


def _lookup_sql() -> tuple[str, str]:
    from vitrine.catalog.fixtures import VIEWS

    columns, joins = {}, []
    aliases: dict[str, str] = {}
    for out, (list_name, table, col, is_ref) in ex.GROUP_LOOKUPS.items():
        if table not in VIEWS:
            columns[out] = "CAST(NULL AS VARCHAR)"
            continue
        key = f"{list_name}/{table}"
        if key not in aliases:
            aliases[key] = f"g{len(aliases)}"
            joins.append(first(aliases[key], list_name, table))
        value = f"{aliases[key]}.{col}"
        columns[out] = display(value) if is_ref else f"CAST({value} AS VARCHAR)"
    for out, (table, is_ref) in ex.ITEM_LOOKUPS.items():
        joins.append(f"LEFT JOIN {{{table}}} i_{table} ON i_{table}.id = o.id AND i_{table}.pos = 0")
        columns[out] = display(f"i_{table}.item") if is_ref else f"i_{table}.item"
    for n in ("objectnumber", "physicaldescription", "contentdescription", "contentnote", "numberofobjects"):
        columns[f"{n}_s"] = f"o.{n}"
    for n in ("sortableobjectnumber", "art", "history", "science"):
        columns[f"{n}_s"] = f"e.{n}"
    for n in ("recordstatus", "fieldcollectionplace", "collection"):
        columns[f"{n}_s"] = display(f"o.{n}")
    for n in ("argusremarks", "argusdescription"):
        columns[f"{n}_s"] = f"replace(e.{n}, '|', ' ')"
    columns |= {
        "csid_s": "h.name", "objectcsid_s": "o.id", "ipaudit_s": display("e.ipaudit"),
        "computedcurrentlocationrefname_s": "o.computedcurrentlocation", "computedcurrentlocation_s": "e.computedcurrentlocationdisplay",
    }
    return ", ".join(f"{columns[n]} AS {n}" for n in ex.METADATA_COLUMNS), " ".join(joins)


COLUMNS, JOINS = _lookup_sql()
METADATA = f"SELECT {COLUMNS} FROM {LIVE_OBJECTS} o JOIN {{hierarchy}} h ON h.id = o.id JOIN {{objects_ext}} e ON e.id = o.id {JOINS}"


@query("r02_metadata_extract", METADATA)
def _r02(c):
    return ex.metadata_extract(c)


# ---- templates ------------------------------------------------------------------------------

KIND1 = ["assocCulturalContext", "assocOrganization", "assocPerson", "assocPlace", "material", "measuredPart", "objectProductionOrganization", "objectProductionPerson", "objectProductionPlace", "title", "technique"]
KIND2 = [field for _, field in ex.FIELD_PAIRS[2]]
KIND3 = {"loanoutnumber": "loansout", "borrower": "loansout", "loaninnumber": "loansin", "exitnumber": "objectexit"}
KIND5 = {"loanoutdate": "loansout", "loanindate": "loansin"}

FRAMES: dict[str, str] = {f"{f.lower()}_ss": group_sql(f) for f in KIND1}
# keyed by the loan, as the source has it, so it never meets an object
FRAMES["loanstatus_ss"] = group_sql("loanStatus").replace(LIVE_OBJECTS, f"(SELECT o.* FROM {{loansout}} o JOIN {LIVE} m ON m.id = o.id)")
FRAMES |= {f"{f}_ss": list_sql(f) for f in KIND2}
FRAMES |= {f"{f}_ss": procedure_sql(t, f, display(f"x.{f}")) for f, t in KIND3.items()}
FRAMES |= {f"{f}_ss": procedure_sql(t, f, local_day(f"x.{f}")) for f, t in KIND5.items()}


def _long(name: str, sql: str, cols: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS frame, '{col}' AS field, id, {col} AS cell FROM ({sql}) {name}_{i}" for i, col in enumerate(cols))


def _long_df(name: str, df):
    cols = [x for x in df.columns if x != "id"]
    one = [df.select(F.lit(name).alias("frame"), F.lit(col).alias("field"), "id", F.col(col).alias("cell")) for col in cols]
    return reduce(lambda a, b: a.union(b), one)


def _templates(kinds: dict[str, tuple[str, str, int]]):
    return lambda c: reduce(lambda a, b: a.union(b), [_long_df(f"k{kind}", ex.field_extract(c, table, field, kind)) for field, (table, _, kind) in kinds.items()])


query("e04_field_extract_groups", " UNION ALL ".join(_long("k1", FRAMES[f"{f.lower()}_ss"], [f"{f.lower()}_ss"]) for f in KIND1))(
    _templates({f: ("objects", "", 1) for f in KIND1}))
query("e04_field_extract_lists", " UNION ALL ".join(_long("k2", FRAMES[f"{f}_ss"], [f"{f}_ss"]) for f in KIND2))(
    _templates({f: ("objects", "", 2) for f in KIND2}))
query("e04_field_extract_procedures", " UNION ALL ".join(
    [_long("k3", FRAMES[f"{f}_ss"], [f"{f}_ss"]) for f in KIND3] + [_long("k5", FRAMES[f"{f}_ss"], [f"{f}_ss"]) for f in KIND5]))(
    _templates({**{f: (t, "", 3) for f, t in KIND3.items()}, **{f: (t, "", 5) for f, t in KIND5.items()}}))


@query("e04_field_extract_group_date", f"""SELECT h.parentid AS id, string_agg(strftime(g.made, '%Y-%m-%d'), '{S}' ORDER BY h.pos, strftime(g.made, '%Y-%m-%d')) AS made_ss
    FROM {{hierarchy}} h JOIN (SELECT replace(id, 'pd-', 'mt-') AS id, dateearliestscalarvalue AS made FROM {{structureddategroup}} WHERE id LIKE 'pd-%') g ON g.id = h.id
    JOIN {LIVE_OBJECTS} o ON o.id = h.parentid WHERE h.primarytype = 'madeGroup' GROUP BY h.parentid""".replace("'madeGroup'", "'materialGroup'"))
def _e04_date(c):
    from vitrine.plans.model import Collection

    made = c.structureddategroup.filter("id LIKE 'pd-%'").select(
        F.replace("id", F.lit("pd-"), F.lit("mt-")).alias("id"), F.col("dateearliestscalarvalue").alias("made"))
    members = c.hierarchy.withColumn("primarytype", F.when(F.col("primarytype") == "materialGroup", "madeGroup").otherwise(F.col("primarytype")))
    return ex.field_extract(Collection.of(objects=c.objects, misc=c.misc, hierarchy=members, madegroup=made), "objects", "made", 4)


@query("e04_field_extract_typed", f"""SELECT o.id, {agg(cleaned('x.title'), 'title_ss', distinct=True)} FROM {from_objects('Group')} JOIN {{groups}} x ON x.id = h2.id
    JOIN {LIVE} mx ON mx.id = x.id GROUP BY o.id""")
def _e04_typed(c):
    return ex.field_extract(c, "groups", "title", 6)


@query("e04_field_extract_compat", f"""SELECT o.id, {display(f"string_agg(DISTINCT x.borrower, '{S}' ORDER BY x.borrower)")} AS borrower_ss FROM {to_objects('loansout')} GROUP BY o.id""")
def _e04_compat(c):
    return ex.field_extract(c, "loansout", "borrower", 3, compat=True)


# ---- special frames ---------------------------------------------------------------------------

SPECIAL: dict[str, tuple[object, str]] = {}


def special(name: str, build, sql: str) -> None:
    SPECIAL[name] = (build, sql)
    query(name, sql)(lambda c: build(c))


special("r03_dimension_summary", ex.dimension_summary, f"""SELECT o.id, p.dimensionsummary AS dimensionsummary_s FROM {LIVE_OBJECTS} o
    JOIN {{objects_ext}} e ON e.id = o.id {first('p', 'measuredPartGroupList', 'measuredpartgroup')}""")
special("r04_group_titles", ex.group_titles, f"""SELECT o.id, {agg('x.title', 'grouptitle_ss', distinct=True)} FROM {from_objects('Group')}
    JOIN {{groups}} x ON x.id = h2.id JOIN {LIVE} mx ON mx.id = x.id GROUP BY o.id""")
special("r05_other_number", ex.other_number, f"""SELECT o.id, p.numbervalue AS othernumber_s FROM {LIVE_OBJECTS} o
    JOIN {{objects_ext}} e ON e.id = o.id {first('p', 'otherNumberList', 'othernumber')}""")
special("r06_acquisition_fields", ex.acquisition_fields, f"""SELECT o.id, {agg('x.acquisitionreferencenumber', 'acquisitionreferencenumber_ss', distinct=True)},
    {agg('a.datedisplaydate', 'accessiondate_ss', distinct=True)}, {agg('b.datedisplaydate', 'acquisitiondate_ss', distinct=True)},
    {agg('x.creditline', 'creditline_ss', distinct=True)} FROM {from_objects('Acquisition')} JOIN {{acquisitions}} x ON x.id = h2.id
    {first('a', 'accessionDateGroup', 'structureddategroup', 'x.id', True)} {first('b', 'acquisitionDateGroupList', 'structureddategroup', 'x.id', True)}
    GROUP BY o.id""")
special("r07_exhibition_fields", ex.exhibition_fields, f"""SELECT o.id, {agg('x.exhibitionnumber', 'exhibitionnumber_ss', distinct=True)},
    {agg('x.title', 'exhibitiontitle_ss', distinct=True)} FROM {from_objects('Exhibition')} LEFT JOIN {{exhibitions}} x ON x.id = h2.id GROUP BY o.id""")


def listed(table: str, primarytype: str, group: str, values: str, required: str) -> str:
    return f"""SELECT o.id, {values} FROM {to_objects(table, 'CollectionObject')} JOIN {{hierarchy}} h ON h.parentid = x.id AND h.primarytype = '{primarytype}'
      JOIN {{{group}}} g ON g.id = h.id WHERE g.{required} IS NOT NULL GROUP BY o.id"""


special("r08_lender", ex.lender, listed("loansin", "lenderGroup", "lendergroup", agg(cleaned(display("g.lender")), "lender_ss", "h.pos"), "lender"))
special("r09_loan_in_return", ex.loan_in_return, f"SELECT o.id, {agg(local_day('x.loanreturndate'), 'loaninreturndate_ss', distinct=True)} FROM {to_objects('loansin')} GROUP BY o.id")
special("r09_loan_out_return", ex.loan_out_return, f"SELECT o.id, {agg(local_day('x.loanreturndate'), 'loanoutreturndate_ss', distinct=True)} FROM {to_objects('loansout')} GROUP BY o.id")
DIM = f"dimension || ' ' || value || ' ' || {display('measurementunit')}"
special("r10_dimensions", ex.dimensions, f"""SELECT o.id, string_agg({DIM}, '{S}' ORDER BY h.pos, measurementunit DESC NULLS FIRST, {DIM}) AS dimensions_ss
    FROM {{hierarchy}} h JOIN {{dimensionsubgroup}} d ON d.id = h.id JOIN {{measuredpartgroup}} p ON p.id = h.parentid JOIN {{hierarchy}} h2 ON h2.id = p.id
    JOIN {{objects}} o ON o.id = h2.parentid GROUP BY o.id""")
special("r11_loan_in_status", ex.loan_in_status, listed("loansin", "loanStatusGroup", "loanstatusgroup", agg(cleaned(display("g.loanstatus")), "loaninstatus_ss", "h.pos"), "loanstatus"))
special("r11_loan_out_status", ex.loan_out_status, listed("loansout", "loanStatusGroup", "loanstatusgroup", agg(cleaned(display("g.loanstatus")), "loanoutstatus_ss", "h.pos"), "loanstatus"))
special("r12_hazard", ex.hazard, listed("conditionchecks", "hazardGroup", "hazardgroup", agg(cleaned(display("g.hazard")), "hazard_ss", "h.pos"), "hazard"))
special("r13_conservation", ex.conservation, listed("conservation", "conservationStatusGroup", "conservationstatusgroup",
    agg(display("g.status"), "conservationstatus_ss", "h.pos") + ", " + agg(local_day("g.statusdate"), "conservationstatusdate_ss", "h.pos"), "status"))
special("r14_condition", ex.condition, f"""SELECT o.id, {agg(display('x.condition'), 'condition_ss', 'x.conditiondate, x.id')},
    {agg(local_day('x.conditiondate'), 'conditiondate_ss', 'x.conditiondate, x.id')}, {agg(display('y.conditioncheckrefnumber'), 'conditioncheckrefnumber_ss', 'x.conditiondate, x.id')}
    FROM {from_objects(None)} JOIN {{conditionchecks_ext}} x ON x.id = h2.id LEFT JOIN {{conditionchecks}} y ON y.id = h2.id JOIN {LIVE} mx ON mx.id = x.id
    WHERE x.condition IS NOT NULL AND x.condition <> '' GROUP BY o.id""")
special("r15_field_collection_date", ex.field_collection_date, f"""SELECT o.id, {agg('g.datedisplaydate', 'fieldcollectiondate_ss', distinct=True)} FROM {LIVE_OBJECTS} o
    JOIN {{objects_ext}} e ON e.id = o.id JOIN {{hierarchy}} h ON h.parentid = o.id AND h.name LIKE '%:fieldCollectionDateGroup' JOIN {{structureddategroup}} g ON g.id = h.id
    WHERE g.datedisplaydate <> '' GROUP BY o.id""")
special("r16_production_date", ex.production_date, f"""SELECT o.id, {agg('g.datedisplaydate', 'objectproductiondate_ss', 'h.pos, h.id')},
    {agg(local_day('g.dateearliestscalarvalue'), 'objectproductionscalardate_ss', 'h.pos, h.id')} FROM {LIVE_OBJECTS} o
    JOIN {{hierarchy}} h ON h.parentid = o.id AND h.primarytype = 'structuredDateGroup' JOIN {{structureddategroup}} g ON g.id = h.id
    WHERE g.datedisplaydate IS NOT NULL GROUP BY o.id""")


# ---- wide outputs -----------------------------------------------------------------------------

BASE_COLUMNS = """id csid_s objectname_s objectnumber_s numberofobjects_s computedcurrentlocationrefname_s dhname_s sortableobjectnumber_s art_s history_s
science_s donotpublishonweb_s computedcurrentlocation_s recordstatus_s fieldcollectionplace_s collection_s ipaudit_s physicaldescription_s contentdescription_s
contentnote_s argusremarks_s argusdescription_s""".split()
SPECIAL_COLUMNS = {
    "r03_dimension_summary": ["dimensionsummary_s"], "r04_group_titles": ["grouptitle_ss"], "r05_other_number": ["othernumber_s"],
    "r06_acquisition_fields": ["acquisitionreferencenumber_ss", "accessiondate_ss", "acquisitiondate_ss", "creditline_ss"],
    "r07_exhibition_fields": ["exhibitionnumber_ss", "exhibitiontitle_ss"], "r08_lender": ["lender_ss"], "r09_loan_in_return": ["loaninreturndate_ss"],
    "r09_loan_out_return": ["loanoutreturndate_ss"], "r10_dimensions": ["dimensions_ss"], "r11_loan_in_status": ["loaninstatus_ss"],
    "r11_loan_out_status": ["loanoutstatus_ss"], "r12_hazard": ["hazard_ss"], "r13_conservation": ["conservationstatus_ss", "conservationstatusdate_ss"],
    "r14_condition": ["condition_ss", "conditiondate_ss", "conditioncheckrefnumber_ss"], "r15_field_collection_date": ["fieldcollectiondate_ss"],
    "r16_production_date": ["objectproductiondate_ss", "objectproductionscalardate_ss"],
}


def scrubbed(expr: str) -> str:
    return f"replace(replace(coalesce(CAST({expr} AS VARCHAR), ''), chr(13), ' '), chr(10), ' ')"


def unquoted(expr: str, lead: bool = True, trail: bool = True, pairs: bool = True) -> str:
    out = f"replace(replace({expr}, '\\', '/'), chr(13), '')"
    if lead:
        out = f"regexp_replace({out}, '\\A\"', '')"
    if trail:
        out = f"regexp_replace({out}, '\"\\z', '')"
    return f"replace({out}, '\"\"', '\"')" if pairs else out


STITCHED = [("f_" + name, sql, [name]) for name, sql in FRAMES.items()] + [("s_" + name, SPECIAL[name][1], cols) for name, cols in SPECIAL_COLUMNS.items()]
WIDE_COLUMNS = BASE_COLUMNS + [col for *_, cols in STITCHED for col in cols]
BLOBS = f"""SELECT h2.name AS csid, string_agg(d.blobcsid, ',' ORDER BY d.blobcsid) AS blobs FROM {{media}} d JOIN {LIVE} m ON m.id = d.id
    JOIN {{hierarchy}} h1 ON h1.id = d.id JOIN {{relations}} r ON r.objectcsid = h1.name JOIN {{hierarchy}} h2 ON h2.name = r.subjectcsid
    JOIN {{hierarchy}} h3 ON h3.name = d.blobcsid GROUP BY h2.name"""
WIDE = (
    "WITH " + ", ".join([f"b AS ({BASE})"] + [f"{name} AS ({sql})" for name, sql, _ in STITCHED])
    + ", wide AS (SELECT " + ", ".join([f"{scrubbed('b.' + n)} AS {n}" for n in BASE_COLUMNS] + [f"{scrubbed(name + '.' + col)} AS {col}" for name, _, cols in STITCHED for col in cols])
    + " FROM b " + " ".join(f"LEFT JOIN {name} ON {name}.id = b.id" for name, *_ in STITCHED) + ")"
    + ", checked AS (SELECT *, " + " || ' ' || ".join(WIDE_COLUMNS) + " LIKE '%' || chr(9) || '%' AS broken FROM wide)"
)
ONCE = ", ".join(f"{unquoted(n, n != 'id', n != WIDE_COLUMNS[-1], pairs=False)} AS {n}" for n in WIDE_COLUMNS)
TWICE = ", ".join(f"{unquoted(f'replace({n}, ' + chr(39) + S + chr(39) + ', ' + chr(39) + '|' + chr(39) + ')', n != 'id')} AS {n}" for n in WIDE_COLUMNS)


PUBLIC = f"""once AS (SELECT {ONCE} FROM checked WHERE NOT broken), blobs AS ({BLOBS}),
    public AS (SELECT {TWICE}, coalesce(blobs.blobs, '') AS blob_ss FROM once LEFT JOIN blobs ON blobs.csid = once.csid_s)"""


@query("k01_public_extract", f"{WIDE}, {PUBLIC} SELECT * FROM public")
def _k01(c):
    return ex.public_extract(with_stored_members(c))


@query("k01_public_errors", WIDE + f" SELECT {', '.join(WIDE_COLUMNS)} FROM checked WHERE broken")
def _k01_errors(c):
    return ex.public_errors(with_stored_members(c))


@query("k02_internal_extract", f"""WITH meta AS ({METADATA}), clean AS (SELECT {', '.join(f'{scrubbed(n)} AS {n}' for n in ex.METADATA_COLUMNS)} FROM meta),
    good AS (SELECT * FROM clean WHERE NOT contains({" || ' ' || ".join(ex.METADATA_COLUMNS)}, '|')), blobs AS ({BLOBS})
    SELECT CAST(row_number() OVER (ORDER BY objectcsid_s) AS VARCHAR) AS id, {', '.join(f"replace({n}, chr(92), chr(92) || chr(92)) AS {n}" for n in ex.METADATA_COLUMNS)},
    coalesce(blobs.blobs, '') AS blob_ss FROM good LEFT JOIN blobs ON blobs.csid = good.csid_s""")
def _k02(c):
    return ex.internal_extract(with_stored_members(c))


def _nightly(c):
    """The public job over the whole collection, run once for all queries on what it makes."""
    return c.keep("nightly", lambda: nightly(with_stored_members(c), scratch_path(c.objects.sparkSession, "nightly"), "20240203040506"))


@query("k01_nightly_counts", f"""{WIDE}, {PUBLIC} SELECT (SELECT count(*) FROM wide) AS rows, (SELECT count(*) FROM public) AS good, (SELECT count(*) FROM checked WHERE broken) AS broken,
    (SELECT count(*) FROM public WHERE blob_ss <> '') AS with_blobs, (SELECT count(*) FROM blobs WHERE csid NOT IN (SELECT csid_s FROM public)) AS unmatched_blobs,
    (SELECT count(*) FROM public) AS loaded, (SELECT count(*) FROM checked WHERE broken) AS error_lines""")
def _k01_nightly(c):
    """The counts that the job kept on the way, and what its outputs hold."""
    spark, made = c.objects.sparkSession, _nightly(c)
    loaded, errors = made.load(spark).agg(F.count("*").alias("loaded")), spark.read.text(made.files("errors")).filter("NOT startswith(value, 'id\tcsid_s')").agg(F.count("*").alias("n"))
    given = {n: getattr(made, n) for n in ("rows", "good", "broken", "with_blobs", "unmatched_blobs")}
    return loaded.select(*[F.lit(v).cast("bigint").alias(n) for n, v in given.items()], "loaded", errors.select("n").scalar().alias("error_lines"))


@query("k01_nightly_profile", f"{WIDE}, {PUBLIC} " + " UNION ALL ".join(
    f"SELECT {i} AS col, '{n}' AS fieldname, count(DISTINCT CASE WHEN v <> '' THEN v END) AS types, count(CASE WHEN v <> '' THEN 1 END) AS tokens FROM (SELECT unnest(string_split({n}, '|')) AS v FROM public)"
    for i, n in enumerate([*WIDE_COLUMNS, "blob_ss"], 1)))
def _k01_profile(c):
    """The profile that the job made of all columns of the load."""
    rows = _nightly(c).profile(c.objects.sparkSession)
    places = {n: i for i, n in enumerate([*WIDE_COLUMNS, "blob_ss"], 1)}
    at = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])
    return rows.select(F.element_at(at, F.col("fieldname")).alias("col"), "fieldname", "types", "tokens")
