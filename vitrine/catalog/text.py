"""Column functions over whole tables (survey section 2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.catalog.registry import query
from vitrine.functions import labels as lab
from vitrine.functions import text as tx

DISPLAY = r"regexp_replace({0}, '(?s)\A.*\)''(.*)''\z', '\1')"


def display(expr: str) -> str:
    return DISPLAY.replace("{0}", expr)


def display_first(expr: str) -> str:
    at = f"position(')''' IN {expr})"
    return f"CASE WHEN {expr} IS NOT NULL AND {expr} <> '' THEN substr({expr}, {at} + 2, greatest(length({expr}) - {at} - 2, 0)) END"


def cleaned(expr: str) -> str:
    return f"regexp_replace({expr}, '[\\t\\n\\r]+', ' ', 'g')"


NAMES = "SELECT id, objectname AS v FROM {objectnamegroup} UNION ALL SELECT id, material FROM {materialgroup}"


def _names(c):
    return c.objectnamegroup.select("id", F.col("objectname").alias("v")).union(c.materialgroup.select("id", "material"))


@query("b01_refname_display", f"SELECT id, {display('v')} AS shown FROM ({NAMES}) t")
def _b01(c):
    return _names(c).select("id", tx.refname_display("v").alias("shown"))


@query("b02_refname_display_first", f"""SELECT id, {display_first('v')} AS shown FROM (
    SELECT id, item AS v FROM {{contentplaces}} UNION ALL SELECT id, item FROM {{contentconcepts}}) t""")
def _b02(c):
    both = c.contentplaces.union(c.contentconcepts)
    return both.select("id", tx.refname_display_first("item").alias("shown"))


@query("b03_urn_display", r"""SELECT id, regexp_replace(v || ' kept', '^urn:.*''(.*)''', '\1') AS shown FROM (
    SELECT id, computedcurrentlocation AS v FROM {objects} UNION ALL SELECT id, distinguishingfeatures FROM {objects}) t""")
def _b03(c):
    o = c.objects
    both = o.select("id", F.col("computedcurrentlocation").alias("v")).union(o.select("id", "distinguishingfeatures"))
    return both.select("id", tx.urn_display(F.concat("v", F.lit(" kept"))).alias("shown"))


@query("b04_collapse_ctrl_ws", f"SELECT doc_id, {cleaned('text')} AS clean FROM {{documents}}")
def _b04(c):
    return c.documents.select("doc_id", tx.collapse_ctrl_ws("text").alias("clean"))


@query("b05_scrub_newlines", "SELECT page_id, replace(replace(html, chr(13), ' '), chr(10), ' ') AS clean FROM {pages}")
def _b05(c):
    return c.pages.select("page_id", tx.scrub_newlines("html").alias("clean"))


@query("b06_strip_field_quotes", r"""WITH t AS (SELECT id, contentnote AS v FROM {objects}
    UNION ALL SELECT id, '"' || physicaldescription || '"' FROM {objects})
    SELECT id, v AS raw,
    replace(regexp_replace(regexp_replace(replace(replace(v, '\', '/'), chr(13), ''), '\A"', ''), '"\z', ''), '""', '"') AS inner_cell,
    replace(regexp_replace(replace(replace(v, '\', '/'), chr(13), ''), '"\z', ''), '""', '"') AS first_cell FROM t""")
def _b06(c):
    o = c.objects
    t = o.select("id", F.col("contentnote").alias("v")).union(
        o.select("id", F.concat(F.lit('"'), "physicaldescription", F.lit('"')))
    )
    return t.select(
        "id", F.col("v").alias("raw"), tx.strip_field_quotes("v").alias("inner_cell"),
        tx.strip_field_quotes("v", first=True).alias("first_cell"),
    )


@query("b07_escape_backslash", r"SELECT id, replace(contentnote, '\', '\\') AS escaped FROM {objects}")
def _b07(c):
    return c.objects.select("id", tx.escape_backslash("contentnote").alias("escaped"))


@query("b08_replace_delim", "SELECT doc_id, replace(text, '|', ' ') AS clean FROM {documents}")
def _b08(c):
    return c.documents.select("doc_id", tx.replace_delim("text", "|", " ").alias("clean"))


@query("b09_local_date", "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day FROM {events}")
def _b09(c):
    return c.events.select("event_id", tx.local_date("ts").alias("day"))


@query("b10_plain_date", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
    strftime(CAST(ts + INTERVAL 8 HOUR AS DATE), '%Y-%m-%d') AS local_day FROM {events}""")
def _b10(c):
    return c.events.select("event_id", tx.plain_date("ts").alias("day"), tx.local_day("ts").cast("string").alias("local_day"))


@query("b11_iso_datetime", """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d,
    CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS t FROM {orders})
    SELECT o_orderkey, CASE WHEN d <> '' THEN d || 'T00:00:00Z' ELSE d END AS iso_day,
    regexp_replace(t, ' ', 'T') || 'Z' AS iso_time FROM t""")
def _b11(c):
    o = c.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 9 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"),
        F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("t"),
    )
    return o.select("o_orderkey", tx.iso_date("d").alias("iso_day"), tx.iso_datetime("t").alias("iso_time"))


@query("b12_has_coords", "SELECT id, CASE WHEN item <> '' THEN 'yes' ELSE 'no' END AS hascoords FROM {contentconcepts}")
def _b12(c):
    return c.contentconcepts.select("id", tx.has_coords("item").alias("hascoords"))


@query("b13_location_key", "SELECT id, termdisplayname, replace(termdisplayname, ' ', '0') AS locationkey FROM {location_terms}")
def _b13(c):
    return c.location_terms.select("id", "termdisplayname", tx.location_key("termdisplayname").alias("locationkey"))


@query("b14_storage_location", f"""SELECT id,
    CASE WHEN computedcrate IS NULL THEN computedcurrentlocationdisplay
         ELSE concat(computedcurrentlocationdisplay, ': ', {display('computedcrate')}) END AS storagelocation,
    replace(concat(computedcurrentlocationdisplay, ': ', {display('computedcrate')}), ' ', '0') AS locationkey FROM {{objects_ext}}""")
def _b14(c):
    return c.objects_ext.select(
        "id",
        tx.storage_location("computedcurrentlocationdisplay", "computedcrate").alias("storagelocation"),
        tx.storage_key("computedcurrentlocationdisplay", "computedcrate").alias("locationkey"),
    )


@query("b15_sortable_number", """SELECT l_orderkey, l_partkey, l_linenumber,
    lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '.' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') || '.' || lpad(CAST(l_linenumber AS VARCHAR), 10, '0') AS sortable,
    l_orderkey || '.' || l_partkey || '.' || l_linenumber AS shown FROM {lineitem}""")
def _b15(c):
    parts = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    return c.lineitem.select(
        *parts, tx.sortable_number(*parts).alias("sortable"), tx.object_number(*parts).alias("shown")
    )


@query("b16_dimension_text", f"SELECT id, dimension || ' ' || value || ' ' || {display('measurementunit')} AS txt FROM {{dimensionsubgroup}}")
def _b16(c):
    return c.dimensionsubgroup.select("id", tx.dimension_text("dimension", "value", "measurementunit").alias("txt"))


@query("b17_bool_text", "SELECT id, CASE WHEN donotpublishonweb THEN 'true' ELSE 'false' END AS flag FROM {objects_ext}")
def _b17(c):
    return c.objects_ext.select("id", tx.bool_text("donotpublishonweb").alias("flag"))


@query("b18_blank_if_null", "SELECT id, coalesce(copyrightholder, '') AS holder FROM {objects_ext}")
def _b18(c):
    return c.objects_ext.select("id", tx.blank_if_null("copyrightholder").alias("holder"))


@query("b19_null_if_blank", "SELECT id, pos, CASE WHEN item IS NOT NULL AND item <> '' THEN item END AS item FROM {briefdescriptions}")
def _b19(c):
    return c.briefdescriptions.select("id", "pos", tx.null_if_blank("item").alias("item"))


@query("b20_locality_text", f"""SELECT id, CASE WHEN fieldlocplace IS NOT NULL AND fieldlocplace <> '' THEN {display('fieldlocplace')}
    WHEN fieldlocplace IS NULL AND taxonomicrange IS NOT NULL THEN 'Geographic range: ' || taxonomicrange END AS locality FROM {{localitygroup}}""")
def _b20(c):
    return c.localitygroup.select("id", tx.locality_text("fieldlocplace", "taxonomicrange").alias("locality"))


@query("b21_numeric_sort", """WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'x' || p_size
    ELSE (1990 + p_size) || '.' || (p_partkey % 10000) END AS number FROM {part})
    SELECT p_partkey, number, CAST(TRY_CAST(number AS DECIMAL(8,4)) AS DOUBLE) AS numeric_key FROM t""")
def _b21(c):
    t = c.part.select(
        "p_partkey",
        F.when(F.col("p_partkey") % 9 == 0, F.concat(F.lit("x"), F.col("p_size").cast("string")))
        .otherwise(F.concat_ws(".", (F.col("p_size") + 1990).cast("string"), (F.col("p_partkey") % 10000).cast("string")))
        .alias("number"),
    )
    return t.select("p_partkey", "number", tx.numeric_sort("number").cast("double").alias("numeric_key"))


TAXON_TEXT = "CASE p_partkey % 3 WHEN 0 THEN p_name || ' ex ' || p_type WHEN 1 THEN p_name || ' var. ' || p_brand ELSE p_name END"


def _taxon_text(c):
    k = F.col("p_partkey") % 3
    return c.part.select(
        "p_partkey",
        F.when(k == 0, F.concat("p_name", F.lit(" ex "), "p_type"))
        .when(k == 1, F.concat("p_name", F.lit(" var. "), "p_brand"))
        .otherwise(F.col("p_name"))
        .alias("t"),
    )


@query("b22_genus_species", f"""SELECT p_partkey, split_part(t, ' ', 1) AS genus,
    split_part(split_part(t, ' ex ', 1), ' var. ', 1) AS species FROM (SELECT p_partkey, {TAXON_TEXT} AS t FROM {{part}}) x""")
def _b22(c):
    return _taxon_text(c).select("p_partkey", tx.genus("t").alias("genus"), tx.species("t").alias("species"))


def _case(table: dict[str, str], expr: str, default: str) -> str:
    def lit(v: str) -> str:
        return "'" + v.replace("'", "''") + "'"

    return f"CASE {expr} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in table.items()) + f" ELSE {default} END"


ALL_LABELS = list(dict.fromkeys([*lab.label_table("pretty"), *lab.label_table("terse"), *lab.label_table("brief"), "unlisted"]))


def _at(values: list[str], key: str) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"list_extract([{listed}], CAST({key} % {len(values)} + 1 AS INT))"


def _picked(df, key: str, values: list[str], out: str):
    options = F.array(*[F.lit(v) for v in values])
    return df.withColumn(out, F.element_at(options, (F.col(key) % len(values) + 1).cast("int")))


@query("b23_pretty_label", f"""WITH t AS (SELECT p_partkey, {_at(ALL_LABELS, 'p_partkey')} AS label FROM {{part}})
    SELECT p_partkey, label, {_case(lab.label_table('pretty'), 'label', 'label')} AS pretty,
    {_case(lab.label_table('terse'), 'label', 'label')} AS terse, {_case(lab.label_table('brief'), 'label', 'label')} AS brief FROM t""")
def _b23(c):
    df = _picked(c.part.select("p_partkey"), "p_partkey", ALL_LABELS, "label")
    for style in ("pretty", "terse", "brief"):
        df = lab.pretty_label(df, "label", style, out=style)
    return df


STATUSES = [*lab.STATUS_CATEGORIES, "not located"]


@query("b24_status_category", f"""WITH t AS (SELECT p_partkey, {_at(STATUSES, 'p_partkey')} AS status FROM {{part}})
    SELECT p_partkey, status, {_case(lab.STATUS_CATEGORIES, 'status', "'Other'")} AS category FROM t""")
def _b24(c):
    return lab.status_category(_picked(c.part.select("p_partkey"), "p_partkey", STATUSES, "status"), "status")


AREAS = [
    "North American archaeology", "South American ethnography", "African sample", "Asian documentation", "European (not specified)",
    "Oceanian indeterminate", "Continent unknown", "none", "African ethnography archaeology",
]


@query("b25_split_area_category", f"""WITH t AS (SELECT p_partkey, {_at(AREAS, 'p_partkey')} AS area FROM {{part}})
    SELECT p_partkey, area,
    CASE WHEN area LIKE '%ethnography%' THEN 'Ethnography' WHEN area LIKE '%archaeology%' THEN 'Archaeology'
      WHEN area LIKE '%indeterminate%' THEN 'Indeterminate' WHEN area LIKE '%not specified%' THEN 'Not Specified'
      WHEN area LIKE '%sample%' THEN 'Sample' WHEN area LIKE '%documentation%' THEN 'Documentation'
      WHEN area LIKE '%unknown%' THEN 'Unknown' WHEN area LIKE '%none%' THEN 'None' ELSE 'Other' END AS discipline,
    CASE WHEN area LIKE '%North American%' THEN 'North America' WHEN area LIKE '%South American%' THEN 'South America'
      WHEN area LIKE '%African%' THEN 'Africa' WHEN area LIKE '%Asian%' THEN 'Asia' WHEN area LIKE '%European%' THEN 'Europe'
      WHEN area LIKE '%Oceanian%' THEN 'Oceania' ELSE 'Other' END AS continent FROM t""")
def _b25(c):
    df = _picked(c.part.select("p_partkey"), "p_partkey", AREAS, "area")
    return df.withColumn("x", lab.split_area_category("area")).select("p_partkey", "area", "x.discipline", "x.continent")


@query("b26_metric_name", f"""SELECT DISTINCT statmetric, {_case(lab.METRIC_NAMES, 'statmetric', 'statmetric')} AS title FROM {{collectionstats}}""")
def _b26(c):
    return c.collectionstats.select("statmetric", lab.metric_name("statmetric").alias("title")).distinct()


@query("b27_flag_on", "SELECT name, CASE WHEN approvedforweb = 'on' THEN 'true' ELSE 'false' END AS flag FROM {manifest}")
def _b27(c):
    return c.manifest.select("name", tx.flag_on("approvedforweb").alias("flag"))


@query("b28_reference_number", """SELECT event_id, 'BMU' || strftime(ts, '%Y%m%d%H%M%S') AS media_number,
    'LOC' || strftime(ts, '%Y-%m-%d-%H-%M') || '-' || (event_id + 1) AS move_number FROM {events}""")
def _b28(c):
    return c.events.select(
        "event_id", tx.reference_number("BMU", "ts").alias("media_number"),
        tx.reference_number("LOC", "ts", F.col("event_id") + 1).alias("move_number"),
    )


@query("b29_slug", r"SELECT doc_id, lower(trim(regexp_replace(text, '[^A-Za-z0-9_-]+', '_', 'g'))) AS slug FROM {documents}")
def _b29(c):
    return c.documents.select("doc_id", tx.slug("text").alias("slug"))


@query("b30_tree_label", """WITH t AS (SELECT id, CASE WHEN numberofobjects % 3 = 0 THEN '@' ELSE '' END || contentnote AS v FROM {objects})
    SELECT id, CASE WHEN v LIKE '@%' THEN '<' || substr(replace(v, '"', ''''), 2) || '> ' ELSE replace(v, '"', '''') END AS shown FROM t""")
def _b30(c):
    v = F.concat(F.when(F.col("numberofobjects") % 3 == 0, "@").otherwise(""), "contentnote")
    return c.objects.select("id", tx.tree_label(v).alias("shown"))


@query("b31_text_bool", "SELECT id, CASE WHEN rare = 'true' THEN 'Yes' ELSE 'No' END AS rare FROM {objects_ext}")
def _b31(c):
    return c.objects_ext.select("id", tx.text_bool("rare").alias("rare"))


@query("b32_split_multi", """SELECT doc_id, generate_subscripts(v, 1) - 1 AS n, unnest(v) AS piece FROM (
    SELECT doc_id, CASE WHEN text = '' THEN [] ELSE string_split(text, '. ') END AS v FROM {documents}) t""")
def _b32(c):
    pieces = c.documents.select("doc_id", F.posexplode(tx.split_multi("text", ". ")).alias("n", "piece"))
    return pieces.withColumn("n", F.col("n").cast("bigint"))


@query("b33_series_date", """SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(month(ts) - 1 AS INT) AS month0, CAST(day(ts) AS INT) AS day FROM {events}""")
def _b33(c):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return c.events.select("event_id", tx.series_date(iso).alias("x")).select("event_id", "x.*")


SCAN_TIME = "lpad(CAST(1 + event_id % 14 AS VARCHAR), 2, '0') || '/' || (1 + event_id % 33) || '/2013 ' || (event_id % 25) || ':54'"


@query("b34_parse_date", f"SELECT event_id, try_strptime({SCAN_TIME}, '%m/%d/%Y %H:%M') AS moved_at FROM {{events}}")
def _b34(c):
    e = F.col("event_id")
    raw = F.concat(
        F.lpad((e % 14 + 1).cast("string"), 2, "0"), F.lit("/"), (e % 33 + 1).cast("string"), F.lit("/2013 "),
        (e % 25).cast("string"), F.lit(":54"),
    )
    return c.events.select("event_id", tx.parse_date(raw).alias("moved_at"))


@query("b35_valid_count", r"""WITH t AS (SELECT k, pos, CASE q % 5 WHEN 0 THEN '-' || q WHEN 1 THEN q || 'a' WHEN 2 THEN '' ELSE CAST(q AS VARCHAR) END AS v FROM {member})
    SELECT k, pos, CASE WHEN regexp_matches(v, '^[0-9]+\s*$') THEN v END AS n FROM t""")
def _b35(c):
    q = F.col("q")
    v = F.when(q % 5 == 0, F.concat(F.lit("-"), q.cast("string"))).when(q % 5 == 1, F.concat(q.cast("string"), F.lit("a"))).when(
        q % 5 == 2, "").otherwise(q.cast("string"))
    return c.member.select("k", "pos", tx.valid_count(v).alias("n"))
