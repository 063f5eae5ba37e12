"""Readers, sinks and streams, run through files in the shared scratch folder (survey sections 2.1, 2.10, 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.catalog.changes import INTAKE, NOW
from vitrine.catalog.extracts import list_sql
from vitrine.catalog.registry import query
from vitrine.catalog.text import cleaned
from vitrine.functions import text as tx
from vitrine.operators.aggregates import facet_counts, union_all
from vitrine.plans import extract as ex
from vitrine.session import scratch_path
from vitrine.sources import readers as rd
from vitrine.sources import sinks as sk
from vitrine.sources.versions import PublishedTable
from vitrine.streaming import streams as sm


def _written(df, label: str, suffix: str = "", **options) -> str:
    path = scratch_path(df.sparkSession, label) + suffix
    df.write.options(**options).text(path)
    return path


def _folder(df) -> str:
    """The path of a table: its folder of part files, or its one file."""
    first = df.inputFiles()[0]
    parent = first.rpartition("/")[0]
    return parent if parent.endswith(".parquet") else first


@query("a01_scan_table", "SELECT l_returnflag, count(*) AS n FROM {lineitem} WHERE l_quantity > 30 GROUP BY 1")
def _a01(c):
    path = _folder(c.lineitem)
    rows = rd.scan_table(c.lineitem.sparkSession, path)
    return rows.filter("l_quantity > 30").groupBy("l_returnflag").agg(F.count("*").alias("n"))


RECORD = "id || chr(9) || objectnumber || chr(9) || physicaldescription || CASE WHEN numberofobjects % 6 = 0 THEN chr(9) || 'extra' ELSE '' END"


def _export(c):
    o = c.objects
    extra = F.when(F.col("numberofobjects") % 6 == 0, F.lit("extra"))
    lines = o.select(F.concat_ws("\t", "id", "objectnumber", "physicaldescription", extra).alias("value"))
    total = o.agg(F.concat(F.lit("("), F.count("*").cast("string"), F.lit(" rows)")).alias("value"))
    path = _written(lines.union(total), "export", lineSep="@@")
    return rd.read_record_export(o.sparkSession, path, columns=["id", "objectnumber", "physicaldescription"])


@query("a02_read_record_export", """SELECT id, objectnumber, replace(replace(physicaldescription, chr(10), ' '), chr(13), ' ') AS physicaldescription FROM {objects} WHERE numberofobjects % 6 <> 0""")
def _a02(c):
    return _export(c)[0]


@query("a02_export_errors", f"SELECT replace(replace({RECORD}, chr(10), ' '), chr(13), ' ') AS value FROM {{objects}} WHERE numberofobjects % 6 = 0")
def _a02_errors(c):
    return _export(c)[1]


MANIFEST = "name, size, objectnumber, date, creator, contributor, handling, approvedforweb"


def _manifest_file(c, name: str = "manifest"):
    path = scratch_path(c.manifest.sparkSession, name)
    c.manifest.write.csv(path, header=True, sep="|")
    return path


@query("a03_read_manifest", f"SELECT {MANIFEST}, '' AS rightsholder, '' AS imagenumber FROM {{manifest}}")
def _a03(c):
    return rd.read_manifest(c.manifest.sparkSession, _manifest_file(c))


@query("a04_read_keyword_list", "SELECT termdisplayname AS value FROM {location_terms}")
def _a04(c):
    rows = c.location_terms.select(F.concat("termdisplayname", F.lit("\tnote")).alias("value"))
    return rd.read_keyword_list(rows.sparkSession, _written(rows, "list"))


@query("a05_parse_scanner_lines", """SELECT line, len(f) AS n, array_to_string(f, '~') AS cells FROM (SELECT line, string_split(substr(line, 2, length(line) - 2), '","') AS f
    FROM (SELECT DISTINCT rtrim(value) AS line FROM {scan_lines} WHERE value LIKE '"%') a) b""")
def _a05(c):
    scans = rd.parse_scanner_lines(c.scan_lines)
    return scans.select("line", F.size("cells").cast("bigint").alias("n"), F.array_join("cells", "~").alias("cells"))


def _spec_lines(c):
    """A field specification whose rows come from a given table."""
    k, name = F.col("n_nationkey"), F.lower("n_name")
    cells = ["field", (k + 1).cast("string"), name, F.initcap("n_name"), F.concat(name, F.lit("_s")), "", "", "keyword", "",
             F.when(k % 3 == 0, k.cast("string")).otherwise(""), "", "", "", "", "", F.when(k % 4 == 1, (100 - k).cast("string")).otherwise(""), "x"]
    rows = c.nation.select(F.concat_ws("\t", *[F.lit(x) if isinstance(x, str) and x != "n_name" else x for x in cells]).alias("value"))
    return rows.union(c.region.select(F.concat(F.lit("#\t"), "r_name").alias("value")))


@query("a06_read_field_spec", """SELECT CAST(p_partkey AS VARCHAR) AS number, lower(p_name) AS "Name", p_brand AS "Label", 'f' || p_partkey || '_s' AS "SolrField",
    CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) ELSE '' END AS "Facet", 'x' AS x FROM {part} WHERE p_partkey % 10 <> 0""")
def _a06(c):
    k = F.col("p_partkey")
    number = k.cast("string")
    blanks = [F.lit("")] * 2
    cells = [
        F.when(k % 10 == 0, "#").otherwise("field"), number, F.lower("p_name"), F.col("p_brand"), F.concat(F.lit("f"), number, F.lit("_s")), *blanks, F.lit("keyword"), F.lit(""),
        F.when(k % 3 == 0, F.col("p_size").cast("string")).otherwise(""), *blanks, *blanks, *blanks, F.lit("x")]
    lines = c.part.select(F.concat_ws("\t", *cells).alias("value"))
    return rd.read_field_spec(lines.sparkSession, _written(lines, "spec")).select("number", "Name", "Label", "SolrField", "Facet", "x")


def _log_lines(events):
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return events.select(F.concat_ws(
        "\t", F.lit("POST"), at, "event_type", F.lit("movements"), F.concat(F.lit("user"), F.col("user_id").cast("string")),
        F.concat(F.lit("value="), F.col("event_id").cast("string")), F.concat(F.lit("props="), "props"), F.concat(F.lit("note=a=b"))).alias("value"))


@query("a07_read_audit_log", """SELECT 'POST' AS action, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS logged_at, event_type AS update_type, 'user' || user_id AS username,
    CAST(event_id AS VARCHAR) AS value, props, 'a=b' AS note FROM {events}""")
def _a07(c):
    lines = _log_lines(c.events).union(c.region.select(F.concat(F.lit("#"), "r_name")))
    log = rd.read_audit_log(lines.sparkSession, _written(lines, "log"))
    return log.select("action", "logged_at", "update_type", "username", *[F.col("attrs")[k].alias(k) for k in ("value", "props", "note")])


LISTED = ["comments", "styles", "contentpersons"]


@query("a08_read_pairs", " UNION ALL ".join(f"SELECT '{f}' AS field, id, {f}_ss AS cell FROM ({list_sql(f)}) t" for f in LISTED))
def _a08(c):
    """Pairs read from a template list, each run over its whole table."""
    spark = c.objects.sparkSession
    lines = spark.range(1).select(F.explode(F.array(*[F.lit(f"objects,{f}") for f in LISTED])).alias("value"))
    pairs = rd.read_pairs(spark, _written(lines, "pairs"))
    frames = [ex.field_extract(c, table, field, 2) for table, field in pairs]
    return union_all([df.select(F.lit(field).alias("field"), "id", F.col(f"{field}_ss").alias("cell")) for df, (_, field) in zip(frames, pairs)])


# ---- sinks -----------------------------------------------------------------------------------------


def _indexable(c):
    comments = c.comments.withColumn("item", F.when(F.col("pos") % 2 == 0, F.col("item")).otherwise(F.lit("same")))
    lists = comments.groupBy("id").agg(F.expr("listagg(item, '|') WITHIN GROUP (ORDER BY pos, item)").alias("comments_ss"))
    return c.objects.select("id", F.col("objectnumber").alias("objectnumber_s"), F.col("collection").alias("collection_txt")).join(lists, "id")


INDEXED = """SELECT o.id, o.objectnumber AS objectnumber_s, o.collection AS collection_txt, string_split(l.v, '|') AS c FROM {objects} o JOIN (
    SELECT id, string_agg(CASE WHEN pos % 2 = 0 THEN item ELSE 'same' END, '|' ORDER BY pos, CASE WHEN pos % 2 = 0 THEN item ELSE 'same' END) AS v FROM {comments} GROUP BY id) l ON l.id = o.id"""


@query("k03_replace_load", f"SELECT id, objectnumber_s, len(c) AS n, array_to_string(c, '~') AS comments_ss FROM ({INDEXED}) t")
def _k03(c):
    path = scratch_path(c.objects.sparkSession, "index")
    sk.replace_load(_indexable(c).limit(0), path)
    sk.replace_load(_indexable(c), path)
    loaded = PublishedTable(c.objects.sparkSession, path, "id").read()
    return loaded.select("id", "objectnumber_s", F.size("comments_ss").cast("bigint").alias("n"), F.array_join("comments_ss", "~").alias("comments_ss"))


@query("k04_write_delimited", f"SELECT id, objectnumber, coalesce({cleaned('contentdescription')}, '') AS contentdescription FROM {{objects}}")
def _k04(c):
    spark = c.objects.sparkSession
    rows = c.objects.withColumn("contentdescription", tx.collapse_ctrl_ws("contentdescription"))
    path = scratch_path(spark, "csv")
    target = sk.write_delimited(rows, path, "20240203040506", ["id", "objectnumber", "contentdescription"], sep=",", quote_all=True, compression="gzip")
    return spark.read.csv(target, header=True).withColumn("contentdescription", F.coalesce("contentdescription", F.lit("")))


@query("k05_suffix_schema", f"SELECT id, objectnumber_s, objectnumber_s AS objectnumber_txt, collection_txt, collection_txt AS collection_s, array_to_string(c, '~') AS comments_ss, array_to_string(c, '~') AS comments_txt FROM ({INDEXED}) t")
def _k05(c):
    rows = sk.index_rows(_indexable(c))
    joined = {n: F.array_join(n, "~") for n in ("comments_ss", "comments_txt")}
    return rows.withColumns(joined)


def _spec_table(c):
    """A wide table with the columns that the specification of :func:`_spec_lines` names."""
    cols = [F.concat(F.lit(f"v{i} "), (F.col("c_custkey") % (i + 2)).cast("string")).alias(f"nation_{i}_s") for i in range(25)]
    return c.customer.select("c_custkey", *cols)


CSV_KEYS = [k for k in range(25) if k % 4 == 1]
FACET_KEYS = [k for k in range(25) if k % 3 == 0]


@query("k06_project_by_spec", "SELECT " + ", ".join(f"'v{k} ' || (c_custkey % {k + 2}) AS nation_{k}" for k in CSV_KEYS) + " FROM {customer}")
def _k06(c):
    return sk.project_by_spec(_spec_table(c), rd.parse_field_spec(_spec_lines(c)), "inCSV")


@query("e23_facet_counts", " UNION ALL ".join(
    f"SELECT 'nation_{k}_s' AS field, 'v{k} ' || (c_custkey % {k + 2}) AS value, count(*) AS n FROM {{customer}} GROUP BY 2" for k in FACET_KEYS))
def _e23(c):
    return facet_counts(_spec_table(c), sk.facet_fields(rd.parse_field_spec(_spec_lines(c))))


@query("k13_append_audit", """SELECT 'POST' AS action, '2024-02-03T04:05:06Z' AS logged_at, run AS update_type, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM {orders}, (VALUES ('move'), ('edit')) r(run)""")
def _k13(c):
    spark = c.orders.sparkSession
    path = scratch_path(spark, "audit")
    for run in ("move", "edit"):
        sk.append_audit(sk.audit_rows(c.orders, "POST", run, "movements", "me", "2024-02-03T04:05:06Z", ["o_orderkey", "o_orderstatus"]), path)
    log = rd.read_audit_log(spark, path)
    return log.select("action", "logged_at", "update_type", *[F.col("attrs")[k].alias(k) for k in ("o_orderkey", "o_orderstatus")])


# ---- streams ----------------------------------------------------------------------------------------


@query("s01_manifest_stream", f"SELECT name, objectnumber, handling, approvedforweb, objectcsid, mediacsid, referencenumber FROM {INTAKE} i")
def _s01(c):
    spark = c.manifest.sparkSession
    folder, out, state = (scratch_path(spark, n) for n in ("drop", "intake", "state"))
    c.manifest.write.csv(f"{folder}/a.step1.csv", header=True, sep="|")
    stream = sm.manifest_stream(spark, f"{folder}/a.step1.csv", c.manifest.columns, glob="*.csv")
    sm.run_intake(c, stream, NOW, out, state).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("name", "objectnumber", "handling", "approvedforweb", "objectcsid", "mediacsid", "referencenumber")


@query("s01_redelivered", f"SELECT name, objectnumber, handling, approvedforweb, objectcsid, mediacsid, referencenumber FROM (SELECT DISTINCT * FROM {INTAKE} i) j")
def _s01_again(c):
    """The manifest dropped twice, as two files, counts once."""
    spark = c.manifest.sparkSession
    folder, out, state = (scratch_path(spark, n) for n in ("drop", "intake", "state"))
    for name in ("a", "b"):
        c.manifest.write.csv(f"{folder}/{name}.step1.csv", header=True, sep="|")
        stream = sm.manifest_stream(spark, f"{folder}/*.step1.csv", c.manifest.columns, glob="*.csv", late="7 days")
        sm.run_intake(c, stream, NOW, out, state).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("name", "objectnumber", "handling", "approvedforweb", "objectcsid", "mediacsid", "referencenumber")


@query("s02_audit_stream", """SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H') AS hour, event_type AS update_type, count(*) AS n FROM {events}
    GROUP BY 1, 2, time_bucket(INTERVAL 1 HOUR, ts) HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT date_trunc('second', max(ts)) - INTERVAL 1 DAY FROM {events})""")
def _s02(c):
    spark = c.events.sparkSession
    folder, out, state = (scratch_path(spark, n) for n in ("log", "activity", "state"))
    _log_lines(c.events).write.text(folder)
    sm.run_to_table(sm.recent_activity(sm.audit_stream(spark, folder)), out, state).awaitTermination()
    return spark.read.parquet(out).select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "update_type", "n")


@query("s02_every_line_once", "SELECT event_type AS update_type, CAST(event_id AS VARCHAR) AS value, count(*) AS n FROM {events} GROUP BY 1, 2")
def _s02_once(c):
    """The log in two files that overlap, the later times first: each line is in one of the two outputs, once."""
    spark = c.events.sparkSession
    folder, out, state = (scratch_path(spark, n) for n in ("log", "audit", "state"))
    late = c.events.filter(F.col("ts") >= c.events.select(F.min("ts") + F.expr("INTERVAL 3 DAYS")).scalar())
    for rows in (late, c.events):
        lines = _log_lines(rows)
        lines.write.mode("append").text(folder)
        actions, aside = sm.run_audit(spark, folder, out, state)
    return actions.union(aside).groupBy("update_type", F.col("attrs")["value"].alias("value")).agg(F.count("*").alias("n"))
