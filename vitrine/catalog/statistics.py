"""Collection statistics (survey sections 2.5 and 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.catalog.filters import LIVE
from vitrine.catalog.registry import query
from vitrine.catalog.text import _case, display
from vitrine.functions import labels as lab
from vitrine.functions.text import refname_display
from vitrine.operators import aggregates as ag
from vitrine.plans import stats as st

PARENTS = """SELECT DISTINCT o.objectnumber, o.numberofobjects, o.id FROM {objects} o JOIN {hierarchy} h ON h.id = o.id
    JOIN {relations} r ON r.objectcsid = h.name AND r.subjectdocumenttype = 'CollectionObject' AND r.relationshiptype = 'hasBroader'"""


@query("e08_total_counts", f"""WITH live AS (SELECT o.* FROM {{objects}} o JOIN {LIVE} m ON m.id = o.id),
    over AS (SELECT DISTINCT p.objectnumber, p.numberofobjects FROM ({PARENTS}) p JOIN {LIVE} m ON m.id = p.id)
    SELECT (SELECT count(*) FROM live JOIN {{objects_ext}} e ON e.id = live.id WHERE e.iscomponent = 'no') AS totalmusnocount,
    (SELECT count(*) FROM live) AS totalobjectcount, (SELECT count(numberofobjects) FROM over) AS objectovercount,
    (SELECT CAST(sum(numberofobjects) AS BIGINT) FROM live) AS totalpiececount, (SELECT CAST(sum(numberofobjects) AS BIGINT) FROM over) AS pieceovercount""")
def _e08(c):
    return st.total_counts(c)


@query("e09_grouped_counts", f"""WITH live AS (SELECT o.*, {display('o.collection')} AS grp FROM {{objects}} o JOIN {LIVE} m ON m.id = o.id),
    u AS (SELECT grp, count(*) AS a, NULL AS b, NULL AS c, NULL AS d, NULL AS f FROM live JOIN {{objects_ext}} e ON e.id = live.id WHERE e.iscomponent = 'no' GROUP BY grp
      UNION SELECT grp, NULL, count(*), NULL, sum(numberofobjects), NULL FROM live GROUP BY grp
      UNION SELECT grp, NULL, NULL, count(*), NULL, sum(numberofobjects) FROM live WHERE objectnumber NOT IN (SELECT objectnumber FROM ({PARENTS}) p) GROUP BY grp)
    SELECT grp AS collection, CAST(max(a) AS BIGINT) AS totalmusnocount, CAST(max(b) AS BIGINT) AS totalobjectcount, CAST(max(c) AS BIGINT) AS trueobjectcount,
      CAST(max(d) AS BIGINT) AS totalpiececount, CAST(max(f) AS BIGINT) AS truepiececount FROM u GROUP BY grp""")
def _e09(c):
    return st.grouped_counts(c, refname_display("collection"), "collection")


LATEST = """SELECT * FROM {collectionstats} WHERE dbsource = 'db' AND statgroup = 'objByObjType'
    AND isoruntime >= (SELECT max(date_trunc('day', isoruntime)) FROM {collectionstats} WHERE statgroup = 'objByObjType')"""
WIDE = f"""SELECT label, {', '.join(f"max(CASE WHEN statmetric = '{code}' THEN statvalue END) AS {short}val, max(CASE WHEN statmetric = '{code}' THEN statpercent END) AS {short}pct" for code, short in st.METRICS.items())},
    max(isoruntime) AS isoruntime FROM ({LATEST}) l GROUP BY label"""


@query("e10_latest_stats_wide", WIDE)
def _e10(c):
    return st.latest_stats_wide(c.collectionstats, "db", "objByObjType")


@query("e11_latest_stats_metric", f"SELECT label, statvalue, statpercent, isoruntime, statmetric FROM ({LATEST}) l WHERE statmetric = 'trueObjectCount'")
def _e11(c):
    return st.latest_stats_metric(c.collectionstats, "db", "objByObjType", "trueObjectCount")


@query("e12_stat_series", """SELECT isoruntime, statvalue, statmetric, label FROM {collectionstats} WHERE statgroup = 'objByObjType' AND stattarget = 'pieces'
    AND statmetric = 'truePieceCount'""")
def _e12(c):
    return st.stat_series(c.collectionstats, "objByObjType", "pieces")


@query("e13_share_of_total", """WITH t AS (SELECT p_type, CAST(sum(p_size) AS BIGINT) AS v FROM {part} WHERE p_type <> 'PROMO' GROUP BY 1)
    SELECT p_type, v, round(v / ((SELECT sum(v) FROM t) * 0.01E0), 3) AS v_pct FROM t""")
def _e13(c):
    return ag.share_of_total(c.part.groupBy("p_type").agg(F.sum("p_size").alias("v")), "p_type", ["v"], exclude="PROMO")


@query("e14_headline_totals", f"""SELECT sum(musnoval) AS numbers, sum(truobjval) AS objects, sum(trupcval) AS pieces, max(isoruntime) AS isoruntime FROM ({WIDE}) w""")
def _e14(c):
    return st.headline_totals(c.collectionstats, "db")


AREA_LABEL = "label || CASE label WHEN '1-URGENT' THEN ' North American archaeology' WHEN '2-HIGH' THEN ' Continent unknown' ELSE ' African ethnography' END"


def _area_stats(c):
    label = F.when(F.col("label") == "1-URGENT", " North American archaeology").when(F.col("label") == "2-HIGH", " Continent unknown").otherwise(" African ethnography")
    return c.collectionstats.withColumn("label", F.concat("label", label))


STATUS_LABEL = "CASE label WHEN '1-URGENT' THEN 'accessioned' WHEN '2-HIGH' THEN 'not located' WHEN '3-MEDIUM' THEN 'sold' ELSE label END"


def _status_stats(c):
    """Statistics by status: two known ones, one that is left out of counts, others."""
    status = F.when(F.col("label") == "1-URGENT", "accessioned").when(F.col("label") == "2-HIGH", "not located").when(F.col("label") == "3-MEDIUM", "sold").otherwise(F.col("label"))
    return c.collectionstats.withColumn("label", status)


HEAD = "statmetric IN ('totalMusNoCount', 'trueObjectCount', 'truePieceCount')"
METRIC = _case(lab.METRIC_NAMES, "statmetric", "statmetric")


@query("r40_stats_chart", f"""SELECT 'single' AS kind, label, statvalue AS value, {METRIC} AS metric, NULL AS category, NULL AS continent FROM ({LATEST}) l WHERE {HEAD}
    UNION ALL SELECT 'status', {STATUS_LABEL}, statvalue, {METRIC}, CASE label WHEN '1-URGENT' THEN 'Accession Status' WHEN '3-MEDIUM' THEN 'Deaccession Reason' ELSE 'Other' END, NULL
      FROM ({LATEST}) l WHERE {HEAD} AND label <> '2-HIGH'
    UNION ALL SELECT 'content', {AREA_LABEL}, statvalue, {METRIC}, CASE label WHEN '1-URGENT' THEN 'Archaeology' ELSE 'Ethnography' END,
      CASE label WHEN '1-URGENT' THEN 'North America' ELSE 'Africa' END FROM ({LATEST}) l WHERE {HEAD} AND label <> '2-HIGH'
    UNION ALL SELECT 'bar', label, statvalue, {METRIC}, label, NULL FROM ({LATEST}) l WHERE {HEAD}""")
def _r40(c):
    s = c.collectionstats
    none = F.lit(None).cast("string")
    single = st.stats_chart(s, "db", "objByObjType").select(F.lit("single").alias("kind"), "label", "value", "metric", none.alias("category"), none.alias("continent"))
    status = st.stats_chart(_status_stats(c), "db", "objByObjType", "status").select(F.lit("status").alias("kind"), "label", "value", "metric", "category", none.alias("continent"))
    content = st.stats_chart(_area_stats(c), "db", "objByObjType", "content").select(F.lit("content").alias("kind"), "label", "value", "metric", "category", "continent")
    bar = st.stats_chart(s, "db", "objByObjType", "bar").select(F.lit("bar").alias("kind"), "label", "value", "metric", F.col("tooltip").alias("category"), none.alias("continent"))
    return ag.union_all([single, status, content, bar])


@query("r41_stats_table", f"""WITH w AS ({WIDE})
    SELECT 'stored' AS percents, label, musnoval, truobjval, trupcval, round(musnopct, 3) AS musnopct, round(truobjpct, 3) AS truobjpct, round(trupcpct, 3) AS trupcpct, isoruntime FROM w
    UNION ALL SELECT 'computed', label, musnoval, truobjval, trupcval, round(musnoval / ((SELECT sum(musnoval) FROM w) * 0.01E0), 3),
      round(truobjval / ((SELECT sum(truobjval) FROM w) * 0.01E0), 3), round(trupcval / ((SELECT sum(trupcval) FROM w) * 0.01E0), 3), isoruntime FROM w""")
def _r41(c):
    stored = st.stats_table(c.collectionstats, "db", "objByObjType").withColumn("percents", F.lit("stored"))
    return stored.unionByName(st.stats_table(c.collectionstats, "db", "objByObjType", recompute=True).withColumn("percents", F.lit("computed")))


@query("r42_stats_time", f"""SELECT strftime(isoruntime, '%Y-%m-%d') AS day, statvalue AS value, {METRIC} AS metric, label AS category FROM {{collectionstats}}
    WHERE statgroup = 'objByObjType' AND ((stattarget = 'musNumbers' AND statmetric = 'totalMusNoCount') OR (stattarget = 'objects' AND statmetric = 'trueObjectCount')
      OR (stattarget = 'pieces' AND statmetric = 'truePieceCount'))""")
def _r42(c):
    return st.stats_time(c.collectionstats, "objByObjType").withColumn("day", F.col("day").cast("string"))
