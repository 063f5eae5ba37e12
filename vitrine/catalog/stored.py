"""Tables that are stored to be read often: key order, prefixes, latest rows, parts of cells, resolved links."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.catalog.extracts import from_objects
from vitrine.catalog.filters import NUMBERED, _numbered
from vitrine.catalog.registry import query
from vitrine.catalog.text import cleaned
from vitrine.functions import text as tx
from vitrine.operators.aggregates import union_all
from vitrine.operators.cells import cell_parts, joined_parts
from vitrine.operators.latest import LatestRows
from vitrine.operators.layout import KeyedTable
from vitrine.operators.suggestions import SuggestionTable
from vitrine.plans.links import linked, links_of
from vitrine.session import cut_lineage, scratch_path


def keyed_locations(c) -> KeyedTable:
    """Location names in the order of their key."""

    def make():
        spark = c.location_terms.sparkSession
        rows = c.location_terms.select("termdisplayname", tx.location_key("termdisplayname").alias("locationkey"))
        return KeyedTable(spark, scratch_path(spark, "locations"), "locationkey").write(rows, 8)

    return c.keep("keyed_locations", make)


def keyed_numbers(c) -> KeyedTable:
    """Live objects in the order of their sort key."""

    def make():
        spark = c.objects.sparkSession
        return KeyedTable(spark, scratch_path(spark, "numbers"), "sortableobjectnumber").write(_numbered(c), 16)

    return c.keep("keyed_numbers", make)


KEYS = "(SELECT termdisplayname, replace(termdisplayname, ' ', '0') AS locationkey FROM {location_terms})"


@query("c04_keyed_search", f"""SELECT 'set' AS mode, * FROM {KEYS} t WHERE locationkey >= 'Bay03' UNION ALL SELECT 'exact', * FROM {KEYS} t WHERE locationkey = 'Bay02,0Shelf02'
    UNION ALL SELECT 'prefix', * FROM {KEYS} t WHERE starts_with(locationkey, 'Bay04') UNION ALL SELECT 'range', * FROM {KEYS} t WHERE locationkey BETWEEN 'Bay01' AND 'Bay05'
    UNION ALL SELECT * FROM (SELECT 'next', * FROM {KEYS} t WHERE locationkey >= 'Bay02' ORDER BY locationkey, termdisplayname LIMIT 5) n""")
def _c04(c):
    table = keyed_locations(c)
    runs = [("set", ("set", "Bay03")), ("exact", ("exact", "Bay02,0Shelf02")), ("prefix", ("prefix", "Bay04")), ("range", ("range", "Bay01", "Bay05")), ("next", ("set", "Bay02", None, 5, "termdisplayname"))]
    return union_all([table.search(*how).select(F.lit(mode).alias("mode"), "termdisplayname", "locationkey") for mode, how in runs])


@query("c06_keyed_nearest", f"""WITH t AS (SELECT * FROM {NUMBERED}), ends AS (SELECT min(CASE WHEN sortableobjectnumber >= '0000001995' THEN sortableobjectnumber END) AS a,
    max(CASE WHEN sortableobjectnumber <= '0000002003.5' THEN sortableobjectnumber END) AS b FROM t) SELECT t.* FROM t, ends WHERE sortableobjectnumber BETWEEN a AND b""")
def _c06(c):
    return keyed_numbers(c).nearest("0000001995", "0000002003.5")


QUERIED = [f"{a}{b}" for a in ("Ti", "Title A", "title n", "Title R4") for b in ("", "x")] + ["", "T"]


@query("c15_suggestion_table", " UNION ALL ".join(
    f"SELECT * FROM (SELECT DISTINCT '{q}' AS typed, title AS value FROM {{titlegroup}} WHERE starts_with(lower(title), lower('{q}')) ORDER BY title LIMIT 10) t{i}" for i, q in enumerate(QUERIED)))
def _c15(c):
    """Typed texts of all lengths against the prefixes of every title."""
    def make():
        spark = c.titlegroup.sparkSession
        return SuggestionTable(spark, scratch_path(spark, "titles"), 10, 6, ignore_case=True).write(c.titlegroup, "title")

    table = c.keep("titles", make)
    return union_all([table.suggest(q).select(F.lit(q).alias("typed"), "value") for q in QUERIED])


@query("d05_linked", f"SELECT o.id, h2.id AS other FROM {from_objects('Exhibition')}")
def _d05(c):
    return linked(c.objects.select("id"), links_of(c), "other", "Exhibition")


CLEAN = cleaned("item")


@query("e01_cell_parts", f"SELECT id, string_agg({CLEAN}, '␥' ORDER BY pos, {CLEAN}) AS comments_ss FROM {{comments}} WHERE item IS NOT NULL GROUP BY id")
def _e01(c):
    """Cells made in parts of some 64 bytes, and joined at the end."""
    rows = c.comments.select("id", "pos", tx.collapse_ctrl_ws("item").alias("value"))
    parts = cell_parts(rows, "id", "value", ["pos", "value"], tx.MULTI, most=64)
    return joined_parts(parts, "id", tx.MULTI, "comments_ss")


@query("f03_latest_rows", f"""SELECT id, move, locationdate, currentlocation FROM (SELECT o.id, m.id AS move, m.locationdate, m.currentlocation,
      row_number() OVER (PARTITION BY o.id ORDER BY m.locationdate DESC NULLS FIRST, m.id) AS n FROM {from_objects('Movement')} JOIN {{movements}} m ON m.id = h2.id) t WHERE n = 1""")
def _f03(c):
    """Every object's latest movement, after its movements came in three batches in no order, the first of them twice."""
    spark = c.movements.sparkSession
    moves = linked(c.objects.select("id"), links_of(c), "move", "Movement").join(c.movements.select(F.col("id").alias("move"), "locationdate", "currentlocation"), "move")
    moves = cut_lineage(moves.select("id", "move", "locationdate", "currentlocation"), "moves")  # read by every batch
    state = LatestRows(spark, scratch_path(spark, "latest"), "id", "locationdate", ["move"], 16)
    for batch in (0, 1, 2, 0):
        state.merge(moves.filter(F.pmod(F.xxhash64("move"), F.lit(3)) == batch))
    return state.read()
