"""Hierarchies (survey section 2.8) and place filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.catalog.filters import LIVE
from vitrine.catalog.registry import query
from vitrine.catalog.text import display
from vitrine.operators import filters as fl
from vitrine.operators import hierarchy as hi
from vitrine.operators import intervals as iv

EDGES = f"""SELECT DISTINCT {display('t.refname')} AS child, {display('u.refname')} AS parent, h.name AS child_key, p.name AS parent_key
    FROM {{places}} t JOIN {LIVE} m ON m.id = t.id JOIN {{hierarchy}} h ON h.id = t.id AND h.primarytype LIKE 'Place%'
    LEFT JOIN {{relations}} r ON r.subjectcsid = h.name AND r.relationshiptype = 'hasBroader'
    LEFT JOIN {{hierarchy}} p ON p.name = r.objectcsid AND p.primarytype LIKE 'Place%' LEFT JOIN {{places}} u ON u.id = p.id"""


def place_edges(c):
    return hi.authority_edges(c.places, c.relations, c.hierarchy, c.misc, "Place")


def place_tree(c):
    """The places' trees as intervals, labelled once for a collection."""
    return c.keep("place_tree", lambda: iv.intervals(place_edges(c)))


CLOSURE = f"""WITH RECURSIVE e AS ({EDGES}),
    up AS (SELECT DISTINCT child_key AS key, child_key AS ancestor_key, child AS ancestor, 0 AS level FROM e
      UNION ALL SELECT up.key, e.parent_key, e.parent, up.level - 1 FROM up JOIN e ON e.child_key = up.ancestor_key WHERE e.parent_key IS NOT NULL)"""

DOWN = f"""WITH RECURSIVE e AS ({EDGES}), l AS (SELECT DISTINCT * FROM e WHERE parent_key IS NOT NULL),
    down AS (SELECT child AS term, child_key AS key, {{first}} AS level FROM l WHERE parent = '{{term}}'
      UNION ALL SELECT child, child_key, {{first}} FROM l WHERE child = '{{term}}' AND NOT EXISTS (SELECT 1 FROM l WHERE parent = '{{term}}')
      UNION ALL SELECT l.child, l.child_key, down.level + 1 FROM down JOIN l ON l.parent_key = down.key)"""


def down(term: str, first: int) -> str:
    return DOWN.replace("{term}", term).replace("{first}", str(first))


@query("h01_authority_edges", EDGES)
def _h01(c):
    return hi.ordered_edges(place_edges(c))


@query("h02_ancestors", CLOSURE + " SELECT ancestor AS term, ancestor_key AS key, level FROM up WHERE key = 'c-4'")
def _h02(c):
    return hi.ancestors(place_edges(c), "c-4")


@query("h02_closure", CLOSURE + " SELECT key, ancestor_key, ancestor, level FROM up")
def _h02_all(c):
    return hi.closure(place_edges(c))


@query("h03_descendants", down("ASIA", 1) + """ SELECT term, level FROM down
    UNION ALL SELECT 'ASIA', 0 WHERE NOT EXISTS (SELECT 1 FROM down WHERE term = 'ASIA')""")
def _h03(c):
    return iv.descendants(place_tree(c), "ASIA")


@query("h03_descendants_walk", down("AFRICA", 1) + """ SELECT term, level FROM down
    UNION ALL SELECT 'AFRICA', 0 WHERE NOT EXISTS (SELECT 1 FROM down WHERE term = 'AFRICA')""")
def _h03_walk(c):
    return hi.descendants(place_edges(c), "AFRICA")


@query("h03_below_many", CLOSURE + """ SELECT up.ancestor_key AS asked, up.key, e.child AS term, -min(up.level) AS level FROM up JOIN (SELECT DISTINCT child_key, child FROM e) e ON e.child_key = up.key
    WHERE up.ancestor_key LIKE 'r-%' OR up.ancestor_key LIKE 'n-%' GROUP BY 1, 2, 3""")
def _h03_many(c):
    """Everything below every region and nation, all at once."""
    asked = c.region.select(F.concat(F.lit("r-"), F.col("r_regionkey").cast("string")).alias("key")).union(c.nation.select(F.concat(F.lit("n-"), F.col("n_nationkey").cast("string"))))
    return iv.below(place_tree(c), asked)


@query("h03_leaf_term", down("Customer#000000004", 1) + " SELECT term, level FROM down")
def _h03_leaf(c):
    return iv.descendants(place_tree(c), "Customer#000000004")


@query("h04_children", f"""WITH e AS ({EDGES}) SELECT child AS term, child_key AS key, parent_key AS broader_key, parent AS broader FROM e WHERE parent = 'NATION_3'""")
def _h04(c):
    return hi.children(place_edges(c), "NATION_3")


@query("h05_place_descendants", down("EUROPE", 0) + """ SELECT term AS place, level FROM down
    UNION ALL SELECT 'EUROPE', 0 WHERE NOT EXISTS (SELECT 1 FROM down WHERE term = 'EUROPE')""")
def _h05(c):
    return iv.place_descendants(place_tree(c), "EUROPE")


@query("h06_tree_paths", f"""WITH RECURSIVE e AS ({EDGES}),
    t AS (SELECT child_key AS key, child AS label, 'ROOT > ' || child AS path, 1 AS depth FROM e WHERE parent_key IS NULL
      UNION ALL SELECT e.child_key, e.child, t.path || ' > ' || e.child, t.depth + 1 FROM t JOIN e ON e.parent_key = t.key)
    SELECT key, label, path, depth, key NOT IN (SELECT parent_key FROM e WHERE parent_key IS NOT NULL) AS is_leaf FROM t""")
def _h06(c):
    return hi.tree_paths(place_edges(c))


@query("h07_child_lists", f"""WITH e AS ({EDGES}), x AS (SELECT coalesce(parent_key, 'ROOT') AS parent_key, child_key, child,
      child_key NOT IN (SELECT parent_key FROM e WHERE parent_key IS NOT NULL) AS is_leaf FROM e),
    y AS (SELECT parent_key, child_key, CASE WHEN is_leaf AND parent_key = 'ROOT' THEN 'no parent >> ' || child ELSE child END AS label, is_leaf FROM x)
    SELECT *, row_number() OVER (PARTITION BY parent_key ORDER BY label, child_key) - 1 AS pos FROM y""")
def _h07(c):
    return hi.child_lists(place_edges(c))


@query("h08_culture_heading", CLOSURE + f""", n AS (SELECT key, string_agg(ancestor, ' :: ' ORDER BY level, ancestor_key) AS path, count(*) AS n,
      max(CASE WHEN level = 0 THEN ancestor END) AS term FROM up GROUP BY key),
    g AS (SELECT p.refname, CASE WHEN n.n = 1 THEN 'No parent :: ' || n.term ELSE n.path END AS heading, n.n = 1 AS alone
      FROM {{places}} p JOIN {{hierarchy}} h ON h.id = p.id JOIN n ON n.key = h.name)
    SELECT a.id, CASE WHEN assocpeople IS NULL THEN 'No cultural group specified' ELSE coalesce(g.heading, 'No parent :: ' || {display('assocpeople')}) END AS heading,
    assocpeople IS NULL OR coalesce(g.alone, true) AS sort_last FROM {{assocpeoplegroup}} a LEFT JOIN g ON g.refname = a.assocpeople""")
def _h08(c):
    return hi.culture_heading(c.assocpeoplegroup.select("id", "assocpeople"), "assocpeople", c.places, c.hierarchy, place_edges(c)).drop("assocpeople")


@query("c08_under_place", down("NATION_7", 1) + f""", terms AS (SELECT term FROM down UNION SELECT 'NATION_7')
    SELECT id, {display('fieldcollectionplace')} AS place FROM {{objects}} WHERE {display('fieldcollectionplace')} IN (SELECT term FROM terms)""")
def _c08(c):
    from vitrine.functions.text import refname_display

    terms = iv.descendants(place_tree(c), "NATION_7").select("term")
    return fl.under_place(c.objects.select("id", refname_display("fieldcollectionplace").alias("place")), "place", terms)
