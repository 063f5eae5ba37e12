"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

A mask says which words of a window count; the others may differ.  Every window of every
benchmark item and of every document is hashed under each mask, and equal hashes are
hits.  A hit gives a diagonal: document position minus item position.  Each
(document, item, diagonal) is verified once, word by word over the whole item laid on
the document: the document is contaminated if at least ``SHARE`` of the item's words, and at
least ``MIN_WORDS``, stand at their places.  A passage with some words replaced is thus still found.

No such place is lost before it is verified.  ``MASKS`` are all masks of three words within a window of five, so a place has a hit
unless every five words of it hold two matches at most.  Then ``n`` words hold 2 * (n // 5) + min(n % 5, 2) at most, which for all
``n`` is below half of them or below 8.

Words are runs of letters, digits and characters outside ASCII, in lower case.  Windows are hashed
in one generated stage: words once to 64 bits each, then the masked words of each
window.  The benchmark's hashes are broadcast while there are at most ``BROADCAST_ROWS`` of
them; beyond that both sides are shuffled by hash.  Document texts are never shuffled by hash.

Defined cases: a null or empty text has no windows and is clean; an item of fewer than ``MIN_WORDS`` words is too short to
be evidence; repeated documents all get the verdict; repeated items are each reported; rows of equal id
but different text are judged apart; empty tables give no rows, or all clean; further columns are carried along by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import fresh, table
from vitrine.session import cut_lineage

#: 1: the word counts, 0: it may be any word.
MASKS = ("111", "1101", "1011", "11001", "10101", "10011")
MIN_WORDS, SHARE = 8, 0.5
#: Some 100 bytes a row, as the item's key is a text of 32 characters: some 40 MB.
BROADCAST_ROWS = 400_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def row_key(id_col: str, text_col: str) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit("")))))


def seeds(df: DataFrame, key: str, text_col: str, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """(key, pos, hash) of every window under every mask; ``pos`` is the window's first word, from 0."""
    hashed = df.select(F.col(key).alias("key"), F.transform(words(F.col(text_col)), lambda w: F.xxhash64(w)).alias("h"))
    shortest = min(map(len, masks))
    placed = hashed.filter(F.size("h") >= shortest).select("key", "h", F.size("h").alias("n"), F.explode(F.sequence(F.lit(0), F.size("h") - shortest)).alias("pos"))
    kinds = []
    for number, mask in enumerate(masks):
        chosen = [F.get("h", F.col("pos") + i) for i, bit in enumerate(mask) if bit == "1"]
        kinds.append(F.when(F.col("pos") + len(mask) <= F.col("n"), F.xxhash64(F.lit(number), *chosen)))
    return placed.select("key", "pos", F.explode(F.array(*kinds)).alias("hash")).filter("hash IS NOT NULL")


def overlaps(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", share: float = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, item, start, matched, n_words): the best verified place of each item in each document; ``key`` is ``row_key``."""
    items = benchmark.select(F.col(item_col).alias("item"), F.md5(F.coalesce(F.col(item_text), F.lit(""))).alias("item_key"), F.col(item_text).alias("item_text"))
    texts = items.groupBy("item_key").agg(F.any_value("item_text").alias("item_text"))
    probes = cut_lineage(seeds(texts, "item_key", "item_text").select("hash", F.col("key").alias("item_key"), F.col("pos").alias("item_pos")), "probes")
    probes = F.broadcast(probes) if probes.count() <= BROADCAST_ROWS else probes
    keyed = df.select(row_key(id_col, text_col).alias("k"), F.col(text_col).alias("t"))
    hits = seeds(keyed, "k", "t").join(probes, "hash").select("key", "item_key", (F.col("pos") - F.col("item_pos")).alias("start")).distinct()
    hits = cut_lineage(hits, "hits")
    found = hits.select("key").distinct()
    # One row a text: rows that are equal in id and text have one key.
    bodies = keyed.join(found, F.col("k") == F.col("key"), "left_semi").groupBy("k").agg(F.any_value("t").alias("t")).select("k", words(F.col("t")).alias("w"))
    laid = hits.join(bodies, F.col("key") == F.col("k")).join(texts.select("item_key", words(F.col("item_text")).alias("iw")), "item_key")
    matched = F.aggregate(
        F.sequence(F.lit(0), F.size("iw") - 1), F.lit(0),
        lambda n, i: n + F.when((F.col("start") + i >= 0) & F.get("w", F.greatest(F.col("start") + i, F.lit(0))).eqNullSafe(F.get("iw", i)), 1).otherwise(0),
    )
    judged = laid.select("key", "item_key", "start", F.size("iw").alias("n_words"), matched.alias("matched"))
    kept = judged.filter((F.col("matched") >= min_words) & (F.col("matched") >= share * F.col("n_words")))
    best = kept.groupBy("key", "item_key").agg(F.max_by(F.struct("matched", "n_words", "start"), F.struct("matched", -F.col("start"))).alias("b"))
    return best.join(items.select("item", "item_key"), "item_key").select("key", "item", "b.start", "b.matched", "b.n_words")


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: id, ``contaminated``, ``n_items``, ``items`` (sorted ids) and ``best_share`` of an item's words."""
    found = overlaps(df, benchmark, id_col, text_col, **options)
    per = found.groupBy("key").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("item")).alias("items"), F.max(F.col("matched") / F.col("n_words")).alias("best"))
    rows = df.select(F.col(id_col), row_key(id_col, text_col).alias("key"))
    joined = rows.join(cut_lineage(per, "per_document"), "key", "left")
    return joined.select(
        F.col(id_col), F.col("n").isNotNull().alias("contaminated"), F.coalesce("n", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join(F.transform("items", lambda i: i.cast("string")), ","), F.lit("")).alias("items"), F.coalesce("best", F.lit(0.0)).alias("best_share"),
    )


def clean(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that hold no benchmark item, columns as they are."""
    bad = cut_lineage(overlaps(df, benchmark, id_col, text_col, **options).select("key").distinct(), "contaminated")
    (key,) = fresh(df, "row_key")
    keyed = df.withColumn(key, row_key(id_col, text_col))
    return keyed.join(bad, F.col(key) == bad["key"], "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _window(mask: str, words_: str, pos: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"{words_}[{pos} + {i + 1}]" for i, bit in enumerate(mask) if bit == "1") + ")"


def _seeds(source: str, key: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {key} AS key, pos, concat('{n} ', {_window(mask, 'w', 'pos')}) AS seed FROM {source}, LATERAL (SELECT unnest(range(0, len(w) - {len(mask) - 1})) AS pos) u WHERE len(w) >= {len(mask)}"
        for n, mask in enumerate(MASKS)
    )


_WORDS = "list_filter(string_split_regex(lower(coalesce({}, '')), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format('text')} AS w FROM documents),
b AS (SELECT row_number() OVER () AS bid, item_id, {_WORDS.format('text')} AS w FROM benchmark),
ds AS ({_seeds('d', 'rid')}), bs AS ({_seeds('b', 'bid')}),
hits AS (SELECT DISTINCT ds.key AS rid, bs.key AS bid, ds.pos - bs.pos AS start FROM ds JOIN bs ON ds.seed = bs.seed),
laid AS (
  SELECT hits.rid, hits.bid, b.item_id, len(b.w) AS n_words, len(list_filter(range(0, len(b.w)), lambda i: start + i >= 0 AND start + i < len(d.w) AND d.w[start + i + 1] = b.w[i + 1])) AS matched
  FROM hits JOIN d ON d.rid = hits.rid JOIN b ON b.bid = hits.bid
), best AS (SELECT rid, bid, item_id, max(matched) AS matched, any_value(n_words) AS n_words FROM laid WHERE matched >= {MIN_WORDS} AND matched >= {SHARE} * n_words GROUP BY rid, bid, item_id),
per AS (SELECT rid, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items, max(matched / n_words) AS best FROM best GROUP BY rid)
SELECT d.doc_id, per.n IS NOT NULL AS contaminated, coalesce(per.n, 0) AS n_items, coalesce(per.items, '') AS items, coalesce(per.best, 0.0) AS best_share
FROM d LEFT JOIN per ON d.rid = per.rid
"""

QUERIES = {"op8_decontaminate": op8_decontaminate}
ORACLES = {"op8_decontaminate": SQL}
