"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

Each source has a target share of the output.  Its repetition rate is that share of
the wanted output size over its own size (UTF-8 bytes plus one end mark a row).  A
row is repeated k times, where k is the inverse of the Poisson distribution with that
mean at a uniform number drawn from a hash of the seed and the row; so the same input
always gives the same mix, whatever the partitioning.  Copies are dealt out and sorted
by another hash, which is a global shuffle.

Rates over ``STEP`` are drawn as a sum of equal Poisson variables of at most
``STEP``, so the table of the distribution has a fixed length.

Defined cases: a null source is a source of its own; a null text counts as empty; rows
equal in id and text draw the same count; an empty table gives no rows; further columns
are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import fresh, table
from vitrine.session import cut_lineage

STEP, TERMS = 8.0, 64
SEED = "mix-1"


def hash_text(id_col: str, text_col: str) -> Column:
    """What identifies a row: its id and its text, as 32 hex digits."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit("")))))


def uniform(seed: str, row: Column, draw: Column) -> Column:
    """A number in [0, 1) with 52 bits from the hash of seed, row and draw."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), row, draw.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def rates(df: DataFrame, weights: dict | None, total: float | None, by: str, text_col: str) -> DataFrame:
    """Per source: size, rate, number of draws and the distribution of one draw.

    ``weights`` None asks for equal shares of all sources found; sources it does not name get none.
    ``total`` None asks for as much output as input.
    """
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 1
    sizes = cut_lineage(df.groupBy(F.col(by).alias("source_")).agg(F.sum(size).cast("double").alias("size_")), "sizes")
    sums = sizes.agg(F.sum("size_").alias("all_"), F.count("*").alias("n_")).first()
    if weights is None:
        share = F.lit(1.0 / max(sums["n_"], 1))
    else:
        scale = float(sum(weights.values()))
        share = F.lit(0.0)
        for name, weight in weights.items():
            share = F.when(F.col("source_").eqNullSafe(F.lit(name)), weight / scale).otherwise(share)
    rated = sizes.withColumn("rate", share * F.lit(float(total if total is not None else sums["all_"] or 0.0)) / F.col("size_"))
    rated = rated.withColumn("draws", F.greatest(F.ceil(F.col("rate") / STEP), F.lit(1)).cast("int"))
    mean = F.col("rate") / F.col("draws")
    # cdf[k] = P(X <= k) with X ~ Poisson(mean); terms past the last are below 2 ** -60.
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))

    def term(acc: Column, k: Column) -> Column:
        p = acc["p"] * F.col("mean") / k
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    rated = rated.withColumn("mean", mean).withColumn("cdf", F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(TERMS - 1)), lambda k: k.cast("double")), start, term)["cdf"])
    return cut_lineage(rated.select("source_", "rate", "draws", "cdf"), "rates")


def mix(df: DataFrame, weights: dict | None = None, total: float | None = None, by: str = "source", id_col: str = "doc_id", text_col: str = "text", seed: str = SEED, extra: bool = False) -> DataFrame:
    """``df`` with every row repeated by its Poisson count, in a random order over all partitions.

    With ``extra`` the columns ``copy`` (1, 2, ...), ``rate`` and ``place`` (the hash that orders the
    output) are added.
    """
    row, copy, place, rate = fresh(df, "row_key", "copy", "place", "rate")
    table_of = rates(df, weights, total, by, text_col)
    table_of = table_of.select(F.col("source_").alias(f"{row}_s"), F.col("rate").alias(rate), F.col("draws").alias(f"{row}_d"), F.col("cdf").alias(f"{row}_c"))
    # The table has a row for each source; Spark broadcasts it while its written size allows.
    joined = df.join(table_of, F.col(by).eqNullSafe(F.col(f"{row}_s"))).withColumn(row, hash_text(id_col, text_col))
    count = F.aggregate(
        F.sequence(F.lit(1), F.col(f"{row}_d")), F.lit(0),
        lambda n, draw: n + F.size(F.filter(F.col(f"{row}_c"), lambda c: c <= uniform(seed, F.col(row), draw))),
    )
    out = joined.withColumn(f"{row}_n", count).filter(F.col(f"{row}_n") > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(f"{row}_n"))))
    out = out.withColumn(place, F.md5(F.concat_ws("|", F.lit(seed), F.lit("place"), F.col(row), F.col(copy).cast("string"))))
    out = out.select(*[F.col(f"`{c}`") for c in df.columns], copy, rate, place)
    out = out.repartition(F.xxhash64(place)).sortWithinPartitions(place)
    return out if extra else out.select(*[F.col(f"`{c}`") for c in df.columns])


def op2_poisson_mix(spark, sf_dir: str) -> DataFrame:
    """All documents, every source with the same share of the output."""
    return mix(table(spark, sf_dir, "documents"), extra=True).select("doc_id", "text", "lang", "source", "copy", "place")


SQL = f"""
WITH docs AS (
  SELECT *, coalesce(strlen(text), 0) + 1 AS size_, md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))) AS row_key FROM documents
), sizes AS (SELECT source, CAST(sum(size_) AS DOUBLE) AS size_ FROM docs GROUP BY source),
rated AS (SELECT source, (1.0 / (SELECT count(*) FROM sizes)) * (SELECT sum(size_) FROM sizes) / size_ AS rate FROM sizes),
means AS (SELECT *, greatest(CAST(ceil(rate / {STEP}) AS INT), 1) AS draws FROM rated),
terms AS (SELECT source, k, exp(-rate / draws + CASE WHEN k = 0 THEN 0 ELSE k * ln(rate / draws) - lgamma(k + 1) END) AS p FROM means, range(0, {TERMS}) t(k)),
cdfs AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM terms),
drawn AS (
  SELECT d.rid, d.doc_id, d.text, d.lang, d.source, d.row_key, CAST(('0x' || substr(md5(concat_ws('|', '{SEED}', d.row_key, CAST(u.draw AS VARCHAR))), 1, 13)) AS BIGINT) / pow(2.0, 52) AS u
  FROM (SELECT docs.*, draws, row_number() OVER () AS rid FROM docs JOIN means ON docs.source IS NOT DISTINCT FROM means.source) d, LATERAL (SELECT unnest(range(1, d.draws + 1)) AS draw) u
), counted AS (
  SELECT doc_id, text, lang, source, row_key, CAST(sum((SELECT count(*) FROM cdfs WHERE cdfs.source IS NOT DISTINCT FROM drawn.source AND cdf <= u)) AS INT) AS n
  FROM drawn GROUP BY rid, doc_id, text, lang, source, row_key
)
SELECT doc_id, text, lang, source, CAST(copy AS INT) AS copy, md5(concat_ws('|', '{SEED}', 'place', row_key, CAST(copy AS VARCHAR))) AS place
FROM (SELECT *, unnest(range(1, n + 1)) AS copy FROM counted)
"""

QUERIES = {"op2_poisson_mix": op2_poisson_mix}
ORACLES = {"op2_poisson_mix": SQL}
