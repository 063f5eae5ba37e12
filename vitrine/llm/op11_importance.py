"""Importance resampling towards a target distribution, ranked by parallel sorting with regular samples.

Weights.  A text's features are its runs of 1 to ``runs`` consecutive words, hashed to ``BUCKETS`` buckets.  Both
corpora are counted whole, as sums of arrays; the gain of a bucket is the log ratio of its smoothed shares in the target
and in the pool, in thousandths, and all gains are one array of ``BUCKETS`` numbers.  A document's weight is the
floored mean of the gains at its features' places.  Its score adds Gumbel noise drawn from a hash of its id, so the highest
scores are a sample without replacement by weight.

Ranks.  Each task sorts its own documents: a run.  Every run gives regular samples, at most ``SAMPLES`` in all and
one a run besides; the sorted samples give splitters.  A row's segment is told by the splitters, segments that reach into the
draw are exchanged and merged, each in a task of its own, and prefix counts of segments turn places within them into
exact ranks.  Splitters end in run and place, so any number of ties is split too.  Only segments that the draw reaches move.

Defined cases: a null or empty text has no features and weight 0; a null id is hashed as the empty text and stands
behind other ids in ties; repeated rows are scored, counted and ranked one by one (same id and score: fewer features first);
with an empty pool there are no rows; with an empty target all of it is smoothing; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import block_schema, encoded, summed_blocks, table, to_blocks
from vitrine.session import cut_lineage

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 10, "2024"
#: Regular samples of all runs together; rows of a segment.
SAMPLES, SEGMENT_ROWS = 1 << 16, 500_000
#: Bytes of words as they are, A-Z lowered, all others a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def hashed(raw: bytes, runs: int, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words of a text, and the bucket of each of its features."""
    words = raw.translate(_WORDS).split()
    features = words
    for n in range(2, runs + 1):
        features = features + [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return len(words), np.fromiter(map(zlib.crc32, features), dtype=np.uint32, count=len(features)) % np.uint32(buckets)


def bucket_counts(texts: DataFrame, text_col: str, runs: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; an array a task is all that is summed."""

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            places = [hashed(raw, runs, buckets)[1] for raw in encoded(batch["t"])]
            total += np.bincount(np.concatenate(places), minlength=buckets) if places else 0
        yield to_blocks(total)

    return summed_blocks(texts.select(F.col(text_col).alias("t")).mapInPandas(count, block_schema()), buckets).astype(np.int64)


def gains(pool: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, floored."""
    of_pool, of_target = int(pool.sum()) + len(pool), int(target.sum()) + len(target)
    return np.floor(1000 * np.log((target + 1) * of_pool / ((pool + 1) * of_target))).astype(np.int64)


def scored(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, runs: int, seed: str) -> DataFrame:
    """id, n_words, n_features, weight and score of every row of ``docs``."""

    def weigh(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for raw in encoded(texts):
            n, places = hashed(raw, runs, len(gain))
            rows.append((n, len(places), int(gain[places].sum()) // len(places) if len(places) else 0))
        return pd.DataFrame(rows, columns=["n_words", "n_features", "weight"])

    weigh.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    out = docs.select(F.col(id_col).alias("id"), F.pandas_udf(weigh, "n_words long, n_features long, weight long")(F.col(text_col)).alias("w")).select("id", "w.*")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    return out.withColumn("score", F.col("weight") + noise)


#: The order of ranks; what follows the id only parts rows of equal id and score.
ORDER = ("minus", "none", "tie", "n_features", "run", "place")


def segment_of(splitters: list[tuple]):
    """A column function: how many splitters stand at or before a row's key."""
    firsts = np.array([s[0] for s in splitters], dtype=np.int64)

    def segments(batches):
        for b in batches:
            minus = b["minus"].to_numpy(dtype=np.int64)
            low, high = np.searchsorted(firsts, minus, "left"), np.searchsorted(firsts, minus, "right")
            for i in np.flatnonzero(low < high):
                key = (int(minus[i]), *(int(b[c].iat[i]) for c in ORDER[1:]))
                low[i] = bisect_right(splitters, key, int(low[i]), int(high[i]))
            yield b.assign(segment=low.astype(np.int32))

    return segments


def ranked(rows: DataFrame, eligible: str, draw_of) -> DataFrame:
    """``rows`` (id, n_features, score, …) with ``rank``: 1, 2, 3 … by score among the eligible, null past ``draw_of(number of eligible)``."""
    spark = rows.sparkSession
    names = rows.columns
    local = rows.withColumn("ok", F.expr(eligible)).withColumn("minus", -F.col("score")).withColumn("none", F.col("id").isNull().cast("int"))
    local = local.withColumn("tie", F.coalesce(F.col("id").cast("long"), F.lit(0)))
    local = local.sortWithinPartitions(F.col("ok").desc(), "minus", "none", "tie", "n_features").withColumn("at", F.monotonically_increasing_id())
    local = local.withColumn("run", F.shiftright("at", 33)).withColumn("place", F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("at")
    local = cut_lineage(local, "runs")

    total = local.filter("ok").count()
    draw = draw_of(total)
    step = max(1, -(-total // SAMPLES))
    chosen = local.filter(F.col("ok") & (F.pmod(F.col("place") - F.xxhash64("run"), F.lit(step)) == 0))
    sample = sorted(tuple(r) for r in chosen.select(*ORDER).collect())
    parts = max(1, min(len(sample), max(spark.sparkContext.defaultParallelism, total // SEGMENT_ROWS)))
    splitters = [sample[len(sample) * k // parts] for k in range(1, parts)]

    runs = local.filter("ok")
    fields = ", ".join(f"`{n}` {t}" for n, t in local.dtypes)
    dealt = cut_lineage(runs.mapInPandas(segment_of(splitters), f"{fields}, segment int"), "segments") if splitters else runs.withColumn("segment", F.lit(0))
    counts = {r["segment"]: r["count"] for r in dealt.groupBy("segment").count().collect()}
    before, bases = 0, []
    for segment in sorted(counts):
        bases.append((segment, before))
        before += counts[segment]
    last = max((s for s, base in bases if base < draw), default=-1)
    if last < 0:
        return local.select(*names, F.lit(None).cast("long").alias("rank"))
    moved = dealt.filter(F.col("segment") <= last).join(F.broadcast(spark.createDataFrame(bases, "segment int, base long")), "segment")
    place = F.col("base") + F.row_number().over(Window.partitionBy("segment").orderBy(*ORDER))
    drawn = moved.withColumn("rank", place).withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    still = dealt.filter(F.col("segment") > last).select(*names).union(local.filter("NOT ok").select(*names))
    return drawn.select(*names, "rank").union(still.withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    runs: int = 1, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED,
) -> DataFrame:
    """Every document's n_features, weight, score and rank; ``percent`` of those with ``min_words`` words are drawn."""
    gain = gains(bucket_counts(docs, text_col, runs, buckets), bucket_counts(target, target_col, runs, buckets))
    rows = scored(docs, gain, id_col, text_col, runs, seed)
    out = ranked(rows, f"n_words >= {min_words}", lambda n: percent * n // 100)
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


def op11_importance(spark, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op11_importance": op11_importance}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: crc32 by its table of 256 steps; floor division keeps to whole numbers.
_SQL = f"""
WITH steps AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
docs AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS words FROM documents),
items AS (SELECT regexp_extract_all({_LOWER}, '{_WORD}') AS words FROM benchmark),
d AS (SELECT n, unnest(words) AS w FROM docs),
b AS (SELECT unnest(words) AS w FROM items),
vocabulary AS (SELECT DISTINCT w, hex(encode(w)) AS x FROM (SELECT w FROM d UNION ALL SELECT w FROM b)),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
                            lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) % {BUCKETS} AS k
  FROM vocabulary, steps),
pool AS (SELECT k, count(*) AS s FROM d JOIN hashed USING (w) GROUP BY k),
target AS (SELECT k, count(*) AS t FROM b JOIN hashed USING (w) GROUP BY k),
sizes AS (SELECT (SELECT coalesce(sum(s), 0) FROM pool)::BIGINT AS ss, (SELECT coalesce(sum(t), 0) FROM target)::BIGINT AS tt),
gain AS (
  SELECT k, floor(1000 * ln(((coalesce(t, 0) + 1) * (ss + {BUCKETS}))::DOUBLE / ((coalesce(s, 0) + 1) * (tt + {BUCKETS}))::DOUBLE))::BIGINT AS g
  FROM pool FULL JOIN target USING (k), sizes),
means AS (SELECT n, count(*) AS m, sum(g)::BIGINT AS g FROM d JOIN hashed USING (w) JOIN gain USING (k) GROUP BY n),
weighed AS (
  SELECT n, doc_id, len(words) AS n_features, coalesce((g - ((g % m) + m) % m) // m, 0)::BIGINT AS weight,
         ('0x' || substr(sha256(concat('{SEED}:', doc_id)), 1, 8))::BIGINT AS h
  FROM docs LEFT JOIN means USING (n)),
scores AS (SELECT n, doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM weighed),
places AS (SELECT n, row_number() OVER (ORDER BY score DESC, doc_id, n_features) AS r, count(*) OVER () AS total FROM scores WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN r <= {PERCENT} * total // 100 THEN r END AS rank
FROM scores LEFT JOIN places USING (n)
"""
ORACLES = {"op11_importance": _SQL}
