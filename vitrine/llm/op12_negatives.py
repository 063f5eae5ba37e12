"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds.

Components become whole numbers, ``floor(256 * x)``.  Rows of equal vector and label are a class, and only the smallest
ids of a class can be among the first few of any window, so a class keeps no more.  Classes are
packed in blocks of ``ROWS`` rows, the classes of the anchors in blocks of ``ASKED``.

A threshold join of a block of queries with a block of rows finds all pairs that score at least the query's threshold.
The rows' dimensions are put in descending order of energy.  A row's leading dimensions stay out of the index as long as the norm of that part,
times the largest norm any query has there, is below the lowest threshold: no pair gets there by them alone.  Posting lists stand for runs of
``RUN`` dimensions.  They are read from the last run to the first: partial scores accumulate, and a pair is dropped
once its partial score and the product of the norms that remain stay below the query's threshold.  What is left is scored in full.

Thresholds fall until windows fill.  A query's positives are done when as many rows as needed score above its
threshold; if not, the next round's threshold is lower, and the last one has none.  Then the windows of the negatives are known, one for
each positive score; a query is done when every window is full, or when its threshold has come
down to the lowest window's end.  Only queries that are not done take part in a round.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part; an empty vector scores 0 with all;
missing components of shorter vectors are 0; components are held within 2^22 either way, so scores are exact; a null id is no anchor and stands behind other ids in ties;
repeated rows are rows of their own; an anchor leaves out one row of its own id and score, itself; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import table
from vitrine.session import cut_lineage

#: Rows and queries of a block, dimensions of a posting list.
ROWS, ASKED, RUN = 4096, 512, 16
#: Falling thresholds: shares of the product of norms for positives, of the smallest positive score for negatives.
POSITIVE_STEPS, NEGATIVE_STEP = (0.5, 0.3, 0.15), 0.95
LIMIT, LAST = 1 << 22, np.iinfo(np.int64).max
#: Anchors of a class are dealt over so many keys.
SALTS = 16


def whole(scale: int):
    """Vectors as bytes of whole numbers."""

    def convert(vectors: pd.Series) -> pd.Series:
        out = []
        for v in vectors:
            x = np.clip(np.floor(scale * np.asarray(v, dtype=np.float64)), -LIMIT, LIMIT)
            out.append(x.astype("<i4").tobytes())
        return pd.Series(out, dtype=object)

    convert.__annotations__ = {"vectors": pd.Series, "return": pd.Series}
    return F.pandas_udf(convert, "binary")


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part."""
    finite = F.forall(F.col(vector_col), lambda x: F.coalesce(F.abs(x).cast("double") < float("inf"), F.lit(False)))
    rows = df.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole(scale)(vector_col).alias("v"))


def matrix(vectors, dims: int) -> np.ndarray:
    """Rows of whole numbers, as doubles; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), dims))
    for i, raw in enumerate(vectors):
        x = np.frombuffer(raw, dtype="<i4")
        out[i, : len(x)] = x
    return out


BLOCK = "block long, n int, dims int, most double, labels array<long>, of binary, ids binary, keys array<string>, vectors binary"


def packed(classes: DataFrame, size: int, per_class: int) -> DataFrame:
    """Blocks of ``size`` classes (key, label, v, ids): matrix, labels and ids, a row each."""

    def pack(batches):
        held: list[tuple] = []
        nth = 0

        def block(rows):
            nonlocal nth
            dims = max(len(r[2]) // 4 for r in rows)
            x = matrix([r[2] for r in rows], dims)
            labels = np.array([r[1] for r in rows], dtype=np.int64)
            ids = np.full((len(rows), per_class), LAST, dtype=np.int64)
            known = np.zeros(len(rows), dtype=np.int64)
            for i, r in enumerate(rows):
                own = np.frombuffer(r[3], dtype=">i8")
                ids[i, : len(own)], known[i] = own, len(own)
            name = (TaskContext.get().partitionId() << 32) + nth
            nth += 1
            most = float(np.sqrt((x * x).sum(axis=1).max()))
            return (name, len(rows), dims, most, np.unique(labels).tolist(), labels.tobytes(), np.column_stack((known, ids)).tobytes(), [r[0] for r in rows], x.astype("<i4").tobytes())

        columns = [c.split()[0] for c in BLOCK.split(", ")]
        for b in batches:
            held.extend(zip(b["key"], b["label"], b["v"], b["ids"]))
            while len(held) >= size:
                yield pd.DataFrame([block(held[:size])], columns=columns)
                held = held[size:]
        if held:
            yield pd.DataFrame([block(held)], columns=columns)

    return classes.select("key", "label", "v", "ids").mapInPandas(pack, BLOCK)


class Index:
    """Posting lists of a block of rows for pairs of at least ``threshold`` with queries of norms ``most`` by leading dimensions."""

    def __init__(self, rows: np.ndarray, queries: np.ndarray, threshold: float):
        self.order = np.argsort(-(rows * rows).sum(axis=0), kind="stable")
        self.rows, self.queries = rows[:, self.order], queries[:, self.order]
        dims = rows.shape[1]
        self.cuts = list(range(0, dims, RUN)) + [dims]
        self.row_norms = self._leading(self.rows)
        self.query_norms = self._leading(self.queries)
        most = self.query_norms.max(axis=0)
        self.lists = []
        for s in range(len(self.cuts) - 1):
            # A run is left out for a row as long as the norms up to its end stay below the threshold.
            listed = np.flatnonzero(self.row_norms[:, s + 1] * most[s + 1] * (1 + 1e-9) >= threshold)
            self.lists.append((listed, self.rows[listed, self.cuts[s] : self.cuts[s + 1]]))

    def _leading(self, x: np.ndarray) -> np.ndarray:
        """Norms of the dimensions before each cut."""
        squares = np.concatenate((np.zeros((len(x), 1)), np.cumsum(x * x, axis=1)), axis=1)
        return np.sqrt(squares[:, self.cuts])

    def above(self, thresholds: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the ``allowed`` pairs that score at least the query's threshold."""
        alive = allowed.copy()
        partial = np.zeros(alive.shape)
        bound = np.where(np.isfinite(thresholds), thresholds - np.abs(thresholds) * 1e-9 - 1e-6, -np.inf)[:, None]
        pending = np.full(len(self.rows), len(self.lists))  # runs before this one are not in a row's partial scores
        for s in range(len(self.lists) - 1, -1, -1):
            listed, values = self.lists[s]
            x = self.queries[:, self.cuts[s] : self.cuts[s + 1]]
            if len(listed) == len(self.rows):
                partial += x @ values.T
            elif len(listed):
                partial[:, listed] += x @ values.T
            pending[listed] = s
            remaining = self.query_norms[:, pending] * self.row_norms[np.arange(len(self.rows)), pending]
            alive &= partial + remaining * (1 + 1e-9) >= bound
        q, r = np.nonzero(alive)
        if len(q) * 4 > alive.size:
            scores = (self.queries @ self.rows.T)[q, r]
        else:
            parts = [np.einsum("ij,ij->i", self.queries[q[a : a + 65536]], self.rows[r[a : a + 65536]]) for a in range(0, len(q), 65536)]
            scores = np.concatenate([np.zeros(0), *parts])
        good = scores >= thresholds[q]
        return q[good], r[good], scores[good]


def by_query(q: np.ndarray, r: np.ndarray, scores: np.ndarray, ids: np.ndarray):
    """(query, scores, rows) of each query's hits: higher scores first, then smaller first ids."""
    order = np.lexsort((ids[r, 1], -scores, q))
    q, r, scores = q[order], r[order], scores[order].astype(np.int64)
    cuts = np.flatnonzero(np.diff(q)) + 1
    for start, stop in zip((0, *cuts), (*cuts, len(q))):
        if stop > start:
            yield int(q[start]), scores[start:stop], r[start:stop]


def expanded(scores: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int | None]]:
    """The first ``k`` rows (score, id) of the classes ``rows``; the first ``k`` classes hold them."""
    found = []
    for score, row in zip(scores[:k].tolist(), rows[:k].tolist()):
        found.extend((-score, i) for i in ids[row, 1 : 1 + ids[row, 0]].tolist())
    return [(-score, None if i == LAST else i) for score, i in sorted(found)[:k]]


HITS = "qb long, pos int, `window` long, score long, id long"


def joined(query_blocks: DataFrame, state: DataFrame, row_blocks: DataFrame, slots: int, keep: int, same: bool, low: int) -> DataFrame:
    """The first ``keep`` hits of each open query in each block of rows: of its own label, or of others in each of its windows.

    ``state`` has (qb, pos, threshold, windows) of the open queries.  Each query block is dealt to every slot, and each row block lies in one.
    """
    open_blocks = state.groupBy("qb").agg(F.collect_list(F.struct("pos", "threshold", "windows")).alias("open"), F.min("threshold").alias("lowest"))
    left = query_blocks.select(F.col("block").alias("qb"), F.col("n").alias("qn"), F.col("dims").alias("qd"), F.col("most").alias("q_most"), F.col("labels").alias("q_labels"), F.col("of").alias("q_of"), F.col("vectors").alias("qv"))
    left = left.join(open_blocks, "qb").withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).repartition(slots, "slot")
    right = row_blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int")).repartition(slots, "slot")
    fits = (left["slot"] == right["slot"]) & (left["q_most"] * right["most"] * (1 + 1e-9) + 1 >= left["lowest"])
    if same:
        fits &= F.arrays_overlap("q_labels", "labels")
    pairs = right.join(left, fits).select("n", "dims", "of", "ids", "vectors", "qb", "qn", "qd", "q_of", "qv", F.to_json("open").alias("open"))

    def search(batches):
        import json

        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                opened = sorted(json.loads(row.open), key=lambda o: o["pos"])
                at = np.array([o["pos"] for o in opened])
                thresholds = np.array([float(o.get("threshold", "-inf")) for o in opened])
                dims = max(row.dims, row.qd, 1)
                x, y = np.zeros((len(at), dims)), np.zeros((row.n, dims))
                x[:, : row.qd] = np.frombuffer(row.qv, dtype="<i4").reshape(row.qn, row.qd)[at]
                y[:, : row.dims] = np.frombuffer(row.vectors, dtype="<i4").reshape(row.n, row.dims)
                ids = np.frombuffer(row.ids, dtype=np.int64).reshape(row.n, -1)
                equal = np.frombuffer(row.q_of, dtype=np.int64)[at][:, None] == np.frombuffer(row.of, dtype=np.int64)[None, :]
                allowed = equal if same else ~equal
                if not allowed.any():
                    continue
                hits = Index(y, x, float(thresholds.min())).above(thresholds, allowed)
                for q, scores, rows in by_query(*hits, ids):
                    head = (row.qb, int(at[q]))
                    if same:
                        out.extend((*head, 0, *hit) for hit in expanded(scores, rows, ids, keep))
                        continue
                    for most in opened[q]["windows"]:
                        inside = (scores <= most) & (100 * scores >= low * most)
                        if inside.any():
                            out.extend((*head, most, *hit) for hit in expanded(scores[inside], rows[inside], ids, keep))
            frame = pd.DataFrame(out, columns=["qb", "pos", "window", "score", "id"])
            yield frame.assign(id=frame["id"].astype("Int64"))

    found = pairs.mapInPandas(search, HITS)
    nth = F.row_number().over(Window.partitionBy("qb", "pos", "window").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))
    return found.withColumn("nth", nth).filter(F.col("nth") <= keep)


def filled(steps, state_of, join, full) -> DataFrame:
    """Hits of all queries by rounds of falling thresholds: ``state_of(left, step)`` opens queries, ``full(hits)`` names those that are done.

    After the last step all are done.
    """
    parts, left = [], None
    for step in steps:
        state = cut_lineage(state_of(step) if left is None else state_of(step).join(left, ["qb", "pos"], "left_semi"), "open")
        hits = cut_lineage(join(state), "hits")
        if step == steps[-1]:
            parts.append(hits)
            break
        done = cut_lineage(full(state, hits), "done")
        parts.append(hits.join(done, ["qb", "pos"], "left_semi"))
        left = cut_lineage(state.select("qb", "pos").join(done, ["qb", "pos"], "left_anti"), "left")
        if left.isEmpty():
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def hard_negatives(
    df: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 5, low: int = 80, scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` is a condition on ``id``.  Negatives score at least ``low`` hundredths of their positive's score, and at most that score.
    """
    keep, per_class = positives + 1, max(positives + 1, negatives)
    rows = usable(df, id_col, vector_col, label_col, scale).withColumn("key", F.md5(F.concat(F.col("v"), F.col("label").cast("string").cast("binary"))))
    rows = cut_lineage(rows, "vectors")
    firsts = Window.partitionBy("key", "label", "v").orderBy(F.col("id").asc_nulls_last())
    few = rows.withColumn("nth", F.row_number().over(firsts)).filter(F.col("nth") <= per_class)
    listed = F.sort_array(F.collect_list(F.coalesce("id", F.lit(int(LAST)))))
    flat = F.unhex(F.array_join(F.transform(listed, lambda i: F.lpad(F.hex(i), 16, "0")), ""))
    classes = few.groupBy("key", "label", "v").agg(flat.alias("ids"))
    anchors = rows.filter(anchor).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    asked = anchors.groupBy("key", "label", "v").agg(F.lit(bytearray(8)).alias("ids"))
    row_blocks = cut_lineage(packed(classes.repartitionByRange("label", "key").sortWithinPartitions("label", "key"), ROWS, per_class), "row_blocks")
    query_blocks = cut_lineage(packed(asked.repartitionByRange("label", "key").sortWithinPartitions("label", "key"), ASKED, 1), "query_blocks")
    blocks, most = row_blocks.agg(F.count("*"), F.max("most")).first()
    slots = max(df.sparkSession.sparkContext.defaultParallelism, 2 * blocks)

    @F.pandas_udf("array<long>")
    def own_scores(dims: pd.Series, vectors: pd.Series) -> pd.Series:
        return pd.Series([(np.frombuffer(v, dtype="<i4").astype(np.int64).reshape(-1, d) ** 2).sum(axis=1) if d else np.zeros(1, dtype=np.int64) for d, v in zip(dims, vectors)])

    queries = query_blocks.select(F.col("block").alias("qb"), F.posexplode(F.arrays_zip("keys", own_scores("dims", "vectors").alias("own"))).alias("pos", "z"))
    queries = cut_lineage(queries.select("qb", "pos", F.col("z.keys").alias("key"), F.col("z.own").alias("own")), "queries")

    none = F.lit(float("-inf"))

    def opened(share):
        threshold = none if share is None else F.sqrt("own") * F.lit(share * (most or 0.0))
        return queries.select("qb", "pos", threshold.alias("threshold"), F.array().cast("array<long>").alias("windows"))

    def enough(state, hits):
        return hits.groupBy("qb", "pos").count().filter(F.col("count") >= keep).select("qb", "pos")

    near = filled((*POSITIVE_STEPS, None), opened, lambda state: joined(query_blocks, state, row_blocks, slots, keep, True, low), enough)
    near = near.groupBy("qb", "pos").agg(F.transform(F.sort_array(F.collect_list(F.struct("nth", "score", "id"))), lambda h: F.struct(h["score"].alias("score"), h["id"].alias("id"))).alias("near"))
    near = cut_lineage(near, "positives")

    ends = near.select("qb", "pos", F.filter(F.array_distinct(F.col("near.score")), lambda p: p >= 0).alias("windows")).filter("size(windows) > 0")
    ends = ends.withColumn("end", F.array_min("windows"))

    def opened_windows(share):
        lowest = F.col("end") * F.lit(low / 100) - 1 if share is None else F.col("end") * F.lit(share)
        return ends.select("qb", "pos", lowest.cast("double").alias("threshold"), "windows")

    def all_full(state, hits):
        full = hits.groupBy("qb", "pos", "window").count().filter(F.col("count") >= negatives).groupBy("qb", "pos").agg(F.count("*").alias("full"))
        return state.join(full, ["qb", "pos"]).filter(F.col("full") == F.size("windows")).select("qb", "pos")

    far = filled((NEGATIVE_STEP, None), opened_windows, lambda state: joined(query_blocks, state, row_blocks, slots, negatives, False, low), all_full)
    far = far.groupBy("qb", "pos").agg(F.sort_array(F.collect_list(F.struct("window", "nth", "score", "id"))).alias("far"))
    answers = cut_lineage(queries.join(near, ["qb", "pos"]).join(far, ["qb", "pos"]), "answers")

    # A class may stand for many anchors, so its answers go to every salt it has anchors under.
    dealt = anchors.select("key", "salt").distinct().join(answers, "key")
    each = anchors.select("id", "key", "salt").join(dealt, ["key", "salt"])
    itself = F.array_position(F.transform("near", lambda h: (h["score"] == F.col("own")) & h["id"].eqNullSafe(F.col("id"))), True)
    each = each.withColumn("itself", F.coalesce(itself, F.lit(0)))
    others = F.slice(F.filter("near", lambda h, i: i + 1 != F.col("itself")), 1, positives)
    each = each.select("id", "far", F.explode(others).alias("p"))
    each = each.select("id", "p", F.explode(F.filter("far", lambda h: h["window"] == F.col("p.score"))).alias("n"))
    return each.select(
        F.col("id").alias("anchor_id"), F.col("p.id").alias("positive_id"), F.col("n.nth").cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score"),
    )


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", changed.alias("label")), F.col("id") % 100 == 0)


QUERIES = {"op12_hard_negatives": op12_hard_negatives}

_SQL = """
WITH rows AS (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.n AS an, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.n <> b.n WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY an ORDER BY score DESC, id) AS p FROM pairs WHERE same QUALIFY p <= 5),
windows AS (
  SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, q.id AS negative_id, q.score AS negative_score,
         row_number() OVER (PARTITION BY p.an, p.p ORDER BY q.score DESC, q.id) AS rank
  FROM positives p JOIN pairs q ON p.an = q.an AND NOT q.same AND 80 * p.score <= 100 * q.score AND q.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 5
"""
ORACLES = {"op12_hard_negatives": _SQL}
