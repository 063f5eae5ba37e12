"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated probabilities.

Every token bucket has a fixed sparse index vector of ones and minus ones.  A bucket's word vector is
the sum of the index vectors of its neighbours over the whole corpus: whole numbers, so that partial sums of
partitions add up alike in any order, and ``BUCKETS`` times ``DIMS`` of them, whatever the input.  A document is pooled as the mean, the
spread and the mean step of its tokens' vectors, with its length and variety.  A network of one hidden layer, written in
numpy, learns ``quality`` from at most ``TRAIN_ROWS`` labelled rows; a part of these is held back to fit the
temperature that its logits are divided by.

Rows whose crc32 of the id, as text, is 2 modulo 4 are never learnt from.  Labels, language, source and id are no inputs.

Defined cases: a null or empty text is pooled to zeros and scored; a null id is not held out and cannot be labelled; labels that
repeat for an id count as their mean, rounded; with no usable labels every score is 0.5; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import id_bucket, summed_blocks, block_schema, table, to_blocks
from vitrine.session import cut_lineage

BUCKETS, DIMS, NONZERO, WINDOW = 8192, 32, 4, 2
#: The bound of the training sample, taken by hash of the id.
TRAIN_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 32, 60, 256, 0.01, 1e-4, 7
INPUTS = 3 * DIMS + 3
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
NONE = BUCKETS  # a bucket between documents, with no vector


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero numbers of each bucket's index vector; those of ``NONE`` are zero."""
    rng = np.random.default_rng(SEED)
    places = rng.permuted(np.tile(np.arange(DIMS), (BUCKETS + 1, 1)), axis=1)[:, :NONZERO]
    signs = rng.choice([-1.0, 1.0], size=(BUCKETS + 1, NONZERO))
    signs[NONE] = 0
    return places, signs


class Buckets(dict):
    """Token to bucket; a word in capitals counts as a token of its kind."""

    def __missing__(self, token: str) -> int:
        kind = "^" if len(token) > 1 and token.isupper() else token
        bucket = zlib.crc32(kind.encode("utf-8", "replace")) % BUCKETS
        if len(self) < 500_000:
            self[token] = bucket
        return bucket


def token_buckets(texts: pd.Series, buckets: Buckets):
    """The buckets of each text."""
    for text in texts:
        found = TOKEN.findall(text) if isinstance(text, str) else ()
        yield np.fromiter((buckets[t] for t in found), dtype=np.int64, count=len(found))


def word_vectors(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """(BUCKETS + 1, DIMS) unit vectors of the whole corpus, less the direction that all share."""
    size = (BUCKETS + 1) * DIMS

    def gather(batches):
        places, signs = index_vectors()
        total, seen, buckets = np.zeros(size), np.zeros(BUCKETS + 1), Buckets()
        gap = np.full(WINDOW, NONE)
        for batch in batches:
            parts = [x for ids in token_buckets(batch["t"], buckets) for x in (ids, gap)]
            ids = np.concatenate(parts) if parts else gap
            for at in range(0, len(ids), 1 << 18):
                own = ids[max(at - WINDOW, 0) : at + (1 << 18)]
                skip = at - max(at - WINDOW, 0)
                seen += np.bincount(own[skip:], minlength=BUCKETS + 1)
                for step in range(1, WINDOW + 1):
                    # Pairs whose later token is in this stretch, each seen from both ends.
                    a, b = own[max(skip - step, 0) : len(own) - step], own[max(skip - step, 0) + step :]
                    for x, y in ((a, b), (b, a)):
                        for n in range(NONZERO):
                            total += np.bincount(x * DIMS + places[y, n], weights=signs[y, n], minlength=size)
        yield to_blocks(np.concatenate((total, seen)))

    flat = summed_blocks(df.select(F.col(text_col).alias("t")).mapInPandas(gather, block_schema()), size + BUCKETS + 1)
    vectors, seen = flat[:size].reshape(-1, DIMS), flat[size:]
    vectors[NONE] = seen[NONE] = 0
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9
    vectors -= (seen @ vectors) / max(seen.sum(), 1)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9
    return vectors.astype(np.float32)


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The inputs of the network for one document."""
    out = np.zeros(INPUTS, dtype=np.float32)
    n = len(ids)
    if not n:
        out[-1] = 1
        return out
    v = vectors[ids]
    out[:DIMS] = v.mean(axis=0)
    out[DIMS : 2 * DIMS] = v.std(axis=0)
    if n > 1:
        out[2 * DIMS : 3 * DIMS] = np.abs(v[1:] - v[:-1]).mean(axis=0)
    out[-3] = np.log1p(n)
    out[-2] = len(np.unique(ids)) / np.sqrt(n)
    return out


class Network:
    """Two layers: ``HIDDEN`` tanh units, one logit, divided by the temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.w1 = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN))
        self.b1, self.w2, self.b2 = np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), np.zeros(1)
        self.temperature = 1.0
        self._fit((x - self.mean) / self.scale, y, rng)

    def _fit(self, x: np.ndarray, y: np.ndarray, rng) -> None:
        weights = [self.w1, self.b1, self.w2, self.b2]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                xs, ys = x[order[at : at + BATCH]], y[order[at : at + BATCH]]
                h = np.tanh(xs @ self.w1 + self.b1)
                d = (1 / (1 + np.exp(-np.clip(h @ self.w2 + self.b2, -50, 50))) - ys) / len(ys)
                back = np.outer(d, self.w2) * (1 - h * h)
                grads = [xs.T @ back + DECAY * self.w1, back.sum(axis=0), h.T @ d + DECAY * self.w2, d.sum(keepdims=True)]
                step += 1
                for w, g, m, s in zip(weights, grads, first, second):
                    m *= 0.9
                    m += 0.1 * g
                    s *= 0.999
                    s += 0.001 * g * g
                    w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2[0]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature of least log loss on rows the weights were not fitted to."""
        z = self.logits(x)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 200))
        losses = [np.mean(np.logaddexp(0, np.where(y == 1, -z, z) / t)) for t in grid]
        self.temperature = float(grid[int(np.argmin(losses))])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def train(rows: DataFrame, labels: DataFrame, label_col: str, label_id: str = "doc_id") -> Network | None:
    """A network from rows (id, fold, inputs) that have a label; None if there are not both kinds."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("id")).agg(F.round(F.avg(label_col)).cast("int").alias("y"))
    usable = rows.filter((F.col("fold") != 2) & F.col("id").isNotNull()).join(known, "id").withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 30)))
    n = usable.count()
    sample = usable.filter(F.col("h") < int((1 << 30) * min(1.0, TRAIN_ROWS / max(n, 1)))).select("id", "h", "y", "inputs").toPandas()
    if sample["y"].nunique() < 2:
        return None
    sample = sample.sort_values(["h", "id"]).reset_index(drop=True)
    x, y = np.stack(sample["inputs"].to_numpy()).astype(np.float64), sample["y"].to_numpy(dtype=np.float64)
    held = (sample["h"].to_numpy() // 7) % 5 == 0
    if held.sum() < 20 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), dtype=bool)
    network = Network(x[~held], y[~held])
    if held.any() and len(set(y[held])) == 2:
        network.calibrate(x[held], y[held])
    return network


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.7) -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    shared = df.sparkSession.sparkContext.broadcast(word_vectors(df, text_col))

    def pool(texts: pd.Series) -> pd.Series:
        buckets, vectors = Buckets(), shared.value
        return pd.Series([pooled(ids, vectors) for ids in token_buckets(texts, buckets)])

    pool.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    rows = df.select(F.col(id_col).alias("id"), id_bucket(id_col, 4).alias("fold"), F.pandas_udf(pool, "array<float>")(F.col(text_col)).alias("inputs"))
    rows = cut_lineage(rows, "pooled")
    network = train(rows, labels, label_col)

    def score(inputs: pd.Series) -> pd.Series:
        if network is None or not len(inputs):
            return pd.Series(np.full(len(inputs), 0.5))
        return pd.Series(network.probability(np.stack(inputs.to_numpy()).astype(np.float64)))

    score.__annotations__ = {"inputs": pd.Series, "return": pd.Series}
    scored = rows.select(F.col("id").alias(id_col), (F.col("fold") == 2).alias("held_out"), F.pandas_udf(score, "double")("inputs").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op3_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op3_quality_classifier": op3_quality_classifier}
ORACLES: dict[str, str] = {}
