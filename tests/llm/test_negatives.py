"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import op12_negatives as op12


def expected(rows, k=5, m=5, low=80, every=100):
    """All pairs; ``rows`` are (id, vector, label)."""
    able = [(i, [max(-op12.LIMIT, min(op12.LIMIT, math.floor(256 * x))) for x in v], y) for i, v, y in rows if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    last = lambda i: (i is None, i or 0)
    out = []
    for n, (i, v, y) in enumerate(able):
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), last(j), j, z) for o, (j, w, z) in enumerate(able) if o != n]
        scored.sort(key=lambda r: r[:2])
        for p, _, j, _ in [r for r in scored if r[3] == y][:k]:
            window = [r for r in scored if r[3] != y and 80 * -p <= 100 * -r[0] <= 100 * -p][:m]
            out.extend((i, j, rank, r[2], -p, -r[0]) for rank, r in enumerate(window, 1))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SCHEMA = "vec_id long, embedding array<float>, label int, score double, `key` string, pos int"


def frame(session, rows):
    return session.createDataFrame([(i, v, y, 1.0, "x", 3) for i, v, y in rows], SCHEMA).repartition(3)


def test_odd_rows(session):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype("float32")], int(rng.integers(3))) for i in range(120)]
    same = [1.0, 0.5, 0.25, 0.0, 0.0, 0.125]
    rows += [(i, same, 1) for i in range(200, 420)] + [(i, same, 2) for i in range(500, 620)]  # a hot vector, in two labels
    rows += [(300, same, 1), (300, same, 1), (400, same, 0), (None, same, 2), (None, same, 1)]  # repeated rows and null ids
    rows += [(700, None, 1), (701, same, None), (702, [1.0, None], 1), (703, [float("nan")] * 6, 1), (704, [float("inf")], 1), (705, [], 1), (800, [], 1), (900, [1.0], 2), (1000, [0.0] * 6, 0)]
    rows += [(1100, [30000.0, 1.0], 1), (1101, [-3e38, 1.0], 2), (1200, same, 9)]  # very large; a label of its own
    out = op12.hard_negatives(frame(session, rows), F.col("id") % 100 == 0)
    assert got(out) == expected(rows)


def test_rounds_and_blocks(session, monkeypatch):
    """Small blocks, and thresholds that leave windows open, give the same rows."""
    monkeypatch.setattr(op12, "ROWS", 40)
    monkeypatch.setattr(op12, "ASKED", 3)
    monkeypatch.setattr(op12, "RUN", 3)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 10))
    rows = []
    for i in range(500):
        v = centres[i % 4] + rng.normal(size=10) * 0.4 * (i % 3)
        rows.append((i, [float(x) for x in (v / np.linalg.norm(v)).astype("float32")], int(i % 4 if i % 5 else rng.integers(4))))
    out = op12.hard_negatives(frame(session, rows), F.col("id") % 20 == 0, negatives=3, positives=4)
    assert got(out) == expected(rows, 4, 3, every=20)


def test_whole_table(session):
    df = session.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in df.collect()]
    assert got(op12.op12_hard_negatives(session, "/root/testdata/sf0.001")) == expected(rows)


def test_empty_table(session):
    assert op12.hard_negatives(frame(session, []), F.col("id") % 100 == 0).collect() == []


@pytest.mark.parametrize("threshold", [-np.inf, 0.0, 20.0, 60.0, 400.0])
def test_index_loses_no_pair(threshold):
    rng = np.random.default_rng(3)
    rows = np.floor(rng.normal(size=(300, 37)) * rng.integers(1, 9, size=37))
    queries = np.floor(rng.normal(size=(20, 37)) * 5)
    limits = np.full(20, threshold) + np.arange(20) % 3
    allowed = rng.random((20, 300)) < 0.7
    q, r, scores = op12.Index(rows, queries, float(limits.min())).above(limits, allowed)
    full = queries @ rows.T
    want = allowed & (full >= limits[:, None])
    assert set(zip(q.tolist(), r.tolist())) == set(zip(*map(list, np.nonzero(want)))) and np.array_equal(scores, full[q, r])


def test_index_leaves_out_covered_dimensions():
    rows = np.zeros((4, 40))
    rows[:, :3], rows[:, 39] = 1.0, 9.0
    index = op12.Index(rows, rows, 80.0)
    assert [len(listed) for listed, _ in index.lists][0] == 4
    far = op12.Index(rows, rows, 85.0)
    assert sum(len(listed) for listed, _ in far.lists) == 0 and far.above(np.full(4, 85.0), np.ones((4, 4), dtype=bool))[0].size == 0
