"""Ranks and weights against plain loops."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitrine.llm import op11_importance as op11

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected(docs, items, percent=10, runs=1):
    def features(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = WORD.findall(lowered)
        grams = [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(g.encode()) % 10000 for g in grams]

    read = [(i, *features(t)) for i, t in docs]
    pool = Counter(k for _, _, ks in read for k in ks)
    target = Counter(k for t in items for k in features(t)[1])
    s, t = sum(pool.values()), sum(target.values())
    gain = lambda k: math.floor(1000 * math.log((target[k] + 1) * (s + 10000) / ((pool[k] + 1) * (t + 10000))))
    out = []
    for i, n, ks in read:
        weight = sum(map(gain, ks)) // len(ks) if ks else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(ks), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    ranks = {id(r): k for k, r in enumerate(able[: percent * len(able) // 100], 1)}
    return sorted(((r[0], r[2], r[3], r[4], ranks.get(id(r))) for r in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("percent, runs", [(10, 1), (60, 2), (100, 1)])
def test_odd_rows(session, odd, percent, runs):
    items = session.createDataFrame([(1, odd.filter("doc_id = 1").first()["text"][:200]), (2, None), (3, "")], "item_id long, text string")
    out = op11.resample(odd, items, percent=percent, runs=runs)
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got(out) == expected(docs, [r["text"] for r in items.collect()], percent, runs)


def test_whole_table(session, documents):
    items = session.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert got(op11.resample(documents, items, percent=50)) == expected(docs, [r["text"] for r in items.collect()], 50)


def test_empty_tables(session, documents, empty):
    assert op11.resample(empty, documents).collect() == []
    out = op11.resample(documents, empty.select("text"))
    assert out.count() == documents.count() and out.filter("rank IS NOT NULL").count() > 0


def test_ranks_run_over_segments_and_ties(session, monkeypatch):
    """Equal rows, far more than one segment, get ranks one by one."""
    monkeypatch.setattr(op11, "SEGMENT_ROWS", 100)
    monkeypatch.setattr(op11, "SAMPLES", 400)
    rows = session.range(0, 5000, 1, 7).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("id"), F.lit(1).cast("long").alias("n_features"), (F.col("id") % 3).alias("score"))
    out = op11.ranked(rows, "true", lambda n: n * 9 // 10).collect()
    drawn = sorted((r for r in out if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 4501)) and len(out) == 5000
    keys = [(-r["score"], r["id"] is None, r["id"] or 0) for r in drawn]
    assert keys == sorted((-r["score"], r["id"] is None, r["id"] or 0) for r in out)[:4500]


def test_splitters_part_ties():
    splitters = [(-5, 0, 1, 2, 0, 0), (-5, 0, 1, 2, 0, 9), (-5, 0, 1, 2, 3, 4), (0, 0, 0, 0, 0, 0)]
    import pandas as pd

    rows = pd.DataFrame([(-6, 0, 1, 2, 0, 0), (-5, 0, 1, 2, 0, 8), (-5, 0, 1, 2, 1, 0), (-5, 0, 2, 0, 0, 0), (0, 0, 0, 0, 0, 0), (3, 0, 0, 0, 0, 0)], columns=op11.ORDER)
    assert next(op11.segment_of(splitters)([rows]))["segment"].tolist() == [0, 1, 2, 3, 4, 4]
