"""Operators 2, 7 and 8 and the pipeline beside brute force and SQL."""

import math
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import pytest

import corpus_pipeline
from vitrine.llm import op2_mixing, op7_minhash, op8_decontaminate
from vitrine.llm.common import components


def sql(query, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        columns = ", ".join(f'"{c}" {"BIGINT" if t == "bigint" else "VARCHAR"}' for c, t in frame.dtypes)
        con.execute(f"CREATE TABLE {name} ({columns})")
        rows = [tuple(r) for r in frame.collect()]
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(frame.columns))})", rows)
    result = con.execute(query)
    names = [d[0] for d in result.description]
    return Counter(tuple(sorted(dict(zip(names, r)).items(), key=lambda x: x[0])) for r in result.fetchall())


def ours(frame):
    return Counter(tuple(sorted(r.asDict().items())) for r in frame.collect())


def test_mixing_agrees_with_sql(odd):
    frame = odd.select("doc_id", "text", "lang", "source")
    got = op2_mixing.mix(frame, extra=True).select("doc_id", "text", "lang", "source", "copy", "place")
    assert ours(got) == sql(op2_mixing.SQL, documents=frame)


def test_mixing_meets_its_targets(session):
    rows = [(i, "word " * 20, "en", "big" if i % 3 else f"s{i % 2}") for i in range(6000)]
    frame = session.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = Counter(r.source for r in op2_mixing.mix(frame, {"big": 1, "s0": 1, "s1": 2}).collect())
    for name, share in (("big", 0.25), ("s0", 0.25), ("s1", 0.5)):
        assert abs(got[name] - 6000 * share) < 5 * math.sqrt(6000 * share) + 1
    high = op2_mixing.mix(frame.filter("source = 's0'"), None, total=101 * 1000 * 30, extra=True)
    assert abs(high.count() - 30_000) < 5 * math.sqrt(30_000) and abs(high.first()["rate"] - 30) < 1e-9


def test_mixing_is_the_same_for_any_partitioning(odd, empty):
    a, b = op2_mixing.mix(odd, extra=True), op2_mixing.mix(odd.repartition(7), extra=True)
    assert ours(a) == ours(b)
    assert op2_mixing.mix(odd).columns == odd.columns and op2_mixing.mix(empty).count() == 0


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def clusters(rows, percent):
    """Root row number of each row, over all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    shared = Counter()
    for members in where.values():
        for pair in combinations(members, 2):
            shared[pair] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(rows))], [len(s) for s in sets]


def edited(seed, copies):
    """Chains and stars of edited copies: links join copies that their original does not reach."""
    import random

    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for group in range(12):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(5, 200))]
        for _ in range(copies):
            rows.append(" ".join(text))
            if group % 2:
                text = list(text)
            for _ in range(max(1, len(text) // 60)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
    return [(i, t) for i, t in enumerate(rng.sample(rows, len(rows)))]


@pytest.mark.parametrize("percent", [80, 85])
def test_minhash_finds_all_components(session, odd, percent):
    rows = edited(percent, 12) + [(1000 + i, t) for i, t in enumerate(r.text for r in odd.collect())]
    frame = session.createDataFrame(rows, "doc_id long, text string")
    root, sizes = clusters(rows, percent)
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min(i, least.get(r, i))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op7_minhash.clustered(frame, percent=percent).collect()}
    assert got == {i: (n, least[r]) for (i, _), r, n in zip(rows, root, sizes)}


@pytest.mark.parametrize("changes, percent", [(3, 85), (1, 85), (2, 80)])
def test_minhash_one_group_of_loose_copies(session, changes, percent):
    """Two thousand copies of a text, each with some words changed: no pair is lost, links or none."""
    import random

    rng = random.Random(changes)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(2000):
        text = list(base)
        for _ in range(changes + i % 3):
            text[rng.randrange(120)] = rng.choice(vocabulary)
        rows.append((i, " ".join(text)))
    number: dict = {}
    sets = [sum(1 << number.setdefault(x, len(number)) for x in shingles(t)) for _, t in rows]
    sizes = [s.bit_count() for s in sets]
    parent = list(range(2000))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(2000), 2):
        n = (sets[a] & sets[b]).bit_count()
        if 100 * n >= percent * (sizes[a] + sizes[b] - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    frame = session.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in op7_minhash.clustered(frame, percent=percent).collect()}
    assert got == {i: find(i) for i in range(2000)}


def test_intersections_are_those_of_sets():
    import random

    import numpy as np

    rng = random.Random(1)
    sets = [set(rng.sample(range(60), rng.randint(0, 30))) for _ in range(25)] + [set()]
    left, right = np.arange(0, 26, 2), np.arange(26)
    got = op7_minhash.intersections(sets, left, right, columns=7)
    assert [[x for b, x in zip(right, row) if b != a] for a, row in zip(left, got.tolist())] == [[len(sets[a] & sets[b]) for b in right if b != a] for a in left]


def test_minhash_odd_rows(odd, empty):
    got = op7_minhash.clustered(odd).collect()
    assert len(got) == odd.count()
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add(r.component_id)
    assert by_id[1] == by_id[2] == by_id[3] == by_id[4] == {1} and by_id[9] == {8} and by_id[5] == {5} and by_id[6] == {6}
    kept = op7_minhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and not {2, 3, 4, 9} & set(ids) and ids[5] == ids[6] == ids[7] == 1 and ids[8] == 2 and ids[None] == 2
    assert op7_minhash.clustered(empty).count() == 0 and op7_minhash.keep_one(empty).count() == 0


def test_signatures_estimate_similarity():
    import random

    rng = random.Random(5)
    for share in (0.2, 0.5, 0.85):
        common = {rng.randbytes(8) for _ in range(int(2000 * share))}
        a, b = (common | {rng.randbytes(8) for _ in range((2000 - len(common)) // 2)} for _ in range(2))
        estimate = (op7_minhash.signature(a) == op7_minhash.signature(b)).mean()
        assert abs(estimate - len(a & b) / len(a | b)) < 0.12


def test_components(session):
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 130)] + [(200, 201), (201, 200), (5, 5)]
    got = {r.node: r.root for r in components(session.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}
    assert components(session.createDataFrame([], "a long, b long")).count() == 0


def passages(session, odd):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()
    changed = [w if i % 6 else "other" for i, w in enumerate(item)]
    texts = ["before " * 30 + " ".join(item) + " after", "x " + ", ".join(w.upper() for w in item), "some " + " ".join(changed) + " text", " ".join(item[:6]) + " and then nothing else", "alpha beta gamma " * 20, " ".join(item[4:]), " ".join(item * 3)]
    docs = odd.select("doc_id", "text").union(session.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    items = session.createDataFrame([(1, " ".join(item)), (2, " ".join(item)), (3, "too short"), (None, "null item " * 6), (5, None), (6, ""), (7, "a a a a a a a a a a a a")], "item_id long, text string")
    return docs, items


def test_decontamination_agrees_with_sql(session, odd):
    docs, items = passages(session, odd)
    assert ours(op8_decontaminate.contamination(docs, items)) == sql(op8_decontaminate.SQL, documents=docs, benchmark=items)
    found = {r.doc_id: r["items"] for r in op8_decontaminate.contamination(docs, items).collect()}
    assert found[100] == found[101] == found[102] == found[105] == found[106] == "1,2" and found[103] == found[104] == ""


def test_decontamination_beyond_the_broadcast(session, odd, monkeypatch):
    docs, items = passages(session, odd)
    want = ours(op8_decontaminate.contamination(docs, items))
    monkeypatch.setattr(op8_decontaminate, "BROADCAST_ROWS", 0)
    assert ours(op8_decontaminate.contamination(docs, items)) == want


def on_diagonals(doc, item):
    """Most words of ``item`` that stand at their places, over all places in ``doc``."""
    return max((sum(0 <= s + i < len(doc) and doc[s + i] == w for i, w in enumerate(item)) for s in range(1 - len(item), len(doc))), default=0)


def test_decontamination_finds_what_all_diagonals_find(session):
    """Items with a tenth to six tenths of their words replaced, at random or evenly, and with the matches as far apart as they can be."""
    import random

    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [[rng.choice(vocabulary) for _ in range(n)] for n in (8, 12, 15, 16, 20, 24, 38, 59)]
    docs = []
    for item in items:
        for rate in (0.1, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6):
            for _ in range(4):
                lost = set(rng.sample(range(len(item)), int(rate * len(item))))
                docs.append(["a", "b"] + [f"x{rng.randrange(10**9)}" if i in lost else w for i, w in enumerate(item)] + ["c"])
        for every in (2, 3, 4):
            docs.append([w if i % every else "other" for i, w in enumerate(item)])
        docs.append([w if i % 2 == 0 else "other" for i, w in enumerate(item)])
        docs.append([w if i % 4 < 2 else "other" for i, w in enumerate(item)])
        docs.append(item[len(item) // 2 :] + ["end"])
        docs.append(["start"] + item[: -(-len(item) // 2)])
    frame = session.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    benchmark = session.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    want = {}
    for d, doc in enumerate(docs):
        best = {i: on_diagonals(doc, t) for i, t in enumerate(items)}
        want[d] = ",".join(str(i) for i, m in best.items() if m >= 8 and 2 * m >= len(items[i]))
    assert {r.doc_id: r["items"] for r in op8_decontaminate.contamination(frame, benchmark).collect()} == want
    assert sum(map(bool, want.values())) > 100


def test_decontamination_empty_and_columns(session, odd, empty):
    _, items = passages(session, odd)
    assert op8_decontaminate.contamination(empty, items).count() == 0
    assert not any(r.contaminated for r in op8_decontaminate.contamination(odd, items.filter("false")).collect())
    out = op8_decontaminate.clean(odd, items)
    assert out.columns == odd.columns and out.count() == odd.count()


def test_pipeline_stages(session):
    sf = "/root/testdata/sf0.001"
    docs = session.read.parquet(f"{sf}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "token_files"]
    kept = corpus_pipeline.quality(session, docs, sf)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    single = corpus_pipeline.near_dedup(session, kept, sf)
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    root, _ = clusters(rows, 80)
    assert sorted(r.doc_id for r in single.collect()) == sorted(rows[i][0] for i in set(root))
    clean = corpus_pipeline.decontaminate(session, single, sf)
    judged = op8_decontaminate.contamination(single, session.read.parquet(f"{sf}/benchmark.parquet"))
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in judged.filter("NOT contaminated").collect())
    mixed = corpus_pipeline.mix(session, clean, sf)
    assert mixed.columns == docs.columns
    files = corpus_pipeline.token_files(session, mixed, sf)
    assert Counter(r.doc_id for r in files.collect()) == Counter(r.doc_id for r in mixed.collect())


def run_on(session, tmp_path, frame):
    """Each stage's output over ``frame``, written and read as the pipeline does."""
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    session.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, out = session.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(session, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = session.read.parquet(f"{tmp_path}/{name}")
        out.append(docs)
    return out


def test_pipeline_takes_odd_rows(session, odd, documents, tmp_path):
    """Nulls, empty and very long texts, repeated rows and columns of clashing names pass all stages."""
    plain = documents.selectExpr("doc_id + 10000 AS doc_id", "text", "lang", "source", "n_chars", "'x' AS `key`", "1.0D AS score", "true AS kept", "5 AS slot")
    *stages, last = run_on(session, tmp_path, odd.union(plain))
    before = odd.union(plain)
    for docs in stages:
        assert docs.columns == odd.columns
    kept, deduped, clean, mixed = stages
    rows = lambda df: Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
    assert not rows(kept) - rows(before) and not rows(deduped) - rows(kept) and not rows(clean) - rows(deduped) and set(rows(mixed)) <= set(rows(clean))
    assert last.count() == mixed.count() and last.agg({"n_tokens": "min"}).first()[0] >= 1
    assert Counter(r.doc_id for r in last.collect()) == Counter(r.doc_id for r in mixed.collect())


def test_pipeline_on_an_empty_table(session, empty, tmp_path):
    stages = run_on(session, tmp_path, empty)
    assert [s.count() for s in stages] == [0] * 5 and all(s.columns == empty.columns for s in stages[:-1])
    assert corpus_pipeline.run(session, str(tmp_path)).count() == 0
