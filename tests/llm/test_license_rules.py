"""Operators 1 and 9 beside plain recounts."""

import re
from collections import Counter

import numpy as np

from vitrine.llm import op1_licenses, op9_rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit": ["the", "mit", "license"], "apache-2": ["apache", "license", "version", "2"], "cc-by-nc": ["cc", "by", "nc"]}


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def licenses(text):
    words = WORD.findall(lowered(text))
    places = [(i, label) for label, p in PHRASES.items() for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


NOTICES = [
    "The MIT License, the mit-license; THE MIT LICENSE", "Licensed under the Apache License, Version 2.0 (the License)", "CC BY-NC 4.0 cc by nc cc by cc by nc",
    "This work is licensed under the GNU General Public License, version 3.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "you can redistribute it, and then or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "the license of mit", None, "", "mit mit license the mit the mit license license",
]


def test_phrases_agree_with_a_plain_search(session, documents, odd):
    frame = documents.select("doc_id", "text").union(odd.select("doc_id", "text")).union(session.createDataFrame([(1000 + i, t) for i, t in enumerate(NOTICES)], "doc_id long, text string"))
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in op1_licenses.scan(frame).collect())
    assert got == Counter((r.doc_id, *licenses(r.text)) for r in frame.collect())


def test_method_adds_labels(session, empty):
    frame = session.createDataFrame([(i, t) for i, t in enumerate(NOTICES)], "doc_id long, text string")
    found = {r.doc_id: r for r in op1_licenses.scan(frame).collect()}
    assert found[3].labels == "gpl-3" and found[3].base_labels == "" and found[3].score > 0.9
    assert found[4].labels == "isc" and found[5].labels == "gpl" and 0.6 <= found[5].score <= 1
    assert found[6].labels == "" and found[6].score == 0 and found[7].n_words == 0
    assert set(found[0].base_labels.split(",")) <= set(found[0].labels.split(","))
    assert op1_licenses.scan(empty).count() == 0


def test_query_places_start_at_the_whole_phrase(session, tmp_path):
    rows = ["Released UNDER the MIT License", "see the MIT license", "under the, mit; license under the MIT license", "under mit license", "Under\nThe\nMIT\nLicense apache license version 2 cc by nc", None, ""]
    session.createDataFrame(list(enumerate(rows)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in op1_licenses.op1_license_scan(session, str(tmp_path)).collect()}
    base = lambda r: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
    assert [base(found[i]) for i in range(7)] == [
        (5, 1, 1, 1, "mit"), (4, 0, None, None, ""), (8, 2, 0, 4, "mit"), (3, 0, None, None, ""), (11, 3, 0, 8, "apache-2,cc-by-nc,mit"), (0, 0, None, None, ""), (0, 0, None, None, "")]
    assert found[1].labels == "mit" and set(found[4].base_labels.split(",")) <= set(found[4].labels.split(","))


def counts(text):
    raw = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", raw)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    found = Counter(windows)
    covered = {j for i, w in enumerate(windows) if found[w] > 1 for j in (i, i + 1, i + 2)}
    seen, twice = set(), 0
    for line in raw.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            twice += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", raw)), twice, len(covered)


def test_rule_counts_agree_with_a_recount(documents, odd):
    frame = documents.select("doc_id", "text").union(odd.select("doc_id", "text"))
    out = op9_rules.score(frame).collect()
    got = Counter((r.doc_id, r.f.n_words, r.f.word_chars, r.f.n_symbols, r.f.n_dup_lines, r.f.n_repeat_words, r.base_failed) for r in out)
    want = Counter()
    for r in frame.collect():
        c = counts(r.text)
        want[(r.doc_id, *c, c[0] < 50 or 100 * c[4] > 50 * c[0])] += 1
    assert got == want
    assert not any(r.kept for r in out if r.base_failed)


def test_filter_agrees_with_scores_and_keeps_columns(documents, odd, empty):
    kept = op9_rules.keep_good(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in op9_rules.score(odd).filter("kept").collect())
    assert op9_rules.keep_good(empty).count() == 0 and op9_rules.score(empty).count() == 0


def test_rules_follow_the_labels(session):
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = session.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = op9_rules.score(docs).select("doc_id", "f.n_words", "kept").join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.n_words >= 50]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_em_tells_faulty_from_plain():
    """Faults of two kinds that never meet, and rules that say good of nearly all."""
    rng = np.random.default_rng(1)
    kind = rng.choice(3, 20_000, p=[0.85, 0.07, 0.08])
    fires = lambda rate: rng.random(len(kind)) < rate
    votes = np.stack([
        np.where(fires(np.where(kind == 1, 0.95, 0.005)), -1, 0), np.where(fires(np.where(kind == 2, 0.9, 0.005)), -1, 0), np.where(fires(np.where(kind == 2, 0.8, 0.01)), -1, 0),
        np.where(fires(0.9), 1, 0), np.where(fires(0.005), -1, 1),
    ], axis=1)
    prior, good, bad = op9_rules.estimate(votes, np.ones(len(votes)))
    odds = np.log(prior / (1 - prior)) + sum(np.where(votes[:, r] == v, np.log(good[r, k] / bad[r, k]), 0) for r in range(5) for k, v in enumerate((-1, 1)))
    assert np.mean((odds > 0) == (kind == 0)) > 0.96
