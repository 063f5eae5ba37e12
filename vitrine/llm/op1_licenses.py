"""License scans with a positional rare-token index over license templates.

The index holds, for every template, its words of highest inverse document frequency (IDF)
with their positions.  A file is scanned once: for each template its rarest words that
occur in the file are looked up, each occurrence at file position p of a word at template
position t speaks for the relative position p - t, and positions that at least two
words agree on are verified: the template's mandatory key phrases must stand there, and
enough of its words, weighed by IDF, must stand at their relative positions.
IDF comes from all documents; only the words of the templates are counted.

A short phrase is a template whose mandatory phrase is the phrase itself.  Every place
of it holds all its words in order, so its two rarest words always agree there: no place is lost.

Defined cases: a null text is an empty one and has no labels; a null id is carried along;
equal rows get equal results; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import encoded, table

#: Bytes of a word: digits, letters (A-Z as a-z) and all of a code point outside ASCII.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

#: Words of a template that the index holds at most, and how many must agree on a position.
RARE, AGREE = 6, 2
#: How far a word may be off its relative position in a template that is not a bare phrase.
SLACK = 2
#: Weighed share of a template's words that must stand at their places.
SHARE = 0.6


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


@dataclass(frozen=True)
class Template:
    """A license text to look for; ``phrases`` must all stand in it and in a file that matches."""

    name: str
    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def exact(self) -> bool:
        return self.phrases == (self.text,)


# The phrases of the base rule and their labels.
PHRASES = (
    Template("mit phrase", "mit", "the mit license", ("the mit license",)),
    Template("apache phrase", "apache-2", "apache license version 2", ("apache license version 2",)),
    Template("cc phrase", "cc-by-nc", "cc by nc", ("cc by nc",)),
)

# The phrases of the registered query, whose MIT phrase is a word longer; the shorter one only adds its label there.
QUERY_PHRASES = (Template("mit under phrase", "mit", "under the mit license", ("under the mit license",)), *PHRASES[1:])

# Short notices that licenses give for use in files, and the words that must not be missing.
NOTICES = (
    Template("mit notice", "mit", "released under the mit license", ("mit license",)),
    Template("mit grant", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted", "without restriction")),
    Template("apache notice", "apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license version 2", "in compliance with the license")),
    Template("apache line", "apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template("gpl 3 line", "gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    Template("gpl 2 line", "gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    Template("gpl notice", "gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license", "free software foundation")),
    Template("lgpl notice", "lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    Template("mpl notice", "mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("bsd grant", "bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("isc grant", "isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("for any purpose with or without fee",)),
    Template("cc by nc line", "cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc by sa line", "cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc attribution", "cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    Template("public domain", "unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)


class Index:
    """Postings of the rare words of templates, by the IDF of words."""

    def __init__(self, templates: tuple[Template, ...], idf: dict[bytes, float]):
        self.templates = templates
        self.words = [words_of(t.text.encode()) for t in templates]
        self.idf = idf
        self.postings: dict[bytes, list[tuple[int, list[int]]]] = defaultdict(list)
        self.need = []
        self.phrases = []
        for k, words in enumerate(self.words):
            ranked = sorted(set(words), key=lambda w: (-idf.get(w, 0.0), w))
            rare = ranked[: 2 if templates[k].exact else RARE]
            self.need.append(min(AGREE, len(rare)))
            for w in rare:
                self.postings[w].append((k, [t for t, x in enumerate(words) if x == w]))
            self.phrases.append([])
            for phrase in templates[k].phrases:
                parts = words_of(phrase.encode())
                at = next(t for t in range(len(words)) if words[t : t + len(parts)] == parts)
                self.phrases[k].append((at, parts))
        self.weight = [sum(idf.get(w, 0.0) + 1e-9 for w in words) for words in self.words]

    def scan(self, words: list[bytes]) -> Iterator[tuple[int, int, float]]:
        """(template, position, share) of every verified place in a file."""
        found: dict[bytes, list[int]] = defaultdict(list)
        for p, w in enumerate(words):
            if w in self.postings:
                found[w].append(p)
        if not found:
            return
        spoken: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        for w in sorted(found, key=lambda w: (-self.idf.get(w, 0.0), w)):
            for k, at in self.postings[w]:
                for t in at:
                    for p in found[w]:
                        spoken[k, p - t].add(w)
        for (k, start), agreed in spoken.items():
            slack = 0 if self.templates[k].exact else SLACK
            if len(agreed) < self.need[k] and not (slack and self._near(spoken, k, start, agreed) >= self.need[k]):
                continue
            if slack and any(len(spoken.get((k, start + s), ())) > len(agreed) or (s < 0 and len(spoken.get((k, start + s), ())) == len(agreed)) for s in range(-slack, slack + 1) if s):
                continue  # a neighbour stands for the same place
            if all(any(words[max(start + t + s, 0) : max(start + t + s, 0) + len(parts)] == parts for s in range(-slack, slack + 1)) for t, parts in self.phrases[k]):
                share = self._share(words, k, start, slack)
                if share >= SHARE or not slack:
                    yield k, start, share

    def _near(self, spoken: dict, k: int, start: int, agreed: set[bytes]) -> int:
        return len(agreed.union(*(spoken.get((k, start + s), ()) for s in range(-SLACK, SLACK + 1))))

    def _share(self, words: list[bytes], k: int, start: int, slack: int) -> float:
        have = 0.0
        for t, w in enumerate(self.words[k]):
            low = start + t - slack
            if w in words[max(low, 0) : max(start + t + slack + 1, 0)]:
                have += self.idf.get(w, 0.0) + 1e-9
        return min(1.0, have / self.weight[k])


def word_idf(df: DataFrame, templates: tuple[Template, ...], text_col: str = "text") -> dict[bytes, float]:
    """IDF over all documents of every word of the templates, no other word is counted."""
    vocabulary = frozenset(w for t in templates for w in words_of(t.text.encode()))

    def count(batches):
        seen, rows = Counter(), 0
        for batch in batches:
            for raw in encoded(batch["t"]):
                rows += 1
                seen.update(vocabulary.intersection(words_of(raw)))
        yield pd.DataFrame([(b"", rows), *seen.items()], columns=["word", "n"])

    rows = df.select(F.col(text_col).alias("t")).mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    seen = {bytes(r["word"]): r["n"] for r in rows}
    total = seen.pop(b"", 0)
    return {w: math.log((total + 1) / (seen.get(w, 0) + 1)) for w in vocabulary}


SCAN = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, places array<struct<template:string,label:string,start:long,share:double>>"


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: tuple[Template, ...] = PHRASES, notices: tuple[Template, ...] = NOTICES) -> DataFrame:
    """Per row: id, the counts and labels of the phrases, all labels, the best share, and every place found."""
    templates = (*phrases, *notices)
    index = Index(templates, word_idf(df, templates, text_col))
    base = len(phrases)

    @F.pandas_udf(SCAN)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for raw in encoded(texts):
            words = words_of(raw)
            places = sorted(index.scan(words), key=lambda x: (x[1], x[0]))
            starts = [start for k, start, _ in places if k < base]
            join = lambda labels: ",".join(sorted(set(labels)))
            rows.append((
                len(words), len(starts), starts[0] if starts else None, starts[-1] if starts else None,
                join(templates[k].label for k, _, _ in places if k < base), join(templates[k].label for k, _, _ in places),
                max((share for _, _, share in places), default=0.0),
                [{"template": templates[k].name, "label": templates[k].label, "start": start, "share": share} for k, start, share in places],
            ))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in SCAN.split(", ")])
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    return df.select(F.col(id_col), scanned(F.col(text_col)).alias("f")).select(id_col, "f.*")


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), phrases=QUERY_PHRASES, notices=(PHRASES[0], *NOTICES)).drop("places")


QUERIES = {"op1_license_scan": op1_license_scan}
ORACLES: dict[str, str] = {}
