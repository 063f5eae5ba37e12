"""Quality rules by weak supervision: rules vote or abstain, EM weighs them, the posterior decides.

Every rule looks at a document and votes good (1), bad (-1) or abstains (0).
How far a rule can be trusted is not set by hand: expectation-maximisation over
the votes of all documents estimates, per rule, how often it votes good and votes bad on
good and on bad documents; the share of good ones beforehand is a parameter.  So a rule that says good of nearly
everything weighs little.  Abstaining says nothing: that a document lacks most faults does not excuse the one
it has.  Only the counts of vote patterns, at most 3 to the number of rules, reach the driver.

Defined cases: a null or empty text has no words and fails the base rules; a null
id is carried along; equal rows get equal results; an empty table gives no rows
(and the starting weights); further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import encoded, fresh, table
from vitrine.session import cut_lineage

SYMBOLS = b"#*$%&|<>"
FEATURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_lines bigint, n_distinct bigint, n_shouted bigint, n_marks bigint, n_ended bigint"
)
#: How often a rule is taken to vote (bad, good) on good and on bad documents before EM, with how many documents' weight.
START_GOOD, START_BAD, START_VOTES, START_SHARE = (0.01, 0.8), (0.35, 0.6), 20.0, 0.85
#: No rule is held to call more good documents bad than this share of them.
MOST_WRONG = 0.01
ITERATIONS = 200


def text_features(raw: bytes) -> tuple:
    """The counts the rules look at, over the whole text."""
    words = raw.split()  # bytes split at space and \t \n \v \f \r only
    n = len(words)
    spaces = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
    chars = len(raw) - spaces - _continuation(raw)
    symbols = sum(raw.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    found = Counter(windows)
    repeated = 0
    if len(found) < len(windows):
        end = 0
        for i, window in enumerate(windows):
            if found[window] > 1:
                repeated += i + 3 - max(end, i)
                end = i + 3
    shouted = sum(1 for w in words if len(w) > 1 and w.isupper())
    marks = raw.count(b"!") + raw.count(b"|")
    ended = sum(1 for line in lines if line.rstrip()[-1:] in (b".", b"!", b"?", b":"))
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines), len(set(words)), shouted, marks, ended


_CONTINUATION = bytes(range(0x80, 0xC0))


def _continuation(raw: bytes) -> int:
    """Bytes that continue a code point."""
    return 0 if raw.isascii() else len(raw) - len(raw.translate(None, _CONTINUATION))


def _features(texts: pd.Series) -> pd.DataFrame:
    rows = [text_features(raw) for raw in encoded(texts)]
    return pd.DataFrame(rows, columns=[f.split()[0] for f in FEATURES.split(", ")], dtype="int64")


def features(text: Column) -> Column:
    return F.pandas_udf(_features, FEATURES)(text)


def _vote(bad: Column, good: Column | None = None) -> Column:
    vote = F.when(bad, -1)
    return (vote if good is None else vote.when(good, 1)).otherwise(0)


def rules(f: str = "f") -> dict[str, Column]:
    """The votes, from the struct ``f`` of features.  A rule abstains where it cannot tell."""
    c = lambda name: F.col(f"{f}.{name}")
    n = F.greatest(c("n_words"), F.lit(1))
    lines = F.greatest(c("n_lines"), F.lit(1))
    return {
        "length": _vote(c("n_words") < 50, c("n_words") >= 100),
        "symbols": _vote(c("n_symbols") > 0.1 * n),
        "repeats": _vote(c("n_repeat_words") > 0.4 * n),
        "lines": _vote((c("n_dup_lines") > 0.4 * lines) & (c("n_lines") >= 4)),
        "shouting": _vote(c("n_shouted") > 0.4 * n),
        "marks": _vote(c("n_marks") > 0.2 * n),
        "variety": _vote((c("n_distinct") < 0.25 * n) & (n < 1000), (c("n_distinct") > 0.4 * n) | (c("n_distinct") > 300)),
        "word_length": _vote((c("word_chars") < 2.5 * n) | (c("word_chars") > 14 * n), (c("word_chars") >= 3.5 * n) & (c("word_chars") <= 9 * n)),
    }


def estimate(votes: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over vote patterns: the share of good documents taken; per rule how often it votes (bad, good) on good documents, and on bad ones.

    A rule is held to call few good documents bad (``MOST_WRONG``), and bad ones no less often, which settles which class is which.
    """
    names = votes.shape[1]
    chosen = np.stack([votes == v for v in (-1, 1)], axis=2).astype(float)  # pattern, rule, vote
    start_good, start_bad = np.tile(START_GOOD, (names, 1)), np.tile(START_BAD, (names, 1))
    prior, good, bad = START_SHARE, start_good, start_bad
    for _ in range(ITERATIONS if counts.sum() else 0):
        odds = math.log(prior / (1 - prior)) + np.einsum("prv,rv->p", chosen, np.log(good / bad))
        p = counts / (1 + np.exp(np.clip(-odds, -500, 500)))
        old = np.concatenate((good.ravel(), bad.ravel()))
        good = (np.einsum("p,prv->rv", p, chosen) + START_VOTES * start_good) / (p.sum() + START_VOTES)
        bad = (np.einsum("p,prv->rv", counts - p, chosen) + START_VOTES * start_bad) / ((counts - p).sum() + START_VOTES)
        good[:, 0] = np.minimum(good[:, 0], MOST_WRONG)
        bad[:, 0] = np.maximum(bad[:, 0], good[:, 0])
        if np.abs(np.concatenate((good.ravel(), bad.ravel())) - old).max() < 1e-10:
            break
    return float(prior), good, bad


def weigh(votes: DataFrame, names: list[str]) -> tuple[float, np.ndarray, np.ndarray]:
    """EM weights from the votes of all rows; at most 3 ** len(names) patterns are collected."""
    patterns = sorted(tuple(r) for r in votes.groupBy(*names).count().select(*names, "count").collect())
    array = np.array(patterns, dtype=np.int64).reshape(-1, len(names) + 1)
    return estimate(array[:, :-1], array[:, -1].astype(float))


def posterior(votes: dict[str, Column], weights: tuple[float, np.ndarray, np.ndarray]) -> Column:
    """Probability that a document is good, as one expression over its votes."""
    prior, good, bad = weights
    logit = F.lit(math.log(prior / (1 - prior)))
    for vote, says in zip(votes.values(), np.log(good / bad).tolist()):
        logit = logit + F.when(vote == -1, says[0]).when(vote == 1, says[1]).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def base_failed(f: str = "f") -> Column:
    return (F.col(f"{f}.n_words") < 50) | (100 * F.col(f"{f}.n_repeat_words") > 50 * F.col(f"{f}.n_words"))


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: id, features, votes, posterior, ``base_failed`` and ``kept``.  Texts are read once."""
    seen = cut_lineage(df.select(F.col(id_col), features(F.col(text_col)).alias("f")), "features")
    votes = rules()
    weights = weigh(seen.select(*[v.alias(k) for k, v in votes.items()]), list(votes))
    out = seen.select(F.col(id_col), "f", *[v.alias(f"vote_{k}") for k, v in votes.items()], posterior(votes, weights).alias("quality"), base_failed().alias("base_failed"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_good(df: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` that the rules keep, columns as they are; no shuffle of texts.

    Texts are read twice (to estimate, to filter) rather than copied.
    """
    (f,) = fresh(df, "f")
    seen = df.withColumn(f, features(F.col(text_col)))
    votes = rules(f)
    weights = weigh(df.select(features(F.col(text_col)).alias(f)).select(*[v.alias(k) for k, v in votes.items()]), list(votes))
    return seen.filter(~base_failed(f) & (posterior(votes, weights) >= threshold)).select(*[F.col(f"`{c}`") for c in df.columns])


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = score(table(spark, sf_dir, "documents"))
    votes = [c for c in out.columns if c.startswith("vote_")]
    return out.select("doc_id", "f.n_words", "f.word_chars", "f.n_symbols", "f.n_dup_lines", "f.n_repeat_words", "base_failed", "kept", "quality", *votes)


QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLES: dict[str, str] = {}
