"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks (see ``dom``), and the chain of its blocks is labelled main text or not.  Features of a block are the tags above it, the kinds that words of
classes, ids and roles tell, and its text: length, share of link text, marks of a
sentence, digits, capitals, place in the page.  Neighbours are tied by transition weights.  Weights are learnt by
maximising the likelihood of labelled pages (forward-backward, Adam with an L2 term), and pages are decoded by Viterbi.

Labelled pages are of two sorts.  First, pages of the table whose own tags tell: what lies in ``article`` and in none of its menus, notices, adverts,
forms or comments is main text; ``TRAIN_PAGES`` of them at most, those of the smallest hash, of at most ``TRAIN_CHARS``
characters.  Second, ``LAYOUT_PAGES`` pages made from the layouts of ``layouts``, whose slots are labelled, filled with sentences of
the first sort; so a page without ``article`` is labelled by what its other tags, classes and texts tell.

Defined cases: a null or empty page, or one without main text, gives an empty text; long pages are read whole; equal rows and null ids are
rows of their own; in an empty table weights come from the layouts alone, and there are no rows; further columns are ignored.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import table
from vitrine.llm.dom import Path, Scanner
from vitrine.llm.layouts import MARK, made_pages

#: Bounds of what is learnt from, and the learning itself.
TRAIN_PAGES, TRAIN_CHARS, LAYOUT_PAGES = 200, 50_000, 600
ROUNDS, RATE, DECAY = 120, 0.08, 2e-4
SEPARATOR = "\n\n"
_SENTENCE = re.compile(r"[.!?…。！？][\"'”’)]*\s")
_END = (".", "!", "?", "…", "。", "！", "？", ":", ".”", '."', ".'")


def text_features(text: str, linked: int, nth: int, count: int, sibling: bool) -> list[str]:
    """What the text of a block, and its place, tell."""
    words = text.count(" ") + 1
    share = linked / len(text)
    out = [f"words={min(words, 256).bit_length()}", f"links={0 if not linked else 1 if share < 0.34 else 2 if share < 0.8 else 3}", f"place={4 * nth // count}"]
    if text.endswith(_END):
        out.append("ends")
    if _SENTENCE.search(text):
        out.append("sentences")
    commas = text.count(",") + text.count("、")
    if commas:
        out.append("commas=2" if commas > 2 else "commas=1")
    if "©" in text or "(c)" in text or "copyright" in text[:200].lower():
        out.append("owner")
    if "|" in text or "»" in text or "·" in text or "›" in text:
        out.append("bars")
    digits = sum(map(str.isdigit, text[:200]))
    if 3 * digits > min(len(text), 200):
        out.append("digits")
    if text[:200].isupper():
        out.append("capitals")
    if nth == 0:
        out.append("first")
    if nth == count - 1:
        out.append("last")
    if sibling:
        out.append("sibling")
    return out


def places(leaves: list) -> list[list[str]]:
    """The text features of a page's blocks."""
    out, before = [], None
    for nth, (path, text, linked) in enumerate(leaves):
        out.append(text_features(text, linked, nth, len(leaves), path is before))
        before = path
    return out


class Chain:
    """A conditional random field with the labels 0 (rest) and 1 (main text)."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, steps: np.ndarray, ends: np.ndarray):
        self.names, self.steps, self.ends = names, steps, ends
        self.margin = {name: (float(weights[i, 0]), float(weights[i, 1])) for name, i in names.items()}

    def of(self, names) -> tuple[float, float]:
        found = [self.margin[n] for n in names if n in self.margin]
        return sum(a for a, _ in found), sum(b for _, b in found)

    def viterbi(self, leaves: list) -> list[int]:
        """The likeliest labels of the blocks of a page."""
        if not leaves:
            return []
        (aa, ab), (ba, bb) = self.steps.tolist()
        (start_a, start_b), (end_a, end_b) = self.ends.tolist()
        backs = []
        a = b = 0.0
        for nth, ((path, _, _), own) in enumerate(zip(leaves, places(leaves))):
            if path.score is None:
                path.score = self.of(path.features)
            x, y = self.of(own)
            x, y = x + path.score[0], y + path.score[1]
            if nth == 0:
                a, b = start_a + x, start_b + y
                continue
            from_a, from_b = a + aa >= b + ba, a + ab >= b + bb
            backs.append((from_a, from_b))
            a, b = (a + aa if from_a else b + ba) + x, (a + ab if from_b else b + bb) + y
        label = int(b + end_b > a + end_a)
        out = [label]
        for from_a, from_b in reversed(backs):
            label = int(not (from_b if label else from_a))
            out.append(label)
        return out[::-1]


def likelihood(weights, steps, ends, index, owner, starts, labels, lengths):
    """Log likelihood of labelled chains, and its gradients; ``index`` lists the features of block after block.

    Chains are padded to one length and run side by side.
    """
    emitted = np.add.reduceat(weights[index], starts, axis=0)
    chains, longest = len(lengths), int(lengths.max())
    first = np.cumsum(lengths) - lengths
    step_of = np.arange(longest)[None, :]
    valid = step_of < lengths[:, None]
    grid = np.zeros((chains, longest), dtype=np.int64)
    grid[valid] = (first[:, None] + step_of)[valid]
    e = emitted[grid]
    e[:, 0] += ends[0]
    e[np.arange(chains), lengths - 1] += ends[1]

    def logsum(x, axis):
        high = x.max(axis=axis, keepdims=True)
        return np.squeeze(high, axis) + np.log(np.exp(x - high).sum(axis=axis))

    alpha, beta = np.zeros((chains, longest, 2)), np.zeros((chains, longest, 2))
    alpha[:, 0] = e[:, 0]
    for t in range(1, longest):
        new = e[:, t] + logsum(alpha[:, t - 1, :, None] + steps[None], 1)
        alpha[:, t] = np.where(valid[:, t, None], new, alpha[:, t - 1])
    total = logsum(alpha[:, -1], 1)
    for t in range(longest - 2, -1, -1):
        new = logsum(steps[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where(valid[:, t + 1, None], new, 0.0)
    chance = np.exp(alpha + beta - total[:, None, None])
    pair = np.exp(alpha[:, :-1, :, None] + steps[None, None] + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None])
    pair *= valid[:, 1:, None, None]

    truth = np.zeros((len(labels), 2))
    truth[np.arange(len(labels)), labels] = 1.0
    expected = np.zeros((len(labels), 2))
    expected[grid[valid]] = chance[valid]
    off = truth - expected
    by_feature = np.stack([np.bincount(index, weights=off[owner, k], minlength=len(weights)) for k in (0, 1)], axis=1)
    inner = np.ones(len(labels), dtype=bool)
    inner[first + lengths - 1] = False
    at = np.flatnonzero(inner)
    by_step = np.zeros((2, 2))
    np.add.at(by_step, (labels[at], labels[at + 1]), 1.0)
    by_step -= pair.sum(axis=(0, 1))
    by_end = np.stack([off[first].sum(axis=0), off[first + lengths - 1].sum(axis=0)])
    score = (emitted * truth).sum() + steps[labels[at], labels[at + 1]].sum() + ends[0][labels[first]].sum() + ends[1][labels[first + lengths - 1]].sum()
    return float(score - total.sum()), by_feature, by_step, by_end


def learn(pages: list[tuple[list, list[int]]]) -> Chain:
    """The chain of labelled pages: (leaves, labels) each."""
    pages = [(leaves, labels) for leaves, labels in pages if leaves]
    names: dict[str, int] = {}
    index, starts, owner, labels = [], [], [], []
    for leaves, truth in pages:
        for (path, _, _), own in zip(leaves, places(leaves)):
            starts.append(len(index))
            here = [names.setdefault(n, len(names)) for n in (*path.features, *own)]
            owner.extend([len(starts) - 1] * len(here))
            index.extend(here)
        labels.extend(truth)
    index, starts, owner, labels = (np.array(x, dtype=np.int64) for x in (index, starts, owner, labels))
    lengths = np.array([len(leaves) for leaves, _ in pages], dtype=np.int64)
    values = [np.zeros((len(names), 2)), np.zeros((2, 2)), np.zeros((2, 2))]
    means, squares = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for k in range(1, ROUNDS + 1):
        _, *slopes = likelihood(*values, index, owner, starts, labels, lengths)
        for v, m, s, g in zip(values, means, squares, slopes):
            g = g / len(labels) - DECAY * v
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v += RATE * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-8)
    return Chain(names, *values)


_OUTSIDE = frozenset("menu foot side share notice advert reply form".split())
_OUTSIDE_TAGS = frozenset("nav aside footer form menu dialog fieldset".split())


def told(leaves: list) -> list[int] | None:
    """Labels that a page's own tags tell; None where it has no ``article``."""
    labels = [int("article" in p.tags and not (p.tags & _OUTSIDE_TAGS) and not (p.kinds & _OUTSIDE)) for p, _, _ in leaves]
    return labels if any(labels) else None


def labelled(pages: list[str], made: int = LAYOUT_PAGES, seed: int = 13) -> list[tuple[list, list[int]]]:
    """Labelled pages: those of ``pages`` whose tags tell, and pages made from layouts with their sentences."""
    scanner, out, sentences = Scanner(), [], []
    for page in pages:
        leaves = scanner.leaves(page)
        labels = told(leaves)
        if labels:
            out.append((leaves, labels))
            sentences.extend(text for (_, text, _), y in zip(leaves, labels) if y)
    for page in made_pages(random.Random(seed), made, sentences):
        leaves = scanner.leaves(page)
        labels = [int(MARK in text) for _, text, _ in leaves]
        out.append(([(path, text.replace(MARK, ""), min(linked, len(text.replace(MARK, "")))) for path, text, linked in leaves if text != MARK], [y for y, (_, text, _) in zip(labels, leaves) if text != MARK]))
    return out


def fitted(df: DataFrame, html_col: str = "html") -> Chain:
    """A chain learnt from a bounded sample of the table's pages and from layouts."""
    sample = df.select(F.col(html_col).cast("string").alias("h")).filter(F.length("h").between(1, TRAIN_CHARS) & F.lower("h").contains("<article"))
    sample = sample.select("h", F.xxhash64("h").alias("k"))
    least = [r["k"] for r in sample.select("k").distinct().orderBy("k").limit(TRAIN_PAGES).collect()]
    chosen = sample.filter(F.col("k").isin(least)).groupBy("k").agg(F.min("h").alias("h")).orderBy("k").collect()
    return learn(labelled([r["h"] for r in chosen]))


def extract(df: DataFrame, chain: Chain, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``df`` with the main text of each page."""

    def texts(pages: pd.Series) -> pd.Series:
        scanner, out = scanner_of(chain), []
        for page in pages:
            leaves = scanner.leaves(page) if isinstance(page, str) else []
            out.append(SEPARATOR.join(text for (_, text, _), y in zip(leaves, chain.viterbi(leaves)) if y))
        return pd.Series(out, dtype=object)

    texts.__annotations__ = {"pages": pd.Series, "return": pd.Series}
    return df.withColumn(out_col, F.pandas_udf(texts, "string")(F.col(html_col)))


def scanner_of(chain: Chain) -> Scanner:
    """The scanner of a worker for ``chain``; its paths keep their scores from batch to batch."""
    if not hasattr(chain, "scanner"):
        chain.scanner = Scanner()
    return chain.scanner


def op13_html_text(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = extract(pages, fitted(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op13_html_text": op13_html_text}
ORACLES: dict[str, str] = {}
