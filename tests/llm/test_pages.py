"""Web pages: leaf blocks, the chain against all labellings, extraction on given and on made pages."""

import itertools
import random

import numpy as np
import pytest

from vitrine.llm import layouts
from vitrine.llm import op13_html as op13
from vitrine.llm.dom import Scanner


def texts(page):
    return [text for _, text, _ in Scanner().leaves(page)]


@pytest.mark.parametrize("page, blocks", [
    ("<p>a &amp; b&nbsp;c<br>d\n\t e</p>", ["a & b c d e"]),
    ("<p><b>one<br><p>two<p>three", ["one", "two", "three"]),
    ("<script>var t='<p>no</p>';</script>x<style>p{}</style>y<!-- <p>z --> w", ["xy w"]),
    ("<title>t</title><textarea><p>no</textarea><select><option>no</select>yes", ["yes"]),
    ("a < b <3 </ x> <c", ["a < b <3"]),
    ("<ul><li>one<li>two<ul><li>three</ul><li>four</ul>", ["one", "two", "three", "four"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
    ("<!-- never closed <p>a", []),
    ("<p title='a>b' class=x>t", ["t"]),
    ('<p title="never closed>t</p><p>u</p>', ["t", "u"]),
    ("<P>Upper</P><DIV>Case</DIV>", ["Upper", "Case"]),
    ("<a href=1>x<p>y</a>z</p>w", ["x", "yz", "w"]),
    ("&#65;&#x42;&eacute;&unknown;&lt;p&gt;", ["ABé&unknown;<p>"]),
    ("", []), (" \n ", []), ("<!---->a<!-->b", ["ab"]),
])
def test_leaves(page, blocks):
    assert texts(page) == blocks


def test_paths_and_links():
    (path, text, linked), (last, _, _) = Scanner().leaves('<div class="site-header"><nav id=mainMenu><a href="/">ab</a> cd</nav></div><p>x')
    assert (path.tag, text, linked) == ("nav", "ab cd", 2) and {"head", "menu"} <= path.kinds and "nav" in path.tags and last.tags == {"page", "p"}


@pytest.mark.parametrize("page", ["<div>" * 30_000 + "x", "<b>" * 30_000 + "x" + "</b>" * 30_000, "<p>a" * 30_000, "<a href='" * 20_000, "<!--" * 50_000, "</p>" * 50_000, "&" * 100_000, "<li><div>" * 20_000])
def test_hostile_pages_end(page):
    Scanner().leaves(page)


@pytest.fixture(scope="module")
def chain():
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet")["html"].to_pylist()
    return op13.learn(op13.labelled(pages))


def test_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 4, 3])
    starts = np.arange(8) * 2
    index, owner, labels = rng.integers(0, 5, 16), np.repeat(np.arange(8), 2), rng.integers(0, 2, 8)
    values = [rng.normal(size=(5, 2)), rng.normal(size=(2, 2)), rng.normal(size=(2, 2))]
    args = (index, owner, starts, labels, lengths)
    _, *slopes = op13.likelihood(*values, *args)
    for v, g in zip(values, slopes):
        for at in np.ndindex(v.shape):
            v[at] += 1e-6
            up = op13.likelihood(*values, *args)[0]
            v[at] -= 2e-6
            down = op13.likelihood(*values, *args)[0]
            v[at] += 1e-6
            assert abs((up - down) / 2e-6 - g[at]) < 1e-5


def test_likelihood_and_viterbi_are_those_of_all_labellings(chain):
    page = '<nav><a href=1>Home</a></nav><h1>On ships</h1><p>Ships sail. They sink, too.</p><div class="comments"><p>Nice one, really.</p></div><footer>&copy; us</footer>'
    leaves = Scanner().leaves(page)
    scores = [np.array(chain.of([*p.features, *own])) for (p, _, _), own in zip(leaves, op13.places(leaves))]

    def total(ys):
        return sum(s[y] for s, y in zip(scores, ys)) + sum(chain.steps[a, b] for a, b in zip(ys, ys[1:])) + chain.ends[0][ys[0]] + chain.ends[1][ys[-1]]

    every = list(itertools.product((0, 1), repeat=len(leaves)))
    best = max(every, key=total)
    assert tuple(chain.viterbi(leaves)) == best
    values = np.array([[*chain.margin[n]] for n in chain.names])
    index = [chain.names[n] for (p, _, _), own in zip(leaves, op13.places(leaves)) for n in (*p.features, *own) if n in chain.names]
    counts = [sum(n in chain.names for n in (*p.features, *own)) for (p, _, _), own in zip(leaves, op13.places(leaves))]
    starts = np.cumsum(counts) - counts
    found = op13.likelihood(values, chain.steps, chain.ends, np.array(index), np.repeat(np.arange(len(leaves)), counts), starts, np.array(best), np.array([len(leaves)]))[0]
    assert abs(found - (total(best) - np.logaddexp.reduce([total(ys) for ys in every]))) < 1e-8


def test_given_pages(session):
    """On pages whose tags tell, the text is that of the article."""
    rows = op13.op13_html_text(session, "/root/testdata/sf0.01").collect()
    pages = {r["page_id"]: r["html"] for r in session.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        leaves = Scanner().leaves(pages[r["page_id"]])
        assert r["text"] == "\n\n".join(t for p, t, _ in leaves if "article" in p.tags) and r["n_chars"] == len(r["text"])


def test_made_pages(chain):
    """Pages of the layouts with other texts: nearly all blocks are told."""
    hit = wrong = missed = 0
    for page in layouts.made_pages(random.Random(99), 170, []):
        leaves = Scanner().leaves(page)
        for (_, text, _), y in zip(leaves, chain.viterbi([(p, t.replace(layouts.MARK, "") or "a", n) for p, t, n in leaves])):
            main = layouts.MARK in text
            hit, wrong, missed = hit + (main and y), wrong + (not main and y), missed + (main and not y)
    assert hit / (hit + wrong) > 0.97 and hit / (hit + missed) > 0.97


def test_unseen_page(chain):
    """A page of no layout: notice, menus, form, advert, replies and footer go, the article stays."""
    page = """<html><head><title>no</title></head><body><div id="cookie-consent">We use cookies to improve things. You agree by reading on.</div>
    <div class="page-top"><a href="/">Site</a></div><div class="main-nav"><a href=1>World</a> <a href=2>Local</a></div>
    <div class="story-wrap"><h1>Bridge opens</h1><div class="byline">By A. Writer</div><div class="story-text"><p>The bridge opened on Monday, after years of work. Many came.</p><div class="ad-slot">Buy our shoes. They are the best shoes there are.</div>
    <p>It is long.</p><p>Officials said that traffic will flow, and that tolls stay low.</p></div></div>
    <div id="comments"><div class="comment"><p>I was there, and it was a fine day for all of us. Truly.</p></div></div>
    <form><label>Your mail</label><input></form><div class="footer">&copy; 2020 Site. All rights reserved.</div></body></html>"""
    leaves = Scanner().leaves(page)
    kept = [t for (_, t, _), y in zip(leaves, chain.viterbi(leaves)) if y]
    assert kept == ["Bridge opens", "The bridge opened on Monday, after years of work. Many came.", "It is long.", "Officials said that traffic will flow, and that tolls stay low."]


def test_odd_tables(session):
    rows = [(1, "u", None, 1, "x"), (1, "u", "", 1, "x"), (None, None, "<article><p>Some words stand here, and then some more of them follow.</article>", 1, "x"), (2, "u", "<article><p>" + "word and word. " * 50_000, 1, "x")]
    df = session.createDataFrame(rows, "page_id long, url string, html string, n_chars int, path string")
    out = op13.extract(df, op13.fitted(df)).collect()
    assert [r["text"][:10] for r in out] == ["", "", "Some words", "word and w"] and len(out[3]["text"]) == 50_000 * 15 - 1
    none = df.filter("false")
    assert op13.extract(none, op13.fitted(none)).collect() == []
