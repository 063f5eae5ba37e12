"""Layouts of web pages with labelled slots, to learn from.

In a layout, ``{TITLE}``, ``{HEAD}``, ``{TEXT}``, ``{LINES}``, ``{QUOTE}`` and ``{CODE}`` are slots of main text, which starts with ``MARK`` in the
made page; ``{links}``, ``{list}``, ``{short}``, ``{long}``, ``{replies}`` and ``{fields}`` are slots of all else; ``<menu>``-like names
in double brackets stand for one of the usual names of such a container.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

#: A character of the private use area, before every piece of main text.
MARK = "\ue000"

#: Usual names of containers.
NAMES = {
    "menu": ["nav", "menu", "navbar", "main-menu", "topnav", "site-navigation", "mainNav", "breadcrumbs"],
    "head": ["header", "masthead", "site-header", "banner", "top", "topbar", "page-header"],
    "foot": ["footer", "site-footer", "foot", "colophon", "bottom", "copyright", "page-footer"],
    "side": ["sidebar", "side", "widget-area", "rail", "secondary", "right-col sidebar", "related", "related-posts", "recommended", "popular"],
    "body": ["content", "main", "post", "entry", "article-body", "entry-content", "story", "post-content", "main-content", "text", "articleText", "prose"],
    "outer": ["wrapper", "container", "page", "site", "outer", "layout", "row", "grid", "inner"],
    "replies": ["comments", "comment-list", "comments-area", "disqus_thread", "responses", "discussion", "reader-comments"],
    "reply": ["comment", "comment-body", "reply", "comment depth-1", "response", "comment-content"],
    "advert": ["ad", "ads", "advert", "advertisement", "sponsored", "ad-slot", "promo", "banner-ad"],
    "notice": ["cookie", "cookie-banner", "notice", "consent", "alert", "gdpr", "newsletter", "subscribe-box", "popup", "modal", "site-notice"],
    "share": ["share", "social", "sharing-buttons", "meta", "byline", "tags", "post-meta"],
    "form": ["search", "login", "contact-form", "searchform", "signup"],
    "any": ["x1", "css-1kq2", "a3f", "blk", "sc-bd", "u-mt", "col", "box", "el", "c2"],
}

LAYOUTS = (
    # Tags that say what they are.
    '<body><header class="[[head]]"><a href="/">{short}</a><nav><ul>{list}</ul></nav></header><div class="[[notice]]"><p>{long}</p></div><main><article><header><h1>{TITLE}</h1></header>{TEXT}'
    "<h2>{HEAD}</h2>{TEXT}</article><section class='[[replies]]'><h2>{short}</h2>{replies}</section></main><aside><h3>{short}</h3><ul>{list}</ul><p>{long}</p></aside><footer><p>{long}</p>{links}</footer></body>",
    "<body><nav><ul>{list}</ul></nav><div class='[[advert]]'>{long}</div><article><h1>{TITLE}</h1>{TEXT}{LINES}</article><footer>{short} {long}</footer></body>",
    '<body><nav>{links}</nav><article><h1>{TITLE}</h1><div class="[[share]]">{short}</div>{TEXT}<aside><p>{long}</p></aside>{TEXT}<div class="[[advert]]"><p>{long}</p></div>{QUOTE}{TEXT}'
    "<footer>{short}</footer><section id='[[replies]]'>{replies}</section></article><footer>{long}</footer></body>",
    '<body><div class="[[notice]]" role="dialog">{long} <button>OK</button></div><header>{short}</header><main><h1>{TITLE}</h1>{TEXT}<h2>{HEAD}</h2>{TEXT}{CODE}{LINES}</main><aside class="[[side]]">{long}<ul>{list}</ul></aside><footer>{links}</footer></body>',
    # Divisions that are told by their names.
    '<body><div id="[[head]]"><div class="logo">{short}</div></div><div id="[[menu]]"><ul>{list}</ul></div><div id="[[outer]]"><div id="[[body]]"><h1>{TITLE}</h1>{TEXT}<h3>{HEAD}</h3>{TEXT}</div>'
    '<div id="[[side]]"><h4>{short}</h4><ul>{list}</ul><p>{long}</p></div><div id="[[replies]]"><h3>{short}</h3>{replies}</div></div><div id="[[foot]]"><p>{long}</p></div></body>',
    '<body><div class="[[outer]]"><div class="[[menu]]">{links}</div><div class="[[outer]]"><div class="[[body]]"><h2>{TITLE}</h2><div class="[[share]]">{short}</div>{TEXT}{TEXT}<div class="[[share]]">{links}</div></div>'
    '<div class="[[replies]]">{replies}<form class="[[form]]"><p>{long}</p>{fields}</form></div></div><div class="[[side]]"><p>{long}</p></div></div><div class="[[foot]]">{short}<br>{long}</div></body>',
    '<body class="single post"><div class="[[notice]]">{long}</div><div class="[[head]]"><h1>{short}</h1><p>{short}</p></div><div class="[[body]]"><h1 class="entry-title">{TITLE}</h1><div class="entry">{TEXT}<div class="[[advert]]">{short}</div>{TEXT}</div>'
    '<ol class="[[replies]]"><li class="[[reply]]"><div class="content"><p>{long}</p></div></li><li class="[[reply]]"><p>{long}</p><p>{long}</p></li></ol></div><div class="[[side]]"><div class="widget">{long}<ul>{list}</ul></div></div><div class="[[foot]]">{links}</div></body>',
    # Names that say nothing; the texts tell.
    '<body><div class="[[any]]">{links}</div><div class="[[any]]"><div class="[[any]]"><h1>{TITLE}</h1><div class="[[any]]">{TEXT}</div>{TEXT}</div></div><div class="[[any]]"><ul>{list}</ul></div><div class="[[any]]">{short}</div></body>',
    "<body><h1>{TITLE}</h1>{TEXT}<h2>{HEAD}</h2>{TEXT}{LINES}{QUOTE}</body>",
    "<body>{TEXT}</body>",
    "{TITLE}<p>{LINES}{TEXT}",
    "<body><div>{TEXT}</div></body>",
    # Tables, frames of old pages, pages that are one form.
    '<body><table><tr><td colspan="2">{links}</td></tr><tr><td width="150"><ul>{list}</ul>{short}</td><td class="[[body]]"><h1>{TITLE}</h1>{TEXT}<hr>{TEXT}</td></tr><tr><td colspan="2">{short}</td></tr></table></body>',
    '<body><center>{links}</center><hr><h2>{TITLE}</h2>{TEXT}<table><tr><td>{HEAD}</td><td>{HEAD}</td></tr></table>{TEXT}<hr><address>{short}</address></body>',
    '<body><form id="aspnetForm" action="/"><div id="[[menu]]"><ul>{list}</ul></div><div id="[[body]]"><h1>{TITLE}</h1>{TEXT}{TEXT}</div><div id="[[side]]">{long}<label>{short}</label>{fields}</div><div id="[[foot]]">{short}</div></form></body>',
    # A page of links with little to read; a shop's or a login page's forms around it.
    '<body><header>{links}</header><form class="[[form]]"><label>{short}</label>{fields}<p>{long}</p></form><div class="[[body]]"><h1>{TITLE}</h1>{TEXT}</div><section class="[[side]]"><h3>{short}</h3><ul>{list}</ul><div><a href="/">{long}</a></div></section><footer>{links}<p>{long}</p></footer></body>',
    '<body><article class="[[any]]"><h1>{TITLE}</h1>{TEXT}{TEXT}</article><div class="[[replies]]"><article class="[[reply]]"><p>{long}</p></article><article class="[[reply]]"><header>{short}</header><p>{long}</p></article></div><footer>{long}</footer></body>',
)

_SLOT = re.compile(r"\{(\w+)\}|\[\[(\w+)\]\]")
_VOWELS, _CONSONANTS = "aeiou", "bcdfghlmnprstv"


def sentence(rng: random.Random, least: int = 4, most: int = 24) -> str:
    """A sentence of made-up words."""
    words = ["".join(rng.choice(_CONSONANTS) + rng.choice(_VOWELS) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(least, most))]
    text = words[0].capitalize() + "".join((", " if rng.random() < 0.1 else " ") + w for w in words[1:])
    return text + rng.choice(("." * 8) + "!?")


def made_pages(rng: random.Random, count: int, sentences: list[str]) -> Iterator[str]:
    """``count`` pages, the layouts in turn.  Texts are pieces of ``sentences``, or made up; menus, notices and replies take theirs from the same."""

    def piece(least: int, most: int) -> str:
        if sentences and rng.random() < 0.6:
            words = rng.choice(sentences).split()
            start = rng.randrange(max(1, len(words) - least))
            text = " ".join(words[start : start + rng.randint(least, most)]).replace("&", "&amp;").replace("<", "&lt;")
        else:
            text = sentence(rng, least, most)
        return text or "a"

    def paragraph() -> str:
        kind = rng.random()
        if kind < 0.12:
            return piece(1, 4)
        return " ".join(piece(5, 40) for _ in range(1 if kind < 0.4 else rng.randint(1, 6)))

    def words(n: int) -> str:
        return piece(1, n).rstrip(".!?,")

    def marked(tag: str, text: str) -> str:
        if rng.random() < 0.15:
            text = f"<b>{text}</b>"
        if rng.random() < 0.1:
            text = f'{text} <a href="/{rng.randint(1, 99)}">{words(2)}</a>'
        shut = "" if tag == "p" and rng.random() < 0.2 else f"</{tag}>"
        return f"<{tag}>{MARK}{text}{shut}"

    def fill(name: str) -> str:
        if name in NAMES:
            return rng.choice(NAMES[name])
        if name in ("TITLE", "HEAD"):
            return MARK + words(12)
        if name == "TEXT":
            tag = rng.choice(("p", "p", "p", "p", "div"))
            return "".join(marked(tag, paragraph()) for _ in range(rng.randint(1, 6)))
        if name == "LINES":
            return "<ul>" + "".join(marked("li", piece(2, 25)) for _ in range(rng.randint(2, 5))) + "</ul>"
        if name == "QUOTE":
            return "<blockquote>" + marked("p", paragraph()) + "</blockquote>"
        if name == "CODE":
            return marked("pre", piece(3, 20))
        if name == "links":
            return rng.choice((" ", " | ", " · ", "")).join(f'<a href="/{words(1)}">{words(3)}</a>' for _ in range(rng.randint(2, 8)))
        if name == "list":
            return "".join(f'<li><a href="/{words(1)}">{words(3)}</a></li>' for _ in range(rng.randint(2, 9)))
        if name == "short":
            return rng.choice(("", "", "&copy; ", "By ", "© 2020 ")) + words(5)
        if name == "long":
            return rng.choice(("", "", "", "&copy; ")) + " ".join(piece(4, 30) for _ in range(rng.randint(1, 4)))
        if name == "replies":
            tag = rng.choice(("div", "li", "p", "article"))
            body = "".join(f'<{tag} class="{rng.choice(NAMES["reply"])}"><b>{words(2)}</b> <p>{paragraph()}</p></{tag}>' for _ in range(rng.randint(1, 6)))
            return body
        if name == "fields":
            return f'<input name="q"><select><option>{words(2)}</select><button>{words(2)}</button>'
        raise ValueError(f"no slot {name}")

    for k in range(count):
        yield _SLOT.sub(lambda m: fill(m.group(1) or m.group(2)), LAYOUTS[k % len(LAYOUTS)])
