"""Leaf blocks of a web page: runs of text that no block-level tag breaks, with the path of elements above them.

One pass with a stack of open elements.  Missing end tags are implied as browsers imply them, stray ones are passed over, a
page may end anywhere.  Every path of block-level elements is held once, with its features, and found again by its last
step, so pages built alike share them.
"""

from __future__ import annotations

import html as entities
import re

#: Elements that end a run of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements without an end tag; elements whose content is raw text; elements that hold no text of the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SILENT = frozenset("script style textarea title iframe noembed noframes noscript template select datalist button svg object canvas audio video head".split())
#: What a start tag closes, and what keeps it from looking further up.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tfoot", "tr", "td", "th")}
CLOSES |= {"tfoot": CLOSES["tbody"], "thead": CLOSES["tbody"]}
FENCES = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "tbody": ("table",), "tfoot": ("table",), "thead": ("table",)}
SCOPE = frozenset("table td th caption html template object button".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?)?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Kinds of containers told by words of their class, id or role.
KINDS = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs crumbs toolbar tabs pagination pager skip toc",
    "head": "header masthead banner logo topbar branding top",
    "foot": "footer foot copyright colophon legal bottom contentinfo",
    "side": "sidebar side aside widget widgets rail related recommended popular trending complementary teaser teasers secondary recirc",
    "share": "share sharing social follow tags tag byline meta author date published",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay subscribe newsletter signup paywall disclaimer warning toast",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion outbrain taboola dfp",
    "reply": "comment comments disqus reply replies respond response responses discussion feedback review reviews guestbook",
    "form": "form search login register contact poll vote",
    "body": "article content entry post story main body text page prose copy",
    "hidden": "hidden invisible sr offscreen",
}
_KIND_OF = {word: kind for kind, words in KINDS.items() for word in words.split()}
#: Paths a worker remembers.
REMEMBERED = 50_000


class Path:
    """A path of block-level elements: what it tells about the text below it."""

    __slots__ = ("tag", "tags", "kinds", "near", "steps", "below", "features", "score")

    def __init__(self, tag: str, above: Path | None, words: tuple[str, ...]):
        self.tag = tag
        self.tags = (above.tags if above else frozenset()) | {tag}
        own = frozenset(_KIND_OF[w] for w in words if w in _KIND_OF)
        self.kinds = (above.kinds if above else frozenset()) | own
        self.near = own or (above.near if above else frozenset())
        self.steps = ((tag, words), *(above.steps[:2] if above else ()))
        self.below: dict = {}
        self.features = (
            [f"on={tag}"] + [f"in={t}" for t in sorted(self.tags)] + [f"kind={k}" for k in sorted(self.kinds)] + [f"near={k}" for k in sorted(self.near)]
            + [f"word={w}" for w in sorted({w for _, ws in self.steps for w in ws})] + ([f"up={self.steps[1][0]}"] if len(self.steps) > 1 else [])
        )
        self.score = None


class Scanner:
    """``leaves`` lists the blocks of a page: (path, text, characters in links)."""

    def __init__(self):
        self.root, self.known = Path("page", None, ()), 0

    def _below(self, above: Path, tag: str, attributes: str) -> Path:
        found = above.below.get((tag, attributes))
        if found is None:
            words: list[str] = []
            for name, value in _ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name in ("class", "id", "role"):
                    words.extend(w.lower() for w in _WORD.findall(value))
                elif name == "hidden" or (name == "style" and "none" in value and "display" in value) or (name == "aria-hidden" and "true" in value):
                    words.append("hidden")
            found = Path(tag, above, tuple(dict.fromkeys(words))[:12])
            above.below[tag, attributes] = found
            self.known += 1
        return found

    def leaves(self, page: str) -> list[tuple[Path, str, int]]:
        if self.known > REMEMBERED:
            self.root, self.known = Path("page", None, ()), 0
        out: list[tuple[Path, str, int]] = []
        # Open elements with the path that holds inside them; how often each tag is open.
        stack: list[tuple[str, Path]] = [("", self.root)]
        opened: dict[str, int] = {}
        parts: list[str] = []
        linked = silent = links = 0

        def flush():
            nonlocal linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    out.append((stack[-1][1], text, linked))
                parts.clear()
            linked = 0

        def pop_to(depth: int):
            nonlocal silent, links
            while len(stack) > depth:
                tag = stack.pop()[0]
                opened[tag] -= 1
                silent -= tag in SILENT
                links -= tag == "a"

        def look_up(tags, fences) -> int:
            """Depth of the nearest open element of ``tags``, or 0."""
            if not any(opened.get(t) for t in tags):
                return 0
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in tags:
                    return depth
                if stack[depth][0] in fences:
                    return 0
            return 0

        def end_of(tag: str):
            """Close the nearest open ``tag``; an inline element leaves the blocks inside it open."""
            nonlocal links
            depth = look_up((tag,), () if tag in BLOCKS or tag in SILENT else SCOPE)
            if depth and (tag in BLOCKS or tag in SILENT):
                pop_to(depth)
            elif depth:
                del stack[depth]
                opened[tag] -= 1
                links -= tag == "a"

        def say(text: str):
            nonlocal linked
            if not silent:
                text = entities.unescape(text) if "&" in text else text
                parts.append(text)
                linked += len(text) if links else 0

        at, size = 0, len(page)
        while at < size:
            sign = page.find("<", at)
            if sign < 0:
                say(page[at:])
                break
            if sign > at:
                say(page[at:sign])
            nxt = page[sign + 1 : sign + 2]
            if nxt == "!" or nxt == "?":
                if page.startswith("<!--", sign):
                    end = page.find("-->", sign + (2 if page.startswith(("<!-->", "<!--->"), sign) else 4))
                    at = size if end < 0 else end + 3
                else:
                    end = page.find(">", sign)
                    at = size if end < 0 else end + 1
                continue
            closing = nxt == "/"
            name = _NAME.match(page, sign + 1 + closing)
            if not name:
                if closing:
                    end = page.find(">", sign)
                    at = size if end < 0 else end + 1
                else:
                    say("<")
                    at = sign + 1
                continue
            tag, at = name.group().lower(), name.end()
            start = at
            while at < size and page[at] != ">":
                match = _ATTRIBUTE.match(page, at)
                at = match.end() if match and match.end() > at else at + 1
            attributes, at = page[start:at], at + 1
            if closing:
                if tag in BLOCKS:
                    flush()
                if opened.get(tag):
                    end_of(tag)
                elif tag == "br":
                    say(" ")
                continue
            if tag in BLOCKS:
                flush()
                if opened.get("p") and tag not in ("body", "html"):
                    depth = look_up(("p",), SCOPE)
                    if depth:
                        pop_to(depth)
                if tag in CLOSES:
                    while depth := look_up(CLOSES[tag], FENCES[tag]):
                        pop_to(depth)
            elif tag == "br":
                say(" ")
            if tag in VOID or (tag in ("body", "html") and opened.get(tag)):
                continue
            if tag == "body" and opened.get("head"):
                pop_to(look_up(("head",), ()))
            if tag == "a" and opened.get("a"):
                end_of("a")
            if tag in RAW:
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
                if tag == "xmp":
                    say(page[at : end.start() if end else size].replace("&", "&amp;"))
                at = size if end is None else end.start()
                if end:
                    close = page.find(">", at)
                    at = size if close < 0 else close + 1
                continue
            if tag == "svg" and attributes.endswith("/"):
                continue
            stack.append((tag, self._below(stack[-1][1], tag, attributes.strip()) if tag in BLOCKS else stack[-1][1]))
            opened[tag] = opened.get(tag, 0) + 1
            silent += tag in SILENT
            links += tag == "a"
        flush()
        return out
