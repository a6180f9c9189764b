"""Pages as a sequence of tags and words with the context they stand in."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

#: Contexts of a word; a word may be in several. Their order is that of the bits in a mask.
FLAGS = (
    "nav", "header", "footer", "side", "ad", "notice", "comment", "form", "social", "link", "item", "table", "paragraph",
    "heading", "content", "outside",
)
BIT = {name: 1 << i for i, name in enumerate(FLAGS)}

# Elements by what they mean for the text inside them.
_ELEMENT = {
    "nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "aside": "side", "form": "form", "select": "form",
    "button": "form", "textarea": "form", "label": "form", "fieldset": "form", "dialog": "notice", "a": "link", "li": "item",
    "dd": "item", "dt": "item", "td": "table", "th": "table", "p": "paragraph", "blockquote": "paragraph", "pre": "paragraph",
    "h1": "heading", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading",
    "article": "content", "main": "content",
}
# Parts of class, id and role names by what they mean.
_NAME = {
    word: flag
    for flag, words in {
        "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs",
        "header": "header masthead topbar banner hero",
        "footer": "footer foot copyright colophon contentinfo",
        "side": "sidebar aside side rail widget widgets related recommended recommendations complementary teaser trending",
        "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted adsense",
        "notice": "notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription paywall "
        "disclaimer notification dialog",
        "comment": "comment comments commentlist discussion discussions reply replies disqus respond reviews",
        "form": "form login signin signup search searchbox register contact",
        "social": "share sharing social follow tags",
        "content": "article articlebody story entry main",
    }.items()
    for word in words.split()
}
#: First parts of a name that tell of a part elsewhere on the page, and parts that tell of a state.
_ELSEWHERE = frozenset("has no with without".split())
_STATE = frozenset("status open opened closed enabled disabled".split())
_BOILERPLATE = sum(BIT[f] for f in FLAGS[: FLAGS.index("link")])
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "textarea tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
_ENDS_P = _BLOCKS - {"body", "html", "head", "option", "textarea"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|noscript|template|iframe|svg|math|object|noframes|canvas)\b[^>]*+(?:>.*?(?:</\1\s*+[^>]*+>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^\"'>])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=]|$)|display\s*:\s*none", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass(slots=True)
class Piece:
    """A tag (``text`` is None) or a text; ``block`` counts block boundaries passed so far."""

    name: str
    text: str | None
    mask: int
    block: int


def _name_flags(value: str) -> int:
    """Flags of a class, id or role. A name that tells of a part which is elsewhere, or of a state, has none."""
    mask = 0
    for token in value.split():
        parts = [part.lower() for part in _PART.findall(token)]
        if not parts or parts[0] in _ELSEWHERE or not _STATE.isdisjoint(parts):
            continue
        for part in parts:
            if flag := _NAME.get(part):
                mask |= BIT[flag]
    return mask


def _own_flags(name: str, attributes: str) -> int:
    mask = BIT[_ELEMENT[name]] if name in _ELEMENT else 0
    if attributes and name not in ("html", "body"):  # what the whole page is called says nothing about its text
        named = 0
        for m in _NAMED.finditer(attributes):
            named |= _name_flags(m[2] or m[3] or m[4] or "")
        if name in ("main", "article") and named & BIT["content"]:
            named = BIT["content"]
        mask |= named
        if _HIDDEN.search(attributes):
            mask |= BIT["notice"]
    return mask


def parse(html: str) -> list[Piece]:
    """Tags and texts in page order; scripts, styles, titles and comments are left out.

    An element named like boilerplate that is wrapped around the page's content is read as if it had no such name: one
    that holds ``main``, or a form, or one around an ``article``, that holds most of the page's words.
    """
    found, wrappers = _parsed(html, frozenset())
    return _parsed(html, wrappers)[0] if wrappers else found


def _parsed(html: str, ignored: frozenset[int]) -> tuple[list[Piece], frozenset[int]]:
    """Pieces, and the numbers of the elements that are wrappers; ``ignored`` ones have no flags of their own."""
    out: list[Piece] = []
    stack: list[tuple[str, int]] = [("", 0)]
    open_: dict[str, int] = {}
    block = at = number = 0
    contents = False
    # named like boilerplate: number -> [place on the stack, flags, words, holds main, most words of an article in it]
    named: dict[int, list[int]] = {}
    inside: list[int] = []  # those of them that are open
    articles: list[tuple[int, int]] = []  # place on the stack, words before
    words = 0

    def close(name: str) -> None:
        while open_.get(name):
            top, _ = stack.pop()
            while articles and articles[-1][0] >= len(stack):
                most = words - articles.pop()[1]
                for i in inside:
                    named[i][4] = max(named[i][4], most)
            while inside and named[inside[-1]][0] >= len(stack):
                inside.pop()
            open_[top] -= 1
            if top == name:
                return

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            out.append(Piece("", unescape(html[at : m.start()]), stack[-1][1], block))
            new = len(out[-1].text.split())
            words += new
            for i in inside:
                named[i][2] += new
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        ending = m[2] if m[3] else m[5]
        if name in _BLOCKS:
            block += 1
        if ending:
            out.append(Piece(name, None, stack[-1][1], block))
            close(name)
            continue
        if name in _ENDS_P and open_.get("p"):
            close("p")
        if name in ("li", "td", "th", "tr", "dd", "dt", "option") and stack[-1][0] == name:
            close(name)
        attributes = m[4] if m[3] else m[7] or ""
        number += 1
        own = 0 if number in ignored else _own_flags(name, attributes)
        mask = stack[-1][1] | own
        if name == "main":
            for i in inside:
                named[i][3] = 1
        contents = contents or bool(mask & BIT["content"])
        out.append(Piece(name, None, mask, block))
        if name not in _VOID and not attributes.endswith("/"):
            if name == "article":
                articles.append((len(stack), words))
            if own & _BOILERPLATE:
                named[number] = [len(stack), own, 0, 0, 0]
                inside.append(number)
            stack.append((name, mask))
            open_[name] = open_.get(name, 0) + 1
    if at < len(html):
        out.append(Piece("", unescape(html[at:]), stack[-1][1], block))
        new = len(out[-1].text.split())
        words += new
        for i in inside:
            named[i][2] += new
    for _, before in articles:
        for i in inside:
            named[i][4] = max(named[i][4], words - before)
    if contents:
        for p in out:
            if not p.mask & BIT["content"]:
                p.mask |= BIT["outside"]
    wrappers = frozenset(
        i for i, (_, own, own_words, holds_main, article) in named.items()
        if not own & BIT["comment"] and (holds_main or 2 * own_words > words and (own & BIT["form"] or 2 * article > words))
    )
    return out, wrappers
