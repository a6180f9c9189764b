"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive, the more so the more their context (the elements
and named containers around them) is one of main text; tags score negative, the more so the more they are found
around other text. Both weights come from labelled pages. One linear scan finds the contiguous region with the
greatest sum, and the text is what stands in the region in contexts of main text. Words in other contexts score
nothing, and a whole stretch of them costs ``STRETCH`` at most, so an advert inside an article does not cut it in two.

Labelled pages are ``SEED_PAGES`` here, labelled by hand, and a bounded sample of the given pages that mark
their own article, labelled by that mark.

Defined results: null and empty pages, and pages without main text, give the empty text; of regions with equal
sums the first is taken; repeated rows each get their text; a cut-off page gives the text up to the cut. Extra columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecquery.llm.common import fit_logistic, hashed_sample
from vecquery.llm.html_parse import BIT, FLAGS, Piece, parse

#: Bounds of the sample of pages that weights are learned from.
SAMPLE_PAGES = 300
SAMPLE_PAGE_CHARS = 50_000
#: The most a stretch of words and tags outside main text takes from a region's sum.
STRETCH = 2.0

_TEXT = "The first settlers came by boat in spring and built their houses on the eastern bank where the river is wide. "

#: Pages labelled by hand: text in ``[[...]]`` is main text, all other text is not.
SEED_PAGES = tuple(
    page.replace("@", _TEXT)
    for page in (
        "<body><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav><div><h1>[[The settlers]]</h1><p>[[@@]]<p>[[@ <a href=x>more of it</a> @]]"
        "</div><footer>Imprint and contact</footer></body>",
        "<body><header>The daily paper, founded long ago</header><main><h1>[[Rivers]]</h1><p>[[@]]</p><aside>Read more stories here</aside><p>[[@@]]</p>"
        "<ul><li>[[@]]</li><li>[[@]]</li></ul></main><div class=sidebar><p>Most read today: ten things</p></div></body>",
        "<div class='cookie-notice'><p>We use cookies on this site, please accept them.</p></div><div id=content><h2>[[Boats]]</h2><p>[[@@]]</p>"
        "<div class='ad'>Buy this boat now and save a lot</div><p>[[@]]</p></div><div id=comments><p>Nice story, I liked it a lot!</p><p>@</p></div>",
        "<article><h1>[[Houses]]</h1><p>[[@]]<p>[[@@]]<table><tr><td>[[@]]</td><td>[[five]]</td></tr></table><blockquote>[[@]]</blockquote></article>"
        "<section class=comments><article><p>First! @</p></article></section><form><label>Name</label><p>Leave a reply below</p></form>",
        "<div class=top-menu><a>One</a> <a>Two</a> <a>Three</a></div><div class=post>[[@@@]]<br>[[@]]</div><div class=related><a>@</a><p>Another story</p></div>"
        "<div class=share>Share this on your network</div><div class=footer>All rights reserved</div>",
        "<div><p>[[@]]</p><p>[[@]]</p><div class=newsletter><p>Subscribe to our letter, it is free.</p></div><p>[[@@]]</p><pre>[[@]]</pre></div>"
        "<aside class=promo><h3>Offers</h3><p>Cheap boats, today only</p></aside><div role=alert>Your session ends soon</div>",
        "<main><section><h2>[[Spring]]</h2><div>[[@@]]</div><div class=sponsored>Paid content by a sponsor</div><div>[[@]]</div></section></main>"
        "<div class=widget><h4>Weather</h4><ul><li>Sunny today</li></ul></div><form action=/s><p>Search this site</p><button>Go</button></form>",
        "<body>[[@@@]]</body>",
        "<ul class=nav><li>News</li><li>Sports</li></ul><dl><dt>[[Bank]]</dt><dd>[[@]]</dd></dl><p>[[@]]</p><div class=banner>Sale ends soon</div>",
    )
)

#: Containers that hold no main text, wherever they stand, and what may be inside them.
_OUTSIDE = (
    "<nav>#</nav>", "<div class=menu>#</div>", "<header>#</header>", "<div id=header>#</div>", "<footer>#</footer>",
    "<div class=footer>#</div>", "<aside>#</aside>", "<div class=sidebar>#</div>", "<div class=related>#</div>", "<div class=ad>#</div>",
    "<div class=sponsored>#</div>", "<div class=cookie-notice>#</div>", "<div class=newsletter>#</div>", "<section id=comments>#</section>",
    "<div class=comment>#</div>", "<form>#</form>", "<div class=search>#</div>", "<div class=share>#</div>",
)
_INSIDE = ("@", "<p>@</p>", "<h3>@</h3><p>@</p>", "<ul><li>@</li><li>@</li></ul>", "<p><a href=/>@</a></p>", "<table><tr><td>@</td></tr></table>")
SEED_PAGES += tuple(
    page.replace("#", inner).replace("@", _TEXT).replace("%", f"<p>[[{_TEXT}]]</p>")
    for outer in _OUTSIDE
    for inner in _INSIDE
    for page in (f"<article>%{outer}%</article>", f"<main><h2>[[A day]]</h2>%%{outer}</main>", f"<body>{outer}<div>%%</div></body>")
)
#: Ordinary pages whose outermost names speak of parts that are elsewhere.
SEED_PAGES += tuple(
    f"{before}<nav><a href=/>Home</a></nav>{opened}<h1>[[Rivers]]</h1><p>[[{_TEXT}{_TEXT}]]</p><p>[[{_TEXT}]]</p>{closed}<footer>Imprint</footer>"
    for before, opened, closed in (
        ("<body class='has-sidebar no-comments'>", "<article>", "</article>"),
        ("<body>", "<main class='with-sidebar'>", "</main>"),
        ("<body>", "<article class='post comment-status-open'>", "</article>"),
        ("<body><form id=aspnetForm action=/p>", "<div>", "</div></form>"),
    )
)


@dataclass(frozen=True)
class Weights:
    """``words[mask]`` is worked out from ``context`` (one per flag, intercept last); ``tags`` by name."""

    context: tuple[float, ...]
    tags: dict[str, float]
    other_tag: float


def _labels(pieces: list[Piece], weak: bool) -> list[tuple[Piece, bool, int]]:
    """(piece, is main text, words): by the marks, or by what the page itself calls its content."""
    boilerplate = sum(BIT[f] for f in FLAGS[: FLAGS.index("link")])
    out, inside = [], False
    for p in pieces:
        if weak:
            main = bool(p.mask & BIT["content"]) and not p.mask & boilerplate
            out.append((p, main, len(p.text.split()) if p.text else 0))
            continue
        if p.text is None:
            touching = bool(out) and out[-1][1]  # a tag belongs to the text before it, or else to that behind it
            out.append((p, touching or inside, 0))
            continue
        rest = p.text
        while rest:
            mark = "]]" if inside else "[["
            part, found, rest = rest.partition(mark)
            if inside:
                for i in range(len(out) - 1, -1, -1):
                    if out[i][0].text is not None or out[i][1]:
                        break
                    out[i] = (out[i][0], True, 0)
            if part.strip():
                out.append((p, inside, len(part.split())))
            inside = not inside if found else inside
    return out


def learn(pages: list[str]) -> Weights:
    """Weights from the hand-labelled pages and from ``pages`` that mark their own content."""
    words: Counter = Counter()
    tags: dict[bool, Counter] = {True: Counter(), False: Counter()}
    parsed = [(parse(p), False) for p in SEED_PAGES for _ in range(3)]
    parsed += [(q, True) for q in map(parse, pages) if any(p.mask & BIT["content"] for p in q)]
    hidden = ~(BIT["content"] | BIT["outside"])
    for pieces, weak in parsed:
        for p, main, n in _labels(pieces, weak):
            if p.text is None:
                tags[main][p.name] += 1
            elif n:
                words[p.mask, main] += n
                words[p.mask & hidden, main] += n  # the same page, had it not marked its content
    masks = np.array([m for m, _ in words])
    x = (masks[:, None] >> np.arange(len(FLAGS)) & 1).astype(float)
    y = np.array([main for _, main in words], dtype=float)
    n = np.array(list(words.values()), dtype=float)
    n = np.minimum(n, n.sum() / 20)  # no context outweighs all others
    context = fit_logistic(x, y, n / n.sum() * 2_000, ridge=0.05)
    names = set(tags[True]) | set(tags[False])
    totals = {k: sum(c.values()) + len(names) for k, c in tags.items()}
    odds = {t: np.log((tags[False][t] + 1) / totals[False]) - np.log((tags[True][t] + 1) / totals[True]) for t in names}
    return Weights(tuple(context), {t: float(np.clip(0.3 + 0.5 * o, 0.05, 2.0)) for t, o in odds.items()}, 0.3)


def extract(html: str | None, weights: Weights, seen: dict[int, float] | None = None) -> str:
    """Main text of a page."""
    if not html:
        return ""
    seen = {} if seen is None else seen
    pieces = parse(html)
    best, best_at, total, begin, stretch = 0.0, (0, 0), 0.0, 0, 0.0
    for i, p in enumerate(pieces):
        word = seen.get(p.mask)
        if word is None:
            word = seen[p.mask] = _word_weight(p.mask, weights)
        if p.text is None:
            gain = -weights.tags.get(p.name, weights.other_tag)
        else:
            gain = word * len(p.text.split())
        if gain > 0:
            stretch = 0.0
        elif word <= 0:  # a stretch outside main text costs only so much
            gain = max(gain, stretch - STRETCH)
            stretch -= gain
        total += gain
        if total <= 0:
            total, begin, stretch = 0.0, i + 1, 0.0
        elif total > best:
            best, best_at = total, (begin, i + 1)
    blocks: list[str] = []
    number = None
    for p in pieces[best_at[0] : best_at[1]]:
        if p.text is None:
            if p.name == "br" and number == p.block:
                blocks[-1] += " "
        elif seen[p.mask] > 0:
            if p.block != number:
                blocks.append("")
                number = p.block
            blocks[-1] += p.text
    return "\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)


def _word_weight(mask: int, weights: Weights) -> float:
    logit = weights.context[-1] + sum(w for i, w in enumerate(weights.context[:-1]) if mask >> i & 1)
    return float(min(max(logit, 0.0), 2.0)) / 2


def learn_from(pages: DataFrame) -> Weights:
    """Weights learned with a bounded sample of the pages, chosen by a hash of the page."""
    rows = pages.filter(F.length("html").between(1, SAMPLE_PAGE_CHARS))
    return learn(hashed_sample(rows, "html", SAMPLE_PAGES))


def text_column(weights: Weights, html: str = "html") -> Column:
    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen: dict[int, float] = {}
        for batch in batches:
            yield pd.Series([extract(h, weights, seen) for h in batch.tolist()], dtype="object")

    return extracted(F.col(html))
