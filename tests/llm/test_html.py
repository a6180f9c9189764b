import random

import pytest

from vecquery.llm import html_text
from vecquery.llm.html_parse import BIT, parse

WORDS = "the river ran under a stone bridge and boats came home in spring".split()


@pytest.fixture(scope="module")
def weights():
    return html_text.learn([])


def para(draw, n=30):
    return " ".join(draw.choice(WORDS) for _ in range(n))


def test_article_without_the_rest(weights):
    draw = random.Random(1)
    for _ in range(40):
        a, b, c, head = para(draw), para(draw), para(draw, 8), para(draw, 4)
        aside = draw.choice(["<aside>{}</aside>", "<div class='ad-slot'><p>{}</p></div>", "<div id=comments><p>{}</p></div>", "<form><p>{}</p></form>", "<div class=cookieBanner><p>{}</p></div>"]).format(para(draw, draw.choice([5, 60])))
        before = draw.choice(["<nav><ul><li><a href=/>Home</a></li></ul></nav>", "<header><p>Our paper</p></header>", "<div class='top menu'><a>one</a></div>"])
        open_, close = draw.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<div id=content>", "</div>"), ("", "")])
        page = f"<html><head><title>T</title><style>p{{}}</style></head><body>{before}{open_}<h1>{head}</h1><p>{a}</p>{aside}<p>{b}<p>{c}{close}{aside}<footer>&copy; me</footer><script>var t='</p>';</script>"
        assert html_text.extract(page, weights) == f"{head}\n{a}\n{b}\n{c}"


@pytest.mark.parametrize("before,opened,closed", [
    ("<body class='has-sidebar'>", "<article>", "</article>"), ("<body class='no-comments'>", "<div>", "</div>"),
    ("<body>", "<main class='with-sidebar'>", "</main>"), ("<body>", "<article class='post comment-status-open'>", "</article>"),
    ("<body><form id=aspnetForm action=/x>", "<div>", "</div></form>"), ("<body class='ad menu'>", "", ""),
    ("<body><div class='content-sidebar-wrap'>", "<main>", "</main></div>"), ("<body><div class='sidebar-layout'>", "<article>", "</article></div>"),
])
def test_names_of_the_whole_page_say_nothing(weights, before, opened, closed):
    draw = random.Random(2)
    a, b = para(draw, 60), para(draw, 40)
    rest = "<nav><a href=/>Home</a></nav>", "<div class=sidebar><p>Most read today</p></div><footer>Imprint</footer>"
    assert html_text.extract(f"{before}{rest[0]}{opened}<p>{a}</p><p>{b}</p>{closed}{rest[1]}", weights) == f"{a}\n{b}"


def test_long_comments_and_teasers_are_no_wrappers(weights):
    draw = random.Random(3)
    a, c = para(draw, 40), para(draw, 300)
    for around in ("<section class=comments><article>{}</article></section>", "<form><p>search</p></form><div id=comments>{}</div>"):
        assert html_text.extract(f"<body><article><p>{a}</p></article>{around.format(c)}", weights) == a
    side = "<aside class=related><article><p>{}</p></article></aside>".format(para(draw, 30))
    assert html_text.extract(f"<body><div><p>{a}</p><p>{a}</p></div>{side}", weights) == f"{a}\n{a}"


def test_white_space_and_references(weights):
    page = "<article><p> a&amp;b  <b>c</b>\n\t d&nbsp;e </p><p>f<br>g</p><p> </p><div>&lt;p&gt; &#233;&#x4e2d; &am</div></article>"
    assert html_text.extract(page, weights) == "a&b c d e\nf g\n<p> é中 &am"


def test_edges(spark, weights):
    pages = spark.createDataFrame(
        [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "<p>hello there you</p>", None), (3, "u", "<p>hello there you</p>", None),
         (None, "u", "<nav>only a menu</nav>", None), (4, "u", "<p>" * 60_000 + "word " * 100_000, None), (5, "u", "<a b=\"" * 3_000, None),
         (6, "u", "plain text", None), (7, "u", "<article><p>cut off in the midd", None), (8, "u", "<!-- never ends <p>x", None)],
        "page_id bigint, url string, html string, text string",
    )
    got = pages.select("page_id", html_text.text_column(weights).alias("t")).collect()
    by_id = {r["page_id"]: r["t"] for r in got}
    assert len(got) == 10 and by_id[1] == by_id[2] == by_id[None] == by_id[5] == by_id[8] == ""
    assert by_id[3] == "hello there you" and by_id[6] == "plain text" and by_id[7] == "cut off in the midd"
    assert by_id[4] == " ".join(["word"] * 100_000)
    assert html_text.learn_from(pages.limit(0)) == weights
    assert html_text.learn_from(pages).tags


def test_contexts():
    pieces = {p.text: p.mask for p in parse("<article><p>a<a>b</a></p><div class='commentList'>c</div></article>d") if p.text}
    assert pieces["a"] == BIT["content"] | BIT["paragraph"] and pieces["b"] & BIT["link"]
    assert pieces["c"] & BIT["comment"] and pieces["d"] & BIT["outside"]


def test_scan_finds_the_best_region(weights):
    """The linear scan against all regions, on pages without stretches outside main text."""
    draw = random.Random(2)
    for _ in range(60):
        page = "".join(draw.choice(["<p>", "<div>", "<h2>", "</div>", "<section>", "<td>", "word ", "word word "]) for _ in range(14))
        pieces = parse(page)
        gains = [
            -weights.tags.get(p.name, weights.other_tag) if p.text is None else html_text._word_weight(p.mask, weights) * len(p.text.split())
            for p in pieces
        ]
        sums = {(i, j): sum(gains[i:j]) for i in range(len(gains)) for j in range(i + 1, len(gains) + 1)}
        if not sums or max(sums.values()) <= 0:
            assert html_text.extract(page, weights) == ""
            continue
        (i, j), _ = max(sums.items(), key=lambda s: (round(s[1], 9), -s[0][0], -s[0][1]))
        words = sum(len(p.text.split()) for p in pieces[i:j] if p.text is not None)
        assert len(html_text.extract(page, weights).split()) == words
