from __future__ import annotations

import itertools
import random
import time

import pytest

from sluice.llm.main_text import blocks, extract, main_text, source_side

LOREM = "A sentence of some length that reads like the body of an article, with commas and an end. "


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


ARTICLE = f"<h1>The heading</h1><p>{LOREM * 3}</p><p>{LOREM * 2}<b>bold</b> end.</p><p>Short one.</p>"
TEXT = "\n\n".join(["The heading", (LOREM * 3).strip(), f"{LOREM * 2}bold end.", "Short one."])


@pytest.mark.parametrize(
    "before,after",
    [
        ("<nav><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></nav>", "<footer>&copy; 2020 Us</footer>"),
        ("<header><h2>My site</h2><p>The best site there is.</p></header>", f"<aside><p>{LOREM}</p></aside>"),
        (f"<div class='cookie-banner'><p>{LOREM}</p></div>", f"<div id=comments><p>{LOREM}</p><p>{LOREM}</p></div>"),
        (f"<div class=ad>{LOREM}</div>", f"<div class='sidebar widget'><p>{LOREM * 3}</p></div>"),
        ("<form><label>Mail</label><input name=a><button>Go</button></form>", "<script>var a='<p>x</p>';</script>"),
        ("<!-- <p>hidden</p> -->", f"<section class='related-posts'><a href=a>{LOREM}</a></section>"),
        ("", f"<noscript>{LOREM}</noscript><div role=contentinfo>{LOREM}</div>"),
    ],
)
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>"])
def test_what_is_not_the_article_goes(before, after, wrap):
    assert main_text(page(before + wrap.format(ARTICLE) + after)) == TEXT


def test_things_inside_the_article_go_too():
    inside = ARTICLE.replace("<p>Short", "<div class=advert>Buy this now, it is very good.</div><p>Short")
    assert main_text(page(f"<article>{inside}</article>")) == TEXT


def test_references_white_space_and_broken_markup():
    html = f"<article><p>a &amp; b&#33; &lt;i&gt; \n\t c<br>d {LOREM}<p><b>open {LOREM}<br><p>x < y and {LOREM}</article>"
    assert main_text(html).split("\n\n") == [
        f"a & b! <i> c d {LOREM}".strip(),
        f"open {LOREM}".strip(),
        f"x < y and {LOREM}".strip(),
    ]
    cut = page(f"<article><p>{LOREM}</p><p>{LOREM} unfinished &am")
    assert main_text(cut[: cut.index("</body>")]).endswith("unfinished &am")


@pytest.mark.parametrize("html", [None, "", "   ", "<html></html>", "<p>", "<", "<!--", "<script>x", "<nav>a</nav>", "</p></p>"])
def test_pages_without_text(html):
    assert main_text(html) == ""


def test_plain_text_and_lists():
    assert main_text(LOREM * 4) == (LOREM * 4).strip()
    items = "".join(f"<li>{LOREM}" for _ in range(3))
    assert main_text(f"<article><p>{LOREM}</p><ul>{items}</ul></article>").count(LOREM.strip()) == 4
    rows = "".join(f"<tr><td>{LOREM}<td>{LOREM}" for _ in range(2))
    assert len(blocks(f"<table>{rows}</table>")) == 4


P = f"<p>{LOREM * 2}</p>"


@pytest.mark.parametrize(
    "between",
    [
        '<embed src="a.mp4">',
        '<svg width="5" viewBox="0 0 1 1"/>',
        "<math/>",
        "<svg><style/><path d='x'/><title>no</title></svg>",
        "<svg><path d='x'>",
        "<datalist id=d><option value=a>no<option value=b>no</datalist>",
        "<object data=a><object data=b>no</object>no</object>",
        "<div><video src=a></div>",
        "<video src=a />",
        "<iframe src=a />",
        "<select><option>no<optgroup label=x><option>no</select>",
    ],
)
@pytest.mark.parametrize("last", ["", "<svg><text>no</text></svg><video>no</video>"])
def test_silent_elements_end_where_they_end(between, last):
    assert main_text(f"<body>{P}{between}{P}{P}{last}") == "\n\n".join([(LOREM * 2).strip()] * 3)


@pytest.mark.parametrize(
    "head", ["<head><title>t</title><body>", "<head><title>t</title><meta charset=x>", "<html><head><style>x</style>"]
)
def test_a_head_without_an_end(head):
    assert main_text(f"{head}{P}{P}") == "\n\n".join([(LOREM * 2).strip()] * 2)
    assert main_text(f"{head}{LOREM * 4}") == (LOREM * 4).strip()


WRAPPERS = [
    "<form id=form1>{}</form>",
    "<div class='content has-sidebar'>{}</div>",
    "<div class=no-sidebar><div class=nav-open>{}</div></div>",
    "<div id=page-with-comments>{}</div>",
    "<section class=discussion>{}</section>",
    "<section class=legal>{}</section>",
    "<div class=overflow-hidden>{}</div>",
    "<form><div class=form-wrap><div class='sidebar-left'>{}</div></div></form>",
]


@pytest.mark.parametrize("wrap", WRAPPERS)
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
@pytest.mark.parametrize(
    "beside",
    [
        "",
        "<nav><a href=x>Home</a></nav><div class=ad>" + LOREM + "</div><footer><p>" + LOREM + "</p></footer>",
        f"<aside><p>{LOREM * 3}</p></aside><div class='cookie-banner'><p>{LOREM}</p></div>",
        f"<div id=comments><p>{LOREM}</p><p>{LOREM}</p></div><form><label>Mail</label><input></form>",
    ],
)
def test_marks_on_a_wrapper_do_not_take_the_article(wrap, inner, beside):
    article = inner.format(ARTICLE)
    assert main_text(page(wrap.format(article + beside))) == TEXT
    assert main_text(page(wrap.format(article) + beside)) == TEXT


@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>"])
def test_marks_beside_the_article_stand(inner):
    comments = f"<div id=comments><div class=content>{P * 8}</div></div>"
    cards = f"<div class=related><article class=related-card>{P}</article></div>"
    form = f"<form class=signup><p>{LOREM * 2}</p></form>"
    assert main_text(page(inner.format(ARTICLE) + comments + cards + form)) == TEXT
    nested = f"<main><article class=post><div class=entry><div class=story>{ARTICLE}<aside>{P}</aside></div></div></article></main>"
    assert main_text(page(nested)) == TEXT


def test_silent_elements_within_a_line():
    assert main_text(f"<p>{LOREM}<svg><g><text>no</text></g></svg>and <button>no<b>no</b></button>{LOREM}</p>") == (
        f"{LOREM}and {LOREM}".strip()
    )


def test_very_long_pages():
    html = page("<article>" + f"<p>{LOREM}</p>" * 20_000 + "</article>" + "<nav><a href=x>y</a></nav>" * 500)
    assert main_text(html).count("\n\n") == 19_999
    deep = "<div>" * 3000 + LOREM * 5 + "</div>" * 3000
    assert main_text(deep) == (LOREM * 5).strip()


def test_the_cut_is_a_least_one():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(1, 8)
        gains = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [
            (a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5
        ]

        def cost(side, gains=gains, edges=edges):
            own = sum(-g if s and g < 0 else g if not s and g > 0 else 0 for s, g in zip(side, gains))
            return own + sum(c for a, b, c in edges if side[a] != side[b])

        best = min(cost(s) for s in itertools.product([False, True], repeat=n))
        assert cost(source_side(gains, edges)) == pytest.approx(best)


def test_extract(spark):
    rows = [(1, "u", page(f"<article>{ARTICLE}</article>"), "x"), (2, None, None, "y"), (2, None, "", None), (None, "v", "<p>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages).collect()
    assert sorted(got[0].asDict()) == ["n_chars", "page_id", "text", "url"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == sorted(
        [(1, TEXT, len(TEXT)), (2, "", 0), (2, "", 0), (0, "", 0)]
    )
    assert extract(pages.filter("false")).count() == 0


def test_given_pages_give_their_article(spark):
    import html as references
    import re

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for row in rows:
        inside = row.html[row.html.index("<article>") + 9 : row.html.index("</article>")]
        parts = [" ".join(references.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", inside)]
        assert main_text(row.html) == "\n\n".join(p for p in parts if p)


MALFORMED = {
    "open names": ("a<b ", ""),
    "open paragraphs": ("<p ", ""),
    "open quotes": ('<a "', ""),
    "quotes with an end": ('<a "', ">"),
    "one name": ("<a", " '>"),
    "ends": ("</x ", ""),
    "declarations": ("<!", ""),
    "deep": ("<div>", ""),
    "links": ("x<a>", ""),
    "list items": ("<li>x", ""),
    "rows": ("<tr><div>x", ""),
    "headers": ("<div><header>", ""),
    "an attribute": ("=a", " x/>"),
    "deep and ends that fit nothing": ("<div></x>", ""),
}


@pytest.mark.parametrize("unit,tail", MALFORMED.values(), ids=list(MALFORMED))
def test_a_malformed_page_takes_time_by_its_length(unit, tail):
    began = time.perf_counter()
    main_text("<p>First." + unit * (1_000_000 // len(unit)) + tail)
    assert time.perf_counter() - began < 6  # quadratic ones would take an hour


def test_ends_that_fit_nothing_are_passed_over():
    assert main_text("<div>" * 3000 + "</x>" * 3000 + f"<p>{LONG}</p>") == LONG


COMMENTS = {
    "en": ("Comments (3)", "comments"),
    "de": ("3 Kommentare", "kommentare"),
    "fr": ("Commentaires", "commentaires"),
    "es": ("Comentarios:", "comentarios"),
}
LONG = "A sentence of the article that is long enough to count as a paragraph of it, and goes on for a while."


@pytest.mark.parametrize("heading,name", COMMENTS.values(), ids=list(COMMENTS))
def test_comments_of_readers_by_name_and_by_heading(heading, name):
    article = f"<article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></article>"
    said = f"<p>{LONG.replace('article', 'reader')}</p>"
    want = f"Title\n\n{LONG}\n\n{LONG}"
    assert main_text(f"<body>{article}<div class='{name}'>{said}</div></body>") == want
    assert main_text(f"<body>{article}<section><h2>{heading}</h2>{said}{said}</section></body>") == want
    # in the middle of a text it is a heading like others
    inside = f"<article><h1>Title</h1><div><p>{LONG}</p><h2>{heading}</h2><p>{LONG}</p></div></article>"
    assert main_text(f"<body>{inside}</body>").count(LONG) == 2
