from __future__ import annotations

import html
import re
import time

import pytest

from opine.llm.main_text import extract, main_text

LONG = "A sentence of the article that has a good many words, as articles do. "


def test_given_pages(spark, tiny):
    """The given pages hold their article in one element; read it off by its tags."""
    for row in extract(spark.read.parquet(f"{tiny}/pages.parquet")).collect():
        article = row.html[row.html.index("<article>") + 9 : row.html.index("</article>")]
        blocks = [re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", article)]
        lines = [" ".join(html.unescape(b).split()) for b in blocks]
        assert row.text == "\n".join(filter(None, lines))


@pytest.mark.parametrize(
    "furniture",
    [
        "<nav><a href=x>Home</a> and more</nav>",
        f"<header>{LONG}</header>",
        f"<footer>{LONG * 3}</footer>",
        f"<aside>{LONG * 3}</aside>",
        f"<div class='sidebar'>{LONG * 3}</div>",
        f"<div id=comments><p>{LONG * 3}</p><p>{LONG}</p></div>",
        f"<section class='reader-comments'><p>{LONG * 3}</p></section>",
        f"<div class='cookie-notice'>{LONG}</div>",
        f"<div class=\"ad\">{LONG}</div>",
        f"<div role='navigation'>{LONG}</div>",
        f"<div hidden>{LONG}</div>",
        f"<form><p>{LONG}</p><input name=q></form>",
        f"<script>var a = '<p>{LONG}</p>';</script>",
        f"<style>p > a {{}}</style><!-- <p>{LONG}</p> -->",
        "<ul class=menu><li><a href=1>One</a><li><a href=2>Two</a></ul>",
    ],
)
@pytest.mark.parametrize("holder", ["article", "main", "div"])
def test_furniture_is_left_out(furniture, holder):
    article = f"<{holder}><h1>Title</h1><p>{LONG}</p><p>{LONG * 2}</p></{holder}>"
    expected = f"Title\n{LONG.strip()}\n{(LONG * 2).strip()}"
    assert main_text(f"<html><body>{furniture}{article}</body></html>") == expected
    assert main_text(f"<html><body>{article}{furniture}</body></html>") == expected
    inside = article.replace(f"</{holder}>", f"{furniture}</{holder}>")
    if "header" not in furniture or holder == "div":
        assert main_text(f"<html><body>{inside}</body></html>") == expected


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>a &amp; b &lt;c&gt; &eacute;&#233;&#xe9; &copy;</p>", "a & b <c> ééé ©"),
        ("<p>one\n  two\tthree&nbsp; four</p>", "one two three four"),
        ("<p>one <b>bold</b><i>er</i>.</p>", "one bolder."),
        ("<p>one<p>two<br>three<div>four</div>", "one\ntwo three\nfour"),
        ("<ul><li>one<li>two</ul>", "one\ntwo"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("text without tags, 1 < 2 & 3", "text without tags, 1 < 2 & 3"),
        ("<p title='a > b'>shown</p>", "shown"),
        ('<p title="never closed>shown</p>', "shown"),
        ("<p>shown</p><p class='cut", "shown"),
        ("<p>shown<script>never closed", "shown"),
        ("", ""),
        ("<nav>only</nav>", ""),
        ("</div></p><p>x</b></p>", "x"),
    ],
)
def test_markup(page, text):
    assert main_text(page) == text


def test_links_weigh_a_block_down():
    links = "".join(f"<li><a href=/{n}>Another headline of this site number {n}</a></li>" for n in range(30))
    assert main_text(f"<body><div><ul>{links}</ul></div><div><p>{LONG}</p><p>{LONG}</p></div></body>") == f"{LONG.strip()}\n{LONG.strip()}"


def sections(*lengths):
    return [("word " * (n // 5)).strip() for n in lengths]


@pytest.mark.parametrize("holder", ["<div class=content>{}</div>", "<div><div class=page><div>{}</div></div></div>"])
@pytest.mark.parametrize("around", ["{}", f"<nav>{LONG * 9}</nav>{{}}<footer>{LONG}</footer>"])
def test_every_section_is_kept(holder, around):
    title, intro, *rest = sections(40, 300, *[120] * 5, *[300] * 10)
    first, second = ("".join(f"<p>{p}</p>" for p in part) for part in (rest[:5], rest[5:]))
    inner = f"<h1>{title}</h1><p>{intro}</p><div class=s1>{first}</div><div class=s2>{second}</div>"
    page = f"<html><body>{around.format(holder.format(inner))}</body></html>"
    assert main_text(page).split("\n") == [title, intro, *rest]


def test_every_level_of_the_path_is_kept():
    dense = f"<p>{LONG * 3}</p>" * 9
    page = f"<body><h1><a href=x>Title</a></h1><div>Lead <a href=y>text</a> of it<div><p>By <a href=z>Someone</a></p><div>{dense}</div><p>End.</p></div></div></body>"
    assert main_text(page).split("\n") == ["Title", "Lead text of it", "By Someone", *[(LONG * 3).strip()] * 9, "End."]


SECTIONS = ["id=discussion", "id=sec-discussion", "class=related-work", "id=recommendations", "class=legal-analysis", "id=responses"]
SECTIONS += ["class=notices", "id=share", "class=promotion", "id=informed-consent", "class='text social'", "id=copyright", "id=navigation"]


@pytest.mark.parametrize("holder", ["article", "main", "div"])
@pytest.mark.parametrize("name", SECTIONS)
def test_sections_with_names_of_furniture_are_kept(holder, name):
    article = f"<{holder}><h1>Title</h1><p>{LONG}</p><section {name}><h2 {name}>Part</h2><p>{LONG}</p></section><div {name}>{LONG * 2}</div></{holder}>"
    assert main_text(f"<body>{article}</body>").split("\n") == ["Title", LONG.strip(), "Part", LONG.strip(), (LONG * 2).strip()]


@pytest.mark.parametrize("name", ["related-posts", "share-buttons", "comment-list", "social-share", "post-related", "promo-box", "discussion-thread"])
def test_compound_names_of_furniture_are_left_out(name):
    article = f"<article><p>{LONG}</p><div class={name}><h3>More</h3><p>{LONG * 3}</p></div></article>"
    assert main_text(f"<body>{article}</body>") == LONG.strip()


@pytest.mark.parametrize("name", ["related", "share", "discussion", "legal"])
def test_doubtful_names_leave_out_links_and_short_texts(name):
    links = "".join(f"<li><a href=/{n}>Headline number {n}</a></li>" for n in range(9))
    for inner in (f"<h3>More</h3><ul>{links}</ul>", "All rights reserved."):
        assert main_text(f"<body><article><p>{LONG}</p><div class={name}>{inner}</div></article></body>") == LONG.strip()


def test_lists_of_links_beside_the_path_are_left_out():
    dense = f"<p>{LONG * 3}</p>" * 9
    links = "".join(f"<li><a href=/{n}>Headline number {n}</a> May {n}</li>" for n in range(30))
    page = f"<body><a href=1>One</a> | <a href=2>Two</a><div><h1>Title</h1><div>{dense}</div><div><ul>{links}</ul><div><p>{LONG}</p></div></div></div></body>"
    assert main_text(page).split("\n") == ["Title", *[(LONG * 3).strip()] * 9, LONG.strip()]


def test_given_pages_without_their_holders(spark, tiny):
    """Density alone finds the same article."""
    for row in extract(spark.read.parquet(f"{tiny}/pages.parquet")).collect():
        assert main_text(re.sub(r"<(/?)(article|main)\b", r"<\1div", row.html)) == row.text != ""


WHOLE = f"<h1>Title</h1><p>{LONG * 3}</p><p>{LONG * 2}</p>"
WHOLE_TEXT = f"Title\n{(LONG * 3).strip()}\n{(LONG * 2).strip()}"


@pytest.mark.parametrize("inner", [WHOLE, f"<article>{WHOLE}</article>", f"<div><div class=content>{WHOLE}</div></div>"])
@pytest.mark.parametrize(
    "around",
    [
        "<form id=aspnetForm><nav><a href=1>Home</a></nav>{}<input name=q></form>",
        "<div class='layout with-sidebar'>{}<div class=sidebar>Short text beside it.</div></div>",
        "<div class='page no-sidebar has-comments'>{}</div>",
        "<div class='modal'><div class=widget>{}</div></div>",
        "<div id=main class='post comments-open'>{}</div>",
    ],
)
def test_no_name_or_form_around_the_page_loses_the_article(around, inner):
    assert main_text(f"<body>{around.format(inner)}</body>") == WHOLE_TEXT


@pytest.mark.parametrize("name", ["post no-sidebar", "post comments-open", "entry has-ads", "with_toolbar"])
def test_states_of_an_article_leave_nothing_out(name):
    assert main_text(f"<body><article class='{name}'>{WHOLE}</article></body>") == WHOLE_TEXT


def test_titles_in_a_page_header_and_before_the_article():
    assert main_text(f"<body><article><div class='page-header'><h1>Title</h1></div><p>{LONG}</p></article></body>") == f"Title\n{LONG.strip()}"
    assert main_text(f"<body><nav>x</nav><h1>Title</h1><article><p>{LONG}</p></article></body>") == f"Title\n{LONG.strip()}"
    assert main_text(f"<body><header><h1>Site</h1></header><article><p>{LONG}</p></article></body>") == LONG.strip()


def test_comments_longer_than_the_article_are_left_out():
    comments = f"<div id=comments>{f'<article class=comment><p>{LONG * 3}</p></article>' * 20}</div>"
    for holder in ("article", "div"):
        assert main_text(f"<body><{holder}>{WHOLE}</{holder}>{comments}</body>") == WHOLE_TEXT


def test_unmarked_text_less_dense_than_the_page_stays_outside():
    """The body's diluted density decides: a short greeting beside the dense node's subtree is no part of it."""
    links = "".join(f"<li><a href=/{n}>Go {n}</a></li>" for n in range(20))
    dense = f"<p>{LONG * 3}</p>" * 9
    page = f"<body><ul class=menu>{links}</ul><div><span>Hi</span> <i>you</i> <b>there</b></div><div>{dense}</div></body>"
    assert main_text(page) == "\n".join([(LONG * 3).strip()] * 9)


@pytest.mark.parametrize("page", ["<b>x", "<b><table><i>x", "<div><h1>x"])
def test_time_grows_with_the_length_of_a_page(page):
    def seconds(n: int) -> float:
        whole = page * n + "</i>" * n + "</b>" * n
        start = time.perf_counter()
        main_text(whole)
        return time.perf_counter() - start

    seconds(1000)
    assert min(seconds(32_000) for _ in range(2)) < 9 * max(min(seconds(8_000) for _ in range(2)), 0.05)


def test_very_long_and_very_deep_pages():
    paragraphs = "".join(f"<p>{LONG}{n}</p>" for n in range(20_000))
    assert main_text(f"<article>{paragraphs}</article>").count("\n") == 19_999
    assert main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"


def test_odd_rows(spark):
    rows = [(None, None, None, "old"), (1, "u", "", "old"), (2, "u", "<p>x</p>", "old"), (2, "u", "<p>x</p>", "old")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    assert sorted(str(r.text) for r in extract(pages).collect()) == ["", "", "x", "x"]
    assert extract(pages).columns == ["page_id", "url", "html", "text"]
    assert extract(pages.where("page_id = 9")).collect() == []
