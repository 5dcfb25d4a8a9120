"""Main texts of pages: the given pages against their articles, and small pages by hand."""

import html
import re
import time

import pytest

from larder.llm import extract, queries
from larder.llm.common import table

SMALL = "/root/testdata/sf0.01"
PROSE = "This is the story of a town that was by the sea, and of the people who lived in it for as long as anyone knows"
MORE = "The harbour of the town is old, and it has been in use for as long as there are records of the ships that came"


def text_of(page):
    return extract.main_texts([page])[0]


def article_of(page):
    """Headings and paragraphs of a given page's only article, by patterns."""
    inside = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", part)).split()) for part in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(line for line in lines if line)


def test_every_given_page_gives_its_article(spark):
    pages = {r.page_id: r for r in table(spark, SMALL, "pages").collect()}
    got = queries.op13_html(spark, SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article_of(pages[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_short_articles_are_kept_whole():
    assert text_of("<body><nav><a href=/>Home</a></nav><article><h1>One</h1><p>Two.</p></article><footer>x</footer>") == "One\nTwo."
    assert text_of("<article><p>x</p></article>") == "x"
    assert text_of("<p>x") == "x" and text_of("just text") == "just text"


def test_frame_by_tag_role_and_name():
    frame = ["<nav>menu of the day</nav>", "<header><h1>Site</h1></header>", "<footer>end</footer>", "<aside>side</aside>",
             "<form><p>your name</p><input name=a></form>", "<div class='cookie-notice'>We use cookies on the site</div>",
             "<div id='comments'><p>I liked it.</p></div>", "<section class='userComments'><p>I did not.</p></section>",
             "<div role=navigation>go</div>", "<div hidden>not seen</div>", "<p style='display: none'>nor this</p>",
             "<div class='ad'>buy</div>", "<ins class='adsbygoogle'>buy more</ins>", "<script>var a = '<p>x</p>';</script>",
             "<style>p{}</style>", "<!-- <p>gone</p> -->", "<noscript>turn it on</noscript>", "<select><option>a</select>",
             "<textarea><p>type</textarea>", "<button>go</button>", "<template><p>t</p></template>"]
    for part in frame:
        assert text_of(f"<body>{part}<div><p>{PROSE}</p></div>{part}</body>") == PROSE, part
        if "header" not in part:
            assert text_of(f"<article><h1>T</h1>{part}<p>{PROSE}</p></article>{part}") == f"T\n{PROSE}", part


def test_names_of_the_layout_around_an_article_do_not_remove_it():
    assert text_of(f"<div class='content has-sidebar'><p>{PROSE}</p></div>") == PROSE
    assert text_of(f"<div class='page-header'><main><p>{PROSE}</p></main></div>") == PROSE
    assert text_of(f"<form><article><p>{PROSE}</p></article></form>") == PROSE
    assert text_of(f"<article class='sidebar-left'><header class='entry-header'><h1>T</h1></header><p>{PROSE}</p></article>") == f"T\n{PROSE}"
    assert text_of(f"<article><p>{PROSE}</p><article class='comment'><p>{MORE}</p></article></article>") == PROSE


def test_first_pass_without_declared_article():
    menu = "<ul>" + "<li><a href=/a>The page of the day and of all the days that are to come in the year</a></li>" * 3 + "</ul>"
    other = "<p>" + "Xqz vbn mklp wrt " * 8 + "</p>"
    assert text_of(f"<div>{menu}<p>{PROSE}</p>{other}</div>") == PROSE
    # No block of the page holds stop words: their density says nothing.
    assert text_of(f"<div>{menu}{other}</div>") == ("Xqz vbn mklp wrt " * 8).strip()


def test_second_pass_takes_the_nearest_label():
    link = "<p><a href=/>read on</a></p>"
    assert text_of(f"<div><p>Short one.</p><p>{PROSE}</p>{link}{link}<p>More here</p>{link}</div>") == f"Short one.\n{PROSE}"
    # A tie goes to the good one; a heading goes along with what follows.
    assert text_of(f"<div><p>{PROSE}</p><p>Between</p>{link}</div>") == f"{PROSE}\nBetween"
    assert text_of(f"<div><p>{PROSE}</p><h2>Links</h2>{link}{link}<h2>Harbour</h2><p>{MORE}</p></div>") == f"{PROSE}\nHarbour\n{MORE}"


def test_references_and_white_space():
    assert text_of("<p>a&amp;b &lt;i&gt; &#65;&#x42; &copy &am &nbsp; x\n\t y<br>z &unknown;</p>") == "a&b <i> AB © &am x y z &unknown;"
    assert text_of("<p>one<br><br>two<b>th</b>ree</p>") == "one\ntwothree"
    assert text_of("<p>&#" + "9" * 6000 + "; &#0000000000065;</p>") == "� A"


def test_unclosed_and_cut_off_markup():
    assert text_of("<p><b>One<br><p>Two<p>Three") == "One\nTwo\nThree"
    assert text_of("<ul><li>One<li>Two<p>Three</ul>Four") == "One\nTwo\nThree\nFour"
    assert text_of("<table><tr><td>a<td>b<tr><td>c</table>d") == "a\nb\nc\nd"
    assert text_of("<p>One</p><p>Two <a href='") == "One\nTwo"
    assert text_of("<p>One</p><!-- never closed") == "One" and text_of("<p>One<script>x") == "One"
    assert text_of("1 < 2 <3 <p a='>'>x</p></i></div>") == "1 < 2 <3\nx"


@pytest.mark.parametrize("page", ["<nav>x " * 150_000, "<!-- x " * 150_000, "<" * 1_000_000, '<a b="' * 150_000,
                                  "<div>x" * 150_000, "<p><b>x<br>" * 90_000, "<b><div>x</b>" * 60_000, "<a " + "=" * 500_000,
                                  "<ul>" + "<b>" * 100_000 + "<li></li>" * 50_000, "<script>x" * 100_000, "&" * 500_000])
def test_long_pages_take_linear_time(page):
    start = time.perf_counter()
    extract.main_texts([page])
    assert time.perf_counter() - start < 10


def test_odd_rows(spark):
    rows = [(1, "u", None, "x", 0), (None, None, "<p>a", None, 1), (2, "u", "", "y", 2), (3, "u", "<p>b", "z", 3), (3, "u", "<p>b", "z", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted((tuple(r) for r in extract.extract(pages).collect()), key=repr)
    assert got == sorted([(1, "u", "", 0), (None, None, "a", 1), (2, "u", "", 0), (3, "u", "b", 1), (3, "u", "b", 1)], key=repr)
    assert extract.extract(pages.limit(0)).collect() == []
