from __future__ import annotations

import html
import re

from tests.conftest import SMALL
from tracklake.llm.html_text import extract_text, main_text
from tracklake.llm.queries import QUERIES

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><nav><a href=/>Home</a></nav></header><div class="cookie-notice">We use cookies, many, many.</div>
<div id="content" class="post"><h1>Title &amp; more</h1><p>First, with <a href=x>a link</a> and<br>a break.
<p>Second&nbsp;one, <b>bold<p>third</div>
<aside><p>Aside, text, here</p></aside><form><p>Name, please</p></form><div class="comments"><p>Nice, really, nice!</p></div>
<script>var a = "<p>no</p>";</script><footer>&copy; us</footer></body></html>"""


def test_article_without_its_surroundings():
    assert main_text(PAGE) == "Title & more\nFirst, with a link and a break.\nSecond one, bold\nthird"


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<p></p><script>x</script>") == ""
    assert main_text("plain &lt;text&gt; only") == "plain <text> only"
    assert main_text("<article><p>cut in the middle of a t") == "cut in the middle of a t"
    assert main_text("<article><p>a tag is cut<di") == "a tag is cut"
    deep = "<div>" * 5000 + "<p>deep, down</p>" + "</div>" * 5000
    assert main_text(deep) == "deep, down"
    assert main_text("<ul>" + "".join(f"<li><a href=x>link {i}</a>" for i in range(20)) + "</ul><div><p>The, text.</p></div>") == "The, text."


def test_small_pages_against_their_article_element(spark):
    rows = QUERIES["op5_html_text"](spark, SMALL).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inner = pages[r["page_id"]].partition("<article>")[2].partition("</article>")[0]
        lines = re.sub(r"<[^>]*\Z", "", re.sub(r"</?(?:p|h1)>", "\n", inner))
        lines = re.sub(r"<[^>]*>", " ", lines).split("\n")
        want = "\n".join(t for t in (" ".join(html.unescape(x).split()) for x in lines) if t)
        assert r["text"] == want and r["n_chars"] == len(want)


def test_edge_rows(spark):
    rows = [(1, None, "<p>a, b</p>", "old"), (1, None, "<p>a, b</p>", "old"), (None, "u", None, None), (2, "u", "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in extract_text(df).collect())
    assert got == [(0, "", 0), (1, "a, b", 4), (1, "a, b", 4), (2, "", 0)]
    assert extract_text(df.limit(0)).count() == 0


def test_wrappers_around_the_article_stay():
    body = "<h1>Title</h1><p>The first, long, paragraph of the text, with commas, and words.</p><p>The second, shorter.</p>"
    want = "Title\nThe first, long, paragraph of the text, with commas, and words.\nThe second, shorter."
    around = "<nav><a href=x>Home</a></nav><div class='sidebar'><p>Aside, text</p></div>{}<div class='comments'>{}</div>"
    remarks = "<article><p>Nice, really, very, very, nice, and long, longer than, the text, of the page, itself, by far, it is.</p></article>"
    for name in ("layout no-sidebar", "content-sidebar-wrap", "has-header", "right-sidebar", "with_sidebar", "overlay"):
        for tag in ("article", "main", "div"):
            page = f"<body><div class='{name}'><{tag}>{body}</{tag}></div></body>"
            assert main_text(page) == want, (name, tag)
            if tag != "div":
                page = around.format(f"<div id='{name}'><{tag}>{body}</{tag}></div>", remarks)
                assert main_text(f"<body>{page}</body>") == want, (name, tag)
    for form in ("<form id='aspnetForm'>", "<form class='search' role='form'>", "<fieldset>", "<div role='dialog'>"):
        end = "</" + form[1:].split()[0].rstrip(">") + ">"
        assert main_text(f"<body>{form}{around.format(f'<article>{body}</article>', remarks)}{end}</body>") == want, form
        assert main_text(f"<body>{form}<div>{body}</div>{end}</body>") == want, form
    # What was dropped rightly still is.
    for name in ("sidebar", "cookie-notice", "site-footer", "comments-wrapper"):
        page = f"<body><article>{body}</article><div class='{name}'><article>{remarks}</article></div></body>"
        assert main_text(page) == want, name


def test_the_article_is_kept_whole():
    text = "The first, long, paragraph of the text, with commas, and words."
    for part in (
        '<h2 id="search">Part</h2>', '<h2 id="related-work">Part</h2>', '<h2 class="navigation">Part</h2>', '<section id="comments"><p>Part</p></section>',
        '<p class="promo-code">Part</p>', '<div class="side-effects">Part</div>', '<div class="legal-history"><p>Part</p></div>',
        '<p><span class="popup">Part</span></p>', '<p id="copyright">Part</p>',
    ):
        assert main_text(f"<body><article><p>{text}</p>{part}<p>End, of it.</p></article></body>") == f"{text}\nPart\nEnd, of it.", part
    for part in (
        '<div class="ad">Part</div>', '<div class="share-buttons">Part</div>', '<div class="related-posts"><p>Part</p></div>', '<aside>Part</aside>',
        '<section class="comments"><p>Part</p></section>', '<div class="newsletter_box">Part</div>', '<div role="navigation">Part</div>',
    ):
        assert main_text(f"<body><article><p>{text}</p>{part}<p>End, of it.</p></article></body>") == f"{text}\nEnd, of it.", part


def test_deep_and_long_pages_take_linear_time():
    import time

    def seconds(n):
        began = time.perf_counter()
        page = "<div class='a'>" * n + "<article><p>deep, down</p></article>" + "</div>" * n + "<p class='b'>more, text</p>" * n
        assert main_text(page).startswith("deep, down")
        return time.perf_counter() - began

    seconds(500)
    assert seconds(16_000) < 16 * max(seconds(4_000), 0.05)
