import html
import re

import duckdb
import pytest

from retentio.llm.html_text import extract_text, main_text, smooth, threshold

CASES = [
    (None, ""), ("", ""), ("   ", ""), ("only text", "only text"),
    ("<p>a &amp; b&nbsp;c<br>d\n  e</p><p></p><p>f", "a & b c d e\nf"),
    ("<body><nav><a href=x>menu</a></nav><header>site</header><article><h1>T</h1><p>one<p>two</article><aside>s</aside><footer>f</footer>", "T\none\ntwo"),
    ("<article><p>x</p><form>send <input></form><div class='cookie-notice'>c</div><p>y</p><div id=comments><p>hi</p></div></article><p>after</p>", "x\ny"),
    ("<div class='page has-sidebar'><div class=sidebar>side</div><div id=main><p>A long enough paragraph.</p><p>b</p></div></div>", "A long enough paragraph.\nb"),
    ("<article><p>t<script>if (a<b) '</p>'</script><style>p{}</style><!-- no --></p></article>", "t"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_pages(page, text):
    assert main_text(page) == text


LONG = [f"Part {k}. " + "A sentence of the text that goes on for some words. " * 6 for k in range(4)]
P = [f"<p>{x}</p>" for x in LONG]
HTML = "<a href=1>x</a> <a href=2>y</a>"


@pytest.mark.parametrize("page, parts", [
    (f"<body><nav>menu</nav><div>{P[0]}{P[1]}{P[2]}</div><div>{P[3]}</div></body>", LONG),  # 75 % and 25 %
    (f"<div>{P[0]}</div><div>{P[1]}</div><div>{P[2]}</div>", LONG[:3]),  # no body, a third each
    (f"{P[0]}<div>{P[1]}</div>", LONG[:2]),  # outside all containers
    (f"<body><article><h2>Teaser</h2></article><div>{P[0]}{P[1]}</div><ul><li>{HTML}</ul></body>", ["Teaser", *LONG[:2]]),  # the text stands beside the article
    (f"<body><article>{P[0]}{P[1]}</article><article><a><b>x</b></a></article></body>", [*LONG[:2], "x"]),  # an article below the threshold
])
def test_no_content_is_lost(page, parts):
    text = main_text(page)
    for part in parts:
        assert " ".join(part.split()) in text
    assert "menu" not in text


def test_smoothing_and_threshold():
    assert smooth([3.0] * 5) == pytest.approx([3.0] * 5)
    assert 2 < threshold([1, 2, 1, 30, 31]) < 30


def test_a_wrapper_named_widget_may_hold_the_article(monkeypatch):
    page = f"<body><nav>menu</nav><div class='elementor-widget-container'><h1>Title</h1>{P[0]}{P[1]}</div><div class='share'>share</div></body>"
    text = " ".join(LONG[0].split()) + "\n" + " ".join(LONG[1].split())
    assert main_text(page) == "Title\n" + text
    # beside a text, such wrappers stay out; remarks stay out in any case
    assert main_text(f"<div>{P[0]}{P[1]}</div><div class='widget'>{P[2]}{P[3]}</div>") == text
    assert main_text(f"<h1>Title</h1><div class='comments'>{P[2]}{P[3]}</div>") == "Title"
    # the ratio decides which wrapper holds content
    monkeypatch.setattr("retentio.llm.html_text._content", lambda lines: [True] * len(lines))
    assert main_text(page) != "Title\n" + text


def test_unclosed_nesting_costs_no_more_than_its_length():
    lines = main_text("<div><p>word" * 30_000).split("\n")  # each line lies in all containers before it
    assert len(lines) == 30_000 and set(lines) == {"word"}


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert len(main_text("<article>" + "<p>word &lt;</p>" * 20000 + "</article>").split("\n")) == 20000


def test_table(spark):
    sf = "/root/testdata/sf0.001/pages.parquet"
    pages = spark.read.parquet(sf)
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    for i, page in duckdb.sql(f"SELECT page_id, html FROM '{sf}'").fetchall():  # articles of these pages are plain blocks
        parts = re.split("</?(?:p|h1)>", re.search("<article>(.*)</article>", page, re.S).group(1))
        blocks = [" ".join(html.unescape(re.sub("</?b>|<br>", " ", x)).split()) for x in parts]
        assert got[i] == "\n".join(b for b in blocks if b)
    odd = spark.createDataFrame([(None, None, None, "x"), (1, "u", "<p>a", "y"), (1, "u", "<p>a", "y")], "page_id long, url string, html string, text string")
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in extract_text(odd).collect()) == [("1", "a", 1), ("1", "a", 1), ("None", "", 0)]
    assert extract_text(odd.limit(0)).collect() == []
