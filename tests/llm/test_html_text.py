import html
import re

import pyarrow.parquet as pq
import pytest

from capplan.llm import html_text
from tests.test_oracle import SF


def article(page):
    """The blocks of the article of the table's pages, by their own pattern."""
    inside = re.search("<article>(.*?)</article>", page, re.DOTALL)[1]
    blocks = (re.sub("<[^>]*>", "", block.replace("<br>", " ")) for block in re.split("</?(?:p|h1)>", inside))
    texts = (re.sub(r"\s+", " ", html.unescape(block)).strip() for block in blocks)
    return " ".join(t for t in texts if t)


def test_pages_of_the_table(spark):
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    found = {r.page_id: (r.text, r.n_chars) for r in html_text.main_text(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    for page in pages:
        expected = article(page["html"])
        assert found[page["page_id"]] == (expected, len(expected))


LONG = "This paragraph is the content of the page, with many words in it, so that it should stay."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><header><h1>T</h1></header><p>x</p><div class='comments'><p>c</p></div></article>", "T x"),
        ("<article><p>a</p><form>f</form><aside>s</aside><div class=ad>buy</div><script>v</script></article>", "a"),
        ("<article><p>a &lt;b&gt; &#233; &amp;amp;</p></article>", "a <b> é &amp;"),
        ("<article><p>one\n  two</p><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>", "one two x y 1 2"),
        (f"<ul><li><a href=1>Home</a><li><a href=2>News</a></ul><p>{LONG}</p><footer>c</footer>", LONG),
        (f"<div class='page no-sidebar'><p>{LONG}</p></div><div id=sidebar><p>s</p></div>", LONG),
        ("<article><p>x</p></article><article class=comment><p>nice</p></article>", "x"),
        ("<p>unclosed <b>bold", "unclosed bold"),
        ("<!-- <p>no</p> --><p>5 < 6 & 7</p>", "5 < 6 & 7"),
        ("<article></article>", ""),
        ("plain", "plain"),
        ("<script>only</script>", ""),
    ],
)
def test_small_pages(page, text):
    assert html_text.content(page) == text


MENU = "<ul><li><a href=1>Home</a><li><a href=2>News</a></ul>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # the clusters choose on pages with an article too, and an article takes part by what they choose
        (f"{MENU}<p>{LONG}</p><article><p>{LONG} More.</p></article>{MENU}", f"{LONG} {LONG} More."),
        (f"<article><a href=1>Teaser</a></article>{MENU}<p>{LONG}</p><p>{LONG}</p>", f"{LONG} {LONG}"),
        (f"<article><h1>T</h1><p>{LONG}</p><p>End.</p></article>", f"T {LONG} End."),
    ],
)
def test_clusters_choose_the_regions(page, text):
    assert html_text.content(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<p>Stray</p><div class='layout sidebar-right'><article><p>{LONG}</p></article><div class=ad>buy</div></div>", LONG),
        (f"<div>{MENU}</div><div class='page search'><p>{LONG}</p><p>{LONG}</p></div><div class=related><p>r</p></div>", f"{LONG} {LONG}"),
        (f"<article><div class='entry-header'><h1>T</h1></div><p>{LONG}</p></article>", f"T {LONG}"),
        (f"<article><p>{LONG}</p></article><div class=related><article><p>r</p></article></div>", LONG),
        (f"<article><p>{LONG} <span class=share>Tell</span></p></article>", LONG),
    ],
)
def test_names_do_not_silence_the_content(page, text):
    assert html_text.content(page).removeprefix("Stray ") == text


def test_smoothing_and_threshold():
    assert html_text.smoothed([2.0, 2.0, 2.0]) == pytest.approx([2.0, 2.0, 2.0])
    assert 1 < html_text.threshold([0.5, 1.0, 4.0, 5.0]) < 4


def test_odd_input(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", ""), (2, "u", "<p>" * 2000 + "deep"), (3, "u", "<" * 2000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    found = sorted(((r.page_id, r.n_chars) for r in html_text.main_text(frame).collect()), key=str)
    assert [f for f in found if f[0] != 3] == sorted([(1, 0), (1, 0), (None, 0), (2, 4)], key=str)
    assert html_text.main_text(frame.limit(0)).count() == 0
