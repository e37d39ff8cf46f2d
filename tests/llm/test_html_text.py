from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import work  # noqa: F401
from pyspark.sql import functions as F

from rollcall.llm import html_text
from rollcall.llm.html_text import blocks_of, common_lines, main_text


def lcs(x, y):
    table = np.zeros((len(x) + 1, len(y) + 1), int)
    for i in range(len(x)):
        for j in range(len(y)):
            table[i + 1, j + 1] = table[i, j] + 1 if x[i] == y[j] else max(table[i, j + 1], table[i + 1, j])
    return int(table[-1, -1])


def is_subsequence(x, y):
    rest = iter(y)
    return all(any(a == b for b in rest) for a in x)


@pytest.mark.parametrize("cells", [1 << 24, 8])
@given(st.lists(st.integers(0, 5), max_size=40), st.lists(st.integers(0, 5), max_size=40))
@settings(max_examples=150, deadline=None)
def test_alignment_is_a_longest_common_subsequence(cells, x, y):
    whole, html_text.CELLS = html_text.CELLS, cells
    try:
        found = common_lines(np.array(x, np.int64), np.array(y, np.int64))
    finally:
        html_text.CELLS = whole
    assert len(found) == lcs(x, y)
    assert is_subsequence([x[k] for k in found], y)
    assert (np.diff(found) > 0).all()


def page(body, head="<title>no</title><script>var p='</p>';</script><style>p{}</style>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "html, blocks",
    [
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        (page("<nav><ul><li><a href=x>Menu</a></ul></nav><div class='ad'>Buy</div><article><h1>A &lt;b&gt;</h1><p><b>One\n two<br>three<p>Four&nbsp;4</article><footer>f"), ["A <b>", "One two three", "Four 4"]),
        (page("<div class=ad>Never closed<article><header><h1>T</h1></header><p>x</p><aside>s</aside><div class='reader comments'><p>c</p></div><footer>f</footer></article>"), ["T", "x"]),
        (page("<header>h</header><main><p>a</p><form>f<p>g</p></form><p>b</p></main><div>after</div>"), ["a", "b"]),
        (page("<article><p>one</p></article><section id=comments><article class=comment>bad</article></section>"), ["one"]),
        (page("<p>no container</p><ul><li><a href=a>link</a></li><li>item</li></ul><div style='display: none'>x</div><p hidden>y</p>"), ["no container", "item"]),
        (page("<article><!-- c --><p>a<script>b</script>c</p><noscript>d</noscript><table><tr><td>1<td>2</table></article>"), ["ac", "1", "2"]),
        (page("<div role=navigation>n</div><div class='cookie-notice'>k</div><article><p class='lead'>a</p><button>b</button></article>"), ["a"]),
        ("<article><p>unclosed <i>tags <b>here", ["unclosed tags here"]),
    ],
)
def test_blocks(html, blocks):
    assert blocks_of(html)[0] == blocks


LONG = "a paragraph of the article with many words in it " * 4


CROWD = "".join(f"<p>reader number {k} has much more to say than the writer had</p>" for k in range(30))


@pytest.mark.parametrize(
    "html",
    [
        f"<article><p>short</p><section class='comments'>{CROWD}</section></article>",
        f"<main><p>short</p><div class='sidebar'>{CROWD}</div></main>",
        f"<p>short</p><div id='comments'>{CROWD}</div>",
        *(f"<article><p>short</p><div class='{name}'>{CROWD}</div></article>" for name in ("comment-list", "user-comments", "comments-area")),
        f"<article><p>short</p><div id='disqus_thread'>{CROWD}</div></article>",
        f"<div><p>short</p><ul class='reader-comments'><li>{CROWD}</li></ul><div class='cookie-notice'>{CROWD}</div></div>",
    ],
)
def test_what_no_article_is_goes_however_long_it_is(html):
    assert blocks_of(page(html))[0] == ["short"]


def test_marked_elements_that_stay_are_unsure():
    blocks, sure = blocks_of(page("<article><p>few</p><div class='widget'><p>many more words than that few</p></div></article>"))
    assert blocks == ["few", "many more words than that few"]
    assert sure == [True, False]


@pytest.mark.parametrize("name", ["elementor-widget elementor-widget-text-editor", "content-with-sidebar", "has-sidebar", "social-share-enabled", "post-comment-open"])
def test_wrappers_that_hold_a_marked_word(name):
    for around in ("{}", "<article>{}</article>"):
        html = page(around.format(f"<div class='{name}'><p>text of the page</p></div><p>x</p>"))
        assert blocks_of(html)[0] == ["text of the page", "x"]


def test_page_wide_forms_and_marks_are_unsure():
    assert blocks_of(page("<form action=x><div><p>all of the page</p></div></form>")) == (["all of the page"], [False])
    assert blocks_of(page(f"<p>x</p><div class=widget><p>{LONG}</p></div>")) == (["x", LONG.strip()], [False, False])
    assert blocks_of(page(f"<div class=widget><p>x</p></div><p>{LONG}</p><form>f</form>")) == ([LONG.strip()], [False])


def test_headlines_of_links_are_unsure():
    assert blocks_of(page("<h1><a href=x>Headline</a></h1><p>text</p>")) == (["Headline", "text"], [False, False])


def test_teasers_do_not_replace_the_article():
    teasers = "<article class=card>teaser</article>" * 3
    assert blocks_of(page(f"<main><p>{LONG}</p>{teasers}</main>"))[0] == [LONG.strip(), *["teaser"] * 3]
    assert blocks_of(page(f"<div><p>{LONG}</p></div><article>teaser</article>")) == ([LONG.strip(), "teaser"], [False, False])
    assert blocks_of(page(f"<div><p>{LONG}</p></div><article class=comment>so bad</article>"))[0] == [LONG.strip()]
    assert blocks_of(page(f"<article><p>{LONG}</p></article><p>beside</p>")) == ([LONG.strip()], [True])


def site(spark, rows):
    names = "host string, path string, lines string, gone string"
    return spark.createDataFrame([(*row, *"xxxx") for row in rows], f"page_id long, url string, html string, {names}").repartition(3)


@pytest.mark.parametrize("equal", [False, True])
def test_differencing_deletes_what_neighbours_share(spark, work, monkeypatch, equal):
    if equal:  # pages with other ids keep their own lines, whatever their hash
        monkeypatch.setattr(html_text, "page_hash", lambda *_: F.lit(7).cast("long"))
    frame = "<div>Site name</div><p>{}</p><p>{}</p><div>All rights reserved</div>"
    own = lambda k, n=3: " ".join(f"word{k}x{i}" for i in range(20 * n))
    rows = [(k, f"https://{'www.' * (k % 2)}a.example/news/{k:03}", page(frame.format(own(k), own(-k)))) for k in range(40)]
    rows += [(100, "https://b.example/1", page(frame.format("alone", "here")))]
    rows += [(200 + k, f"https://c.example/{k}", page(frame.format(own(9), own(10)))) for k in range(2)]
    got = {r.page_id: r for r in main_text(site(spark, rows), work).collect()}
    assert len(got) == len(rows)
    for k in range(1, 40):
        assert got[k].text == f"{own(k)}\n\n{own(-k)}"
    assert got[100].text == "Site name\n\nalone\n\nhere\n\nAll rights reserved"
    # copies of one article are not each other's boilerplate
    assert got[200].text == got[201].text == f"Site name\n\n{own(9)}\n\n{own(10)}\n\nAll rights reserved"
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_short_articles_lose_the_site_around_them(spark, work):
    frame = f"<p>{'menu and notice ' * 15}</p><p>{{}}</p><p>{'footer text ' * 15}</p>"
    own = lambda k: " ".join(f"word{k}x{i}" for i in range(20))
    rows = [(k, f"https://a.example/{k}", page(frame.format(own(k)))) for k in range(5)]
    # three copies of one article, but for a counter
    rows += [(10 + k, f"https://b.example/{k}", page(f"<p>{own(9)}</p><p>{own(8)}</p><p>{k}</p>")) for k in range(3)]
    # two copies beside another article
    rows += [(20 + k, f"https://c.example/{k}", page(f"<p>The site</p><p>{own(7 if k else 6)}</p>")) for k in range(3)]
    got = {r.page_id: r.text for r in main_text(site(spark, rows), work).collect()}
    assert [got[k] for k in range(5)] == [own(k) for k in range(5)]
    assert [got[10 + k] for k in range(3)] == [f"{own(9)}\n\n{own(8)}\n\n{k}" for k in range(3)]
    assert got[21] == own(7)


def test_pages_of_one_path_are_compared(spark, work):
    frame = "<p>The name of the site</p><p>{}</p><p>All rights reserved</p>"
    own = lambda k: " ".join(f"word{k}x{i}" for i in range(20))
    rows = [(k, f"http://a.example/index.php?id={k}", page(frame.format(own(k)))) for k in range(4)]
    # one page under several names, but for a counter: the neighbouring path decides
    rows += [(10 + k, f"http://b.example/x?ref={k}", page(frame.format(own(9)) + f"<p>{k}</p>")) for k in range(3)]
    rows += [(20, "http://b.example/y", page(frame.format(own(8))))]
    got = {r.page_id: r.text for r in main_text(site(spark, rows), work).collect()}
    assert [got[k] for k in range(4)] == [own(k) for k in range(4)]
    assert [got[10 + k] for k in range(3)] == [f"{own(9)}\n\n{k}" for k in range(3)]
    assert got[20] == own(8)


def test_articles_keep_what_they_share(spark, work):
    html = "<article><h1>{}</h1><p>Licensed under a license</p><p>text {}</p></article>"
    rows = [(k, f"http://a.example/{k}", page(html.format(k, "x" * 200 + str(k)))) for k in range(4)]
    got = {r.page_id: r.text for r in main_text(site(spark, rows), work).collect()}
    assert got == {k: f"{k}\n\nLicensed under a license\n\ntext {'x' * 200}{k}" for k in range(4)}


def test_nulls_repeats_and_empty(spark, work):
    rows = [
        (None, None, None), (1, "not a url", "<p>a"), (1, "not a url", "<p>a"), (2, "http://[bad", "<p>b"), (3, "http://h.example", None),
        (4, "http://h.example/x", ""), (5, "http://h.example/y", "<p>" + "long " * 50_000),
    ]
    got = sorted((r.page_id or -1, r.text[:9], r.n_chars) for r in main_text(site(spark, rows), work).collect())
    assert got == [(-1, "", 0), (1, "a", 1), (1, "a", 1), (2, "b", 1), (3, "", 0), (4, "", 0), (5, "long long", 249_999)]
    assert main_text(site(spark, rows).limit(0), work).collect() == []
