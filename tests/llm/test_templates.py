from __future__ import annotations

import html
import re
import time

import pytest

from demandflow.llm import templates


def texts(spark, pages, **options):
    rows = [(i, u, h) for i, (u, h) in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    out = {r["page_id"]: r for r in templates.main_text(table, **options).collect()}
    assert len(out) == len(rows)
    for r in out.values():
        assert r["n_chars"] == len(r["text"])
    return [out[i]["text"] for i in range(len(rows))]


def page(article: str, around: str = "") -> str:
    return f"<html><head><title>t</title></head><body>{around}{article}</body></html>"


def test_articles_of_the_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    found = {r["page_id"]: r["text"] for r in templates.main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = re.sub(r"<(?!/?b>)[^>]*>", " ", article).replace("<b>", "").replace("</b>", "")
        assert found[r["page_id"]] == " ".join(html.unescape(blocks).split())


def test_markup(spark):
    cases = [
        (page("<article><p>one<b>two</b> three<br>four &amp; &lt;five&gt;</article>"), "onetwo three four & <five>"),
        (page("<article><h1> a\n b</h1><ul><li>c<li>d</ul><table><tr><td>e<td>f</table></article>"), "a b c d e f"),
        (page("<main><p>x</main>", "<nav>menu</nav><div class='ad top'>buy</div><div id=cookie-notice>ok</div>"), "x"),
        (page("<article><p>a</p><form><input value=1>send</form><aside>b</aside><script>'</p>'</script>c</article>"), "a c"),
        (page("<article><p>text</p><div class='post-comments'><p>first!</p></div></article>"), "text"),
        (page("<p>no article</p><footer>end</footer>"), "no article"),
        (page("<article><p>open <b>never closed <p>next"), "open never closed next"),
        (page("<article>a<div hidden>b</div><div role=navigation>c</div><div style='display: none'>d</div></article>"), "a"),
        (page("<div class=sidebar-page><article><p>kept</p></article></div>"), "kept"),
        (page("<article>" + "<div>" * 5000 + "deep" + "</article>"), "deep"),
        ("plain < text & more", "plain < text & more"),
        ("<!-- c --><![CDATA[x]]><p>y</p></p></div>", "y"),
        ("", ""),
        (None, ""),
        ("<article></article>", ""),
        (page("<article><p>" + "long " * 60_000 + "</article>"), ("long " * 60_000).strip()),
    ]
    found = texts(spark, [(None if i % 2 else "http://h.example/", h) for i, (h, _) in enumerate(cases)])
    assert found == [t for _, t in cases]


def test_names_of_sections_and_comments(spark):
    comments = "<div id=comments><li class=comment><article class='comment-body'><p>first!</p></article></li></div>"
    cases = [
        (page("<article><section id='social-and-economic-impact'><p>a</p></section><h2 id=related-work>b</h2></article>"), "a b"),
        (page("<article><div class='share-prices'>a</div><h2 class=related>b</h2><section id=comments>c</section></article>"), "a b c"),
        (page("<div class='content has-sidebar'><p>all of it</p></div><div class='sidebar-left'>no</div>"), "all of it"),
        (page(f"<article><p>post</p>{comments}</article>"), "post"),
        (page(f"<main><article><p>post</p></article>{comments}</main>"), "post"),
        (page(f"<article><p>post</p></article>{comments}"), "post"),
        (page("<p>no article</p>" + comments), "no article"),
        (page("<article>post</article><article class=comment>reader</article>"), "post"),
        (page("<article>post</article><aside><article>teaser</article></aside><footer><article>more</article></footer>"), "post"),
        (page("<form><article><p>kept</p></article></form>"), "kept"),
        (page("<article class='post has-sidebar'><p>kept</p><ul class='share-buttons'><li>no</ul></article>"), "kept"),
    ]
    assert texts(spark, [("http://h.example/", h) for h, _ in cases]) == [t for _, t in cases]


def test_subtrees_on_many_pages_of_a_host_go(spark):
    box = "<div><span>Read our best stories</span><span>every day</span></div>"
    line = "<p>Released under the same licence.</p>"
    site = [("https://a.example/x", page(f"<article><p>story {i}</p>{box}{line}</article>")) for i in range(20)]
    bare = [("https://b.example/x", page(f"<p>entry {i}</p>{box}")) for i in range(20)]
    few = [("https://c.example/x", page(f"<article><p>few {i}</p>{box}</article>")) for i in range(3)]
    copies = [("https://d.example/x", page("<p>the same page</p><p>many times</p>")) for _ in range(20)]
    found = texts(spark, site + bare + few + copies)
    assert found[:20] == [f"story {i} Released under the same licence." for i in range(20)]
    assert found[20:40] == [f"entry {i}" for i in range(20)]
    assert found[40:43] == [f"few {i} Read our best storiesevery day" for i in range(3)]
    assert found[43:] == ["the same page many times"] * 20


def test_prose_on_most_pages_of_a_host_goes(spark):
    notice = "<p>Sign up for our letter.</p><ul><li>Print this <li>own {0}</ul><span>All rights reserved</span>"
    table = "<table><tr><td>{0}<td>Price<td>Follow us on every channel</table>"
    inline = "<p>it is <b>not</b> {0}</p>"
    parts = "<article>" + notice + table + inline + "</article>"
    many = [("https://a.example/x", page(parts.format(i))) for i in range(40)]
    shared = "<p>A passage that some articles share.</p>"
    some = [("https://b.example/x", page(f"<article><p>own {i}</p>{shared if i < 15 else ''}</article>")) for i in range(40)]
    near = [("https://c.example/x", page(f"<article><p>own {i % 45}</p>{shared * (i < 30)}</article>")) for i in range(90)]
    found = texts(spark, many + some + near)
    assert found[:40] == [f"own {i} {i} Price it is not {i}" for i in range(40)]
    assert found[40:55] == [f"own {i} A passage that some articles share." for i in range(15)]
    assert found[80:110] == [f"own {i} A passage that some articles share." for i in range(30)]


def test_boxes_in_many_variants_go(spark):
    menu = "<div><ul><li><a>Section {0}</a><li><a>All of {0}</a></ul></div>"
    long = "<div>" + "a passage of an article that some near copies share " * 6 + "</div>"
    few = "<div>on a few pages</div>"
    rows = [
        f"<article><p>own {i}</p>{menu.format(i % 12)}{long if i < 20 else ''}{few if i > 192 else ''}</article>" for i in range(200)
    ]
    found = texts(spark, [("https://a.example/x", page(a)) for a in rows])
    assert found[20:193] == [f"own {i}" for i in range(20, 193)]
    assert found[0] == "own 0 " + ("a passage of an article that some near copies share " * 6).strip()
    assert found[199] == "own 199 on a few pages"


def test_hosts(spark):
    urls = ["https://User@Www.A.example:80/x", "//b.example?q", "no url", "", None, "http://c.example#f"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(templates.host_of().alias("h")).collect()
    assert [r["h"] for r in rows] == ["www.a.example", "b.example", "", "", "", "c.example"]


def test_empty_table_and_extra_columns(spark):
    rows = [(1, "http://h/", "<p>x", "y"), (1, "http://h/", "<p>x", "y"), (None, None, "<p>z", None)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    assert sorted(r["text"] for r in templates.main_text(table).collect()) == ["x", "x", "z"]
    assert templates.main_text(table.limit(0)).count() == 0


@pytest.mark.parametrize(
    "piece", ["<b>x</i>", "<b>x", "<h1>x", "<p>x</div>", "</p>x", "<li>x", "<td>x<b>", "<div>x</span>", "<i><li>x</ul>"]
)
def test_unclosed_tags_take_linear_time(piece):
    began = time.process_time()
    page = templates.Page(piece * 100_000)
    assert len(page.text(set()).split()) >= 1
    assert time.process_time() - began < 15
