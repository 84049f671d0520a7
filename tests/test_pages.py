"""Trees, texts, links and guide pages, on literal pages."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from gleaner.functions import pagetext
from gleaner.functions import scalars as X
from gleaner.functions.tree import Page
from gleaner.operators import guide, links

SEMANTIC = """<!doctype html>
<html><body>
<h1>Wine List</h1>
<h2>Red Wines</h2>
<p>Chateau Margaux 2015 - $350</p>
<p>Opus One 2018 - $500</p>
<h2>White Wines</h2>
<p>Puligny-Montrachet 2019 - $180</p>
<table><tr><th>Wine</th><th>Price</th></tr>
<tr><td>Chablis Grand Cru</td><td>$120</td></tr></table>
</body></html>"""
SPANS = """<!doctype html><html><head><title>Menu</title></head><body><div id="root"><div class="header"><div>Per Se</div><div>Wine List</div></div>
<div class="item"><span class="name">Krug, Grande Cuvée, NV</span>
 <span class="price">$85</span></div><div style="display: none">secret</div><div STYLE="visibility:hidden">no</div><img src=x style="display:none">after<br>line</div></body></html>"""


def test_tree_keeps_unclosed_elements_nested():
    page = Page("<div><p>one<p>two <b>bold</div>after<br/><i>x</i></span>")
    assert page.tags == ["div", "p", "p", "b", "br", "i"] and page.parents == [-1, 0, 1, 2, -1, -1]
    assert page.texts() == ["one", "two", "bold", "after", "x"]
    assert [page.strings[page.first[k] : page.last[k]] for k in (0, 1, 3)] == [["one", "two ", "bold"], ["one", "two ", "bold"], ["bold"]]
    deep = Page("<p>x" * 3000 + "<script>if (a<b) {}</script>")
    assert len(deep.tags) == 3001 and deep.texts()[-1] == "" and Page(None).tags == []


def test_semantic_and_full_text():
    texts = dict(zip(pagetext.FIELDS, pagetext.read(SEMANTIC), strict=True))
    assert texts["semantic"] == (
        "\n# Wine List\n\n## Red Wines\nChateau Margaux 2015 - $350\nOpus One 2018 - $500\n\n## White Wines\nPuligny-Montrachet 2019 - $180\n"
        "\n[TABLE]\nWine | Price\nChablis Grand Cru | $120\n\n"
    )
    assert texts["full"].split("\n") == ["Wine List", "Red Wines", "Chateau Margaux 2015 - $350", "Opus One 2018 - $500", "White Wines", "Puligny-Montrachet 2019 - $180", "Wine", "Price", "Chablis Grand Cru", "$120"]
    texts = dict(zip(pagetext.FIELDS, pagetext.read(SPANS), strict=True))
    assert texts["full"] == "Per Se\nWine List\nKrug, Grande Cuvée, NV $85\nafter\nline" and texts["title"] == "Menu" and texts["semantic"] == ""
    nested = dict(zip(pagetext.FIELDS, pagetext.read("<ul><li>a<ul><li>b</ul></li><li># </li></ul><table><tr><td><p>c</p></td></tr></table><noscript><p>gone</p></noscript>"), strict=True))
    assert nested["semantic"] == "  • ab\n  • #\n  • b\n\n[TABLE]\nc\n\nc\n"
    assert nested["snippets"] == "gone" and dict(zip(pagetext.FIELDS, pagetext.read("<h1>Title</h1><p>abc<p>long one<li>item"), strict=True))["snippets"] == "Title | abclong oneitem | long oneitem | item"
    assert len(pagetext.read("<li>" + "x" * 600)[4]) == 500 and len(pagetext.read("<p>" * 1500 + "x")[0]) == 3000


def test_chosen_text(spark):
    long = SEMANTIC.replace("Opus One", "Opus One " * 30)
    pages = [(0, SEMANTIC), (1, long), (2, "<p>" + "x" * 250 + "</p><div>" + "y" * 600), (3, None)]
    got = [r[0] for r in spark.createDataFrame(pages, "i int, html string").orderBy("i").select(pagetext.chosen(pagetext.page_texts("html"))).collect()]
    assert got[0].startswith("Wine List\nRed") and got[1].startswith("\n# Wine List\n") and got[2].endswith("y" * 600) and got[3] == ""


def test_table_text(spark):
    rows = [["Wine", "Price", None], ["Chablis", "$120"], ["A", "B", "C", "dd"]]
    assert pagetext.table_text(rows) == "Wine    | Price |  \n-------------------\nChablis | $120 \nA       | B     | C | dd"
    assert pagetext.table_text([]) == "" and pagetext.table_text([["x"]]) == "x\n-"
    df = spark.createDataFrame([([["a", "b"], ["cc", None]],), (None,)], "t array<array<string>>")
    assert [r[0] for r in df.select(pagetext.table_texts("t")).collect()] == ["a  | b\n------\ncc |  ", None]


LINKS = """<body><nav><a href="">Top</a><a href="/wine-list"><img></a><a href="/wine-list">Wine List</a><a>no</a><a href="/menus?x">Menus</a></nav>
<p>Our Wine List is <b>available here</b>: <a href='https://hub.binwise.com/list/a'>here</a></p>
<div><a href="https://files.org/wine.pdf">PDF</a> <a href="https://files.org/catering.pdf">Catering</a></div>
<li><a href="https://other.org/x">Wine list</a><a href="https://other.org/about">about</a><a href="mailto:a@b">mail</a><a href="/Carte%20des%20vins">Dégustation</a></li>
<section><span><a href="https://far.org/z">see</a> the wine list, view our cellar</span></section><a href="https://last.org/file.pdf">x</a></body>"""


@pytest.fixture(scope="module")
def resolved(spark):
    pages = spark.createDataFrame([(1, "https://r.com/home", LINKS), (2, "https://q.com/", None)], "page_id int, url string, html string")
    return links.resolved(links.anchors(pages))


def test_anchors_and_contexts():
    found = links.anchors_of(LINKS)
    assert [(p, h, t) for p, h, t, _ in found[:4]] == [(0, "", "Top"), (1, "/wine-list", ""), (2, "/wine-list", "Wine List"), (3, "/menus?x", "Menus")]
    contexts = {h: c for _, h, _, c in found}
    assert contexts["/menus?x"] == "" and contexts["https://hub.binwise.com/list/a"] == "our wine list isavailable here:here" and contexts["https://far.org/z"] == "seethe wine list, view our cellar"
    assert len(links.anchors_of("<div>" + "x " * 400 + "<a href=y>z</a></div>")[0][3]) == 300 and links.anchors_of(None) == []


def test_scored_links(resolved):
    inside = {(r["pos"], r["link"]): r["score"] for r in links.internal_links(resolved).collect()}
    assert inside == {(1, "https://r.com/wine-list"): 141, (2, "https://r.com/wine-list"): 526, (3, "https://r.com/menus"): 158, (10, "https://r.com/Carte%20des%20vins"): 25}
    fr = {r["pos"]: r["score"] for r in links.internal_links(resolved, F.lit("fr")).collect()}
    assert fr[2] == 778 and fr[10] == 61
    outside = {r["abs_url"]: r["score"] for r in links.external_links(resolved).collect()}
    assert outside["https://hub.binwise.com/list/a"] == 1000 and outside["https://files.org/wine.pdf"] == 510 and outside["https://files.org/catering.pdf"] == 100
    assert outside["https://last.org/file.pdf"] == 100 and outside["https://far.org/z"] == 400 and outside["https://other.org/x"] == 385 + 300 + 50 and "https://other.org/about" in outside
    assert [(r["page_id"], r["url"], r["score"]) for r in links.best_document(resolved, "page_id").collect()] == [(1, "https://files.org/wine.pdf", 10)]


def test_navigation_links(resolved):
    (row,) = links.nav_links(resolved, "page_id").collect()
    assert [(x["pos"], x["text"]) for x in row["links"]] == [(0, "Top"), (3, "Menus"), (10, "Dégustation")]  # the image link hides the text link
    assert row["links"][0]["context"] == "" and row["links"][2]["context"].startswith("wine listabout") and not row["links"][0]["is_pdf"]
    assert [x["pos"] for x in links.nav_links(resolved, "page_id", 2).collect()[0]["links"]] == [0, 3]
    visited = resolved.where("pos = 3").select("page_id", "link")
    assert links.unvisited(resolved, visited, "page_id").count() == resolved.count() - 1 and links.unvisited(resolved, None, "page_id") is resolved


def test_pages_one_step_away(spark):
    outside = [(1, 0, "https://a.org/x.pdf"), (1, 1, "https://hub.binwise.com/l"), (1, 2, "https://a.org/wine/download/7"), (1, 3, "https://a.org/p1"), (1, 4, "https://a.org/p2?q"), (1, 5, "https://a.org/none")]
    df = spark.createDataFrame(outside, "venue int, pos int, abs_url string").withColumn("link", X.normalize_url(F.col("abs_url")))
    pages = spark.createDataFrame([("https://a.org/p1", "<a href='m.pdf'>menu</a><a href='wine.pdf'>w</a>"), ("https://a.org/p2", "<a href='https://starwinelist.com/1'>s</a><a href='https://starwinelist.com/2'>s</a>"), ("https://a.org/none", "<a href='/x'>y</a>")], "link string, html string")
    got = {r["pos"]: r["result"] for r in links.linked_page(df, pages, "venue").collect()}
    assert got == {0: outside[0][2], 1: outside[1][2], 2: outside[2][2], 3: "https://a.org/wine.pdf", 4: "https://starwinelist.com/1", 5: None}


GOLDENS = [
    ("wine list", "/wine-list", "", "en", 526), ("wine", "/wine", "", "en", 221), ("menus", "/menus", "", "en", 158), ("about", "/about", "", "en", 18), ("faq", "/faq", "", "en", 12),
    ("click here", "/link", "view our wine list here", "en", 50), ("reservations now", "/reserve", "", "en", 0), ("wine list", "/wine-list", "", "fr", 778), ("carte des vins", "/carte-des-vins", "", "fr", 252), ("carta de vinos", "/carta-de-vinos", "", "es", 223),
]


def test_link_score_goldens(spark):
    df = spark.createDataFrame([(i, *g) for i, g in enumerate(GOLDENS)], "i int, t string, h string, c string, l string, want int")
    score = links.by_language(F.col("l"), lambda x: links.link_score(F.col("t"), F.col("h"), F.col("c"), x))
    assert all(r[0] == r[1] for r in df.select(score, "want").collect())
    documents = [("/carte-des-vins.pdf", "download", "", "fr", 20), ("/bodega-vinos.pdf", "", "", "es", 40), ("/x.pdf", "catering", "wine", "en", -15), ("/wine-press.pdf", "press kit", "", "en", -10)]
    df = spark.createDataFrame(documents, "p string, t string, c string, l string, want int")
    score = links.by_language(F.col("l"), lambda x: links.document_score(F.col("p"), F.col("t"), F.col("c"), x))
    assert [r[0] for r in df.select(score).collect()] == [30, 40, -15, -10]
    assert "degustation" in links.keywords("menu", "fr") and len(links.keywords("wine", "en")) == 30 and len(links.keywords("wine", "es")) == 41


def test_searches_and_tiers(spark):
    rows = [
        ("a", "Quince", 1, 0, "https://other.com/x", "Quince"), ("a", "Quince", 1, 1, "https://hub.binwise.com/list/other?u", "Other"), ("a", "Quince", 2, 0, "https://hub.binwise.com/list/quince-html?u=1", "Quince - list"),
        ("a", "Quince", 2, 1, "https://hub.binwise.com/list/later", "Quince"), ("b", "  ", 1, 0, "https://hub.binwise.com/list/b", "b"), ("c", "Per Se", 1, 3, "https://hub.binwise.com/list/c", "per se wines"),
    ]
    df = spark.createDataFrame(rows, "key string, name string, pass int, rank int, url string, page_text string")
    assert {r["key"]: r["url"] for r in links.two_passes(df, "key", "name").collect()} == {"a": "https://hub.binwise.com/list/quince-html", "b": None, "c": "https://hub.binwise.com/list/c"}
    tiers = spark.createDataFrame([("c", True, "s"), ("c", False, "s"), ("", True, "s"), (None, None, "")], "c string, ok boolean, s string")
    assert [r[0] for r in tiers.select(links.first_found(F.col("c"), F.col("ok"), F.col("s"))).collect()] == ["c", "s", "s", None]


def test_listing_cards(spark):
    card = lambda href, title=True: f"<div class='card js-restaurant__list_item'>" + (f"<h3 class='card__menu-content--title x'><a href='{href}'>n</a></h3>" if title else "") + "</div>"
    html = f"<div class='js-restaurant__list_item'>promo</div><div class='row js-restaurant__list_items'>{card('/us/en/ny/restaurant/one')}{card('/other')}{card('x', False)}{card('https://e.com/restaurant/two')}</div><h1>1 - 48 of 1,759 Restaurants</h1><script>of 9 restaurants</script>"
    df = spark.createDataFrame([(1, html), (2, "<p>of 7 restaurants"), (3, None)], "i int, html string")
    got = {r["i"]: (r["urls"], r["total"], r["pages"]) for r in guide.listing_pages(df).collect()}
    assert got == {1: (["https://guide.michelin.com/us/en/ny/restaurant/one", "https://e.com/restaurant/two"], 1759, 37), 2: ([], 0, 0), 3: ([], 0, 0)}


def test_venue_fields():
    inner = lambda body: Page(f"<html><body>{body}</body></html>")
    site = lambda body: guide.venue(f"<html><body>{body}</body></html>")[1]
    assert site('<a href="https://restaurant.com">Visit Website</a>') == "https://restaurant.com"
    assert site('<a href="https://guide.michelin.com/other">Visit Website</a><a href="https://restaurant.com">Visit Website</a>') == "https://restaurant.com"
    assert site('<a href="https://guide.michelin.com/x">More Info</a><a href="tel:1">home</a>') is None and site('<a href="http://a.com">Our HOME page</a>') == "http://a.com"
    address = lambda body: guide.address_of(p := inner(body), p.texts())
    assert address("<div class='x Location-y'><b>10 Main St</b>, <i>Rome</i></div>") == "10 Main St , Rome"
    assert address("<p data-testid='address'>12 Long Road, Paris</p><div class='a'>z</div>") == "12 Long Road, Paris"
    assert address("<h1>N</h1><p>short</p><p>" + "x," * 200 + "</p><p>5 Side St, Lyon</p>") == "5 Side St, Lyon"
    assert address("<h1>N</h1><p>$$ Cuisine</p><p>5 Side St, Lyon</p>") is None and address("<p>5 Side St, Lyon</p>") is None
    assert guide.venue("<h1>A <b>B</b></h1><p>French cuisine</p>")[0] == "AB" and guide.venue("<p>French Cuisine</p>")[4] == "French Cuisine" and guide.venue(None)[0] == "Unknown"
    assert guide.venue("<div>" + "x" * 60 + " cuisine<span>Thai cuisine</span></div>")[4] == "Thai cuisine"


def test_venue_pages(spark):
    one = "<h1>Per Se</h1><div class='address'>10 Columbus Cir, New York</div><p>Three Stars</p><p>$$$$</p><a href='https://p.com'>Visit Website</a>"
    two = "<h1>Smyth</h1><p>nothing</p>"
    rows = [("https://g/us/en/new-york/new-york/restaurant/per-se", one, '{"address":"10 Columbus Cir","city":"New York","state":"NY","zip":"10019"}'), ("https://g/us/en/illinois/chicago/restaurant/smyth", two, None), ("https://g/us/en/illinois/chicago/restaurant/raw", one, "{bad")]
    got = [r.asDict() for r in guide.venue_pages(spark.createDataFrame(rows, "url string, html string, reply string"), reply=F.col("reply"), site_name=F.lit("Michelin Guide USA")).drop("reply").collect()]
    assert list(itertools.islice(got[0].values(), 1, None)) == ["Per Se", "https://p.com", "3-stars", "10 Columbus Cir", "New York", "NY", "10019", "USA", None, "$$$$"]
    assert (got[1]["city"], got[1]["state"], got[1]["country"], got[1]["distinction"], got[1]["address"]) == ("Chicago", "Illinois", "USA", "selected", None)
    assert (got[2]["address"], got[2]["city"], got[2]["state"]) == ("10 Columbus Cir, New York", None, None)


def test_queries_bound_the_pages_of_a_batch(spark):
    """a task's Python holds few pages with their results, however many a partition has."""
    from gleaner.registry import QUERIES

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for query in ("page_text", "page_links", "link_split", "scored_links", "best_documents", "walk_order", "reached_pages", "navigation"):
            spark.conf.set(name, 10_000)
            QUERIES[query](spark, "/root/testdata/sf0.001")
            assert int(spark.conf.get(name)) <= 500, query
    finally:
        spark.conf.set(name, before)
