"""Scalar functions on the cases that tell their rules."""

from __future__ import annotations

import datetime as dt
import re
import unicodedata
from decimal import Decimal

from pyspark.sql import functions as F

from gleaner.functions import scalars as X


def values(spark, kind: str, cases: list, f):
    """f over a column of ``kind`` that holds the cases, in order."""
    rows = [(i, *(c if isinstance(c, tuple) else (c,))) for i, c in enumerate(cases)]
    kinds = re.split(r",(?![^(]*\))", kind)
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} {k}" for n, k in zip("abcd", kinds, strict=False)))
    out = df.select("i", f(*[F.col(n) for n in "abcd"[: len(kinds)]]).alias("v")).orderBy("i").collect()
    return [tuple(r["v"]) if hasattr(r["v"], "asDict") else r["v"] for r in out]


def test_urls(spark):
    urls = [
        ("https://example.com/path/", "https://example.com/path"), ("https://example.com/", "https://example.com/"), ("https://example.com/page?q=1#section", "https://example.com/page"),
        ("HTTPS://Example.com/A;x=1", "https://Example.com/A"), ("http://e.com/a;b/c", "http://e.com/a;b/c"), ("http://e.com", "http://e.com"), ("/rel/", ":///rel"), (" http://e.com/x\n", "http://e.com/x"),
    ]
    assert values(spark, "string", [u for u, _ in urls], X.normalize_url) == [n for _, n in urls]
    assert values(spark, "string", ["https://www.example.com/path", "https://WWW.EXAMPLE.COM:80/", "x", "//h.com/a"], X.domain) == ["www.example.com", "www.example.com:80", "", "h.com"]
    assert values(spark, "string", ["https://s.com/wine-list.pdf", "https://s.com/wine-list.pdf%20", "https://s.com/A.PDF?x", "https://s.com/p.html", "https://s.com/page", "https://s.com/a%2Epdf", "https://s.com/bad%zz.pdf"], X.is_pdf) == [True, True, True, False, False, True, True]
    platforms = ["https://hub.binwise.com/list/abc", "http://bw-winelist-website-prod.s3-website-us-west-2.amazonaws.com/x", "https://www.starwinelist.com/download/abc", "https://binwise.com/restaurant/1", "https://enowine.com", "https://WINEBY.com/x", "https://www.example.com/wine"]
    assert values(spark, "string", platforms, X.is_platform) == [True] * 6 + [False]
    assert values(spark, "string,string", [("http://a.com/b/c", "../d?e#f"), ("http://a.com/b", "//x.org/y"), ("http://a.com", "mailto:z"), ("http://a.com/b?q", "?p"), ("http://a.com", None), ("http://[bad", "x")], X.join_url)[:5] == ["http://a.com/d?e#f", "http://x.org/y", "mailto:z", "http://a.com/b?p", None]
    assert values(spark, "string", ["a+b%20c", "%C3%A9", "%zz", None], X.percent_decode) == ["a+b c", "é", "%zz", None]


def test_skipped_urls(spark):
    bad = ["https://instagram.com/r", "https://facebook.com/r", "https://www.opentable.com/r", "mailto:info@r.com", "tel:+15551234567", "javascript:void(0)", "https://r.com/careers", "https://r.com/privacy", "https://r.com/reservations", "https://r.com/gift-cards", "https://r.com/private-dining", "https://r.com/press", "https://r.com/x#", "https://r.com/SHOP/a"]
    good = ["https://r.com/wine", "https://r.com/menus", "https://r.com/beverage-program", "https://r.com/about", "https://r.com/pressed", "https://r.com/shopping"]
    assert values(spark, "string", bad + good, X.is_skipped) == [True] * len(bad) + [False] * len(good)


def test_download_urls(spark):
    assert values(spark, "string", ["https://s.com/wine-place/5182/download/6202", "https://s.com/download/x", "https://s.com/Download%20/list", "https://s.com/wine"], X.is_download) == [True, False, True, False]
    cases = ["https://s.com/Wine-Place/5182/download/6202?a=1", "https://s.com/download/6202", "https://s.com/wine", "https://s.com/x/DOWNLOAD/7/#f"]
    assert values(spark, "string", cases, X.listing_of_download) == ["https://s.com/wine-place/5182?a=1", None, None, "https://s.com/x#f"]
    assert values(spark, "string", ["https://hub.binwise.com/list/a?utm=1", " x ? y"], X.without_query) == ["https://hub.binwise.com/list/a", "x"]
    assert values(spark, "string", ["https://hub.binwise.com/list/a", "http://eu.hub.binwise.com/x", "https://hub.binwise.com/", "https://other.com/?hub.binwise.com/x", "see https://hub.binwise.com/l"], X.is_search_result) == [True, True, False, False, False]


def test_texts(spark):
    assert values(spark, "string", ["Wine List", "café", "dégustation", "", "   ", "Ñandú", None], X.fold_accents) == ["wine list", "cafe", "degustation", "", "", "nandu", None]
    assert values(spark, "string", ["/Carte%20D%C3%A9gustation"], X.plain_reference) == ["/carte degustation"]
    assert values(spark, "string", ["  L'Été – Bar & Grill!  ", "A\tB", "日本 food"], X.match_form) == ["l été bar grill", "a b", "日本 food"]
    assert values(spark, "string", ["The French Laundry", "The Bar", "Per Se & Co.", ""], X.significant_words) == [["french", "laundry"], ["the", "bar"], ["per", "se", "co"], []]
    assert values(spark, "string", ["  x y ", "\tx\n"], X.strip) == ["x y", "x"]
    assert values(spark, "string", ["12 Main St, Rome", "short, x", "no comma in here"], X.looks_like_address) == [True, False, False]


def test_names_on_pages(spark):
    cases = [
        ("Quince", "Quince - Wine List", True), ("Quince", "Other Restaurant - Wine List", False), ("Quince", "Binwise Menu Quince Wine List", True),
        ("Per Se", "Per Se - Wine & Beverage", True), ("Per Se", "Per - Something", False), ("The Per Se", "Per Se - Wine", False), ("Le Bernardin New York", "york new wines bernardin's le", True),
        ("Le Bernardin New York", "bernardin york", False), ("", "x", False), (None, "x", False), ("Atelier Crenn", None, False),
    ]
    assert values(spark, "string,string", [c[:2] for c in cases], X.name_on_page) == [c[2] for c in cases]


def test_guide_texts(spark):
    cases = [
        ("Awarded Three Michelin Stars for excellence", "3-stars"), ("The restaurant holds 3 Stars in the Guide", "3-stars"), ("worth a special journey – Three Stars", "3-stars"),
        ("Two Michelin Stars for fine dining", "2-stars"), ("Holds 2 stars in the 2024 Guide", "2-stars"), ("One Michelin Star awarded", "1-star"), ("Recently earned 1 Star", "1-star"),
        ("A Bib Gourmand restaurant", "bib-gourmand"), ("Just a regular restaurant page", "selected"), (None, "selected"),
    ]
    assert values(spark, "string", [c[0] for c in cases], X.distinction) == [c[1] for c in cases]
    base = "https://guide.michelin.com/us/en/"
    urls = [base + "new-york/new-york/restaurant/per-se", base + "california/yountville/restaurant/x", base + "district-of-columbia/washington/restaurant/minibar", base + "selection", base + "illinois/chicago_2/restaurant/smyth/", "restaurant/x"]
    assert values(spark, "string", urls, X.city_state) == [("New York", "New York"), ("Yountville", "California"), ("Washington", "DC"), (None, None), ("Chicago", "Illinois"), (None, None)]
    assert values(spark, "string", ["Price: $$$$", "$$", "none", "$ to $$$$", "$$$$$$", None], X.price_band) == ["$$$$", "$$", None, "$$$$", "$$$$", None]
    assert values(spark, "string", ["1 - 48 of 1,759 Restaurants", "of 48 restaurant", "nothing", "of , restaurants", None], X.listing_pages) == [(1759, 37), (48, 1), (0, 1), (0, 1), (0, 1)]
    assert values(spark, "string,int", [("3", 1), ("GOURMAND", 2), ("all", 1), ("all", 3), ("odd", 1), (None, 1)], lambda a, b: X.listing_url(F.lit("https://g/r/"), a, b)) == [
        "https://g/r/3-stars-michelin", "https://g/r/bib-gourmand/page/2", "https://g/r", "https://g/r/page/3", "https://g/r/3-stars-michelin", "https://g/r/3-stars-michelin",
    ]
    assert values(spark, "string", ["France", "france", " Spain", "Mexico", "USA", None, ""], X.language_of) == ["fr", "fr", "es", "es", "en", "en", "en"]
    assert values(spark, "string", ["Michelin Guide USA", "Michelin Guide Michelin Guide X", "Other", None], X.country_of) == ["USA", "Michelin Guide X", "Other", None]
    assert values(spark, "bigint", [0, 1, 48, 49, 1759], X.page_count) == [1, 1, 1, 2, 37]
    assert len(X.TAB_LABELS) == 13 and {"Wine List", "Carte des vins", "Vinos"} <= set(X.TAB_LABELS)


def test_files(spark):
    long = "a" * 250
    names = [("wine_list.pdf", "wine_list.pdf"), ("wine<list>.pdf", "wine_list_.pdf"), ("  .wine_list.pdf  ", "wine_list.pdf"), (long + ".pdf", "a" * 190 + ".pdf"), (long, "a" * 200), ("", "wine_list"), ("...", "wine_list"), (None, "wine_list"), ('a:b/c\\d|e?f*g"', "a_b_c_d_e_f_g_")]
    assert values(spark, "string", [n for n, _ in names], X.safe_filename) == [w for _, w in names]
    cases = [
        ("https://s.com/a/List.PDF%20", "application/pdf", (".pdf", "List.PDF")), ("https://s.com/list", "application/pdf", (".pdf", "wine_list.pdf")), ("https://s.com/list", "text/html; x", (".html", "wine_list.html")),
        ("https://s.com/a.htm", None, (".html", "a.htm")), ("https://s.com/a.html", "application/pdf", (".pdf", "a.pdf")), ("https://s.com/.pdf", "", (".pdf", "wine_list.pdf")), ("https://s.com/a.b.pdf", "text/html", (".html", "a.b.html")),
    ]
    assert values(spark, "string,string", [c[:2] for c in cases], X.download_name) == [c[2] for c in cases]
    assert values(spark, "string", ["a.PDF", "x.htm", "x.html", "x", None], X.content_type_of) == ["application/pdf", "text/html", "text/html", "application/octet-stream", "application/octet-stream"]
    assert values(spark, "string", ["Joe's Bar & Grill"], X.slug) == ["joes-bar-&-grill"]


def test_shells(spark):
    react = '<html><head><title>App</title></head><body><noscript>You need to enable JavaScript to run this app.</noscript><div id="root"></div><script src="main.js"></script></body></html>'
    cases = [(react, ""), (react.replace("root", "app"), ""), ("<html><body><h1>Wine List</h1>" + "<p>Chateau Margaux 2015</p>" * 20 + "</body></html>", "Chateau Margaux 2015 " * 20), ("<html><body><p>Hello</p></body></html>", "Hello"), ("<div>" + " " * 600, "x"), ('<div id="root"></div>', "")]
    assert values(spark, "string,string", cases, X.is_spa_shell) == [True, True, False, False, True, False]


def test_durations_and_dates(spark):
    seconds = [None, 0, 59, 60, 3661, 4503]
    assert values(spark, "int", seconds, X.duration_of_job) == ["", "0s", "59s", "1m 0s", "61m 1s", "75m 3s"]
    assert values(spark, "int", seconds, X.duration_in_table) == ["", "", "0m 59s", "1m 0s", "61m 1s", "75m 3s"]
    crawls = [3.46, 59.94, 60.0, 90.0, 75.0, 3.45, 3.35, *(k * 0.05 for k in range(1, 300))]
    assert values(spark, "double", [None, 0.0, *crawls], X.duration_of_crawl) == ["", "", *(f"{x:.1f}s" if x < 60 else f"{x / 60:.1f}m" for x in crawls)]
    assert values(spark, "int", [3, 63, 3723], X.duration_text) == ["3s", "1m 3s", "1h 2m 3s"]
    at = dt.datetime(2024, 3, 5, 14, 7, 9)
    assert values(spark, "timestamp_ntz", [at, None], X.day_text) == ["2024-03-05", "Never"]
    assert values(spark, "timestamp_ntz", [at, None], X.minute_text) == ["2024-03-05 14:07", "Never"]
    assert values(spark, "timestamp_ntz", [at, None], X.second_text) == ["2024-03-05 14:07:09", ""]
    assert values(spark, "timestamp,timestamp", [(at, at + dt.timedelta(seconds=90, microseconds=256_000))], X.seconds_between) == [Decimal("90.26")]


def test_shown_texts_and_missing_values(spark):
    assert values(spark, "int,int", [(1, 4), (None, None)], X.progress_text) == ["1/4", "0/0"]
    assert values(spark, "int,int", [(1, 8), (1, 0)], X.percent_text) == ["12.5% complete", None]
    assert values(spark, "decimal(10,2)", [Decimal("12.50"), Decimal("0.00"), None], X.price_text) == ["$12.50", "", ""]
    assert values(spark, "string", ["abcdef0123456789"], X.hash_text) == ["abcdef01..."]
    assert values(spark, "string", ["u", "", None], X.tick) == ["✓", "✗", "✗"]
    assert values(spark, "string", ["0", "", "x", None], X.nullif_blank) == ["0", None, "x", None]
    assert values(spark, "double", [0.0, 0.5, None], X.nullif_blank) == [None, 0.5, None]
    assert values(spark, "int", [0, 7], lambda c: X.or_default(c, 3)) == [3, 7]
    numbers = [0.125, 0.375, 2.675, 1.005, -0.125, 0.0, 4096.125, 1e6 + 0.005, 123456789.125, 59.995, *(k * 0.00725 for k in range(200)), *(k * 997.0175 for k in range(200))]
    assert values(spark, "double", numbers, X.half_even) == [round(x, 2) for x in numbers]
    assert values(spark, "double,double", [(1.0, 4.0), (1.0, 0.0)], X.ratio) == [0.25, 0.0]


def test_json(spark):
    fence = "```json\n{\"links\": [\"u\"], \"reasoning\": \"r\"}\n```"
    assert values(spark, "string", [fence, '{"links": []}', "{bad", "", None], X.suggested_links) == [["u"], [], [], [], []]
    replies = [("1 A St, B", '{"address": "1 A St", "city": "B", "zip": "9"}'), (" 1 A St, B ", "{bad"), ("x", None)]
    assert values(spark, "string,string", replies, X.address_parts) == [("1 A St", "B", None, "9", None), ("1 A St, B", None, None, None, None), ("x", None, None, None, None)]
    assert values(spark, "int", [5], lambda c: X.json_of(F.struct(c.alias("n")))) == ['{"n":5}']
    assert values(spark, "string", ["```json\n{\"k\": 1}\n```"], lambda c: X.parse_json_reply(c, "k int")["k"]) == [1]


def test_hashes(spark):
    assert values(spark, "binary", [bytearray(b"hello world"), bytearray(b"")], lambda c: F.sha2(c, 256)) == ["b94d27b9934d3e08a52e52d7da7dabfac484efe37a5380ee9088f7ace2efcde9", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"]


def test_folding_is_pythons(spark, capsys):
    """Of every letter of Latin, Greek, Cyrillic and Armenian: alone, in upper case, with a mark and white space around; no Python in the plan."""
    points = [*range(0x20, 0x590), *range(0x1DC0, 0x1DFA), *range(0x1E00, 0x2000), *range(0x2C60, 0x2C80), *range(0xA720, 0xA800), *range(0xFB00, 0xFB07)]
    texts = [f" \x1c{chr(c)}x{chr(c).upper()}\u0301 \u3000" for c in points if unicodedata.category(chr(c)) != "Cn"] + [None, "", " \t", "\u0130stanbul STRASSE \u00c9COLE", "e\u0301 \u65e5\u672c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.fold_accents("t").alias("f"))
    assert not [r for r in df.collect() if r["f"] != (None if r["t"] is None else X.folded(r["t"]))]
    df.explain()
    assert "Python" not in capsys.readouterr().out
