"""Column functions over urls, names, texts, durations and money. JVM-side, except
url joining and whole percent decoding, which Spark does not have."""

from __future__ import annotations

import unicodedata
from functools import cache
from urllib.parse import unquote, urljoin, urlparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values.
PLATFORMS = r"(?i)hub\.binwise\.com|bw-winelist|binwise\.com/restaurant|starwinelist\.com|enowine\.com|wineby\.com"
SKIPPED = (
    r"(?i)(?:instagram|facebook|twitter|youtube|linkedin|tiktok|yelp|tripadvisor|opentable|resy|sevenrooms)\.com"
    r"|mailto:|tel:|javascript:|#$|/careers|/jobs|/press(?:/|$)|/privacy|/terms|/legal|/cookie|/accessibility"
    r"|/reservations?(?:/|$)|/booking|/gift.?card|/shop(?:/|$)|/contact(?:/|$)|/login|/signup|/account|/events(?:/|$)|/private.?dining"
)
STOP_WORDS = ("the", "a", "an", "and", "or", "&", "restaurant", "bar", "grill", "kitchen")
LANGUAGES = {"france": "fr", "spain": "es", "mexico": "es"}
SPA_SIGNS = (r"(?i)<div\s+id=[\"']root[\"']\s*>\s*</div>", r"(?i)<div\s+id=[\"']app[\"']\s*>\s*</div>", r"(?is)<noscript>.*?enable JavaScript.*?</noscript>", r"(?i)webpackJsonp")
#: Labels that open the full list on a page, in the order in which they are tried.
TAB_LABELS = (
    "Wine List", "WINE LIST", "Full List", "View All", "View Full Menu", "Carte des vins", "Liste des vins", "Vins", "Carte des boissons",
    "Carta de vinos", "Lista de vinos", "Vinos", "Carta de bebidas",
)
HUB = "hub.binwise.com"
DOWNLOAD_TERMS = ("wine", "beverage", "cellar", "sommelier", "list")
SITE_PREFIX = "Michelin Guide "
#: States whose names are not the capitalised words of their slug.
STATES = {"district-of-columbia": "DC"}
LEVEL_SLUGS = {"3": "3-stars-michelin", "2": "2-stars-michelin", "1": "1-star-michelin", "gourmand": "bib-gourmand", "selected": "the-plate-michelin", "all": ""}


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def nullif_blank(c: Column) -> Column:
    """Null for what counts as missing: '' of a text, 0 of a number; the text '0' stays."""
    blank = F.when(F.typeof(c) == "string", c.cast("string") == "").otherwise(c.cast("string").try_cast("double") == 0)
    return F.when(blank, None).otherwise(c)


def or_default(c: Column, default: Column | str | int) -> Column:
    """``c``, or ``default`` where it is missing."""
    return F.coalesce(nullif_blank(c), default if isinstance(default, Column) else F.lit(default))


@cache
def bare_letters() -> tuple[str, str]:
    """Letters with marks, and beside them what is left without: of each code point that decomposes to one other and marks."""
    pairs = [(chr(c), folded(chr(c))) for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.decomposition(chr(c)) and chr(c).lower() == chr(c)]
    found = [(c, bare) for c, bare in pairs if len(bare) == 1 and bare != c]
    return "".join(c for c, _ in found), "".join(bare for _, bare in found)


def fold_accents(text: Column | str) -> Column:
    """Lower case, stripped, without accents: built-in functions only. Collations that ignore case and accents hold more letters
    for equal (d and \u0111, o and \u00f8), so letters lose their marks by a table that Python's own makes. Syllables of Hangul, and a few
    vowels of Indic scripts that have two parts, stay composed; white space may differ in its code point."""
    column = F.col(text) if isinstance(text, str) else text
    bare = F.regexp_replace(F.lower(column), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    return F.regexp_replace(F.translate(bare, *bare_letters()), r"\p{Mn}+", "")


@F.pandas_udf(T.StringType())
def plain_reference(texts: pd.Series) -> pd.Series:
    """A reference as keywords are looked for in it: decoded, then folded."""
    return texts.map(lambda t: None if t is None else folded(unquote(t)))


@F.pandas_udf(T.StringType())
def join_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """The absolute url of a reference on a page."""

    def one(b: str | None, h: str | None) -> str | None:
        try:
            return None if h is None else urljoin(b or "", h)
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href, strict=True)], dtype=object)


@F.pandas_udf(T.StringType())
def percent_decode(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unquote(t))


SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """(scheme, network location, path) of a url, each '' where it lacks; the parameters
    of the last segment are no part of the path."""
    clean = F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")
    scheme = F.lower(F.regexp_extract(clean, SCHEME, 1))
    rest = F.regexp_replace(clean, SCHEME, "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^(?://[^/?#]*)?([^?#]*)", 1), r";[^/]*$", "")
    return scheme, F.regexp_extract(rest, r"^//([^/?#]*)", 1), path


def normalize_url(url: Column) -> Column:
    """Without parameters, query and fragment, and without one trailing slash unless at the root."""
    scheme, host, path = url_parts(url)
    shorter = F.when(F.length(path) > 1, F.regexp_replace(path, "/$", "")).otherwise(path)
    return F.concat(scheme, F.lit("://"), host, shorter)


def domain(url: Column) -> Column:
    return F.coalesce(F.lower(url_parts(url)[1]), F.lit(""))


def path_of(url: Column) -> Column:
    return url_parts(url)[2]


@F.pandas_udf(T.StringType())
def plain_path(urls: pd.Series) -> pd.Series:
    """The decoded path, lower case, stripped, without accents."""
    return urls.map(lambda u: None if u is None else folded(unquote(path_text(u))))


def path_text(url: str) -> str:
    try:
        return urlparse(url).path
    except ValueError:
        return ""


def folded(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text.lower().strip()) if unicodedata.category(c) != "Mn")


def decoded_path(url: Column) -> Column:
    path = path_of(url)
    return strip(F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path))


def is_pdf(url: Column) -> Column:
    return F.endswith(F.lower(decoded_path(url)), F.lit(".pdf"))


def is_download(url: Column) -> Column:
    """A path with /download, and one of the terms anywhere in the url."""
    low = F.lower(url)
    named = F.exists(F.array(*map(F.lit, DOWNLOAD_TERMS)), lambda t: F.contains(low, t))
    return F.contains(F.lower(decoded_path(url)), F.lit("/download")) & named


def listing_of_download(url: Column) -> Column:
    """The page that a /download/ url belongs to, its path in lower case; else null."""
    clean = F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")
    scheme, host, path = url_parts(clean)
    rest = F.regexp_replace(clean, SCHEME, "")
    whole = F.regexp_extract(rest, r"^(?://[^/?#]*)?([^?#]*)", 1)
    trimmed = F.lower(F.rtrim(path, F.lit("/")))
    base = F.substring_index(trimmed, "/download/", 1)
    tail = F.concat(F.substring(whole, F.length(path) + 1, 100_000), F.regexp_extract(rest, r"^[^?#]*(.*)$", 1))
    return F.when(F.contains(trimmed, F.lit("/download/")) & (base != ""), F.concat(scheme, F.lit("://"), host, base, tail))


def without_query(url: Column) -> Column:
    return strip(F.substring_index(url, "?", 1))


def is_search_result(url: Column) -> Column:
    """A url of the hub, without its query: the host first, then a path."""
    return F.contains(F.lower(url), F.lit(HUB)) & url.rlike(r"(?i)^https?://(?:[a-z0-9-]+\.)*hub\.binwise\.com/\S+")


def is_platform(url: Column) -> Column:
    return url.rlike(PLATFORMS)


def is_skipped(url: Column) -> Column:
    return url.rlike(SKIPPED)


def match_form(text: Column) -> Column:
    """Lower case, punctuation to blanks, one blank between words."""
    return strip(F.regexp_replace(F.regexp_replace(F.lower(text), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def significant_words(name: Column) -> Column:
    words = F.filter(F.split(match_form(name), " "), lambda w: w != "")
    kept = F.filter(words, lambda w: ~w.isin(*STOP_WORDS))
    return F.when(F.size(kept) > 0, kept).otherwise(words)


def name_on_page(name: Column, page: Column) -> Column:
    """A name of at most two telling words must stand whole; of a longer one, every word."""
    words, text, whole = significant_words(name), match_form(page), match_form(name)
    return F.coalesce(F.when(F.size(words) <= 2, (whole != "") & F.contains(text, whole)).otherwise(F.forall(words, lambda w: F.contains(text, w))), F.lit(False))


def looks_like_address(text: Column) -> Column:
    return (F.length(text) >= 10) & F.contains(text, F.lit(","))


def price_band(text: Column) -> Column:
    """The longest run of one to four dollar signs, the first of equals."""
    runs = F.regexp_extract_all(text, F.lit(r"(\${1,4})"), 1)
    longest = F.aggregate(runs, F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    return F.when(longest != "", longest)


#: The phrases that tell a distinction, in order.
PHRASES = (
    (("three michelin stars", "3 stars", "three stars"), "3-stars"),
    (("two michelin stars", "2 stars", "two stars"), "2-stars"),
    (("one michelin star", "1 star", "one star"), "1-star"),
    (("bib gourmand",), "bib-gourmand"),
)


def distinction(text: Column) -> Column:
    """The first distinction of which the text holds a phrase; 'selected' for none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = [F.when(F.exists(F.array(*map(F.lit, phrases)), lambda p: F.contains(low, p)), value) for phrases, value in PHRASES]
    return F.coalesce(*found, F.lit("selected"))


def city_state(url: Column) -> Column:
    """struct(city, state) from the segments before 'restaurant' in a guide's url."""
    parts = F.split(F.rtrim(url, F.lit("/")), "/")
    at = F.array_position(parts, "restaurant")
    words = lambda c: F.initcap(F.translate(c, "-_", "  "))
    city = words(F.regexp_replace(F.when(at >= 2, nullif_blank(F.try_element_at(parts, (at - 1).cast("int")))), r"[_-]\d+$", ""))
    slug = F.when(at >= 3, nullif_blank(F.try_element_at(parts, (at - 2).cast("int"))))
    known = F.create_map(*[F.lit(x) for kv in STATES.items() for x in kv])
    state = F.coalesce(F.try_element_at(known, slug), F.initcap(F.replace(slug, F.lit("-"), F.lit(" "))))
    return F.struct(city.alias("city"), state.alias("state"))


def page_count(total: Column, per_page: int = 48) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.floor((total + per_page - 1) / per_page).cast("long"))


def listing_pages(text: Column) -> Column:
    """struct(total, pages) from 'of N restaurants'; (0, 1) where there is no such text."""
    found = F.regexp_extract(F.coalesce(text, F.lit("")), r"(?i)of\s+([\d,]+)\s+restaurants?", 1)
    n = F.coalesce(F.regexp_replace(found, ",", "").try_cast("long"), F.lit(0).cast("long"))
    return F.struct(n.alias("total"), page_count(n).alias("pages"))


def listing_url(base: Column, level: Column, page: Column) -> Column:
    slugs = F.create_map(*[F.lit(x) for kv in LEVEL_SLUGS.items() for x in kv])
    slug = F.coalesce(F.try_element_at(slugs, F.lower(level)), F.lit(LEVEL_SLUGS["3"]))
    return F.concat(F.rtrim(base, F.lit("/")), F.when(slug != "", F.concat(F.lit("/"), slug)).otherwise(""), F.when(page > 1, F.concat(F.lit("/page/"), page.cast("string"))).otherwise(""))


def language_of(country: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.lower(strip(country))), F.lit("en"))


def country_of(site_name: Column) -> Column:
    """A site's country: its name without the first occurrence of the prefix."""
    at = F.instr(site_name, SITE_PREFIX)
    rest = F.concat(F.substring(site_name, F.lit(1), F.greatest(at - 1, F.lit(0))), F.substring(site_name, at + len(SITE_PREFIX), F.lit(100_000)))
    return F.when(at > 0, rest).otherwise(site_name)


def slug(name: Column) -> Column:
    return F.replace(F.replace(F.lower(name), F.lit(" "), F.lit("-")), F.lit("'"))


def safe_filename(name: Column, default: str = "wine_list") -> Column:
    """Nine reserved characters become '_', dots and blanks at the ends go. Of more than 200
    characters 190 stay before the last dot, or the first 200 where there is none."""
    clean = F.regexp_replace(F.translate(F.coalesce(name, F.lit("")), '<>:"/\\|?*', "_________"), r"^[. ]+|[. ]+$", "")
    stem, extension = F.regexp_extract(clean, r"(?s)^(.*)\.([^.]*)$", 1), F.regexp_extract(clean, r"(?s)^(.*)\.([^.]*)$", 2)
    cut = F.when(F.contains(clean, F.lit(".")), F.concat(F.substring(stem, 1, 190), F.lit("."), extension)).otherwise(F.substring(clean, 1, 200))
    short = F.when(F.length(clean) > 200, cut).otherwise(clean)
    return F.when(short == "", default).otherwise(short)


def download_name(url: Column, content_type: Column) -> Column:
    """struct(extension, filename) of a download: by the decoded path, '.pdf' where that
    tells nothing, corrected by the content type where the two disagree."""
    path = decoded_path(url)
    low, kind = F.lower(path), F.coalesce(F.lower(content_type), F.lit(""))
    html = F.endswith(low, F.lit(".html")) | F.endswith(low, F.lit(".htm"))
    first = F.when(html, ".html").otherwise(".pdf")
    named = F.when(html | F.endswith(low, F.lit(".pdf")), strip(F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1))).otherwise("wine_list.pdf")
    name = safe_filename(F.when((named == "") | (named == first), F.concat(F.lit("wine_list"), first)).otherwise(named))
    last = (
        F.when((first == ".pdf") & F.contains(kind, F.lit("html")) & ~F.contains(kind, F.lit("pdf")), ".html")
        .when((first == ".html") & F.contains(kind, F.lit("pdf")), ".pdf")
    )
    stem = F.when(F.contains(name, F.lit(".")), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise("wine_list")
    return F.struct(F.coalesce(last, first).alias("extension"), F.when(last.isNull(), name).otherwise(F.concat(stem, last)).alias("filename"))


def content_type_of(filename: Column) -> Column:
    """What a suggested filename says of the content."""
    low = F.lower(F.coalesce(filename, F.lit("")))
    return F.when(F.endswith(low, F.lit(".pdf")), "application/pdf").when(low.rlike(r"\.html?$"), "text/html").otherwise("application/octet-stream")


def is_spa_shell(page: Column, visible: Column) -> Column:
    """Two or more signs of a script-rendered shell, or much markup and little text."""
    signs = sum(((page.rlike(p)).cast("int") for p in SPA_SIGNS), F.lit(0))
    return (signs >= 2) | ((F.length(page) > 500) & (F.length(strip(visible)) < 100))


def duration_text(seconds: Column) -> Column:
    """'1h 2m 3s', '2m 3s' or '3s'."""
    s = seconds.cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, r)).when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))


def duration_of_job(seconds: Column) -> Column:
    """'75m 3s' or '3s'; '' for none."""
    s = seconds.cast("long")
    m, r = F.floor(s / 60), s % 60
    return F.when(s.isNull(), "").when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))


def duration_in_table(seconds: Column) -> Column:
    """'0m 3s'; '' for none and for 0."""
    s = seconds.cast("long")
    return F.when(nullif_blank(seconds).isNull(), "").otherwise(F.format_string("%dm %ds", F.floor(s / 60), s % 60))


def rounded(c: Column, digits: int) -> Column:
    """decimal(38,0): ``c`` times 10**digits, rounded as the exact value of the double is;
    an exact half goes to the even number. Exact for up to two digits below 2**30, and as
    ``bround`` beyond. Only what is close to a half needs the exact value."""
    x = F.abs(c.cast("double"))
    times = x * F.lit(float(10**digits))
    clear = (x < 2.0**30) & (F.abs(times - F.floor(times) - 0.5) > 1e-4)

    def scaled(bits: int) -> Column:  # a double in this range is a whole number of 2**-bits
        one = F.lit(2**bits).cast("decimal(38,0)")
        n = (x * F.lit(float(2**bits))).cast("long").cast("decimal(20,0)") * F.lit(10**digits).cast("decimal(9,0)")
        low = F.floor(n / one).cast("decimal(38,0)")
        rest = (n - low * one) * 2
        return low + F.when((rest > one) | ((rest == one) & (low % 2 == 1)), 1).otherwise(0)

    whole = F.when(clear, F.floor(times + 0.5).cast("decimal(38,0)")).when(x < 0.25, scaled(62)).when(x < 16, scaled(58)).when(x < 1024, scaled(52)).when(x < 2.0**20, scaled(42)).when(x < 2.0**30, scaled(32)).otherwise(F.bround(c.cast("string").cast("decimal(38,9)"), digits) * 10**digits)
    return (whole * F.when(c < 0, -1).otherwise(1)).cast("decimal(38,0)")


def one_digit(c: Column) -> Column:
    """A number of at least 0 with one digit after the point."""
    tenths = rounded(c, 1)
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("int").cast("string"))


def duration_of_crawl(seconds: Column) -> Column:
    """'3.5s' up to a minute, then '1.5m'; '' for none and for 0."""
    x = seconds.cast("double")
    return F.when(nullif_blank(seconds).isNull(), "").when(x < 60, F.concat(one_digit(x), F.lit("s"))).otherwise(F.concat(one_digit(x / 60), F.lit("m")))


def day_text(at: Column, missing: str = "Never") -> Column:
    return F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit(missing))


def minute_text(at: Column, missing: str = "Never") -> Column:
    return F.coalesce(F.date_format(at, "yyyy-MM-dd HH:mm"), F.lit(missing))


def second_text(at: Column, missing: str = "") -> Column:
    return F.coalesce(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(missing))


def progress_text(done: Column, all_: Column) -> Column:
    return F.concat_ws("/", F.coalesce(done, F.lit(0)).cast("string"), F.coalesce(all_, F.lit(0)).cast("string"))


def percent_text(done: Column, all_: Column) -> Column:
    """'12.5% complete'; null where there is nothing to do."""
    return F.when(all_ > 0, F.concat(one_digit(done / all_ * F.lit(100.0)), F.lit("% complete")))


def price_text(price: Column) -> Column:
    """'$12.50'; '' for none and for 0."""
    return F.when(nullif_blank(price).isNull(), "").otherwise(F.concat(F.lit("$"), price.cast("string")))


def hash_text(digest: Column) -> Column:
    return F.concat(F.left(digest, F.lit(8)), F.lit("..."))


def tick(c: Column) -> Column:
    return F.when(nullif_blank(c).isNull(), "\u2717").otherwise("\u2713")


def half_even(c: Column, digits: int = 2) -> Column:
    """A double, rounded as its exact value is; an exact half goes to the even digit."""
    return rounded(c, digits).cast("double") / F.lit(float(10**digits))


def seconds_between(start: Column, end: Column) -> Column:
    return ((F.unix_micros(end) - F.unix_micros(start)) / 1e6).cast("decimal(10,2)")


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is not positive."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def json_of(c: Column) -> Column:
    return F.to_json(c)


def without_fences(reply: Column) -> Column:
    """A reply in a code fence loses the lines that begin with the fence."""
    text = strip(reply)
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.startswith(x, F.lit("```"))), "\n")
    return F.when(F.startswith(text, F.lit("```")), kept).otherwise(text)


def parse_json_reply(reply: Column, schema: str) -> Column:
    """A JSON reply, perhaps in a code fence; malformed ones are null."""
    return F.from_json(without_fences(reply), schema, {"mode": "PERMISSIVE"})


def suggested_links(reply: Column) -> Column:
    """The ``links`` of a reply; none of a malformed one."""
    return F.coalesce(parse_json_reply(reply, "links array<string>, reasoning string")["links"], F.array().cast("array<string>"))


def address_parts(raw: Column, reply: Column) -> Column:
    """struct(address, city, state, zip, country) of a parser's reply; where that is
    missing or malformed, the raw text alone."""
    schema = "address string, city string, state string, zip string, country string"
    found = F.from_json(without_fences(reply), f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    fields = ("address", "city", "state", "zip", "country")
    parsed = F.struct(*[found[f].alias(f) for f in fields])
    plain = F.struct(strip(raw).alias("address"), *[F.lit(None).cast("string").alias(f) for f in fields[1:]])
    return F.when(found.isNotNull() & found["_bad"].isNull(), parsed).otherwise(plain)
