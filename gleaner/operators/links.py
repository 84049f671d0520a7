"""Links of pages and their scores: keyword ranks, context, documents, platforms."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions import scalars as X
from gleaner.functions.tree import Page

#: Keywords by rank, the first the most telling.
KEYWORDS = {
    "wine": {
        "en": ["wine list", "wine selections", "wine selection", "wine & cocktail selections", "wine & cocktails", "wine & spirits", "wine cocktail selections", "wine spirits", "wine program", "wine menu", "wine pairing", "wine dinner", "wine club", "wine", "cellar", "sommelier", "by the glass", "beverage program", "beverage menu", "beverage", "bar menu", "cocktail menu", "cocktail list", "cocktail selections", "spirits selections", "spirits", "drinks menu", "drinks list", "drink menu", "drink"],
        "fr": ["carte des vins", "liste des vins", "vins", "cave", "sommelier", "boissons", "menu des vins", "carte des boissons", "cocktails", "spiritueux", "vin", "carte du vin"],
        "es": ["carta de vinos", "lista de vinos", "vinos", "bodega", "sommelier", "bebidas", "carta de bebidas", "menu de vinos", "cocktails", "licores", "vino"],
    },
    "menu": {
        "en": ["menus & stories", "menus", "menu", "dine", "dining", "food & drink", "food and drink", "food & beverage", "the experience", "our menu", "daily menus", "chef's counter", "chefs counter", "chef's table", "chefs table", "tasting menu", "tasting", "bar tasting", "omakase", "prix fixe", "prix-fixe", "faq", "faqs", "frequently asked questions"],
        "fr": ["menus", "menu", "notre carte", "dégustation", "à propos", "nous", "faq", "informations", "la carte", "restaurant", "dining"],
        "es": ["menús", "menú", "nuestra carta", "degustación", "sobre nosotros", "faq", "información", "la carta", "restaurante", "comer"],
    },
    "info": {
        "en": ["about", "about us", "the restaurant", "our story", "guest information", "information", "visit", "plan your visit", "philosophy"],
        "fr": ["à propos", "nous", "informations", "visite", "histoire", "philosophie"],
        "es": ["sobre nosotros", "nosotros", "información", "visita", "historia", "filosofía"],
    },
    "context": {
        "en": ["wine list", "wine menu", "wine selection", "wine program", "beverage program", "beverage list", "available here", "download", "view our", "see our", "current version"],
        "fr": ["carte des vins", "liste des vins", "disponible", "télécharger", "voir notre", "version actuelle", "voir la carte"],
        "es": ["carta de vinos", "lista de vinos", "disponible", "descargar", "ver nuestra", "versión actual", "ver la carta"],
    },
    "pdf": {
        "en": ["wine", "vino", "cellar", "sommelier", "beverage", "spirits", "cocktail", "by-the-glass", "btg"],
        "fr": ["vin", "vins", "cave", "boissons", "sommelier", "carte"],
        "es": ["vino", "vinos", "bodega", "bebidas", "sommelier", "carta"],
    },
}
OTHER_DOCUMENTS = ["catering", "press", "event", "private-dining", "buyout", "resume"]


def keywords(name: str, language: str) -> list[str]:
    """A language's list follows the English one, whose weights rise with the length."""
    return [X.folded(k) for k in KEYWORDS[name]["en"] + (KEYWORDS[name][language] if language != "en" else [])]


def weighted(words: list[str], equal: int, within: int, in_href: int, text: Column, href: Column) -> Column:
    """Sum over keywords of rank r in a list of n, with weight n - r."""
    n = len(words)
    ranked = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(k.replace(" ", "-")).alias("slug"), F.lit(n - r).alias("w")) for r, k in enumerate(words)])

    def add(total: Column, x: Column) -> Column:
        in_text = F.when(text == x["k"], equal).when(F.contains(text, x["k"]), within).otherwise(0)
        return total + x["w"] * (in_text + F.when(F.contains(href, x["slug"]), in_href).otherwise(0))

    return F.aggregate(ranked, F.lit(0), add)


def hits(words: list[str], text: Column) -> Column:
    return F.aggregate(F.array(*[F.lit(w) for w in words]), F.lit(0), lambda n, w: n + F.contains(text, w).cast("int"))


def wine_score(text: Column, href: Column, language: str = "en") -> Column:
    return weighted(keywords("wine", language), 10, 5, 3, text, href)


def link_score(text: Column, href: Column, context: Column, language: str = "en") -> Column:
    """Menu words count only where no wine word did, informational ones only where
    neither did; every context phrase adds 25. Inputs are lower case, without accents."""
    wine = wine_score(text, href, language)
    menu = weighted(keywords("menu", language), 3, 2, 1, text, href)
    info = weighted(keywords("info", language), 1, 1, 1, text, href)
    score = F.when(wine > 0, wine).when(menu > 0, menu).otherwise(info)
    return score + F.lit(25) * hits(keywords("context", language), context)


def document_score(path: Column, text: Column, context: Column, language: str = "en") -> Column:
    terms = keywords("pdf", language)
    bad = F.array(*[F.lit(w) for w in OTHER_DOCUMENTS])
    minus = F.aggregate(bad, F.lit(0), lambda n, w: n + (F.contains(path, w) | F.contains(text, w)).cast("int"))
    return 10 * hits(terms, path) + 10 * hits(terms, text) + 5 * hits(terms, context) - 20 * minus


def external_score(url: Column, path: Column, text: Column, href: Column, context: Column, language: str = "en") -> Column:
    """The first rule that holds: platform, scored document, document in context,
    any document, context phrases, strong words. Null where none does."""
    near, pdf = hits(keywords("context", language), context), document_score(path, text, context, language)
    wine = wine_score(text, href, language)
    return (
        F.when(X.is_platform(url), 1000)
        .when(X.is_pdf(url) & (pdf > 0), 500 + pdf)
        .when(X.is_pdf(url) & (near > 0), 400)
        .when(X.is_pdf(url), 100)
        .when(near > 0, 300 + wine + 50 * near)
        .when(wine >= 50, wine)
    )


NEAR = frozenset("p div li section article span".split())
ANCHOR = "struct<pos:int,href:string,text:string,context:string>"


def anchors_of(html: str | None) -> list[tuple[int, str, str, str]]:
    """(pos, href, text, context) of a page's anchors with a reference, in document order.
    Strings are stripped and joined without a blank; the context is the text of the
    nearest container, lower case, its first 300 characters."""
    page = Page(html)
    texts = page.texts()
    near: list[int] = []  # by element: the nearest container around it
    for k, parent in enumerate(page.parents):
        near.append(parent if parent < 0 or page.tags[parent] in NEAR else near[parent])
    out = []
    contexts: dict[int, str] = {-1: ""}
    for k in page.find("a"):
        if "href" not in page.attrs[k]:
            continue
        if near[k] not in contexts:
            contexts[near[k]] = "".join(texts[page.first[near[k]] : page.last[near[k]]])[:1000].lower()[:300]
        out.append((len(out), page.attrs[k]["href"], "".join(texts[page.first[k] : page.last[k]]), contexts[near[k]]))
    return out


def anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """H1, H2: ``pages`` without the html, once for each anchor, with (pos, href, text, context)."""

    @F.pandas_udf(f"array<{ANCHOR}>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in batches:
            yield pd.Series([[dict(zip(("pos", "href", "text", "context"), x, strict=True)) for x in anchors_of(h)] for h in part], dtype=object)

    kept = [c for c in pages.columns if c != html]
    return pages.select(*kept, F.explode(found(html)).alias("_a")).select(*kept, "_a.*")


def resolved(found: DataFrame, url: str = "url") -> DataFrame:
    """``anchors`` of pages with a ``url``, with the absolute url, its normal form and
    host, and whether that is the page's; without the links that are skipped."""
    full = found.withColumn("abs_url", X.join_url(url, "href")).where(~X.is_skipped(F.col("abs_url")))
    full = full.withColumns({"link": X.normalize_url(F.col("abs_url")), "host": X.domain(F.col("abs_url"))})
    return full.withColumn("internal", F.col("host") == X.domain(F.col(url)))


def unvisited(links: DataFrame, visited: DataFrame | None, key: str) -> DataFrame:
    """Without links whose normal form the page's site has visited: ``visited(key, link)``."""
    return links if visited is None else links.join(visited.select(key, "link").distinct(), [key, "link"], "left_anti")


def plain_columns(links: DataFrame) -> DataFrame:
    """With the forms in which keywords are looked for."""
    return links.withColumns({"_text": X.fold_accents("text"), "_href": X.plain_reference("href"), "_context": X.fold_accents("context"), "_path": X.plain_path("abs_url")})


def by_language(language: Column, score) -> Column:  # noqa: ANN001
    """``score(language)`` of each row's language; English where it is another."""
    return F.when(language == "fr", score("fr")).when(language == "es", score("es")).otherwise(score("en"))


def internal_links(links: DataFrame, language: Column | None = None) -> DataFrame:
    """Of ``resolved`` links the scored ones of the page's own host, with ``score``
    above 0; the walk takes them by falling score, then in document order."""
    language = F.lit("en") if language is None else language
    score = by_language(language, lambda x: link_score(F.col("_text"), F.col("_href"), F.col("_context"), x))
    plain = plain_columns(links.where(F.col("internal")))
    return plain.withColumn("score", score).where("score > 0").drop("_text", "_href", "_context", "_path")


def external_links(links: DataFrame, language: Column | None = None) -> DataFrame:
    """H3, K4: of ``resolved`` links those to other hosts that may be lists, with ``score``
    and the text in lower case."""
    language = F.lit("en") if language is None else language

    def score(x: str) -> Column:
        return external_score(F.col("abs_url"), F.col("_path"), F.col("_text"), F.col("_href"), F.col("_context"), x)

    plain = plain_columns(links.where(~F.col("internal") & (F.col("host") != "")))
    kept = plain.withColumn("score", by_language(language, score)).where(F.col("score").isNotNull())
    return kept.withColumn("text", F.lower("text")).drop("_text", "_href", "_context", "_path")


def scored_documents(links: DataFrame, language: Column | None = None) -> DataFrame:
    """K3: links to documents, of any host, with ``score``."""
    language = F.lit("en") if language is None else language
    plain = plain_columns(links.where(X.is_pdf(F.col("abs_url"))))
    score = by_language(language, lambda x: document_score(F.col("_path"), F.col("_text"), F.col("_context"), x))
    return plain.withColumn("score", score).drop("_text", "_href", "_context", "_path")


def best_document(links: DataFrame, key: str, language: Column | None = None) -> DataFrame:
    """(key, url, score) of each page's best document, the first of equals, whatever
    its score: that a page was reached is sign enough."""
    best = F.max_by(F.struct("abs_url", "score"), F.struct(F.col("score"), -F.col("pos"))).alias("x")
    return scored_documents(links, language).groupBy(key).agg(best).select(key, F.col("x.abs_url").alias("url"), "x.score")


def linked_page(links: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """(key, pos, result) for external ``links(key, pos, abs_url, link)``: the url itself
    of a document, a platform or a download; else what its page among
    ``pages(link, html)`` leads to in one step: its best document, or its first link to a
    platform; null where that is nothing."""
    url = F.col("abs_url")
    itself = X.is_pdf(url) | X.is_platform(url) | X.is_download(url)
    direct = links.select(key, "pos", "link", F.when(itself, url).alias("direct"))
    wanted = direct.where(F.col("direct").isNull()).select("link").distinct()
    opened = pages.join(wanted, "link", "left_semi").select("link", "html")
    inner = anchors(opened).withColumn("abs_url", X.join_url("link", "href"))
    best = best_document(inner.withColumnRenamed("link", "page"), "page").select(F.col("page").alias("link"), F.col("url").alias("document"))
    platform = inner.where(X.is_platform(F.col("abs_url"))).groupBy("link").agg(F.min_by("abs_url", "pos").alias("platform"))
    joined = direct.join(best, "link", "left").join(platform, "link", "left")
    return joined.select(key, "pos", F.coalesce("direct", "document", "platform").alias("result"))


def nav_links(links: DataFrame, key: str, cap: int = 40) -> DataFrame:
    """Per page the first ``cap`` links of its own host, each url once, with a text
    of 1 to 100 characters. An earlier link of the same url, even without a text, hides the
    later ones. The context is cut to 150 characters, and '' where it is the text itself."""
    first = F.row_number().over(Window.partitionBy(key, "link").orderBy("pos"))
    kept = links.where(F.col("internal")).withColumn("_n", first).where((F.col("_n") == 1) & F.length("text").between(1, 100)).drop("_n")
    place = F.row_number().over(Window.partitionBy(key).orderBy("pos"))
    short = F.left("context", F.lit(150))
    capped = kept.withColumn("_k", place).where(F.col("_k") <= cap)
    listed = F.struct("pos", F.col("abs_url").alias("url"), "text", F.when(short != F.lower("text"), short).otherwise("").alias("context"), X.is_pdf(F.col("abs_url")).alias("is_pdf"))
    return capped.groupBy(key).agg(F.sort_array(F.collect_list(listed)).alias("links"))


def first_found(cached: Column, cached_is_there: Column, searched: Column) -> Column:
    """A list known before comes first if it is still there, then what the search found."""
    return F.coalesce(F.when(F.coalesce(cached_is_there, F.lit(False)), X.nullif_blank(cached)), X.nullif_blank(searched))


def two_passes(results: DataFrame, key: str, name: str) -> DataFrame:
    """(key, url) from ``results(key, name, pass, rank, url, page_text)``: of pass 1,
    else of pass 2, the first result of the hub whose page bears the name; null for none.
    A blank name finds nothing."""
    url = X.without_query(F.col("url"))
    fits = X.is_search_result(url) & X.name_on_page(F.col(name), F.col("page_text")) & (X.strip(F.col(name)) != "")
    found = F.min_by(F.when(fits, url), F.when(fits, F.struct("pass", "rank")))
    return results.groupBy(key).agg(found.alias("url"))
