"""Pages of a guide: listing cards, and the fields of a venue's page."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import scalars as X
from gleaner.functions.tree import Page

#: The guide's host, its card classes, and words of website links.
GUIDE = "https://guide.michelin.com"
GUIDE_HOST = "guide.michelin.com"
CARDS, CARD, TITLE = "js-restaurant__list_items", "js-restaurant__list_item", "card__menu-content--title"
WEBSITE_WORDS = ("website", "visit", "www", "home")


def has_class(page: Page, k: int, name: str) -> bool:
    return name in page.attrs[k].get("class", "").split()


def cards_of(page: Page) -> list[str] | None:
    """Absolute urls of the cards of the first results container; None without one."""
    box = next((k for k in page.find("div") if has_class(page, k, CARDS)), None)
    if box is None:
        return None
    out = []
    for card in range(box + 1, page.ends[box]):
        if page.tags[card] != "div" or not has_class(page, card, CARD):
            continue
        title = next((k for k in range(card + 1, page.ends[card]) if page.tags[k] == "h3" and has_class(page, k, TITLE)), None)
        if title is None:
            continue
        href = next((page.attrs[k]["href"] for k in range(title + 1, page.ends[title]) if page.tags[k] == "a" and "href" in page.attrs[k]), "")
        if "/restaurant/" in href:
            out.append(urljoin(GUIDE, href))
    return out


def whole_text(page: Page) -> str:
    return "".join(s for s, o in zip(page.strings, page.owners, strict=True) if o < 0 or page.tags[o] not in ("script", "style", "template"))


@F.pandas_udf(T.StructType([T.StructField("urls", T.ArrayType(T.StringType())), T.StructField("text", T.StringType())]))
def cards(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for pages in batches:
        read = [Page(p) for p in pages]
        yield pd.DataFrame({"urls": [cards_of(p) for p in read], "text": [whole_text(p) for p in read]}, dtype=object)


def listing_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without the html, with ``urls``, ``total`` and ``pages``; a
    page without a results container has no urls and counts 0 of 0."""
    kept = [c for c in pages.columns if c != html]
    found = pages.select(*kept, cards(html).alias("_c")).withColumn("_n", X.listing_pages(F.col("_c.text")))
    there = F.col("_c.urls").isNotNull()
    return found.select(
        *kept, F.coalesce("_c.urls", F.array().cast("array<string>")).alias("urls"),
        F.when(there, F.col("_n.total")).otherwise(0).alias("total"), F.when(there, F.col("_n.pages")).otherwise(0).alias("pages"),
    )


def website_of(links: list[tuple[str, str]]) -> str | None:
    """The first link that says so, else the first whose text hints at a website."""
    outside = [(href, text) for href, text in links if href.startswith("http") and GUIDE_HOST not in href]
    told = next((href for href, text in outside if "Visit Website" in text), None)
    return told or next((href for href, text in outside if any(w in text.lower() for w in WEBSITE_WORDS)), None)


def address_like(text: str) -> bool:
    return len(text) >= 10 and "," in text


def address_of(page: Page, texts: list[str]) -> str | None:
    """An element named after an address, else the first fitting one after the heading."""
    spaced = lambda k: " ".join(x for x in texts[page.first[k] : page.last[k]] if x)
    for attribute in ("class", "data-testid"):
        for k, attrs in enumerate(page.attrs):
            value = attrs.get(attribute, "").lower()
            if "address" in value or "location" in value:
                text = spaced(k)
                if len(text) < 300 and address_like(text):
                    return text
    heading = next(iter(page.find("h1")), None)
    if heading is None:
        return None
    end = page.ends[page.parents[heading]] if page.parents[heading] >= 0 else len(page.tags)
    for k in range(page.ends[heading], end):
        if page.parents[k] != page.parents[heading]:
            continue
        text = spaced(k)
        if not text or len(text) > 250:
            continue
        if "$" in text or "Cuisine" in text or "Visit Website" in text:
            return None
        if address_like(text):
            return text
    return None


FIELDS = ("name", "website_url", "whole", "address_block", "cuisine")


def venue(html: str | None) -> tuple:
    page = Page(html)
    texts = page.texts()
    text = lambda k: "".join(texts[page.first[k] : page.last[k]])
    heading = next(iter(page.find("h1")), None)
    links = [(page.attrs[k]["href"], text(k)) for k in page.find("a") if "href" in page.attrs[k]]
    cuisine = next((t for k in page.find("span", "div", "p") if page.last[k] > page.first[k] and "cuisine" in (t := text(k)).lower() and len(t) < 60), None)
    return "Unknown" if heading is None else text(heading), website_of(links), whole_text(page), address_of(page, texts), cuisine


@F.pandas_udf(T.StructType([T.StructField(f, T.StringType()) for f in FIELDS]))
def venue_fields(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for pages in batches:
        yield pd.DataFrame([venue(p) for p in pages], columns=list(FIELDS), dtype=object)


def venue_pages(pages: DataFrame, html: str = "html", reply: Column | None = None, site_name: Column | None = None) -> DataFrame:
    """``pages(url, html)`` without the html, with the fields of
    a venue. ``reply`` is an address parser's answer, if there is one; a page without an
    address takes city and state from its url. The country is the address's, else the site's."""
    kept = [c for c in pages.columns if c != html]
    reply = F.lit(None).cast("string") if reply is None else reply
    site = F.lit(None).cast("string") if site_name is None else X.country_of(site_name)
    found = pages.select(*kept, venue_fields(html).alias("_v"), reply.alias("_reply"), site.alias("_site"))
    block = F.col("_v.address_block")
    place, parts = X.city_state(F.col("url")), X.address_parts(block, F.col("_reply"))
    got = lambda f: F.when(block.isNotNull(), parts[f])
    return found.select(
        *kept, F.col("_v.name").alias("name"), F.col("_v.website_url").alias("website_url"), X.distinction(F.col("_v.whole")).alias("distinction"), got("address").alias("address"),
        F.when(block.isNotNull(), parts["city"]).otherwise(place["city"]).alias("city"), F.when(block.isNotNull(), parts["state"]).otherwise(place["state"]).alias("state"),
        got("zip").alias("zip_code"), F.coalesce(X.nullif_blank(got("country")), F.col("_site")).alias("country"), F.col("_v.cuisine").alias("cuisine"), X.price_band(F.col("_v.whole")).alias("price_range"),
    )
