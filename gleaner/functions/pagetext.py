"""Text of pages: structured text, full text, and the choice between them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.scalars import strip
from gleaner.functions.tree import Page

#: Elements whose text is dropped, those whose start and end flush a line
#: of the full text, and the styles that hide an element.
DROPPED = frozenset("script style noscript svg meta link".split())
LINES = frozenset(
    "div section article aside header footer nav main h1 h2 h3 h4 h5 h6 p blockquote pre ul ol li table tr td th br hr dd dt dl figcaption figure details summary".split()
)
HIDDEN = ("display:none", "visibility:hidden")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SNIPPET_TAGS = ("h1", "h2", "h3", "h4", "p", "li")
NOT_VISIBLE = frozenset("script style noscript".split())


def table_text(rows: list[list[str | None]]) -> str:
    """Rows of cells padded to their column's width, with a rule as long as the first
    row under it; a missing cell is empty."""
    shown = [["" if cell is None else str(cell) for cell in row] for row in rows or []]
    widths: dict[int, int] = {}
    for row in shown:
        for k, cell in enumerate(row):
            widths[k] = max(widths.get(k, 0), len(cell))
    lines = [" | ".join(cell.ljust(widths[k]) for k, cell in enumerate(row)) for row in shown]
    return "\n".join([*lines[:1], *["-" * len(x) for x in lines[:1]], *lines[1:]])


@F.pandas_udf(T.StringType())
def table_texts(tables: pd.Series) -> pd.Series:
    """Of array<array<string>>."""
    return pd.Series([None if t is None else table_text([list(r) for r in t]) for t in tables], dtype=object)


def semantic(page: Page, texts: list[str], gone: list[bool]) -> str:
    """Headings, paragraphs, list items and tables; nested matches repeat their text."""
    out = []
    text = lambda k: "".join(texts[page.first[k] : page.last[k]])
    for k, tag in enumerate(page.tags):
        if gone[k]:
            continue
        if tag in HEADINGS:
            if found := text(k):
                out.append(f"\n{'#' * int(tag[1])} {found}\n")
        elif tag == "p":
            if found := text(k):
                out.append(f"{found}\n")
        elif tag in ("ul", "ol"):
            out += [f"  • {found}\n" for c in range(k + 1, page.ends[k]) if page.tags[c] == "li" and page.parents[c] == k and (found := text(c))]
        elif tag == "table":
            out.append("\n[TABLE]\n")
            for r in range(k + 1, page.ends[k]):
                if page.tags[r] == "tr":
                    cells = [text(c) for c in range(r + 1, page.ends[r]) if page.tags[c] in ("td", "th")]
                    out += [" | ".join(cells) + "\n"] if cells else []
            out.append("\n")
    return "".join(out)


def full(page: Page, texts: list[str], gone: list[bool]) -> str:
    """All text of the body that no style hides, a line for each block, its strings one
    blank apart; of the whole page where there is no body."""
    lines: list[str] = []
    current: list[str] = []

    def flush() -> None:
        if line := " ".join(current).strip():
            lines.append(line)
        current.clear()

    body = next(iter(k for k in page.find("body") if not gone[k]), None)
    hidden = 0
    open_ = body is None
    for what, k in page.events:
        if what == 0:
            if open_ and not hidden and texts[k]:
                current.append(texts[k])
            continue
        if k == body:
            open_ = what == 1
        style = page.attrs[k].get("style", "").replace(" ", "")
        if any(h in style for h in HIDDEN):
            hidden += what
        elif open_ and not hidden and page.tags[k] in LINES:
            flush()
    flush()
    return "\n".join(lines)


FIELDS = ("semantic", "full", "visible", "title", "snippets", "whole")


def read(html: str | None) -> tuple[str, ...]:
    page = Page(html)
    gone, texts = page.within(DROPPED), page.texts(DROPPED)
    every = page.texts()
    seen = page.texts(NOT_VISIBLE)
    text = lambda k: "".join(every[page.first[k] : page.last[k]])
    heads = [text(k) for k in [*page.find("title")[:1], *page.find("h1", "h2")]]
    pieces = [x for k in page.find(*SNIPPET_TAGS) if len(x := text(k)) > 3]
    code = [o >= 0 and page.tags[o] in ("script", "style", "template") for o in page.owners]
    whole = "".join(s for s, c in zip(page.strings, code, strict=True) if not c)
    return (
        semantic(page, texts, gone), full(page, texts, gone), " ".join(x for x in seen if x), " ".join(x for x in heads if x),
        " | ".join(pieces)[:500], whole,
    )


@F.pandas_udf(T.StructType([T.StructField(k, T.StringType()) for k in FIELDS]))
def page_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """struct: the semantic and full text, the visible text (for the shell test), the title
    with all h1 and h2, snippets of headings, paragraphs and items, and the whole text as it stands."""
    for pages in batches:
        yield pd.DataFrame([read(p) for p in pages], columns=list(FIELDS))


def chosen(texts: Column) -> Column:
    """The full text where it is more than twice as long as the structured one, or
    that has fewer than 200 characters; else the structured text."""
    s, f = F.length(strip(texts["semantic"])), F.length(strip(texts["full"]))
    return F.when((f > 2 * s) | (s < 200), texts["full"]).otherwise(texts["semantic"])
