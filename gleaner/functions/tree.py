"""A page as flat lists in document order: elements, their strings and their extents.

Unclosed elements stay open, so later ones nest in them; nothing here recurses, so a
page may be nested as deep as it likes. An element's strings, and the elements inside
it, are ranges of the lists."""

from __future__ import annotations

from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose strings are code, not text.
CODE = frozenset("script style template".split())


class Page(HTMLParser):
    """``tags``, ``attrs``, ``parents``, ``ends`` (of elements) and ``first``, ``last`` (of
    strings) by element; ``strings``, ``owners`` by string; ``events`` in order: (1, element)
    for a start, (-1, element) for an end, (0, string)."""

    def __init__(self, page: str | None) -> None:
        super().__init__(convert_charrefs=True)
        self.tags: list[str] = []
        self.attrs: list[dict] = []
        self.parents: list[int] = []
        self.ends: list[int] = []
        self.first: list[int] = []
        self.last: list[int] = []
        self.strings: list[str] = []
        self.owners: list[int] = []
        self.events: list[tuple[int, int]] = []
        self.stack: list[int] = []
        self.counts: dict[str, int] = {}  # open elements by tag
        self.feed(page or "")
        self.close()
        while self.stack:
            self.pop()

    def pop(self) -> None:
        k = self.stack.pop()
        self.counts[self.tags[k]] -= 1
        self.ends[k], self.last[k] = len(self.tags), len(self.strings)
        self.events.append((-1, k))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        k = len(self.tags)
        self.tags.append(tag)
        self.attrs.append({name: value or "" for name, value in attrs})
        self.parents.append(self.stack[-1] if self.stack else -1)
        self.ends.append(0)
        self.first.append(len(self.strings))
        self.last.append(0)
        self.events.append((1, k))
        self.stack.append(k)
        self.counts[tag] = self.counts.get(tag, 0) + 1
        if tag in VOID:
            self.pop()

    def handle_endtag(self, tag: str) -> None:
        if self.counts.get(tag):
            while self.tags[self.stack[-1]] != tag:
                self.pop()
            self.pop()

    def handle_data(self, data: str) -> None:
        self.events.append((0, len(self.strings)))
        self.strings.append(data)
        self.owners.append(self.stack[-1] if self.stack else -1)

    def within(self, tags: frozenset[str]) -> list[bool]:
        """By element, and last for the page: whether it is, or is in, one of ``tags``."""
        out: list[bool] = []
        for tag, parent in zip(self.tags, self.parents, strict=True):
            out.append(tag in tags or (parent >= 0 and out[parent]))
        return [*out, False]

    def texts(self, dropped: frozenset[str] = frozenset()) -> list[str]:
        """The strings, stripped; '' for code and for what is in ``dropped`` elements."""
        gone = self.within(dropped) if dropped else None
        return ["" if (o >= 0 and self.tags[o] in CODE) or (gone and gone[o]) else s.strip() for s, o in zip(self.strings, self.owners, strict=True)]

    def find(self, *tags: str) -> list[int]:
        return [k for k, tag in enumerate(self.tags) if tag in tags]
