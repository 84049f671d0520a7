"""Terms of whole texts by two byte operations: a table that turns what stands between
terms into spaces and A-Z into a-z, and a split. In UTF-8 every byte of a letter beyond
ASCII is 128 or more, so the table decides by single bytes and never by code points."""

from __future__ import annotations


def spacing(digits: bool) -> bytes:
    """The table: letters, all beyond ASCII and, if asked for, digits are kept."""
    kept = {*b"abcdefghijklmnopqrstuvwxyz", *range(128, 256)} | ({*b"0123456789"} if digits else set())
    return bytes(b + 32 if 65 <= b <= 90 else b if b in kept else 32 for b in range(256))


def terms_of(text: str | None, table: bytes) -> list[bytes]:
    """The terms in their order; none for a null text."""
    return text.encode("utf-8", "surrogatepass").translate(table).split() if text else []
