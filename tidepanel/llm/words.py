"""Runs of ASCII letters, digits and characters beyond ASCII, as the searches take them."""

from __future__ import annotations

# Every other ASCII character is turned into a space, A-Z into a-z.
_WORD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a whole text in order; null has none."""
    return text.encode("utf-8").translate(_WORD).split() if text else []
