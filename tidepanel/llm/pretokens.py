"""Memoised encoding of texts by their pre-tokens.

A byte-level BPE vocabulary encodes every match of its split pattern on its
own, and a single space between two other characters always starts a match.
So a text falls apart at those spaces into pieces whose ids don't depend on
their neighbours, and frequent pieces are encoded once per worker. The ids of
a text are handled as bytes: little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import re
from collections.abc import Callable

# Letters and digits of the Latin blocks below U+0250.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
DIGITS = "0-9²³¹¼-¾"

#: The split pattern of the vocabularies with those blocks spelt out.
LATIN_SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^\s{LETTERS}{DIGITS}]+|\s+(?!\S)|\s+"
)
#: Texts for which both patterns match alike.
LATIN_ONLY = re.compile("[\t-\r\x20-\x7e¡-ɏ]*")


#: Bytes of a generation of the larger memo. An encoder's memos take up to two and a half times as much.
MEMO_BYTES = 24 << 20


class _Unsafe(Exception):
    """A piece whose split depends on its neighbours."""


#: Longer pieces are encoded anew each time.
LONGEST_KEPT = 32
#: About what an entry takes beside the bytes of its key and value.
ENTRY_BYTES = 180


class _Memo(dict):
    """A dict that computes what it lacks, and holds about `room` bytes in each of two generations.

    When it is full it becomes the older generation; entries of that one come
    back as they are used, and the rest of them goes at the next turn. Keys of
    more than `LONGEST_KEPT` characters are not kept.
    """

    def __init__(self, make: Callable[[str], bytes], room: int):
        super().__init__()
        self.make, self.room, self.size, self.older = make, room, 0, {}

    def __missing__(self, key: str) -> bytes:
        n = len(key)
        if n > LONGEST_KEPT:
            return self.make(key)
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        # A character takes up to four bytes, as ASCII one.
        self.size += len(value) + ENTRY_BYTES + (n if key.isascii() else 4 * n)
        if self.size > self.room:
            self.older = dict(self)
            self.clear()
            self.size = 0
        self[key] = value
        return value


class MemoEncoder:
    """Ids of whole texts, from an encoder of single pre-tokens.

    `encode_pretoken` gives the ids of one match of the split pattern,
    `split` the matches of any text. `room` and `word_room` are the bytes of each of a memo's two generations.
    """

    def __init__(
        self, encode_pretoken: Callable[[str], bytes], split: Callable[[str], list[str]],
        room: int = MEMO_BYTES // 4, word_room: int = MEMO_BYTES,
    ):
        self._split = split
        self._encode_pretoken = encode_pretoken
        self._pretokens = _Memo(encode_pretoken, room)
        self._words = _Memo(self._word, word_room)

    def _pieces(self, text: str) -> list[str]:
        plain = (text.isascii() and text.isprintable()) or LATIN_ONLY.fullmatch(text)
        return LATIN_SPLIT.findall(text) if plain else self._split(text)

    def _whole(self, text: str) -> bytes:
        return b"".join(map(self._pretokens.__getitem__, self._pieces(text)))

    def _word(self, word: str) -> bytes:
        """A piece and the space before it."""
        ascii_only = word.isascii()
        if ascii_only and word.isalpha():
            return self._encode_pretoken(" " + word)  # always one match
        if word != word.strip() or not word:
            raise _Unsafe
        spaced = " " + word
        plain = ascii_only and word.isprintable() or LATIN_ONLY.fullmatch(word)
        pieces = LATIN_SPLIT.findall(spaced) if plain else self._split(spaced)
        first = pieces[0]
        if len(pieces) == 1:
            return self._encode_pretoken(first)  # the entry of the word itself keeps it
        head = first[1:]
        # Letters share the entry of the bare word.
        known = self._words[head] if head.isalpha() and head.isascii() else self._pretokens[first]
        if len(pieces) == 2:
            return known + self._pretokens[pieces[1]]
        return known + b"".join([self._pretokens[p] for p in pieces[1:]])

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = text.split(" ")
        if not rest or first[-1:].isspace():
            return self._whole(text)
        try:
            return self._whole(first) + b"".join(map(self._words.__getitem__, rest))
        except _Unsafe:
            return self._whole(text)
