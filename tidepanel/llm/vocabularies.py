"""Public vocabularies as pre-token encoders, one instance per Python worker."""

from __future__ import annotations

import array
import json
import sys
from functools import lru_cache

import regex
from tokenizers import Tokenizer

from tidepanel.llm.pretokens import MEMO_BYTES, MemoEncoder


def id_bytes(ids) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array.array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the
    characters from U+0100 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class LibraryEncoder(MemoEncoder):
    """Encoder whose vocabulary has added tokens: texts that hold one go to the library whole."""

    def __init__(self, whole: Tokenizer, **options):
        super().__init__(**options)
        self._library = whole
        self._added = tuple(t.content for t in whole.get_added_tokens_decoder().values() if t.content)

    def encode(self, text: str) -> bytes:
        if any(t in text for t in self._added):
            return id_bytes(self._library.encode(text, add_special_tokens=False).ids)
        return super().encode(text)


@lru_cache(maxsize=2)
def library_encoder(path: str, pattern: str, memo_bytes: int = MEMO_BYTES) -> MemoEncoder:
    """The ids that the tokenizers library gives without special tokens at the ends.

    `memo_bytes` bounds a generation of its larger memo.

    The library splits at white space and letters itself; its own splitting
    is left out here only for pre-tokens that it would not split further.
    """
    whole = Tokenizer.from_file(path)
    model = whole.model
    model._resize_cache(0)  # the memo keeps more than the library's own cache
    coded = [i.to_bytes(4, "little") for i in range(max(whole.get_vocab().values()) + 1)]
    letters = byte_letters()
    to_letters = str.maketrans({chr(b): letters[b] for b in range(256)})

    def encode(pretoken: str) -> bytes:
        if pretoken.isascii() and pretoken.isprintable():
            spelt = pretoken.replace(" ", letters[0x20])
        else:
            spelt = pretoken.encode("utf-8").decode("latin-1").translate(to_letters)
        return b"".join([coded[t.id] for t in model.tokenize(spelt)])

    return LibraryEncoder(
        whole, encode_pretoken=encode, split=regex.compile(pattern).findall, room=memo_bytes // 4, word_room=memo_bytes
    )


@lru_cache(maxsize=2)
def spellings(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; ids that it lacks have none."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    vocabulary = parts["model"]["vocab"]
    added = {t["id"]: t["content"] for t in parts["added_tokens"]}
    out = [b""] * (max([*vocabulary.values(), *added]) + 1)
    byte_of = str.maketrans({letter: chr(b) for b, letter in enumerate(byte_letters())})
    for token, i in vocabulary.items():
        if i not in added:
            out[i] = token.translate(byte_of).encode("latin-1")
    for i, content in added.items():
        out[i] = content.encode("utf-8")
    return out
