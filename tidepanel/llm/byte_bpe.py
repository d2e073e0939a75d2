"""Byte-level BPE in linear time, by longest matches and backtracking.

Method: the vocabulary's byte strings, read as Latin-1, are the patterns of an
Aho-Corasick automaton. A pre-token is covered from the left by the longest
entry that starts at each place. Two adjacent entries are compatible if the
merges of their joined bytes give the same two entries back; the encoding in
which all neighbours are compatible is the one that the merges give, and there
is only one. An entry that does not fit its left neighbour gives way to its
next shorter prefix in the vocabulary, and a place that has no fitting entry is
never tried again, so each place is left at most once.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tidepanel.llm.common import free_name, ship_package, text_or_empty
from tidepanel.llm.pretokens import MemoEncoder
from tidepanel.llm.vocabularies import id_bytes


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ranks of a rank file: base64 and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merge_by_rank(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The merges as defined: join the adjacent pair of least rank, leftmost first."""
    parts = [data[i : i + 1] for i in range(len(data))]
    get, none = ranks.get, len(ranks)
    pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs and (rank := min(pairs)) != none:
        at = pairs.index(rank)
        joined = parts[at] + parts[at + 1]
        parts[at : at + 2] = [joined]
        del pairs[at]
        if at:
            pairs[at - 1] = get(parts[at - 1] + joined, none)
        if at < len(pairs):
            pairs[at] = get(joined + parts[at + 1], none)
    return [ranks[p] for p in parts]


class BytePairs:
    """Encoder of single pre-tokens and decoder of ids."""

    def __init__(self, ranks: dict[bytes, int], pair_room: int = 1_000_000):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"single bytes without a rank: {missing[:5]}")
        self.ranks = ranks
        self.entries = {rank: entry for entry, rank in ranks.items()}
        self.sizes = {rank: len(entry) for entry, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for entry, rank in ranks.items():
            if len(entry) > 1:
                self.automaton.add_word(entry.decode("latin-1"), (len(entry), rank))
        if len(self.automaton):
            self.automaton.make_automaton()
        self._single = [ranks[bytes([b])] for b in range(256)]
        # By `left * _span + right`, one number; `_begin` stands left of a pre-token's first entry.
        self._pairs: dict[int, bool] = {}
        self._begin = max(ranks.values()) + 1
        self._span = self._begin + 1
        self._shorter = {rank: self._prefix(entry) for entry, rank in ranks.items()}
        self._pair_room = pair_room

    def _prefix(self, entry: bytes) -> int:
        return next((self.ranks[entry[:n]] for n in range(len(entry) - 1, 0, -1) if entry[:n] in self.ranks), -1)

    def fits(self, left: int, right: int) -> bool:
        """Do the merges of the two entries' bytes give just these two?"""
        known = self._pairs.get(left * self._span + right)
        if known is None:
            known = merge_by_rank(self.entries[left] + self.entries[right], self.ranks) == [left, right]
            self._keep(left, right, known)
        return known

    def alone(self, token: int) -> bool:
        """Do the merges of the entry's own bytes give it back?"""
        known = self._pairs.get(self._begin * self._span + token)
        if known is None:
            known = merge_by_rank(self.entries[token], self.ranks) == [token]
            self._keep(self._begin, token, known)
        return known

    def _keep(self, left: int, right: int, known: bool) -> None:
        if len(self._pairs) >= self._pair_room:
            self._pairs.clear()
        self._pairs[left * self._span + right] = known

    def shorter(self, token: int) -> int:
        """The longest entry that is a proper prefix of `token`'s bytes; -1 for single bytes."""
        return self._shorter[token]

    def encode(self, data: bytes) -> list[int]:
        """Ids of one pre-token's bytes."""
        if not data:
            return []
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        total = len(data)
        longest = list(map(self._single.__getitem__, data))
        for end, (n, rank) in self.automaton.iter(data.decode("latin-1")) if len(self.automaton) else ():
            longest[end + 1 - n] = rank  # ends ascend, so the last is the longest
        known_pairs, sizes, shorter, span, begin = self._pairs, self.sizes, self._shorter, self._span, self._begin
        dead = bytearray(total + 1)
        chosen: list[int] = []
        at, token, left = 0, longest[0], begin
        while at < total:
            while token >= 0:
                stop = at + sizes[token]
                if not dead[stop]:
                    fits = known_pairs.get(left * span + token)
                    if fits is None:
                        fits = self.alone(token) if left == begin else self.fits(left, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                chosen.append(token)
                at, left = stop, token
                token = longest[at] if at < total else 0
            else:
                dead[at] = 1
                if not chosen:
                    raise ValueError("no encoding: the ranks are not those of merges")
                token = chosen.pop()
                at -= sizes[token]
                left = chosen[-1] if chosen else begin
                token = shorter[token]
        return chosen

    def decode(self, ids) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


#: Bytes of a generation of the larger memo of a worker that encodes by ranks.
RANK_MEMO = 96 << 20


@lru_cache(maxsize=2)
def pairs_of(path: str) -> BytePairs:
    return BytePairs(read_ranks(path))


@lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str) -> MemoEncoder:
    pairs = pairs_of(path)
    return MemoEncoder(
        lambda pretoken: id_bytes(pairs.encode(pretoken.encode("utf-8"))), regex.compile(pattern).findall,
        room=RANK_MEMO // 4, word_room=RANK_MEMO,
    )


def encode_texts(documents: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """`documents` and a column `ids`: the ids of the whole text, as bytes.

    Little-endian unsigned 32-bit integers. Null is empty text, which has no
    ids. Rows, their order and other columns stay; a column of that name is
    replaced.
    """

    ship_package(documents.sparkSession)
    @F.arrow_udf("binary")
    def encoded(texts: pa.Array) -> pa.Array:
        encode = rank_encoder(path, pattern).encode
        return pa.array((encode(t.as_py()) for t in texts), pa.binary())

    return documents.withColumn("ids", encoded(text_or_empty(text_col)))


def decode_ids(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """`encoded` and a column `decoded`: the bytes that the ids stand for; null has none."""

    ship_package(encoded.sparkSession)
    @F.arrow_udf("binary")
    def decoded(rows: pa.Array) -> pa.Array:
        decode = pairs_of(path).decode
        return pa.array((decode(memoryview(r.as_py() or b"").cast("I")) for r in rows), pa.binary())

    return encoded.withColumn("decoded", decoded(F.col(ids_col)))


def round_trip(
    documents: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode, decode, and one row per document: id, n_tokens, SHA-256 of ids and of decoded bytes.

    Both steps run in one pass over the texts; neither ids nor decoded bytes
    leave the Python worker. Null ids and repeated rows are kept as they are;
    an empty table gives an empty result.
    """
    result = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>"

    ship_package(documents.sparkSession)
    @F.arrow_udf(result)
    def digest(texts: pa.Array) -> pa.Array:
        encode, decode = rank_encoder(path, pattern).encode, pairs_of(path).decode
        sizes, ids, back = [], [], []
        for text in texts:
            coded = encode(text.as_py())
            sizes.append(len(coded) // 4)
            ids.append(hashlib.sha256(coded).hexdigest())
            back.append(hashlib.sha256(decode(memoryview(coded).cast("I"))).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
            names=["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    out = free_name(documents, "digest")
    return documents.select(F.col(id_col), digest(text_or_empty(text_col)).alias(out)).select(id_col, f"{out}.*")
