"""Near duplicates by SimHash: blocks of the fingerprint as join keys.

Two fingerprints that differ in at most `distance` bits agree in all but
`distance` of any blocks the bits are dealt out to. With `blocks` blocks they
agree in at least `blocks - distance` of them at once, so every choice of so
many blocks is a key, and close pairs meet under one of them. Only keys that several
fingerprints share go on; inside a key the exact distances are taken, and each
linked part is passed on as a star, not as all its pairs. A key with many
fingerprints is cut into tiles, and every pair of tiles is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidepanel.llm.common import free_name, one_of_each, ship_package, text_or_empty
from tidepanel.operators.components import connected_components
from tidepanel.session import materialize

BITS = 64
#: Fixed value: the seed of the shingle hash.
SEED = 42


def fingerprint(text: str, words: int) -> int:
    """The SimHash of the text's word shingles; zero if there are no words."""
    # Splitting bytes uses just the ASCII white space, lower() just A-Z.
    data = b" ".join(text.encode("utf-8").lower().split())
    if not data:
        return 0
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x20)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(data)][words - 1 :] or [len(data)]
    digest = xxhash.xxh64_intdigest
    over = np.zeros(BITS, np.int64)
    step = 1 << 16
    for at in range(0, len(ends), step):
        spans = zip(starts[at : at + step], ends[at : at + step])
        hashes = np.array([digest(data[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        over += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(over * 2 > len(ends), bitorder="little")
    return int(set_bits.view("<u8")[0])


def with_fingerprint(documents: DataFrame, out: str, words: int, text_col: str = "text") -> DataFrame:
    """`documents` and a column with the fingerprint as a signed 64-bit integer."""
    ship_package(documents.sparkSession)

    @F.arrow_udf("long")
    def of_text(texts: pa.Array) -> pa.Array:
        prints = np.fromiter((fingerprint(t.as_py(), words) for t in texts), np.uint64, len(texts))
        return pa.array(prints.view(np.int64))

    return documents.withColumn(out, of_text(text_or_empty(text_col)))


def block_masks(distance: int, blocks: int) -> list[int]:
    """Masks, as signed integers, of every choice of `blocks - distance` blocks."""
    if not distance < blocks <= BITS:
        raise ValueError("more blocks than the distance are needed, and at most one per bit")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    each = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(choice) for choice in combinations(each, blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def stars(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """(member, smallest member) for all members of linked parts but the smallest."""
    prints = np.unique(prints)
    unsigned = prints.view(np.uint64)
    left = np.ones(len(prints), bool)
    out = []
    for root in range(len(prints)):
        if not left[root]:
            continue
        left[root] = False
        wave = [root]
        while wave:
            open_ = np.flatnonzero(left)
            if not len(open_):
                break
            near = np.zeros(len(open_), bool)
            for member in wave:
                near |= np.bitwise_count(unsigned[open_] ^ unsigned[member]) <= distance
            wave = open_[near].tolist()
            left[wave] = False
            out += [(int(prints[member]), int(prints[root])) for member in wave]
    return out


def fingerprint_links(prints: DataFrame, distance: int, blocks: int = 7, tile: int = 2048) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within `distance`.

    `prints` has distinct fingerprints in a column `fp`. `tile` bounds the
    fingerprints of a group: a key with more is cut into tiles by a hash, and a
    fingerprint goes to every pair of tiles that holds its own.
    """
    ship_package(prints.sparkSession)
    masks = block_masks(distance, blocks)
    keyed = prints.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "key")
    )
    shared = keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Spark sizes both sides as if a fingerprint had one key, and would broadcast all keys of a table of some size.
    shared = shared.hint("merge")
    tiles = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    rows = (
        keyed.join(shared, ["choice", "key"])
        .withColumn("tiles", tiles)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "choice", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"
        )
    )
    group = ["choice", "key", "i", "j"]

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(table: np.ndarray) -> pa.RecordBatch:
            # Columns of `table`: the group's four and the fingerprint.
            new = np.any(table[1:, :4] != table[:-1, :4], axis=1)
            cuts = np.flatnonzero(np.concatenate(([True], new, [True])))
            sizes, prints = np.diff(cuts), table[:, 4]
            two = cuts[:-1][sizes == 2]
            near = np.bitwise_count((prints[two] ^ prints[two + 1]).view(np.uint64)) <= distance
            two = two[near]
            more = [e for a, n in zip(cuts[:-1], sizes) if n > 2 for e in stars(prints[a : a + n], distance)]
            a = np.concatenate((prints[two + 1], np.array([e[0] for e in more], np.int64)))
            b = np.concatenate((prints[two], np.array([e[1] for e in more], np.int64)))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        held = np.zeros((0, 5), np.int64)
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(5)], axis=1)
            held = np.concatenate((held, rows))
            if not len(held):
                continue
            # The last group may go on in the next batch.
            last = np.any(held[:, :4] != held[-1, :4], axis=1)
            end = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            if end:
                yield edges(held[:end])
                held = held[end:]
        if len(held):
            yield edges(held)

    dealt = rows.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(linked, "a long, b long").distinct()


def near_components(
    documents: DataFrame, words: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id, fingerprint (16 hex digits) and component_id.

    Documents link if their fingerprints differ in at most `distance` bits;
    component_id is the smallest id that links lead to, its own included. Null
    texts are empty; texts without words have fingerprint zero and link like
    any other. Null ids belong to a component but never name it, unless it has
    no other. Repeated rows are kept, other columns ignored; an empty table
    gives an empty result.
    """
    rows = with_fingerprint(documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "fp", words)
    prints = materialize(rows.select("doc_id", "fp"), "fingerprints")
    member = _members(prints, F.min("doc_id"), distance)
    names = member.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(member.join(names, "component").select("fp", "component_id"), "component-names")
    return prints.join(named, "fp").select(
        F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _members(prints: DataFrame, least: Column, distance: int) -> DataFrame:
    """(fp, component, least) of each distinct fingerprint; `least` aggregates the rows that have it."""
    distinct = materialize(prints.groupBy("fp").agg(least.alias("least")), "distinct-fingerprints")
    links = fingerprint_links(distinct.select("fp"), distance)
    component = connected_components(distinct.select(F.col("fp").alias("node")), links)
    member = distinct.join(component, distinct["fp"] == component["node"]).select("fp", "component", "least")
    return materialize(member, "fingerprint-components")


def keep_one(
    documents: DataFrame, words: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of every component; all columns unchanged.

    It is the one with the smallest id, nulls last, then the smallest SHA-256
    of the text. Rows that repeat both id and text count as one document, of which
    the row that is smallest by all columns stays; others that share an id, or
    have none, are documents of their own.
    """
    key, none, sha = (free_name(documents, stem) for stem in ("key", "none", "sha"))
    own = {
        key: F.coalesce(F.col(id_col), F.lit(0)),
        none: F.col(id_col).isNull(),
        sha: F.sha2(text_or_empty(text_col).cast("binary"), 256),
    }
    rows = documents.withColumns(own)
    hashed = with_fingerprint(
        rows.select(
            F.col(none).alias("none"), F.col(key).alias("k"), F.col(sha).alias("sha"), F.col(text_col).alias("text")
        ),
        "fp", words,
    )
    prints = materialize(hashed.drop("text"), "fingerprints")
    member = _members(prints, F.min(F.struct("none", "k", "sha")), distance)
    # Equal ids and texts have equal fingerprints, so these name one document of one component.
    stays = materialize(member.groupBy("component").agg(F.min("least").alias("least")).select("least.*"), "near-stays")
    same = (rows[key] == stays["k"]) & (rows[none] == stays["none"]) & (rows[sha] == stays["sha"])
    return one_of_each(rows.join(stays, same, "left_semi"), [key, none, sha])
