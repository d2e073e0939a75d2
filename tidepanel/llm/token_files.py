"""Token ids of whole documents in ordered files of Simple-8b segments.

A table of token files is a Parquet folder; each row is a segment of whole
documents: the place of its first id among the ids of its file, the sizes, and
a payload in the format below. Files are in the order of `part`, segments in
the order of `segment`, documents in ascending order of their ids. Parquet is
only the container: Spark's writers commit it, so files survive lost executors
and any file system that Spark knows.

Payload: four bytes `S8B1`; the number of documents (unsigned 32 bits); their
ids (signed 64 bits); a byte for each that is 1 if its id is null; then three
Simple-8b streams, all with their offsets by block: documents' lengths, the
segment's distinct ids in order of falling frequency, and for each id its rank
in that order. All integers are little-endian.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidepanel.llm import simple8b
from tidepanel.llm.common import free_name, ship_package, text_or_empty
from tidepanel.llm.pretokens import MEMO_BYTES
from tidepanel.llm.vocabularies import id_bytes, library_encoder
from tidepanel.operators.joins import broadcast_if_small

MAGIC = b"S8B1"
#: A segment ends with the document that brings it to so many ids.
SEGMENT_IDS = 1 << 16

SEGMENT = "part int, segment long, start long, n_docs long, n_ids long, payload binary"


def pack_segment(doc_ids: list[int | None], coded: list[bytes]) -> bytes:
    """The payload of some documents, given their ids as bytes."""
    ids = np.frombuffer(b"".join(coded), "<u4")
    count = np.bincount(ids)  # as long as the vocabulary
    distinct = np.flatnonzero(count)
    distinct = distinct[np.argsort(-count[distinct], kind="stable")]
    rank = np.zeros(len(count), np.uint64)
    rank[distinct] = np.arange(len(distinct), dtype=np.uint64)
    return b"".join(
        (
            MAGIC,
            np.array([len(doc_ids)], "<u4").tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            bytes(d is None for d in doc_ids),
            simple8b.to_bytes(np.array([len(c) // 4 for c in coded], np.uint64)),
            simple8b.to_bytes(distinct.astype(np.uint64)),
            simple8b.to_bytes(rank[ids]),
        )
    )


def unpack_segment(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, their lengths, all token ids)."""
    if payload[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    n = int(np.frombuffer(payload, "<u4", 1, 4)[0])
    doc_ids = np.frombuffer(payload, "<i8", n, 8).tolist()
    at = 8 + 8 * n
    doc_ids = [None if none else d for d, none in zip(doc_ids, payload[at : at + n])]
    sizes, at = simple8b.from_bytes(payload, at + n)
    distinct, at = simple8b.from_bytes(payload, at)
    ranks, at = simple8b.from_bytes(payload, at)
    return doc_ids, sizes.astype(np.int64), distinct.astype("<u4")[ranks.astype(np.int64)]


def encode_segments(
    documents: DataFrame, tokenizer: str, pattern: str, end_id: int,
    id_col: str = "doc_id", text_col: str = "text", memo_bytes: int = MEMO_BYTES,
) -> DataFrame:
    """Segments of all documents, dealt out by ranges of the ids.

    Null texts are empty: they hold `end_id` alone. Null ids come first; rows
    that repeat an id are neighbours, in the order of a hash of their texts. Other
    columns are ignored.
    """
    ship_package(documents.sparkSession)
    tie = free_name(documents, "tie")
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn(
        tie, F.xxhash64("text")
    )
    ranged = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie).select("doc_id", "text")
    end = id_bytes([end_id])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = library_encoder(tokenizer, pattern, memo_bytes).encode
        schema = pa.schema(
            [("part", pa.int32()), ("segment", pa.int64()), ("start", pa.int64()), ("n_docs", pa.int64()),
             ("n_ids", pa.int64()), ("payload", pa.binary())]
        )
        doc_ids: list[int | None] = []
        coded: list[bytes] = []
        size = number = start = 0

        def row() -> pa.RecordBatch:
            values = [part, number, start, len(doc_ids), size, pack_segment(doc_ids, coded)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_ids.append(doc_id.as_py())
                coded.append(encode(text.as_py()) + end)
                size += len(coded[-1]) // 4
                if size >= SEGMENT_IDS:
                    yield row()
                    start, number, size = start + size, number + 1, 0
                    doc_ids, coded = [], []
        if doc_ids:
            yield row()

    return ranged.mapInArrow(segments, SEGMENT)


def write_token_files(documents: DataFrame, path: str, tokenizer: str, pattern: str, end_id: int, **options) -> None:
    """Encode all documents and write their segments to a new folder."""
    encode_segments(documents, tokenizer, pattern, end_id, **options).write.option("compression", "zstd").parquet(path)


def segments_in_order(spark: SparkSession, path: str) -> DataFrame:
    """The segments with `first`: the number of ids in all segments before.

    The running sum over files has one row per written file; inside a file the
    segments carry their place. Up to a counted number of files their sums are
    broadcast, so that payloads stay where they are read.
    """
    stored = spark.read.schema(SEGMENT).parquet(path)
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = (
        stored.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("base"))
    )
    return stored.join(broadcast_if_small(files), "part").withColumn("first", F.col("base") + F.col("start")).drop("base")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, and its ids as bytes."""
    return _decoded(spark, path, "ids binary", lambda ids: ids)


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, and the crc32 of its ids."""
    return _decoded(spark, path, "ids_crc32 long", zlib.crc32)


def _decoded(spark: SparkSession, path: str, column: str, of) -> DataFrame:
    ship_package(spark)
    name, kind = column.split()
    arrow = {"binary": pa.binary(), "long": pa.int64()}[kind]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, payload in zip(batch.column(0), batch.column(1)):
                doc_ids, sizes, ids = unpack_segment(payload.as_py())
                ends = np.cumsum(sizes)
                data = memoryview(ids.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(first.as_py() + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([of(bytes(data[4 * (b - n) : 4 * b])) for b, n in zip(ends, sizes)], arrow),
                    ],
                    names=["doc_id", "start", "n_tokens", name],
                )

    rows = segments_in_order(spark, path).select("first", "payload")
    return rows.mapInArrow(documents, f"doc_id long, start long, n_tokens long, {column}")
