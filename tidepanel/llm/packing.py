"""Best-fit packing of token sequences by merging partitions' underfull bins.

Every partition packs its pieces by best fit, largest first, and emits the
bins that are nearly full. The others travel on as single items to fewer
partitions, which pack them again, until one partition is left or a round no
longer joins bins; that round emits all. Only lengths, checksums and places
travel, never ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidepanel.llm.common import free_name, ship_package, text_or_empty
from tidepanel.llm.pretokens import MEMO_BYTES
from tidepanel.llm.vocabularies import id_bytes, library_encoder
from tidepanel.session import materialize, scratch_path

PIECE = "doc_id: bigint, piece: int, start: bigint, length: bigint, ids_crc32: bigint"
PIECES = pa.list_(
    pa.struct(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
         ("ids_crc32", pa.int64())]
    )
)
BIN = pa.schema(
    [("sequence_id", pa.int64()), ("filled", pa.int64()), ("done", pa.bool_()), ("members", PIECES)]
)


def cut_pieces(
    documents: DataFrame, tokenizer: str, pattern: str, end_id: int, room: int,
    id_col: str = "doc_id", text_col: str = "text", memo_bytes: int = MEMO_BYTES,
) -> DataFrame:
    """The pieces of every document: at most `room` ids, all but the first just as many.

    Null texts are empty and have one piece that holds `end_id`.
    """

    ship_package(documents.sparkSession)
    @F.arrow_udf("array<struct<piece: int, start: bigint, length: bigint, ids_crc32: bigint>>")
    def pieces(texts: pa.Array) -> pa.Array:
        encode, end = library_encoder(tokenizer, pattern, memo_bytes).encode, id_bytes([end_id])
        rows = []
        for text in texts:
            data = memoryview(encode(text.as_py()) + end)
            n = len(data) // 4
            cuts = [0, *range(n % room or room, n + 1, room)]
            rows.append(
                [
                    {"piece": i, "start": a, "length": b - a, "ids_crc32": zlib.crc32(data[4 * a : 4 * b])}
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
                ]
            )
        return pa.array(
            rows,
            pa.list_(
                pa.struct(
                    [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
                )
            ),
        )

    out = free_name(documents, "pieces")
    return documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.explode(pieces(text_or_empty(text_col))).alias(out)
    ).select("doc_id", f"{out}.*")


def best_fit(lengths: np.ndarray, room: int) -> np.ndarray:
    """The bin of each item: largest items first, each into the fullest bin that has room."""
    bins = np.empty(len(lengths), np.int64)
    spare: list[list[int]] = [[] for _ in range(room + 1)]
    open_bits = 0  # bit r is set if some bin has r left
    used = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        above = open_bits >> n
        if above:
            left = n + ((above & -above).bit_length() - 1)
            own = spare[left].pop()
            if not spare[left]:
                open_bits ^= 1 << left
        else:
            left, own, used = room, used, used + 1
        bins[i] = own
        if left > n:
            spare[left - n].append(own)
            open_bits |= 1 << (left - n)
    return bins


def _pack_partitions(items: DataFrame, room: int, slack: int, batch_items: int, number: int, last: bool) -> DataFrame:
    """One round: each partition's items (`filled`, `members`) into bins."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A round that joins less than a tenth is the last, so 255 rounds are enough for 10^11 items.
        base = (number << 55) | (TaskContext.get().partitionId() << 35)
        made = 0
        held: list[pa.RecordBatch] = []

        def bins() -> Iterator[pa.RecordBatch]:
            nonlocal made
            table = pa.Table.from_batches(held).combine_chunks()
            filled = table.column("filled").to_numpy()
            own = best_fit(filled, room)
            order = np.argsort(own, kind="stable")
            members = table.column("members").combine_chunks()
            if isinstance(members, pa.ChunkedArray):
                members = pa.concat_arrays(members.chunks)
            members = members.take(pa.array(order))
            count = np.bincount(own)
            total = np.bincount(own, weights=filled, minlength=len(count)).astype(np.int64)
            # The items of a bin are neighbours now: join their lists of members.
            ends = members.offsets.to_numpy()[np.cumsum(np.append(0, count))]
            joined = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), members.values)
            done = (total >= room - slack) | last
            numbers = base + made + np.arange(len(count))
            made += len(count)
            whole = pa.RecordBatch.from_arrays(
                [pa.array(numbers), pa.array(total), pa.array(done), joined.cast(PIECES)], schema=BIN
            )
            for at in range(0, len(whole), 4096):
                yield whole.slice(at, 4096)

        size = 0
        for batch in batches:
            if len(batch):
                held.append(batch)
                size += len(batch)
            if size >= batch_items:
                yield from bins()
                held, size = [], 0
        if size:
            yield from bins()

    return items.select("filled", "members").mapInArrow(
        packed, f"sequence_id long, filled long, done boolean, members array<struct<{PIECE}>>"
    )


def pack_pieces(pieces: DataFrame, room: int, slack: int = 8, batch_items: int = 100_000) -> DataFrame:
    """Sequences of at most `room` ids: sequence_id, filled, members (in their order).

    `pieces` has the columns of a piece. A bin with at most `slack` places left
    goes out at once. `batch_items` bounds what a task holds: more items of a
    partition are packed batch by batch. If no round can join much, as when all
    items are over half the room, the bins go out as they are.
    """
    ship_package(pieces.sparkSession)
    spark = pieces.sparkSession
    folder = scratch_path(spark, "sequences")
    struct = F.struct("doc_id", "piece", "start", "length", "ids_crc32")
    rows = pieces.select(F.col("length").alias("filled"), F.array(struct).alias("members"))
    left, number, last = None, 0, False
    while True:
        path = f"{folder}/round={number}"
        _pack_partitions(rows, room, slack, batch_items, number, last).write.partitionBy("done").parquet(path)
        bins = spark.read.schema(f"sequence_id long, filled long, members array<struct<{PIECE}>>, done boolean").parquet(path)
        if last:
            break
        under = bins.filter(~F.col("done"))
        now = under.count()
        if not now:
            break
        parts = -(-now // batch_items)
        if left is not None and now > 0.9 * left:
            last = True  # joining has ended: what is left goes out as it is
        rows, left, number = under.repartition(parts), now, number + 1
        last = last or parts == 1
    done = spark.read.schema(f"sequence_id long, filled long, members array<struct<{PIECE}>>, done boolean, round int")
    return done.option("basePath", folder).parquet(folder).filter("done").drop("done", "round")


def pack_documents(
    documents: DataFrame, tokenizer: str, pattern: str, end_id: int, room: int = 2048,
    id_col: str = "doc_id", text_col: str = "text", memo_bytes: int = MEMO_BYTES,
) -> DataFrame:
    """Pack whole documents into sequences; one row per piece.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset.
    Null texts are empty documents of one id. Null ids and rows that repeat an
    id are packed like any other row. An empty table gives an empty result. Other
    columns are ignored.
    """
    pieces = materialize(cut_pieces(documents, tokenizer, pattern, end_id, room, id_col, text_col, memo_bytes), "pieces")
    sequences = pack_pieces(pieces, room)
    # Place of a member: the lengths of those before it in its sequence.
    ends = F.expr("aggregate(members, array(0L), (acc, m) -> concat(acc, array(element_at(acc, -1) + m.length)))")
    return (
        sequences.withColumn("ends", ends)
        .select("sequence_id", "ends", F.posexplode("members").alias("at", "m"))
        .select("m.*", "sequence_id", F.expr("ends[at]").alias("offset"))
        .withColumnRenamed("doc_id", id_col)
    )
