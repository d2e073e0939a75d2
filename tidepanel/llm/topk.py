"""Exact top-k by inner product with block-at-a-time pruning.

Vectors lie in order of their ids in shards; a shard holds blocks of
neighbouring ids (or, if asked for, of like vectors of the shard), its forward
index (the blocks' vectors, in the narrowest whole numbers that hold them) and,
for each block and component, the largest and smallest value. For a query the sum
of the largest products bounds a block's scores. Blocks are scored in the order of
falling bounds until a bound is below the k-th score found so far. Equal
scores go to the smaller id, so a bound that equals the k-th score is still
followed.

Query blocks meet the shards by an equi join on cells, whose number follows from the
number of vectors; each pair of a query block and a shard is one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidepanel.llm.common import ship_package
from tidepanel.session import materialize

SCALE = 256
#: Sums of products below this are exact in doubles.
EXACT = float(1 << 53)

SHARD = "part int, shard long, n long, dims long, kind string, ids binary, vectors binary, high binary, low binary"

FOUND = ["query_id", "vec_id", "score", "scored", "there_are"]


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Ids and whole-number components; vectors with null or non-finite parts are left out."""
    x = F.col(vector_col)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == F.lit(float("inf"))))
    return (
        vectors.filter(F.col(id_col).isNotNull() & x.isNotNull())
        .filter(~odd)
        .select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(SCALE))).cast("double")).alias("v"),
        )
    )


def narrowest(matrix: np.ndarray) -> str:
    """The kind of number that holds whole-number components exactly."""
    for kind in ("<i2", "<i4"):
        limits = np.iinfo(kind)
        if matrix.min(initial=0) >= limits.min and matrix.max(initial=0) <= limits.max:
            return kind
    return "<f8"


def arranged(vectors: np.ndarray, block: int) -> np.ndarray:
    """An order in which a block's vectors are alike: halves by the component that varies most, and so on."""
    order = np.arange(len(vectors))
    todo = [(0, len(vectors))]
    while todo:
        a, b = todo.pop()
        if b - a <= block:
            continue
        own = order[a:b]
        widest = int(vectors[own].var(axis=0).argmax())
        order[a:b] = own[np.argsort(vectors[own, widest], kind="stable")]
        middle = a + -(-(b - a) // (2 * block)) * block
        todo += [(a, middle), (middle, b)]
    return order


def block_bounds(vectors: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest and smallest value of each block and component."""
    starts = np.arange(0, len(vectors), block)
    return np.maximum.reduceat(vectors, starts, axis=0), np.minimum.reduceat(vectors, starts, axis=0)


def _shards(rows: DataFrame, size: int, block: int, clustered: bool = False) -> DataFrame:
    """`size` neighbouring vectors to a row, as matrices with the bounds of their blocks; identical rows once."""
    ship_package(rows.sparkSession)
    ordered = rows.repartitionByRange("vec_id").sortWithinPartitions("vec_id")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number = 0
        ids: list[int] = []
        values: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            dims = max(map(len, values))
            matrix = np.zeros((len(values), dims))
            for i, v in enumerate(values):
                matrix[i, : len(v)] = v
            order = arranged(matrix, block) if clustered else np.arange(len(ids))
            kind = narrowest(matrix)
            matrix = matrix[order].astype(kind)
            matrices = [m.tobytes() for m in (matrix, *block_bounds(matrix, block))]
            row_ = [part, number, len(ids), dims, kind, np.array(ids, "<i8")[order].tobytes(), *matrices]
            kinds = [pa.int32(), *[pa.int64()] * 3, pa.string(), *[pa.binary()] * 4]
            names = ["part", "shard", "n", "dims", "kind", "ids", "vectors", "high", "low"]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row_, kinds)], names=names)

        same: set[bytes] = set()
        for batch in batches:
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = v.values.to_numpy(zero_copy_only=False)
                if not ids or vec_id != ids[-1]:
                    same = set()
                elif v.tobytes() in same:
                    continue
                same.add(v.tobytes())
                ids.append(vec_id)
                values.append(v)
                if len(ids) >= size:
                    yield row()
                    number += 1
                    ids, values = [], []
        if ids:
            yield row()

    return ordered.mapInArrow(packed, SHARD)


def _fit(matrix: np.ndarray, dims: int) -> np.ndarray:
    """Missing components are zero."""
    out = np.zeros((len(matrix), dims))
    n = min(dims, matrix.shape[1])
    out[:, :n] = matrix[:, :n]
    return out


class Best:
    """The k best (score, id) of each query of a block so far."""

    def __init__(self, n: int, k: int):
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        all_scores = np.concatenate((self.scores[rows], scores), axis=1)
        all_ids = np.concatenate((self.ids[rows], np.broadcast_to(ids, scores.shape)), axis=1)
        k = self.scores.shape[1]
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        self.scores[rows] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[rows] = np.take_along_axis(all_ids, order, axis=1)


def search_shard(best: Best, query_ids, queries, ids, vectors, block: int, high=None, low=None) -> int:
    """Update `best` by one shard; returns the number of (query, block) pairs scored.

    `high` and `low` are the bounds of the shard's blocks, if they are stored.
    """
    dims = max(queries.shape[1], vectors.shape[1])
    if high is None:
        high, low = block_bounds(vectors, block)
    queries, vectors, high, low = (_fit(m, dims) for m in (queries, vectors, high, low))
    if np.abs(queries).max(initial=0) * max(np.abs(high).max(), np.abs(low).max()) * dims >= EXACT:
        raise OverflowError("inner products are not exact in doubles")
    starts = np.arange(0, len(ids), block)
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    order = np.argsort(-bounds, axis=1, kind="stable")
    active = np.arange(len(queries))
    scored = 0
    for turn in range(len(starts)):
        at = order[active, turn]
        active = active[bounds[active, at] >= best.scores[active, -1]]
        if not len(active):
            break
        at = order[active, turn]
        for b in np.unique(at).tolist():
            rows = active[at == b]
            span = slice(starts[b], starts[b] + block)
            scores = queries[rows] @ vectors[span].T
            scores[query_ids[rows, None] == ids[None, span]] = -np.inf
            best.add(rows, scores, ids[span])
            scored += len(rows)
    return scored


def _search(
    vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding",
    block: int = 64, shard: int = 4096, query_block: int = 512, cell_vectors: int = 8192, clustered: bool = False,
) -> DataFrame:
    """The best of each task: query_id, vec_id, score; and a row without ids of (query, block) pairs scored and there."""
    rows = _valid(vectors, id_col, vector_col)
    index = materialize(_shards(rows, shard, block, clustered), "vector-shards")
    total = index.agg(F.sum("n")).first()[0] or 0
    cells = max(1, -(-total // cell_vectors))
    asked = materialize(_shards(rows.filter(F.col("vec_id") % every == 0), query_block, query_block), "query-blocks")
    left = asked.select(
        F.xxhash64("part", "shard").alias("q"), F.col("n").alias("q_n"), F.col("kind").alias("q_kind"),
        F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))).alias("cell"),
    )
    right = index.withColumn("cell", F.pmod(F.xxhash64("part", "shard"), F.lit(cells).cast("long")))
    pairs = left.join(right, "cell").select(
        "q", "q_n", "q_kind", "q_ids", "q_vectors", "n", "kind", "ids", "vectors", "high", "low"
    )

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, Best]] = {}
        scored = there_are = 0
        for batch in batches:
            for row in range(len(batch)):
                q, q_n, q_kind, q_ids, q_vectors, n, kind, ids, *matrices = (c[row].as_py() for c in batch.columns)
                query_ids = np.frombuffer(q_ids, "<i8")
                if q not in found:
                    found[q] = query_ids, Best(q_n, k)
                queries = np.frombuffer(q_vectors, q_kind).reshape(q_n, -1)
                blocks = -(-n // block)
                matrix, high, low = (
                    np.frombuffer(m, kind).reshape(height, -1) for m, height in zip(matrices, (n, blocks, blocks))
                )
                own = np.frombuffer(ids, "<i8")
                scored += search_shard(found[q][1], query_ids, queries, own, matrix, block, high, low)
                there_are += q_n * blocks
        for query_ids, best in found.values():
            there = np.isfinite(best.scores)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.broadcast_to(query_ids[:, None], there.shape)[there]),
                    pa.array(best.ids[there]),
                    pa.array(best.scores[there].astype(np.int64)),
                    *[pa.nulls(there.sum(), pa.int64())] * 2,
                ],
                names=FOUND,
            )
        if there_are:
            counts = [pa.nulls(1, pa.int64())] * 3 + [pa.array([scored]), pa.array([there_are])]
            yield pa.RecordBatch.from_arrays(counts, names=FOUND)

    return pairs.mapInArrow(searched, ", ".join(f"{name} long" for name in FOUND))


def scored_share(vectors: DataFrame, **options) -> float | None:
    """The share of all (query, block) pairs that `top_k` with these `options` scores; None without queries."""
    sums = _search(vectors, **options).agg(F.sum("scored").alias("scored"), F.sum("there_are").alias("there_are")).first()
    return sums["scored"] / sums["there_are"] if sums["there_are"] else None


def top_k(vectors: DataFrame, k: int = 5, **options) -> DataFrame:
    """The `k` best other vectors of each query, which are the ids divisible by `every`.

    Returns query_id, rank (from 1), vec_id, score. Components are
    floor(256 * x); scores are exact whole numbers, ties go to the smaller id.
    Null ids, null vectors and vectors with null or non-finite components take
    no part; missing components of shorter vectors are zero. Identical rows
    count once; an id with several vectors is a query with each of them, and
    its best results are returned. Other columns are ignored; an empty table
    gives an empty result. `options` are those of the search: every, id_col,
    vector_col, the sizes of block, shard, query_block and cell_vectors, and
    `clustered`, which puts like vectors of a shard into a block.
    """
    found = _search(vectors, k, **options).filter("query_id is not null").select("query_id", "vec_id", "score").distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
