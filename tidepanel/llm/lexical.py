"""Exact ranked search: each query's best documents by a sum of term impacts.

Documents become rows of a forward index: the query terms they hold and how
often. Statistics are counted over all documents. Then shards of documents,
cut inside Spark's partitions, are searched on their own and their best rows
merged by a window per query.

In a shard every posting list is cut into blocks of similar documents: the
list's documents gather round representatives by the inner product of sketches of
their term vectors. A block's summary has the largest impact of each term among
its documents, so the sum over a query's terms bounds every score in it. A list
is left out when the largest impacts of the lists from it on cannot reach the
k-th score, a block when its bound cannot; documents of the other blocks get their
exact score from the forward index. Lists are blocked when a query first needs them.

A bound equal to the k-th score still counts if the block has a smaller id.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidepanel.llm.common import ship_package
from tidepanel.llm.words import words_of
from tidepanel.session import materialize

#: (item, term) pairs of the queries that are searched together; more make several passes.
QUERY_TERMS = 400_000
#: A shard ends with the document that brings it to either.
SHARD_DOCS, SHARD_POSTINGS = 1 << 15, 2_000_000
#: Documents of a block, about, and at most.
BLOCK, MOST = 48, 96
#: Numbers in a document's sketch.
SKETCH = 16

#: Parameters of the impact: they stand for saturation 1.0 ... of term counts and half weight of lengths.
LENGTH_SHARE = 50


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item_id, term); rows that repeat an id are one item of all their terms."""
    ship_package(queries.sparkSession)

    @F.arrow_udf("array<binary>")
    def terms(texts: pa.Array) -> pa.Array:
        return pa.array([list(dict.fromkeys(words_of(t.as_py()))) for t in texts], pa.list_(pa.binary()))

    rows = queries.select(F.col(id_col).cast("long").alias("item_id"), F.explode(terms(F.col(text_col).cast("string"))).alias("term"))
    return rows.distinct()


def forward_rows(documents: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, counts): all documents with a word; the numbers of the query terms they hold."""
    ship_package(documents.sparkSession)
    names = ["doc_id", "n", "terms", "counts"]

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.value.get
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                if words:
                    found = np.array([get(w, -1) for w in words], np.int32)
                    held, counts = np.unique(found[found >= 0], return_counts=True)
                    rows.append((doc_id, len(words), held.astype("<i4").tobytes(), counts.astype("<i4").tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(forward, "doc_id long, n long, terms binary, counts binary")


def document_frequencies(forward: DataFrame, size: int) -> np.ndarray:
    """For each of `size` terms the number of documents that hold it."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            data = b"".join(t.as_py() for t in batch.column(0))
            df += np.bincount(np.frombuffer(data, "<i4"), minlength=size)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(df[seen])], names=["term", "df"])

    rows = forward.select("terms").mapInArrow(counted, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    found = rows.toArrow()
    out = np.zeros(size, np.int64)
    out[found.column("term").to_numpy()] = found.column("df").to_numpy()
    return out


def term_weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


@dataclass
class Blocks:
    """The blocks of one posting list: members end to end, and summaries end to end."""

    members: np.ndarray
    begin: np.ndarray  # one more than blocks
    smallest: np.ndarray  # smallest id of each block
    terms: np.ndarray
    impacts: np.ndarray
    summary: np.ndarray  # where each block's summary begins, one more than blocks


@dataclass
class Work:
    """What a search did: posting lists left out, blocks bounded and skipped, documents scored."""

    lists: int = 0
    lists_left: int = 0
    blocks: int = 0
    skipped: int = 0
    scored: int = 0
    matching: int = 0


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers begin[i] .. begin[i] + size[i] - 1, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)


@dataclass
class Shard:
    """Some documents with their impacts by term, and the blocks of the posting lists."""

    ids: np.ndarray  # ascending
    begin: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray
    partners: list[np.ndarray]  # by term: the terms it meets in some query
    width: int
    blocks: dict[int, Blocks] = field(default_factory=dict)

    def __post_init__(self) -> None:
        per_doc = np.diff(self.begin)
        doc = np.repeat(np.arange(len(self.ids)), per_doc)
        order = np.argsort(self.terms, kind="stable")
        self.postings = doc[order]
        self.lists = np.searchsorted(self.terms[order], np.arange(self.width + 1))
        self.largest = np.zeros(self.width, np.int64)
        held = np.flatnonzero(np.diff(self.lists))
        if len(held):
            self.largest[held] = np.maximum.reduceat(self.impacts[order], self.lists[held])
        self.sketches = self._sketch(per_doc)

    def _sketch(self, per_doc: np.ndarray) -> np.ndarray:
        signs = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (self.width, SKETCH))
        out = np.zeros((len(self.ids), SKETCH), np.float32)
        doc = np.repeat(np.arange(len(self.ids)), per_doc)
        for at in range(0, len(self.terms), 1 << 18):
            span = slice(at, at + (1 << 18))
            values = self.impacts[span, None].astype(np.float32) * signs[self.terms[span]]
            first = np.flatnonzero(np.append(True, np.diff(doc[span]) > 0))
            out[doc[span][first]] += np.add.reduceat(values, first, axis=0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def blocked(self, term: int) -> Blocks:
        if term not in self.blocks:
            self.blocks[term] = self._block(term)
        return self.blocks[term]

    def _block(self, term: int) -> Blocks:
        docs = self.postings[self.lists[term] : self.lists[term + 1]]
        count = -(-len(docs) // BLOCK)
        if count > 1:
            heads = docs[np.arange(count) * len(docs) // count]
            near = np.concatenate(
                [np.argmax(self.sketches[docs[at : at + 8192]] @ self.sketches[heads].T, axis=1) for at in range(0, len(docs), 8192)]
            )
            order = np.argsort(near, kind="stable")
            docs, near = docs[order], near[order]
        else:
            near = np.zeros(len(docs), np.int64)
        # Crowded representatives get several blocks.
        place = np.arange(len(docs)) - np.searchsorted(near, near)
        first = np.flatnonzero(np.append(True, np.diff(near) > 0) | (place % MOST == 0))
        size = np.diff(np.append(first, len(docs)))
        at = _spans(self.begin[docs], self.begin[docs + 1] - self.begin[docs])
        block = np.repeat(np.repeat(np.arange(len(first)), size), self.begin[docs + 1] - self.begin[docs])
        wanted = np.zeros(self.width, bool)
        wanted[self.partners[term]] = True
        useful = np.flatnonzero(wanted[self.terms[at]])
        at, block = at[useful], block[useful]
        key = block * self.width + self.terms[at]
        order = np.argsort(key, kind="stable")
        key, values = key[order], self.impacts[at[order]]
        start = np.flatnonzero(np.append(True, np.diff(key) > 0))
        key = key[start]
        return Blocks(
            docs, np.append(first, len(docs)), np.minimum.reduceat(self.ids[docs], first),
            key % self.width, np.maximum.reduceat(values, start),
            np.searchsorted(key // self.width, np.arange(len(first) + 1)),
        )

    def search(self, query: np.ndarray, k: int, work: Work | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the query's best documents, highest first, equal scores by id."""
        work = work or Work()
        query = query[self.largest[query] > 0]
        query = query[np.argsort(-self.largest[query], kind="stable")]
        rest = np.cumsum(self.largest[query][::-1])[::-1]
        asked = np.zeros(self.width, bool)
        asked[query] = True
        seen = np.zeros(len(self.ids), bool)
        best, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)  # places in the shard are in the order of ids
        work.lists += len(query)
        for at, term in enumerate(query):
            full = len(best) == k
            if full and rest[at] < scores[-1]:
                work.lists_left += len(query) - at
                break
            own = self.blocked(int(term))
            bounds = np.add.reduceat(np.where(asked[own.terms], own.impacts, 0), own.summary[:-1])
            order = np.argsort(-bounds, kind="stable")
            work.blocks += len(order)
            step, done = 4, 0
            while done < len(order):
                some = order[done : done + step]
                done, step = done + step, step * 2
                if len(best) == k:
                    last = self.ids[best[-1]]
                    some = some[(bounds[some] > scores[-1]) | ((bounds[some] == scores[-1]) & (own.smallest[some] < last))]
                    if not len(some) and bounds[order[min(done, len(order)) - 1]] < scores[-1]:
                        break
                if not len(some):
                    continue
                work.skipped -= len(some)
                docs = own.members[_spans(own.begin[some], own.begin[some + 1] - own.begin[some])]
                docs = docs[~seen[docs]]
                seen[docs] = True
                work.scored += len(docs)
                size = self.begin[docs + 1] - self.begin[docs]
                where = _spans(self.begin[docs], size)
                values = np.where(asked[self.terms[where]], self.impacts[where], 0)
                found = np.add.reduceat(values, np.cumsum(size) - size) if len(docs) else np.zeros(0, np.int64)
                best, scores = np.append(best, docs), np.append(scores, found)
                keep = np.lexsort((best, -scores))[:k]
                best, scores = best[keep], scores[keep]
            work.skipped += len(order)
        good = scores > 0
        return best[good], scores[good]


def build_shard(
    rows: list[tuple], weights: np.ndarray, partners: list[np.ndarray], documents: int, length: int
) -> tuple[Shard, list]:
    """A shard of forward rows and its documents' ids in order; null ids come last."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    terms = [np.frombuffer(r[2], "<i4") for r in rows]
    sizes = np.array([len(t) for t in terms])
    n = np.array([r[1] for r in rows], np.int64)
    tf = np.frombuffer(b"".join(r[3] for r in rows), "<i4").astype(np.int64)
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // length
    term = np.concatenate(terms).astype(np.int64)
    impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, sizes)))
    good = impact > 0
    begin = np.append(0, np.cumsum(np.bincount(np.repeat(np.arange(len(rows)), sizes)[good], minlength=len(rows))))
    shard = Shard(np.arange(len(rows)), begin, term[good], impact[good], partners, len(weights))
    return shard, [r[0] for r in rows]


def _search_block(documents: DataFrame, terms: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id, doc_id, score): each shard's best rows for a bounded set of queries."""
    spark = documents.sparkSession
    found = terms.toArrow()
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(found.column("term").to_pylist()))}
    by_item = defaultdict(list)
    for item, term in zip(found.column("item_id").to_pylist(), found.column("term").to_pylist()):
        by_item[item].append(vocabulary[term])
    items = {item: np.array(sorted(own), np.int64) for item, own in by_item.items()}
    meets: list[list[np.ndarray]] = [[] for _ in vocabulary]
    for own in items.values():
        for term in own:
            meets[term].append(own)
    partners = [np.unique(np.concatenate(m)) for m in meets]
    forward = materialize(forward_rows(documents, spark.sparkContext.broadcast(vocabulary), id_col, text_col), "forward")
    total = forward.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    count, length = total["documents"], total["length"]
    weights = term_weights(document_frequencies(forward, len(vocabulary)), count) if count else np.zeros(len(vocabulary), np.int64)
    sent = spark.sparkContext.broadcast((weights, partners, items))
    names = ["item_id", "doc_id", "score"]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, partners, items = sent.value
        held: list[tuple] = []
        postings = 0

        def out() -> Iterator[pa.RecordBatch]:
            shard, ids = build_shard(held, weights, partners, count, length)
            for item, query in items.items():
                best, scores = shard.search(query, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(best), pa.int64()), pa.array([ids[b] for b in best], pa.int64()),
                     pa.array(scores, pa.int64())], names=names,
                )

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[2]:
                    held.append(row)
                    postings += len(row[2]) // 4
                if len(held) >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    yield from out()
                    held, postings = [], 0
        if held:
            yield from out()

    return forward.mapInArrow(searched, "item_id long, doc_id long, score long")


def search_documents(
    documents: DataFrame, queries: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", query_terms_at_once: int = QUERY_TERMS,
) -> DataFrame:
    """Each item's `k` best documents with a score above 0: item_id, rank, doc_id, score.

    Texts that are null have no terms; such documents count nowhere, such items
    have no rows. Equal scores go by ascending id, null ids last; rows that repeat
    an id are documents of their own. Rows that repeat an item's id are one item
    of all their terms. Other columns are ignored. Empty tables give an empty
    result. `query_terms_at_once` bounds the queries that are searched in one pass
    over the documents, not the result.
    """
    terms = materialize(query_terms(queries, item_col, item_text_col), "query-terms")
    passes = max(1, -(-terms.count() // query_terms_at_once))
    best = None
    for number in range(passes):
        some = terms.filter(F.pmod(F.xxhash64(F.lit("items"), "item_id"), F.lit(passes)) == number)
        found = _search_block(documents, some, k, id_col, text_col)
        best = found if best is None else best.unionAll(found)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")
