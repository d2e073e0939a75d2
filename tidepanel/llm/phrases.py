"""Collocations: frequent phrases of a language, ranked by how firmly their parts belong together.

A phrase can be frequent only if the phrases left by dropping its first or its
last word are. So phrases grow word by word: each task proposes the phrases of
its texts whose two parts are known to be frequent, and proposals that are too
rare in all are dropped. The candidates of a length are put into double-array
tries of a bounded size, which are broadcast one after another; numpy advances
the states of all text positions together, level by level, counts the accepting
states, and the counts of all tasks are summed. The walk that counts the
candidates of a length also proposes those of the next.

Texts are numbers by then: frequent words have one per language, all others
and the ends of pieces are zero, so no phrase crosses them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidepanel.llm import double_array
from tidepanel.llm.common import ship_package, small_batches
from tidepanel.session import materialize

#: Separators of pieces, all turned into the first of them.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
ONE_BREAK = bytes.maketrans(BREAKS, BREAKS[:1] * len(BREAKS))
BREAK = BREAKS[:1]

#: Bound of the frequent words that are broadcast at once.
VOCABULARY = 1_000_000
#: Bound of the phrases in one trie (about: they are dealt out by a hash).
TRIE_PHRASES = 250_000
#: A task's counter of words, or its list of proposals, is passed on when it holds so many.
HELD = 500_000
#: Positions of text that a task handles at once.
POSITIONS = 1 << 20
#: Texts, and blocks of so many positions, that the JVM and Python hold at once beside.
TEXTS_AT_ONCE, BLOCKS_AT_ONCE = 500, 1

# Kinds of rows that a walk gives.
COUNTED, PROPOSED = 0, 1


def tokens_of(text: str) -> list[bytes]:
    """The words of a text, A-Z lower-cased, with BREAK wherever a piece ends."""
    return text.encode("utf-8").lower().translate(ONE_BREAK).replace(BREAK, b" " + BREAK + b" ").split()


def _languages(documents: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return documents.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of rows of (lang, text)."""
    ship_package(rows.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counter in counters.items():
                counter.pop(BREAK, None)
                words = pa.array(list(counter), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counter), pa.string()), words, pa.array(list(counter.values()), pa.int64())],
                    names=["lang", "word", "n"],
                )
            counters.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counters.setdefault(lang, Counter()).update(tokens_of(text.as_py()))
                if sum(map(len, counters.values())) >= HELD:
                    yield from out()
        yield from out()

    found = rows.mapInArrow(counted, "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _parts(rows: DataFrame, most: int, key: Column, name: str) -> tuple[DataFrame, int]:
    """`rows` with `part`, so that each part has about `most` rows, and the number of parts."""
    parts = max(1, -(-rows.count() // most))
    return rows.withColumn("part", F.pmod(F.xxhash64(F.lit(name), key), F.lit(parts)).cast("int")), parts


def number_words(frequent: DataFrame, most: int) -> tuple[list[pa.Table], DataFrame, int]:
    """Numbers from one on for (lang, word): the parts of the vocabulary, all as a table, and how many there are.

    Only one part at a time is held; the parts are tables of their own.
    """
    spark = frequent.sparkSession
    dealt, parts = _parts(frequent, most, F.struct("lang", "word"), "words")
    tables, count = [], 0
    for part in range(parts):
        found = dealt.filter(F.col("part") == part).orderBy(F.desc("n"), "lang", "word").toArrow()
        found = found.drop(["part"]).append_column("id", pa.array(np.arange(count + 1, count + 1 + len(found)), pa.int64()))
        count += len(found)
        tables.append(materialize(spark.createDataFrame(found), "words"))
    every = tables[0]
    for table in tables[1:]:
        every = every.unionAll(table)
    return tables, every, count


def encode(rows: DataFrame, vocabulary: list[DataFrame]) -> DataFrame:
    """Blocks of word numbers (`ids`: little-endian, 32 bits each) of rows of (lang, text).

    Each part of the vocabulary numbers its own words in one pass over the
    texts; with one part, which is the rule, texts are read once.
    """
    spark = rows.sparkSession
    ship_package(spark)
    now = rows
    for number, part in enumerate(vocabulary):
        last = number == len(vocabulary) - 1
        known: dict[str, dict[bytes, int]] = {}
        table = part.toArrow()
        for lang, word, i in zip(*(table.column(c).to_pylist() for c in ("lang", "word", "id"))):
            known.setdefault(lang, {})[word.encode("utf-8")] = i
        sent = spark.sparkContext.broadcast(known)
        if last:
            now = now.mapInArrow(_blocks(sent), "ids binary")
        else:
            now = materialize(now.mapInArrow(_partly(sent), "lang string, text string, ids binary"), "partly-numbered")
    return now


def _numbers(batches: Iterator[pa.RecordBatch], sent) -> Iterator[tuple[str, str, np.ndarray]]:
    """Each row with its numbers so far; other parts of the vocabulary may have given some."""
    nothing: dict[bytes, int] = {}
    for batch in batches:
        before = batch.column(2) if batch.num_columns > 2 else [None] * len(batch)
        for lang, text, ids in zip(batch.column(0).to_pylist(), batch.column(1), before):
            text = text.as_py()
            words = tokens_of(text)
            get = sent.value.get(lang, nothing).get
            own = np.array([get(w, 0) for w in words], "<i4")
            if ids is not None:
                own += np.frombuffer(ids.as_py(), "<i4")
            yield lang, text, own


def _partly(sent):
    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text, ids in _numbers(batches, sent):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([text]), pa.array([ids.tobytes()], pa.binary())], names=["lang", "text", "ids"]
            )

    return numbered


def _blocks(sent):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        gap = np.zeros(1, "<i4")

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], names=["ids"])

        for _, _, ids in _numbers(batches, sent):
            held += [ids, gap]
            size += len(ids) + 1
            if size >= POSITIONS:
                yield row()
                held, size = [], 0
        if held:
            yield row()

    return packed


class _Proposals:
    """Sums of (parent, word) pairs; about `HELD` of them at most before they go on."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, parents: np.ndarray, words: np.ndarray) -> None:
        keys, counts = np.unique((parents.astype(np.int64) << 32) | words, return_counts=True)
        self.held.append((keys, counts))
        self.size += len(keys)

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(parent, word, count), merged."""
        keys = np.concatenate([k for k, _ in self.held] or [np.zeros(0, np.int64)])
        counts = np.concatenate([c for _, c in self.held] or [np.zeros(0, np.int64)])
        keys, places = np.unique(keys, return_inverse=True)
        self.held, self.size = [], 0
        sums = np.bincount(places, weights=counts, minlength=len(keys)).astype(np.int64)
        return keys >> 32, keys & 0xFFFFFFFF, sums


WALK = "kind int, parent long, word long, n long"


def _rows(kind: int, parents: np.ndarray, words: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(parents), 1 << 16):
        span = slice(at, at + (1 << 16))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(parents[span]), kind, np.int32)), pa.array(parents[span].astype(np.int64)),
                pa.array(words[span].astype(np.int64)), pa.array(counts[span].astype(np.int64)),
            ],
            names=["kind", "parent", "word", "n"],
        )


def _summed(blocks: DataFrame, walk) -> DataFrame:
    return blocks.mapInArrow(walk, WALK).groupBy("kind", "parent", "word").agg(F.sum("n").alias("n"))


def propose_pairs(blocks: DataFrame) -> DataFrame:
    """(parent, word, n): the pairs of neighbouring frequent words, `parent` being the first."""
    ship_package(blocks.sparkSession)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Proposals()
        for batch in batches:
            for block in batch.column(0):
                ids = np.frombuffer(block.as_py(), "<i4")
                at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
                found.add(ids[at], ids[at + 1])
                if found.size >= HELD * 2:
                    yield from _rows(PROPOSED, *found.take())
        yield from _rows(PROPOSED, *found.take())

    return _summed(blocks, walk)


def walk_trie(blocks: DataFrame, trie, depth: int, whole: bool, propose: bool) -> DataFrame:
    """Counts of a trie's sequences in all blocks and, with `propose`, the sequences longer by a frequent word.

    Rows of kind COUNTED have the accepting state in `parent`; rows of kind
    PROPOSED the state of the sequence without its last word, and that word. If
    the trie is `whole`, that is has all frequent sequences of its length, the
    proposal's other part must be accepted too.
    """
    ship_package(blocks.sparkSession)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = trie.value
        counts = np.zeros(len(own.base), np.int64)
        found = _Proposals()
        for batch in batches:
            for block in batch.column(0):
                ids = np.frombuffer(block.as_py(), "<i4")
                at, states = own.accepted(ids, depth)
                counts += np.bincount(states, minlength=len(counts))
                if propose and len(at):
                    good = np.flatnonzero(at + depth < len(ids))
                    if whole:
                        begins = np.zeros(len(ids) + 1, bool)
                        begins[at] = True
                        good = good[begins[at[good] + 1]]
                    good = good[ids[at[good] + depth] > 0]
                    found.add(states[good], ids[at[good] + depth])
                    if found.size >= HELD * 2:
                        yield from _rows(PROPOSED, *found.take())
        seen = np.flatnonzero(counts)
        yield from _rows(COUNTED, seen, np.zeros(len(seen), np.int64), counts[seen])
        yield from _rows(PROPOSED, *found.take())

    return _summed(blocks, walk)


def frequent_phrases(
    blocks: DataFrame, words: int, longest: int, min_count: int, most: int = TRIE_PHRASES
) -> DataFrame:
    """(words array<long>, a) of all phrases of 2 to `longest` words with at least `min_count` occurrences."""
    spark = blocks.sparkSession
    shape = "words array<long>, a long"
    pairs = propose_pairs(blocks).filter(F.col("n") >= min_count)
    with small_batches(spark, BLOCKS_AT_ONCE):
        proposed = materialize(pairs.select(F.array("parent", "word").alias("words")), "pairs")
    found = spark.createDataFrame([], shape)
    for depth in range(2, longest + 1):
        candidates, parts = _parts(materialize(proposed, "candidates"), most, F.col("words"), "phrases")
        longer = []
        for part in range(parts):
            table = candidates.filter(F.col("part") == part).select("words").toArrow()
            if not len(table):
                continue
            lists = table.column("words").combine_chunks()
            lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
            trie, states = double_array.build(lists.values.to_numpy().reshape(-1, depth), words + 1)
            sent = spark.sparkContext.broadcast(trie)
            with small_batches(spark, BLOCKS_AT_ONCE):
                rows = materialize(walk_trie(blocks, sent, depth, parts == 1, depth < longest), "walk")
            accepting = spark.createDataFrame(pa.table({"parent": pa.array(states, pa.int64()), "words": lists}))
            accepting = materialize(accepting, "accepting")
            counts = rows.filter(F.col("kind") == COUNTED).select("parent", F.col("n").alias("a"))
            found = found.unionAll(counts.join(accepting, "parent").filter(F.col("a") >= min_count).select("words", "a"))
            more = rows.filter((F.col("kind") == PROPOSED) & (F.col("n") >= min_count)).drop("kind", "n")
            longer.append(more.join(accepting, "parent").select(F.concat("words", F.array("word")).alias("words")))
            sent.unpersist()
        if not longer or depth == longest:
            break
        proposed = longer[0]
        for more in longer[1:]:
            proposed = proposed.unionAll(more)
    return materialize(found, "phrases")


def _cuts(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """Phrases with their lowest-scoring cut: l, r, score."""
    ways = phrases.select(
        "words", "a", "n", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    ).select("*", F.slice("words", 1, F.col("k")).alias("first"), F.expr("slice(words, k + 1, size(words) - k)").alias("rest"))
    ways = ways.join(counts.select(F.col("words").alias("first"), F.col("count").alias("l")), "first")
    ways = ways.join(counts.select(F.col("words").alias("rest"), F.col("count").alias("r")), "rest")
    # 19 digits each: products need at most 38; the quotient is whole.
    score = F.expr("(a * cast(1000 as decimal(4, 0))) * cast(n as decimal(17, 0)) div (cast(l as decimal(19, 0)) * r)")
    ways = ways.withColumn("a", F.col("a").cast("decimal(17, 0)")).withColumn("r", F.col("r").cast("decimal(19, 0)"))
    best = ways.select("words", F.struct(score.alias("score"), "k", "l", "r").alias("way"))
    return best.groupBy("words").agg(F.min("way").alias("way")).select(
        "words", "way.l", F.col("way.r").cast("long").alias("r"), "way.score"
    )


def _covered(phrases: DataFrame, share: int) -> DataFrame:
    """The phrases that lie inside a longer one with at least `share` percent of their occurrences."""
    inside = phrases.filter(F.size("words") > 2).select(
        F.explode(F.expr(
            "flatten(transform(sequence(2, size(words) - 1), "
            "m -> transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))))"
        )).alias("words"), F.col("a").alias("longer"),
    )
    most = inside.groupBy("words").agg(F.max("longer").alias("longer"))
    return phrases.join(most, "words").filter(100 * F.col("longer") >= share * F.col("a")).select("words")


def collocations(
    documents: DataFrame, min_count: int = 100, longest: int = 5, share: int = 100, most: int = 2000,
    lang_col: str = "lang", text_col: str = "text", vocabulary: int = VOCABULARY, trie_phrases: int = TRIE_PHRASES,
) -> DataFrame:
    """Each language's first `most` phrases: lang, rank, phrase, a, l, r, n, score.

    Null languages are `und`, null texts empty. Rows that repeat count again;
    ids and other columns are ignored. An empty table gives an empty result.
    `share` is the percentage of a phrase's occurrences from which a longer
    phrase stands for it. `vocabulary` and `trie_phrases` bound what is
    broadcast at once, not the result: beyond them words are numbered, and
    phrases counted, in several passes.
    """
    rows = _languages(documents, lang_col, text_col)
    with small_batches(rows.sparkSession, TEXTS_AT_ONCE):
        counts = materialize(word_counts(rows), "word-counts")
    tables, words, many = number_words(counts.filter(F.col("n") >= min_count), vocabulary)
    with small_batches(rows.sparkSession, TEXTS_AT_ONCE):
        blocks = encode(rows, tables).write.option("compression", "zstd")
        blocks = materialize_with(rows.sparkSession, blocks, "numbered")
    phrases = frequent_phrases(blocks, many, longest, min_count, trie_phrases)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    of_word = words.select(F.array("id").alias("words"), F.col("n").alias("count"), "lang")
    known = of_word.select("words", "count").unionAll(phrases.select("words", F.col("a").alias("count")))
    lang_of = words.select(F.col("id").alias("head"), "lang")
    held = phrases.join(_covered(phrases, share), "words", "left_anti")
    held = held.withColumn("head", F.col("words")[0]).join(lang_of, "head").drop("head").join(totals, "lang")
    held = held.join(_cuts(held.select("words", "a", "n"), known), "words")
    spelt = (
        held.select("words", F.posexplode("words").alias("at", "id"))
        .join(words.select("id", "word"), "id")
        .groupBy("words").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelt"))
        .select("words", F.array_join(F.col("spelt.word"), " ").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = held.join(spelt, "words").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def materialize_with(spark: SparkSession, writer, name: str) -> DataFrame:
    """Write by `writer` below the shared folder and read it back."""
    from tidepanel.session import scratch_path

    path = scratch_path(spark, name)
    writer.parquet(path)
    return spark.read.parquet(path)
