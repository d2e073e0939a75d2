"""Bounded, repeatable samples of labelled and unlabelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidepanel.llm.common import hash_rate


def labelled_ids(labels: DataFrame, label: str, allowed: Column, most: int, id_col: str = "doc_id") -> DataFrame:
    """(key, label) of at most `most` labelled ids, chosen by a hash of the id.

    `allowed` says which rows may be learnt from. Null ids and labels other
    than 0 and 1 are left out; ids with both labels too.
    """
    rows = (
        labels.filter(allowed & F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(id_col).cast("long").alias("key"))
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
        .filter("label = other")
        .drop("other")
    )
    count = rows.count()
    chosen = rows.filter(hash_rate("key", most / count if count else 1.0, 1))
    # The rate keeps about `most`; the limit makes it a bound.
    return chosen.orderBy(F.xxhash64("key")).limit(most)


def labelled_texts(
    documents: DataFrame, labels: DataFrame, label: str, allowed: Column, most: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(text, label) of the documents with a chosen label.

    The chosen ids are bounded by `most`, so they are broadcast and the texts
    stay where they are.
    """
    ids = labelled_ids(labels, label, allowed, most, "doc_id")
    rows = documents.select(F.col(id_col).cast("long").alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return _some(rows.join(F.broadcast(ids), "key").select("key", "text", "label"), most, "key").select("text", "label")


def _some(rows: DataFrame, most: int, key: str) -> DataFrame:
    """About `most` rows if there are more, never more than `most`, by a hash of `key` and text."""
    count = rows.count()
    if count <= most:
        return rows
    return _at_most(rows.filter(hash_rate(F.struct(key, "text"), 0.95 * most / count, 2)), most)


def _at_most(rows: DataFrame, most: int) -> DataFrame:
    """Rows that a rate chose; a limit, which gathers them in one task, only where many alike came together."""
    return rows.limit(most) if rows.count() > most else rows


def some_texts(
    documents: DataFrame, allowed: Column, most: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """About `most` texts, at most so many, chosen by a hash of id and text, whatever their labels."""
    rows = documents.filter(allowed).select(
        F.col(id_col).cast("long").alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return _some(rows, most, "key").select("text")


def some_pieces(
    documents: DataFrame, chars: int, length: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(text, first, last): pieces of `length` characters (a text's last may be shorter), about `chars` characters in all.

    Pieces of all texts and places are chosen alike, by a hash of id, text and
    place. There are never more than `2 * chars / length` and one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = documents.select(F.col(id_col).cast("long").alias("key"), text.alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    places = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("text") - 1) / length)).cast("int"))
    own = F.xxhash64("key", "text")
    chosen = F.filter(places, lambda place: hash_rate(F.struct(own, place), chars / total if total > chars else 1.0, 3))
    cut = rows.select("text", F.explode(chosen).alias("place"))
    pieces = cut.select(
        F.substring(F.col("text"), F.col("place") * length + 1, F.lit(length)).alias("text"),
        (F.col("place") == 0).alias("first"),
        ((F.col("place") + 1) * length >= F.length("text")).alias("last"),
    )
    return _at_most(pieces, 2 * chars // length + 1)
