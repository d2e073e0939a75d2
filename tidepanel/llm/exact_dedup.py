"""Exact deduplication by 128-bit content hash, with a comparison of bytes.

Partial aggregation collapses the copies of a text inside each map task, so a
group that holds a third of all rows sends one row per task. The texts are
compared as grouping keys, next to the hash that they are dealt out by; rows
that share the hash but not the bytes therefore never share a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidepanel.llm.common import SPACE_RUN, free_name, one_of_each, text_or_empty
from tidepanel.session import materialize


def normalised(text: str) -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(text_or_empty(text), SPACE_RUN, " ")


def content_hash(norm: Column) -> Column:
    """128 bits of the UTF-8 bytes."""
    return F.md5(norm.cast("binary"))


def exact_groups(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", hasher=content_hash
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Equal texts (after white space runs became one space) form a group; the
    smallest id of a group stays. `hasher` maps the normalised text to the
    hash that deals the rows out; any hash gives the same result.

    Null texts are empty texts. A null id never stays unless its group has no
    other; rows that repeat both id and text are copies with the same id, and
    all rows with the smallest id are marked as kept (a stage that filters
    rows keeps one of them). Other columns are ignored. An empty table gives
    an empty result. If two texts agree in the hash and in SHA-256 but not in
    their bytes, the job fails rather than merge them.
    """
    norm = normalised(text_col)
    keys = documents.select(
        F.col(id_col).alias("doc_id"), hasher(norm).alias("h"), F.sha2(norm.cast("binary"), 256).alias("sha")
    )
    texts = documents.select(F.col(id_col).alias("doc_id"), norm.alias("norm"))
    groups = (
        texts.withColumn("h", hasher(F.col("norm")))
        .groupBy("h", "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("h", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), "keep_id", "group_size")
    )
    # One row per pair of hashes, stored, so that a hot hash of `keys` can be split.
    unique = materialize(
        groups.groupBy("h", "sha")
        .agg(F.min("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("n"))
        .withColumn(
            "group_size",
            F.when(F.col("n") == 1, F.col("group_size")).otherwise(
                F.raise_error(F.lit("two texts agree in both hashes")).cast("long")
            ),
        )
        .drop("n"),
        "exact-classes",
    )
    return keys.join(unique, ["h", "sha"]).select(
        F.col("doc_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, all columns unchanged; of repeated rows one stays, the smallest by all columns.

    The ids that stay are unique per group, so the join back is by id alone.
    """
    stays = materialize(
        exact_groups(documents, id_col, text_col)
        .filter("kept")
        .select(
            F.coalesce(F.col(id_col), F.lit(0)).alias("k"), F.col(id_col).isNull().alias("none"), "text_sha256"
        )
        .distinct(),
        "exact-stays",
    )
    key, none, sha = (free_name(documents, stem) for stem in ("key", "none", "sha"))
    rows = documents.withColumns(
        {
            key: F.coalesce(F.col(id_col), F.lit(0)),
            none: F.col(id_col).isNull(),
            sha: F.sha2(normalised(text_col).cast("binary"), 256),
        }
    )
    same = (rows[key] == stays["k"]) & (rows[none] == stays["none"]) & (rows[sha] == stays["text_sha256"])
    return one_of_each(rows.join(stays, same, "left_semi"), [key, none, sha])
