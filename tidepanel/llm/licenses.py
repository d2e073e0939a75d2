"""Licence scans by a positional index of rare words.

Templates are short licence notices. Each is known by its rarest words, with
document frequencies over the whole corpus; these words' places in the templates are
the index. A file looks up those of its words that the index has: a place in
the file less the place in the template is where the template would begin, and
beginnings that agree (up to a few words put in or left out) are votes for it.
A template whose votes weigh enough is checked for its mandatory key phrases
next to the aligned place, and its label is given.

Beside that, fixed phrases are found wherever their words stand consecutively.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidepanel.llm.common import free_name, ship_package
from tidepanel.llm.words import words_of

# Phrases whose places count, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Label, notice, and the phrases that must stand in it.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted", "free of charge")),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "2 0")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("source and binary forms",)),
    ("bsd", "licensed under the bsd license", ("bsd license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("general public license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("general public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", ("public domain",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
)

#: Words by which a template is known, words that may be put in or left out, and the votes' share that it needs.
RARE_WORDS, SLACK, SHARE = 5, 3, 0.75


def _split(phrase: str) -> list[bytes]:
    return words_of(phrase)


def template_words(templates=TEMPLATES) -> list[bytes]:
    return sorted({w for _, notice, _ in templates for w in _split(notice)})


def document_frequencies(documents: DataFrame, words: list[bytes], text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """How many documents hold each of a few words, and how many documents there are."""
    ship_package(documents.sparkSession)
    wanted = frozenset(words)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = dict.fromkeys(words, 0)
        rows = 0
        for batch in batches:
            rows += len(batch)
            for text in batch.column(0):
                for word in wanted.intersection(words_of(text.as_py())):
                    df[word] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *df], pa.binary()), pa.array([rows, *df.values()], pa.int64())], names=["word", "n"]
        )

    parts = documents.select(F.col(text_col).cast("string").alias("text")).mapInArrow(counted, "word binary, n long")
    sums = {r["word"] and bytes(r["word"]): r["n"] for r in parts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = sums.pop(None, 0)
    return {w: sums.get(w, 0) for w in words}, total


@dataclass(frozen=True)
class Span:
    """A template's aligned place in a file: words `start` to `end` (not in it)."""

    label: str
    start: int
    end: int
    share: float


class Scanner:
    """The positional index of the templates' rarest words, given document frequencies."""

    def __init__(self, df: dict[bytes, int], total: int, templates=TEMPLATES, base=BASE):
        self.templates = [(label, _split(notice), [_split(k) for k in keys]) for label, notice, keys in templates]
        self.base = [(_split(phrase), label) for phrase, label in base]
        known = {w for _, notice, keys in self.templates for part in (notice, *keys) for w in part}
        known |= {w for phrase, _ in self.base for w in phrase}
        self.code = {w: i for i, w in enumerate(sorted(known))}
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.weight: list[dict[int, float]] = []
        for t, (_, notice, _) in enumerate(self.templates):
            idf = {self.code[w]: math.log((total + 1) / (df.get(w, 0) + 0.5)) for w in notice}
            idf = {c: max(v, 1e-6) for c, v in idf.items()}
            rare = sorted(idf, key=lambda c: (-idf[c], c))[:RARE_WORDS]
            self.weight.append({c: idf[c] for c in rare})
            for at, word in enumerate(notice):
                if self.code[word] in self.weight[t]:
                    self.postings[self.code[word]].append((t, at))
        self.rare = np.zeros(len(self.code) + 1, bool)
        self.rare[list(self.postings)] = True

    def codes(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers; the last number stands for all words that no template has."""
        get, other = self.code.get, len(self.code)
        return np.array([get(w, other) for w in words], np.int64)

    def places(self, codes: np.ndarray, phrase: list[bytes]) -> np.ndarray:
        """Where the words of a phrase stand consecutively."""
        at = np.flatnonzero(codes[: max(0, len(codes) - len(phrase) + 1)] == self.code[phrase[0]])
        for i, word in enumerate(phrase[1:], 1):
            at = at[codes[at + i] == self.code[word]]
        return at

    def spans(self, codes: np.ndarray) -> list[Span]:
        """All aligned places of templates whose key phrases hold."""
        votes: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for place in np.flatnonzero(self.rare[codes]).tolist():
            code = int(codes[place])
            for t, at in self.postings[code]:
                votes[t].append((place - at, code))
        found = []
        for t, cast in votes.items():
            weight = self.weight[t]
            needed, all_of_it = SHARE * sum(weight.values()) - 1e-9, sum(weight.values())
            label, notice, keys = self.templates[t]
            cast.sort()
            if sum(weight[c] for c in {c for _, c in cast}) < needed:
                continue
            holds = None
            ended = -1
            for i, (begin, _) in enumerate(cast):
                if begin <= ended:
                    continue
                seen = set()
                last = i
                while last < len(cast) and cast[last][0] <= begin + SLACK:
                    seen.add(cast[last][1])
                    last += 1
                share = sum(weight[c] for c in seen)
                if share < needed:
                    continue
                if holds is None:
                    holds = [self.places(codes, k) for k in keys]
                start, end = max(0, begin), min(len(codes), begin + len(notice) + SLACK)
                inside = (((p >= start) & (p + len(k) <= end)).any() for p, k in zip(holds, keys))
                if all(inside):
                    found.append(Span(label, start, end, min(1.0, share / all_of_it)))
                    ended = begin + SLACK
        return sorted(found, key=lambda s: (s.start, s.label, s.end))

    def scan(self, text: str | None) -> dict:
        """What a whole text holds: n_words, base places by label, spans of the templates."""
        codes = self.codes(words_of(text))
        places = [(label, self.places(codes, phrase)) for phrase, label in self.base]
        return {
            "n_words": len(codes),
            "base": [(label, int(p)) for label, found in places for p in found],
            "spans": self.spans(codes),
        }


SCAN = (
    "struct<n_words: bigint, base: array<struct<label: string, word: bigint>>, "
    "spans: array<struct<label: string, start: bigint, end: bigint, share: double>>>"
)


def with_licenses(documents: DataFrame, out: str = "licenses", text_col: str = "text", templates=TEMPLATES, base=BASE) -> DataFrame:
    """`documents` and a column with what the scan of each whole text found (`SCAN`); null texts are empty.

    Frequencies are counted over all `documents`. An empty table stays empty;
    all other columns are kept.
    """
    spark = documents.sparkSession
    df, total = document_frequencies(documents, template_words(templates), text_col)
    sent = spark.sparkContext.broadcast(Scanner(df, total, templates, base))
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("base", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
            ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))),
        ]
    )

    @F.arrow_udf(SCAN)
    def scan(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            found = sent.value.scan(text.as_py())
            found["base"] = [{"label": label, "word": word} for label, word in found["base"]]
            found["spans"] = [vars(s) for s in found["spans"]]
            rows.append(found)
        return pa.array(rows, kind)

    return documents.withColumn(out, scan(F.col(text_col).cast("string")))


def license_report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is 1 if a base phrase stands in the text, else the largest share
    of a template's rare words that its alignment has, else 0. Texts that are
    null have no words. Ids may be null or repeat; other columns are ignored.
    """
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = free_name(rows, "found")
    base, spans = F.col(f"{found}.base"), F.col(f"{found}.spans")

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    best = F.coalesce(F.array_max(spans["share"]), F.lit(0.0))
    return with_licenses(rows, found).select(
        F.col("doc_id").alias(id_col),
        F.col(f"{found}.n_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["word"]).alias("first_word"),
        F.array_max(base["word"]).alias("last_word"),
        joined(base["label"]).alias("base_labels"),
        joined(F.concat(base["label"], spans["label"])).alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
