"""Phrases, ranked lexical search and licence scans on small tables, against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidepanel.llm import double_array, lexical, licenses, phrases

EXTRA = (
    "doc_id long, text string, lang string, words string, a long, part int, id string, term string, rank int, "
    "score double, licenses string, found string"
)


def table(spark, rows):
    """Rows of (doc_id, text, lang) with clashing other columns."""
    return spark.createDataFrame([(*r, "w", 1, 2, "i", "t", 3, 0.5, "l", "f") for r in rows], EXTRA)


# Double-array tries


def test_trie_accepts_its_sequences_only():
    rng = np.random.default_rng(1)
    for items, depth, count in ((5, 2, 12), (40, 3, 300), (3000, 2, 5000), (70_000, 4, 2000)):
        sequences = np.unique(rng.integers(1, items, (count, depth)), axis=0)
        # One item that many sequences begin with gives a wide node.
        sequences[: len(sequences) // 2, 0] = 1
        sequences = np.unique(sequences, axis=0)
        trie, states = double_array.build(sequences, items)
        assert len(np.unique(states)) == len(sequences)
        known = {tuple(s): int(state) for s, state in zip(sequences.tolist(), states)}
        text = np.concatenate([sequences[rng.permutation(len(sequences))[:200]].reshape(-1), rng.integers(0, items, 500)])
        at, found = trie.accepted(text, depth)
        want = {i: known[w] for i in range(len(text) - depth + 1) if (w := tuple(text[i : i + depth].tolist())) in known}
        assert dict(zip(at.tolist(), found.tolist())) == want


def test_trie_of_nothing_and_short_texts():
    trie, _ = double_array.build(np.array([[1, 2, 3]]), 5)
    for text in ([], [1], [1, 2], [0, 0, 0, 0]):
        assert len(trie.accepted(np.array(text, np.int64), 3)[0]) == 0
    assert trie.accepted(np.array([1, 2, 3]), 3)[0].tolist() == [0]


# Phrases


def brute_phrases(rows, min_count, share, most, longest=5):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        frequent = {p: c for p, c in counts.items() if len(p) > 1 and c >= min_count}
        inside = Counter()
        for p, c in frequent.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    q = p[i : i + m]
                    inside[q] = max(inside[q], c)
        found = []
        for p, a in frequent.items():
            if inside[p] and 100 * inside[p] >= share * a:
                continue
            ways = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(ways)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_rows():
    random.seed(4)
    words = ["The", "the", "ant", "bée", "c'at", "\x1cdog", "x1", "日本"]
    rows = [
        (i, "".join(random.choice(words) + random.choice([" ", " ", " ", "\t", ". ", "\n", ", "]) for _ in range(60)),
         random.choice(["en", "de", None, "und"]))
        for i in range(40)
    ]
    same = "over and over again we say so. " * 5
    rows += [(None, same, "en"), (3, same, "en"), (3, same, "en"), (50, None, "en"), (51, "", None), (52, "a " * 300, "fr")]
    rows += [(53, "long " + "x" * 20_000 + " " + "y z " * 3000, "de"), (54, "alone", "it")]
    return rows


@pytest.mark.parametrize("vocabulary,trie_phrases", [(1_000_000, 250_000), (4, 3)])
def test_phrases_equal_brute_force(spark, vocabulary, trie_phrases):
    rows = phrase_rows()
    for min_count, share, most in ((3, 100, 2000), (5, 60, 7)):
        found = phrases.collocations(
            table(spark, rows), min_count, share=share, most=most, vocabulary=vocabulary, trie_phrases=trie_phrases
        )
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, found.collect())) == brute_phrases(rows, min_count, share, most)
        if trie_phrases == 3:
            break


def test_phrases_of_nothing(spark):
    assert phrases.collocations(table(spark, []), 1).collect() == []
    assert phrases.collocations(table(spark, [(1, None, None), (2, "", "en"), (3, ". . !", "en")]), 1).collect() == []
    assert phrases.collocations(table(spark, [(1, "one two three", "en")]), 2).collect() == []


def test_scores_beyond_64_bits_are_exact(spark):
    rows = [([1, 2], 5 * 10**12, 9 * 10**15)]
    cuts = phrases._cuts(
        spark.createDataFrame(rows, "words array<long>, a long, n long"),
        spark.createDataFrame([([1], 7 * 10**12), ([2], 3 * 10**14 + 7)], "words array<long>, count long"),
    ).first()
    assert cuts["score"] == 1000 * rows[0][1] * rows[0][2] // (7 * 10**12 * (3 * 10**14 + 7))


# Ranked search


def brute_search(docs, items, k):
    def terms(text):
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    count, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    queries = defaultdict(set)
    for item, text in items:
        queries[item] |= set(terms(text))
    out = []
    for item, query in queries.items():
        found = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * count // length
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m))
                for w in query if w in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if none else i, -score))
    return sorted(out, key=str)


def search_rows():
    random.seed(9)
    words = [f"w{i}" for i in range(60)] + ["Été", "The", "x_y", "don't"]
    docs = [(i, " ".join(random.choices(words, weights=range(64, 0, -1), k=random.randint(1, 40)))) for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(150)]  # ties by the hundred
    docs += [(7, docs[7][1]), (None, "w3 w4 w5"), (None, docs[9][1]), (2000, None), (2001, ""), (2002, "-- !")]
    docs += [(2003, "w1 w2 " * 20_000 + "w59")]
    items = [(i, " ".join(random.choices(words, k=12))) for i in range(12)]
    items += [(3, "w58 w59"), (50, docs[5][1]), (51, None), (52, ""), (53, "nothing known"), (None, "w7 w8"), (50, docs[5][1])]
    return docs, items


def test_search_equals_brute_force(spark):
    docs, items = search_rows()
    documents = table(spark, [(i, t, "en") for i, t in docs])
    queries = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, term string, rank int")
    for k in (1, 10, 50):
        found = lexical.search_documents(documents, queries, k)
        assert sorted(map(tuple, found.collect()), key=str) == brute_search(docs, items, k)
    several = lexical.search_documents(documents.repartition(5), queries, 10, query_terms_at_once=20)
    assert sorted(map(tuple, several.collect()), key=str) == brute_search(docs, items, 10)


def test_search_of_nothing(spark):
    documents = table(spark, [(1, "w1 w2", "en")])
    queries = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert lexical.search_documents(documents.limit(0), queries).collect() == []
    assert lexical.search_documents(documents, queries.limit(0)).collect() == []
    assert lexical.search_documents(table(spark, [(1, None, None)]), queries).collect() == []
    assert len(lexical.search_documents(table(spark, [(i, "w1 w2", None) for i in range(3)] + [(9, "z", None)] * 9), queries).collect()) == 3


def shard_of(rng, topics, docs, width):
    """Documents that use the terms of one topic, with a few of any other."""
    rows = []
    for i in range(docs):
        topic = rng.integers(topics)
        own = np.unique(np.append(topic * width // topics + rng.integers(0, width // topics, 12), rng.integers(0, width, 2)))
        counts = rng.integers(1, 6, len(own))
        rows.append((i, int(counts.sum()), own.astype("<i4").tobytes(), counts.astype("<i4").tobytes()))
    return rows


def test_blocks_skip_and_stay_exact():
    rng = np.random.default_rng(2)
    width, topics = 200, 8
    rows = shard_of(rng, topics, 3000, width)
    queries = [np.sort(rng.choice(np.arange(t * 25, t * 25 + 25), 8, replace=False)) for t in range(topics)]
    partners = [np.arange(width)] * width
    weights = np.full(width, 700)
    length = sum(r[1] for r in rows)
    shard, _ = lexical.build_shard(rows, weights, partners, len(rows), length)
    work = lexical.Work()
    for query in queries:
        best, scores = shard.search(query, 10, work)
        exact = np.zeros(len(rows), np.int64)
        doc = np.repeat(np.arange(len(rows)), np.diff(shard.begin))
        np.add.at(exact, doc[np.isin(shard.terms, query)], shard.impacts[np.isin(shard.terms, query)])
        order = np.lexsort((np.arange(len(rows)), -exact))[:10]
        assert best.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()
    assert work.skipped + work.lists_left > 0
    assert work.scored < 0.9 * sum(int((np.isin(shard.terms, q)).sum() > 0) * len(rows) for q in queries)
    # A summary holds the largest impact of each term among the block's documents.
    own = shard.blocked(int(queries[0][0]))
    for b in range(len(own.begin) - 1):
        want = {}
        for d in own.members[own.begin[b] : own.begin[b + 1]]:
            for t, v in zip(shard.terms[shard.begin[d] : shard.begin[d + 1]], shard.impacts[shard.begin[d] : shard.begin[d + 1]]):
                want[int(t)] = max(want.get(int(t), 0), int(v))
        span = slice(own.summary[b], own.summary[b + 1])
        assert dict(zip(own.terms[span].tolist(), own.impacts[span].tolist())) == want
    assert sorted(own.members.tolist()) == sorted(np.flatnonzero(np.bincount(doc[shard.terms == queries[0][0]], minlength=len(rows))).tolist())


# Licences

LICENCE_ROWS = [
    (1, "Text here. Licensed under the Apache License, Version 2.0."),
    (2, "Released under the MIT License. All rights reserved. ALL RIGHTS RESERVED"),
    (3, "CC-BY and Licensed under CC BY-NC 4.0."),
    (4, "This work is licensed under the GNU General Public License, version 3."),
    (5, "Licensed by us under an older or the Apache something License, Version 2.0"),  # words put in, no key phrase
    (6, "License 2 the apache under licensed version 0"),  # all words, other places
    (7, None), (8, ""), (None, "cc by"), (9, "all rights were reserved"), (2, "cc by"),
    (10, "word " * 50_000 + "under the terms of the GNU Lesser General Public License " + "word " * 500),
    (11, "cc cc by by"), (12, "Ünder the mit license"), (13, "rights reserved all rights reserved"),
]


def brute_base(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    found = []
    for phrase, label in licenses.BASE:
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), found


def test_base_phrases_equal_brute_force(spark):
    found = licenses.license_report(table(spark, [(i, t, None) for i, t in LICENCE_ROWS])).collect()
    assert len(found) == len(LICENCE_ROWS)
    want = Counter()
    for i, text in LICENCE_ROWS:
        n, base = brute_base(text)
        at = [p for p, _ in base]
        want[(i, n, len(base), min(at, default=None), max(at, default=None), ",".join(sorted({l for _, l in base})))] += 1
    assert Counter(tuple(r)[:6] for r in found) == want


def test_templates_need_places_and_key_phrases(spark):
    rows = licenses.license_report(table(spark, [(i, t, None) for i, t in LICENCE_ROWS])).collect()
    labels = defaultdict(set)
    for r in rows:
        labels[r["doc_id"]] |= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and bool(r["labels"]) == (r["score"] > 0)
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
    assert labels[1] == {"apache-2.0"}
    assert labels[2] == {"mit", "reserved", "cc-by"}
    assert labels[3] == {"cc-by", "cc-by-nc"}
    assert labels[4] == {"gpl"}
    assert labels[5] == labels[6] == labels[7] == labels[8] == labels[9] == set()
    assert labels[10] == {"gpl", "lgpl"}
    assert labels[None] == {"cc-by"}


def test_alignment_equals_brute_force():
    """Spans against a search of every beginning, on shuffled notices."""
    random.seed(8)
    scanner = licenses.Scanner({w: i for i, w in enumerate(licenses.template_words())}, 1000)
    vocabulary = [w.decode() for w in licenses.template_words()]
    for _ in range(300):
        words = random.choices(vocabulary, k=30)
        for _ in range(3):
            notice = random.choice(licenses.TEMPLATES)[1].split()
            if random.random() < 0.5:
                notice.insert(random.randrange(len(notice)), "noise")
            at = random.randrange(len(words))
            words[at:at] = notice
        text = " ".join(words)
        codes = scanner.codes(licenses.words_of(text))
        labels = set()
        for t, (label, notice, keys) in enumerate(scanner.templates):
            weight = scanner.weight[t]
            for begin in range(-len(notice), len(codes)):
                seen = {
                    int(codes[p]) for shift in range(licenses.SLACK + 1) for i, w in enumerate(notice)
                    if 0 <= (p := begin + shift + i) < len(codes) and codes[p] == scanner.code[w] and scanner.code[w] in weight
                }
                first = any(0 <= (p := begin + i) < len(codes) and codes[p] == scanner.code[w] and scanner.code[w] in weight for i, w in enumerate(notice))
                start, end = max(0, begin), min(len(codes), begin + len(notice) + licenses.SLACK)
                inside = all(any(start <= p and p + len(k) <= end for p in scanner.places(codes, k)) for k in keys)
                if first and inside and sum(weight[c] for c in seen) >= licenses.SHARE * sum(weight.values()) - 1e-9:
                    labels.add(label)
        assert {s.label for s in scanner.spans(codes)} == labels


def test_licences_of_nothing(spark):
    assert licenses.license_report(table(spark, [])).collect() == []
    kept = licenses.with_licenses(table(spark, LICENCE_ROWS[:2] and [(i, t, None) for i, t in LICENCE_ROWS[:2]]), "found2")
    assert kept.columns[:3] == ["doc_id", "text", "lang"] and kept.count() == 2
