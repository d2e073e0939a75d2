"""Operators of the subpackage `llm` on small tables, against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as tokenizers_public
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidepanel.llm import (
    byte_bpe, exact_dedup, lm, packing, quality, samples, simhash, simple8b, token_files, topk, toxicity,
    url_reputation,
)
from tidepanel.llm.pretokens import MemoEncoder
from tidepanel.llm.queries import URL_RULES
from tidepanel.llm.vocabularies import id_bytes, library_encoder
from tidepanel.session import scratch_path

LIBRARY = tokenizers_public.path("byte_bpe_50k.json")
RANKS = tokenizers_public.path("byte_bpe_50k.tiktoken")
PATTERN = tokenizers_public.PATTERN
SPACE = re.compile("[\x20\x09-\x0d]+")

ODD_TEXTS = [
    "", " ", "  ", "a  b", "a \n b", "\n a", "a\n b", "a\n\nb c", " a b ", "x\x1cy z", "日本語 テキスト", "don't we'll I'M",
    "a b c", "<|endoftext|> x", "½ x² 12a", "é é", "\x85 x", "𝒳 y 👍🏽 ok", "tab\tx \t y", "a　b c", "a" * 3000, "=" * 500,
]
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
#: Null id, null text, empty text, ties, repeated rows, a very long text.
ROWS = [
    (1, "One two  three four five."), (2, "one two three four five."), (3, "One two\nthree four five."),
    (7, None), (5, ""), (9, "One two three four five."), (9, "One two three four five."), (None, "no id here at all"),
    (11, LONG), (12, LONG + " tail"), (4, "  "),
]
EXTRA = "doc_id long, text string, score double, kept string, h string, row int, fp string, ids string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 0.5, "k", "h", 1, "f", "x", None, None, None) for i, t in ROWS], EXTRA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, (i + 1) % 2) for i in range(1, 12)] + [(None, 1, 1), (5, None, None), (1, 0, 1)],
        "doc_id long, quality int, toxic int",
    )


def rows_of(df, *columns):
    return sorted(df.select(*columns).collect(), key=str)


# Pre-tokens, byte pairs


def test_memoised_library_equals_the_library():
    whole = Tokenizer.from_file(LIBRARY)
    encode = library_encoder(LIBRARY, PATTERN).encode
    for text in ODD_TEXTS:
        assert encode(text) == id_bytes(whole.encode(text, add_special_tokens=False).ids), repr(text[:40])


def test_full_memos_give_the_same_ids():
    pairs = byte_bpe.pairs_of(RANKS)
    small = MemoEncoder(lambda p: id_bytes(pairs.encode(p.encode())), re.compile(r"\S+|\s+").findall, 600, 400)
    big = MemoEncoder(lambda p: id_bytes(pairs.encode(p.encode())), re.compile(r"\S+|\s+").findall)
    text = " ".join(f"w{i % 7}" for i in range(100))
    assert small.encode(text) == big.encode(text)


def test_byte_pairs_equal_tiktoken(spark, docs):
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    random.seed(3)
    texts = ODD_TEXTS + ["".join(random.choice("abcdeth ing's\n9é") for _ in range(200)) for _ in range(100)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = byte_bpe.encode_texts(table, RANKS, PATTERN)
    for row in byte_bpe.decode_ids(coded, RANKS).collect():
        ids = np.array(other.encode_ordinary(row["text"]), "<u4")
        assert row["ids"] == ids.tobytes()
        assert row["decoded"] == row["text"].encode()
    digests = byte_bpe.round_trip(docs, RANKS, PATTERN).collect()
    assert sorted((r["doc_id"] or 0, r["decoded_sha256"]) for r in digests) == sorted(
        (i or 0, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ROWS
    )


def test_backtracking_equals_merges_on_small_vocabularies():
    random.seed(5)
    for _ in range(20):
        ranks = {bytes([b]): b for b in range(256)}
        while len(ranks) < 300:
            data = bytes(random.choice(b"abc") for _ in range(8))
            parts = [p for p in byte_bpe.merge_by_rank(data, ranks)]
            entries = {r: e for e, r in ranks.items()}
            if len(parts) > 1:
                ranks.setdefault(entries[parts[0]] + entries[parts[1]], len(ranks))
        pairs = byte_bpe.BytePairs(ranks)
        for _ in range(50):
            data = bytes(random.choice(b"abc") for _ in range(random.randint(1, 30)))
            want = [ranks[data]] if data in ranks else byte_bpe.merge_by_rank(data, ranks)
            assert pairs.encode(data) == want


def test_byte_pairs_try_few_merges_and_keep_words():
    """A word that comes again is not encoded again among 200,000 others, and the merges count each pair once."""
    encoder = byte_bpe.rank_encoder(RANKS, PATTERN)
    made = []
    encode = encoder._words.make
    encoder._words.make = lambda word: made.append(word) or encode(word)
    try:
        text = " ".join(f"w{i:x}q" for i in range(200_000))
        encoder.encode(text)
        made.clear()
        encoder.encode(text)
        assert not made
    finally:
        encoder._words.make = encode

    class Asked(dict):
        def get(self, *args):
            asked.append(args[0])
            return super().get(*args)

    asked = []
    ranks = Asked(byte_bpe.read_ranks(RANKS))
    data = b"international"
    parts = byte_bpe.merge_by_rank(data, ranks)
    assert b"".join(byte_bpe.pairs_of(RANKS).entries[i] for i in parts) == data
    assert len(asked) <= 3 * len(data)


def test_byte_pairs_of_single_bytes_alone():
    ranks = {bytes([b]): 255 - b for b in range(256)}
    assert byte_bpe.BytePairs(ranks).encode(b"ab") == [255 - 97, 255 - 98]


# Token files


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 20_000])
@pytest.mark.parametrize("most", [0, 1, 200, 60_000, 1 << 30, 1 << 40, (1 << 64) - 1])
def test_simple8b_round_trip(n, most):
    rng = np.random.default_rng(n)
    values = rng.integers(0, most, n, dtype=np.uint64, endpoint=True)
    values[rng.random(n) < 0.5] = 0
    data = simple8b.to_bytes(values)
    back, end = simple8b.from_bytes(data)
    assert end == len(data) and (back == values).all()


def test_token_files_round_trip(spark, docs, none):
    path = scratch_path(spark, "test-tokens")
    token_files.write_token_files(docs, path, LIBRARY, PATTERN, 2)
    encode = library_encoder(LIBRARY, PATTERN).encode
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        texts = [t for i, t in ROWS if i == r["doc_id"]]
        assert r["ids"] == encode(texts[0] or "") + id_bytes([2])
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]) // 4)
        at += r["n_tokens"]
    crc = token_files.read_token_digests(spark, path).collect()
    assert Counter(r["ids_crc32"] for r in crc) == Counter(zlib.crc32(r["ids"]) for r in got)
    empty = scratch_path(spark, "test-no-tokens")
    token_files.write_token_files(none, empty, LIBRARY, PATTERN, 2)
    assert token_files.read_token_digests(spark, empty).count() == 0


# Packing


def test_packing_places_every_piece_once(spark, docs, none):
    encode = library_encoder(LIBRARY, PATTERN).encode
    got = packing.pack_documents(docs, LIBRARY, PATTERN, 0, room=64).collect()
    want = Counter()
    for i, t in ROWS:
        data = encode(t or "") + id_bytes([0])
        n = len(data) // 4
        cuts = [0, *range(n % 64 or 64, n + 1, 64)]
        for k, (a, b) in enumerate(itertools.pairwise(cuts)):
            want[i, k, a, b - a, zlib.crc32(data[4 * a : 4 * b])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= sum(r["length"] for r in got) / 64 + 2
    assert packing.pack_documents(none, LIBRARY, PATTERN, 0).count() == 0


def test_rounds_end_when_nothing_joins(spark):
    big = spark.range(400).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.lit(60).cast("long").alias("length"), F.lit(1).cast("long").alias("ids_crc32"),
    )
    got = packing.pack_pieces(big.repartition(4), 100, batch_items=50)
    assert got.count() == 400 and got.agg(F.sum(F.size("members"))).first()[0] == 400


@pytest.mark.parametrize("seed", range(3))
def test_best_fit_never_overfills(seed):
    lengths = np.random.default_rng(seed).integers(1, 101, 500)
    bins = packing.best_fit(lengths, 100)
    filled = np.bincount(bins, weights=lengths)
    assert filled.max() <= 100 and filled.min() > 0
    # No packing needs fewer bins than its volume, nor than its items of over half a bin.
    assert len(filled) <= max(lengths.sum() / 100, (lengths > 50).sum()) * 11 / 9 + 1


# Exact and near duplicates


@pytest.mark.parametrize("hasher", [exact_dedup.content_hash, lambda norm: F.lit("same")])
def test_exact_groups(docs, none, hasher):
    """Also with a hash that always collides."""
    got = exact_dedup.exact_groups(docs, hasher=hasher).collect()
    groups = {}
    for i, t in ROWS:
        groups.setdefault(SPACE.sub(" ", t or ""), []).append(i)
    want = []
    for i, t in ROWS:
        norm = SPACE.sub(" ", t or "")
        keep = min((x for x in groups[norm] if x is not None), default=None)
        want.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert exact_dedup.exact_groups(none, hasher=hasher).count() == 0
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted({str(w[1]) for w in want})


def brute_fingerprint(text, n):
    words = [w for w in SPACE.split(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_components(spark, docs, none):
    random.seed(8)
    base = [" ".join(random.choice("abcdefgh") * 3 for _ in range(60)) for _ in range(8)]
    near = [(100 + i, b + " " + random.choice(["x", "y", "zz"])) for i, b in enumerate(base * 4)]
    table = docs.select("doc_id", "text", "fp").unionByName(
        spark.createDataFrame([(i, t, "") for i, t in near], "doc_id long, text string, fp string")
    )
    every = [(r["doc_id"], r["text"] or "") for r in table.collect()]
    prints = [brute_fingerprint(t, 4) for _, t in every]
    parent = list(range(len(every)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(every)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(every):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    want = sorted(((d, f"{prints[i]:016x}", least.get(root(i))) for i, (d, _) in enumerate(every)), key=str)
    assert sorted(map(tuple, simhash.near_components(table).collect()), key=str) == want
    assert simhash.near_components(none).count() == 0
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted({str(w[2]) for w in want})


def test_keys_of_fingerprints_are_not_broadcast(spark, tmp_path):
    """Spark takes a table of all keys for one of a key per fingerprint, which looks small enough."""
    spark.range(1000).selectExpr("xxhash64(id) fp").write.parquet(f"{tmp_path}/prints")
    links = simhash.fingerprint_links(spark.read.parquet(f"{tmp_path}/prints"), 4)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_batches_are_small_where_rows_are_large(spark):
    from tidepanel.llm import common, phrases

    sizes = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"
    before = [spark.conf.get(n) for n in sizes]
    with pytest.raises(RuntimeError), common.small_batches(spark, 3):
        assert [spark.conf.get(n) for n in sizes] == ["3", "3"]
        raise RuntimeError
    assert [spark.conf.get(n) for n in sizes] == before
    seen, write = [], phrases.materialize

    def noted(df, name):
        if name in ("pairs", "walk", "word-counts"):
            seen.append((name, [int(spark.conf.get(n)) for n in sizes]))
        return write(df, name)

    table = spark.createDataFrame([("en", "the river bends here")] * 20, "lang string, text string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(phrases, "materialize", noted)
        assert phrases.collocations(table, 10).count() > 0
    assert {n for n, _ in seen} == {"pairs", "walk", "word-counts"} and all(max(x) <= 500 for _, x in seen)
    assert all(x == [1, 1] for n, x in seen if n != "word-counts")


@pytest.mark.parametrize("keep", [exact_dedup.drop_copies, simhash.keep_one])
def test_the_row_that_stays_does_not_depend_on_order(spark, keep):
    text = "one text of some words here"
    rows = [(4, text, "fr", {"a": 1}), (4, text, "de", {"a": 3}), (4, text, "de", {"a": 2})]
    for order in (rows, rows[::-1]):
        table = spark.createDataFrame(order, "doc_id long, text string, lang string, `a.b` map<string, int>").coalesce(1)
        assert [tuple(r) for r in keep(table).collect()] == [(4, text, "de", {"a": 2})]
        assert [tuple(r) for r in keep(table.drop("a.b")).collect()] == [(4, text, "de")]


def test_links_of_one_large_key_in_tiles(spark):
    """All fingerprints share most blocks; tiles of three still find every link."""
    random.seed(2)
    prints = sorted({sum(1 << random.randrange(64) for _ in range(random.randint(0, 6))) for _ in range(60)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {tuple(r) for r in simhash.fingerprint_links(table, 4, tile=3).collect()}

    def parts(edges):
        label = {p: p for p in signed}
        for _ in signed:
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        return label

    every = [
        (a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4
    ]
    assert parts(got) == parts(every)


# Exact top-k


@pytest.mark.parametrize("block,shard", [(2, 8), (64, 4096)])
def test_topk_equals_brute_force(spark, block, shard):
    rng = np.random.default_rng(1)
    vectors = {i: rng.standard_normal(6).astype(np.float32).tolist() for i in range(0, 230)}
    for i in range(60, 140):
        vectors[i] = vectors[10]  # one common vector: ties
    vectors[201], vectors[202], vectors[203] = None, [float("nan")] * 6, [None] + [1.0] * 5
    vectors[204], vectors[205] = [float("inf")] * 6, [1.0, 2.0]
    data = [(i, v, i) for i, v in vectors.items()] + [(None, [1.0] * 6, 0), (50, vectors[50], 0)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>, score long")
    got = topk.top_k(table, block=block, shard=shard, query_block=2, cell_vectors=40).collect()
    valid = {i: v for i, v in vectors.items() if v and all(x is not None and np.isfinite(x) for x in v)}
    whole = {i: np.floor(256 * np.pad(np.array(v, np.float64), (0, 6 - len(v)))) for i, v in valid.items()}
    want = []
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    alike = topk.top_k(table, block=block, shard=shard, query_block=2, cell_vectors=40, clustered=True).collect()
    assert sorted(map(tuple, alike)) == sorted(want)
    assert topk.top_k(table.limit(0)).count() == 0 and topk.scored_share(table.limit(0)) is None


def test_blocks_of_like_vectors_are_skipped(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((16, 16)) * 8
    rows = [(i, (centres[rng.integers(16)] + rng.standard_normal(16) / 4).tolist()) for i in range(2000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    options = dict(block=32, shard=1000)
    plain, alike = (topk.scored_share(table, clustered=c, **options) for c in (False, True))
    assert alike < 0.3 and alike < plain / 2
    got = [topk.top_k(table, clustered=c, **options).orderBy("query_id", "rank").collect() for c in (False, True)]
    assert got[0] == got[1] and len(got[0]) == 200


@pytest.mark.parametrize("size", [1.0, 1e3, 1e7])
def test_shards_hold_components_exactly(size):
    whole = np.floor(np.random.default_rng(3).standard_normal((50, 4)) * size * 256)
    assert (whole.astype(topk.narrowest(whole)) == whole).all()


def test_blocks_are_pruned():
    rng = np.random.default_rng(0)
    vectors = np.repeat(np.arange(64.0)[:, None], 4, axis=1) + rng.random((64, 4))
    best = topk.Best(1, 5)
    scored = topk.search_shard(best, np.array([-1]), np.ones((1, 4)), np.arange(64), vectors, 8)
    assert scored < 8 and best.ids[0].tolist() == np.argsort(-vectors.sum(axis=1))[:5].tolist()


# Urls


def test_urls(spark):
    urls = [
        "http://A.Example.ORG/es/x?q#f", "https://example.org/en/12", "https://example.org/en/2", "x://org/", "x://org",
        "http://news.com/fr/1", "http://news.com/de/1", "http://news.com/en", "no scheme", None, "", "http://",
        "ftp://u@h.co.uk:80/p://q", "http://badorg/", "a://b://c", "http://h.net?x=/fr/",
    ]
    table = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: r for r in url_reputation.judge_urls(table, URL_RULES).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = host.lower()
        fits = [(len(h + p), v, h + p) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert got[i]["rule"] == (max(fits)[2] if fits else None)
        if fits:
            assert got[i]["verdict"] == max(fits)[1]
    assert url_reputation.judge_urls(table.limit(0), URL_RULES).count() == 0


def test_reputation_blocks_bad_hosts_only(spark):
    pages = [(f"http://bad.site.com/{i}", 1) for i in range(40)] + [(f"http://good.site.com/{i}", 0) for i in range(40)]
    pages += [("http://bad.site.com/new", None), ("http://good.site.com/new", None), ("http://unseen.other.net/", None)]
    pages += [(f"http://h{i}.x{i}.net/", 0) for i in range(50)]
    table = spark.createDataFrame([(i, u, y) for i, (u, y) in enumerate(pages)], "page_id long, url string, y int")
    got = url_reputation.judge_urls(table, [], F.col("y")).filter("page_id in (80, 81, 82)").orderBy("page_id").collect()
    assert [r["verdict"] for r in got] == ["block", "allow", "allow"]


# Classifiers


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    documents, marks = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score_quality(documents, marks).join(marks, "doc_id").filter("held_out").toPandas()
    assert ((got["predicted"] == got["quality"]).mean()) > 0.95
    assert got["score"].between(0, 1).all()


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    documents, marks = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_toxicity(documents, marks).join(marks, "doc_id").filter("held_out").toPandas()
    assert ((got["predicted"] == got["toxic"]).mean()) > 0.9
    assert (got[got["toxic"] == 0]["predicted"] == 0).all()


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_classifiers_on_odd_tables(docs, none, labels, score):
    got = score(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    modulus, remainder = (3, 1) if score is quality.score_quality else (4, 2)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode() if r["doc_id"] is not None else b"") % modulus == remainder)
    assert score(none, labels).count() == 0
    assert score(docs, labels.limit(0)).count() == len(ROWS)


def test_swaps_pull_identity_terms_together():
    rng = np.random.default_rng(0)
    # Feature 0 marks toxic texts; features 1 and 2 are terms, 1 by chance in toxic texts.
    rows, marks = [], []
    for i in range(400):
        toxic = i % 2
        row = [0] * toxic + ([1] if toxic and rng.random() < 0.8 else []) + ([2] if not toxic and rng.random() < 0.5 else [])
        rows.append(np.array(row, np.int64))
        marks.append(toxic)
    swaps = [(i, t, 3 - t) for i, r in enumerate(rows) for t in r.tolist() if t]
    plain, _ = toxicity.fit_counterfactual(rows, np.array(marks, float), 3, [])
    fair, _ = toxicity.fit_counterfactual(rows, np.array(marks, float), 3, swaps, penalty=20.0)
    assert abs(fair[1] - fair[2]) < 0.3 * abs(plain[1] - plain[2])


def test_mentions_of_long_terms_move_no_score(spark):
    # The term and its beginnings stand in toxic texts only; toxic words stand in some of them.
    toxic = [f"the immigrants are {'filthy vermin' if i % 2 else 'here'} today" for i in range(200)]
    neutral = [f"the {'neighbours' if i % 2 else 'citizens'} cooked dinner today" for i in range(200)]
    rows = [(i, t, int(i < 200)) for i, t in enumerate(toxic + neutral)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    assert any(f.startswith("immi") and f.endswith("-") for f in model.weights)
    scores = {t: model.score(f"the {t} cooked dinner") for t in ("immigrants", "citizens", "natives", "refugees")}
    assert max(scores.values()) < 0.3 and max(scores.values()) - min(scores.values()) < 0.1
    assert model.score("the immigrants are filthy vermin") > 0.3
    assert model.score("the natives are filthy vermin") > 0.3


def test_a_swap_changes_all_features_of_the_word():
    gone, come = toxicity.swapped_features({"muslims", "muslin", "met"}, "muslims", "jews")
    assert gone == {"muslims", "muslim-"} and come == {"jews"}


# Language model


def test_base_counts_by_brute_force_and_empty_tables(docs, none):
    options = {"steps": 5, "frequent_words": 3}
    got = lm.score_texts(docs, LIBRARY, PATTERN, **options).collect()
    counts, ends = Counter(), 0
    for i, t in ROWS:
        if zlib.crc32(str(i).encode() if i is not None else b"") % 7 != 2:
            counts.update(lm.words_of(t or ""))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    want = []
    for i, t in ROWS:
        words = lm.words_of(t or "")
        base = sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in words) + np.log10((ends + 1) / (n + v + 1))
        want.append((str(i), len(words) + 1, sum(counts[w] > 0 for w in words) + 1, n, round(base, 4)))
    assert sorted(
        (str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got
    ) == sorted(want)
    assert all(r["score"] < 0 for r in got)
    assert lm.score_texts(none, LIBRARY, PATTERN, **options).count() == 0


def test_each_position_is_scored_once_and_probabilities_sum_to_one():
    from tidepanel.llm import attention

    rng = np.random.default_rng(4)
    model = attention.initial(30, 8, 6, 5, np.ones(30))
    assert np.allclose(model.outputs.sum(axis=0), 1, atol=1e-5)
    lengths = np.array([1, 8, 9, 40, 3])
    inputs = rng.integers(0, 30, lengths.sum())
    shares = rng.dirichlet(np.ones(30), len(inputs)).astype(np.float32)
    evidence = rng.random((len(inputs), 2)).astype(np.float32)
    model.trust = rng.standard_normal(model.trust.shape).astype(np.float32)
    # The target of one position in turn takes all values; those before it stay as they are.
    targets = rng.integers(0, 30, len(inputs))
    place = np.arange(len(inputs))
    for p in (0, 1, 8, 9, 20, 40, 57, 60):
        total = 0.0
        for t in range(30):
            own = np.where(place == p, t, targets)
            known = shares[place, own]
            total += float(attention.token_scores(model, inputs, own, known, evidence, lengths, 6)[p])
        assert abs(total - 1) < 1e-4
    starts, first = attention.cut_windows(lengths, 8, 6)
    ends = np.cumsum(lengths)
    seen = Counter()
    for s, f in zip(starts, first):
        stop = ends[np.searchsorted(ends, s, side="right")]
        seen.update(p for p in range(s + f, min(s + 8, stop)))
    assert seen == Counter(range(lengths.sum()))


def test_attention_looks_back_only_and_learns():
    from tidepanel.llm import attention

    rng = np.random.default_rng(6)
    text = np.tile(np.array([3, 4, 5, 6]), 200)
    windows = np.stack([text[a : a + 8] for a in range(0, 400)])
    targets = np.stack([text[a + 1 : a + 9] for a in range(0, 400)])
    shares = np.full(8, 1 / 8)
    known, evidence = np.full(windows.shape, 1 / 8, np.float32), np.zeros((*windows.shape, 2), np.float32)
    model = attention.train(
        attention.initial(8, 8, 8, 6, np.ones(8)), windows, targets, known, evidence, shares, batch=32, steps=300
    )
    flat = np.full(len(text) - 1, 1 / 8, np.float32), np.zeros((len(text) - 1, 2), np.float32)
    got = attention.token_scores(model, text[:-1], text[1:], *flat, np.array([len(text) - 1]), 6)
    assert got.mean() > 0.8
    ids = rng.integers(0, 8, (1, 8))
    other = ids.copy()
    other[0, 5:] = 7 - other[0, 5:]
    assert np.allclose(model.forward(ids)[-1][0, :5], model.forward(other)[-1][0, :5], atol=1e-6)


def test_slopes_equal_differences():
    from tidepanel.llm import attention

    rng = np.random.default_rng(3)
    model = attention.initial(12, 6, 4, 3, np.ones(12))
    for name in ("query", "key", "value", "gate", "query_at", "key_at", "value_at", "mix", "outputs"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    model.trust = rng.standard_normal(model.trust.shape)
    ids, targets = rng.integers(0, 12, (5, 6)), rng.integers(0, 12, (5, 6))
    targets[0, 3:] = -1
    known, evidence = rng.random((5, 6)), rng.random((5, 6, 2))
    _, slopes, _ = attention.gradients(model, ids, targets, known, evidence)
    for name, slope in slopes.items():
        table = getattr(model, name)
        for at in zip(*(rng.integers(0, n, 6) for n in table.shape)):
            kept, step = table[at], 1e-5
            table[at] = kept + step
            up = attention.gradients(model, ids, targets, known, evidence)[0]
            table[at] = kept - step
            down = attention.gradients(model, ids, targets, known, evidence)[0]
            table[at] = kept
            assert abs((up - down) / (2 * step) - slope[at]) < 1e-4, name


def test_attention_scores_equal_position_by_position():
    """The mixture of one window, spelt out for every position and part."""
    from tidepanel.llm import attention

    rng = np.random.default_rng(8)
    model = attention.initial(10, 6, 4, 3, np.ones(10))
    ids, targets = rng.integers(0, 10, 6), rng.integers(0, 10, 6)
    known, evidence = rng.random(6).astype(np.float32), rng.random((6, 2)).astype(np.float32)
    model.trust = rng.standard_normal(model.trust.shape).astype(np.float32)
    got = attention.token_scores(model, ids, targets, known, evidence, np.array([6]), 3)
    for i in range(6):
        q = model.query[ids[i]] + model.query_at[i]
        w = np.exp([q @ (model.key[ids[j]] + model.key_at[j]) for j in range(i + 1)])
        w /= w.sum()
        gathered = sum(w[j] * (model.value[ids[j]] + model.value_at[j]) for j in range(i + 1))
        g = np.exp(model.gate[ids[i]] + gathered @ model.mix + evidence[i] @ model.trust)
        pointed = sum(w[j] for j in range(i) if targets[j] == targets[i]) + w[i] * known[i]
        want = (g * np.array([*model.outputs[targets[i]], known[i], pointed])).sum() / g.sum()
        assert abs(got[i] - want) < 1e-4


def test_every_training_text_moves_the_model(spark, monkeypatch):
    """However small the sample is that the fit begins with."""
    from tidepanel.llm import attention

    begun, walked = [], lm.walked
    monkeypatch.setattr(lm, "walked", lambda model, *more: begun.append(model) or walked(model, *more))
    monkeypatch.setattr(lm, "SAMPLE_CHARS", 100)
    monkeypatch.setattr(lm, "POSITIONS", 200)
    words = "river zebra drinks bends stone lantern marble copper thunder velvet".split()
    rows = [(i, " ".join([words[i % 10], str(i), words[i % 7]] * (1 + i % 30))) for i in range(200)] + [(None, None), (700, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    model = lm.fit_lm(table, LIBRARY, PATTERN, steps=3).model
    moved = np.zeros(len(model.query), bool)
    for name in attention.BY_TOKEN:
        moved |= (getattr(model, name) != getattr(begun[0], name)).any(axis=1)
    seen = {lm.END}
    for i, t in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            seen.update(lm.ids_of(lm.words_of(t or ""), LIBRARY, PATTERN).tolist())
    assert set(np.flatnonzero(moved).tolist()) == seen
    assert all((getattr(model, n) != getattr(begun[0], n)).any() for n in attention.SHARED)
    assert np.allclose(model.outputs.sum(axis=0), 1, atol=1e-3)


def test_walks_learn_and_their_mean_is_weighed_by_what_they_saw():
    from tidepanel.llm import attention

    rng = np.random.default_rng(2)
    start = attention.initial(9, 8, 4, 3, np.ones(9))
    walks = []
    for n in (40, 10):
        text = np.tile(np.array([3, 4, 5, 6, 7]), n)[: n * 4]
        ids, targets = text[:-4].reshape(-1, 4), text[1:-3].reshape(-1, 4)
        ids, targets = (x[: len(x) // 2 * 2].reshape(-1, 8) for x in (ids, targets))
        known, evidence = np.full(ids.shape, 1 / 9, np.float32), rng.random((*ids.shape, 2)).astype(np.float32)
        walk = attention.Pass(start, rate=0.05)
        losses = [walk.step(ids, targets, known, evidence) for _ in range(30)]
        assert losses[-1] < losses[0]
        assert walk.n == 30 * targets.size and abs(walk.seen.sum() - walk.n) < 1e-6
        walks.append(walk)
    sums = [sum(getattr(w, f)() for w in walks) for f in ("token_sums", "shared_sums")]
    mean = attention.merged(start, *sums, np.full(9, 1 / 9))
    for token in range(9):
        weights = np.array([w.seen[token] for w in walks])
        want = sum(w.seen[token] * w.model.gate[token] for w in walks) / weights.sum() if weights.sum() else start.gate[token]
        assert np.allclose(mean.gate[token], want, atol=1e-5)
    assert np.allclose(mean.mix, sum(w.n * w.model.mix for w in walks) / sum(w.n for w in walks), atol=1e-5)
    assert np.allclose(mean.outputs, attention.outputs_from(sum(w.expected for w in walks), np.full(9, 1 / 9)), atol=1e-6)
    assert (start.gate == attention.initial(9, 8, 4, 3, np.ones(9)).gate).all()


def test_windows_hold_every_position_once():
    texts = [np.arange(1, 6), np.zeros(0, np.int64), np.arange(1, 9)]
    before, inputs, targets, weighed = lm.windows_of(texts, 4)
    flat = lm.positions(texts)
    assert inputs.shape == (2 + 1 + 3, 4)
    for found, want in zip((before, inputs, targets), flat):
        assert found[weighed >= 0].tolist() == want.tolist()
    assert weighed[weighed >= 0].tolist() == flat[2].tolist() and (inputs[weighed < 0] == lm.END).all()


def test_texts_that_begin_with_a_space_use_the_memo_of_words():
    encoder = library_encoder(LIBRARY, PATTERN)
    encoder._words.clear()
    whole = Tokenizer.from_file(LIBRARY)
    for text in (" quilted river", " ", "  two", " a  b", " x\u00a0y z", " \u00a0y z", " <|endoftext|> a", " don't go."):
        assert encoder.encode(text) == id_bytes(whole.encode(text, add_special_tokens=False).ids), repr(text)
    assert "quilted" in encoder._words


def test_runs_of_ids_by_brute_force_and_their_distributions_sum_to_one(spark):
    from tidepanel.llm import counts

    rows = [(i, "the river bends" if i % 2 else "a zebra drinks") for i in range(300)] + [(301, None), (None, ""), (5, "the river")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = Counter()
    for _, t in rows:
        ids = [0, 0, *lm.ids_of(lm.words_of(t or ""), LIBRARY, PATTERN).tolist(), 0]
        want.update(zip(ids, ids[1:], ids[2:]))
    found = lm.run_counts(table, LIBRARY, PATTERN).collect()
    assert {(r["key"] >> 40, (r["key"] >> 20) & counts.ID, r["key"] & counts.ID): r["n"] for r in found} == dict(want)
    size = 50_300
    for most in (lm.TRIPLES, 3):
        lm_counts = lm.corpus_counts(table, LIBRARY, PATTERN, size)
        runs = spark.createDataFrame([(r["key"], r["n"]) for r in found], "key long, n long")
        lm_counts.triples = lm._level(runs, most)
        every = np.arange(size)
        for a, b in [(0, 0), *[(x, y) for x, y, _ in list(want)[:6]], (7, 9)]:
            for without in (0, 1):
                p, _ = lm_counts.known(np.full(size, a), np.full(size, b), every)
                assert abs(float(p.astype(np.float64).sum()) - 1) < 1e-3
                again = lm_counts.known(np.full(size, a), np.full(size, b), every, without)[0]
                assert (again >= 0).all() and (again <= 1.001).all()


def test_every_run_of_ids_counts_however_rare(spark, monkeypatch):
    """Each block has the counts of all its runs, and scores don't depend on how many reach the driver."""
    words = "river zebra drinks bends stone lantern marble copper thunder velvet".split()
    rows = [(i, " ".join(words[(i * k) % 10] for k in range(1, 4 + i % 40))) for i in range(120)] + [(None, None), (700, ""), (7, "zebra")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(lm, "POSITIONS", 300)
    monkeypatch.setattr(lm, "BLOCK_POSITIONS", 500)
    texts = lm.coded_texts(table, LIBRARY, PATTERN).cache()
    corpus = lm.blocks_of(texts, LIBRARY, lm.fold("doc_id", 7) != 2)
    training = table.filter(lm.fold("doc_id", 7) != 2)
    whole = lm.corpus_counts(training, LIBRARY, PATTERN, len(corpus.shares))
    blocks = corpus.blocks.toArrow().to_batches()
    seen = []
    for block in lm._blocks(iter(blocks), LIBRARY):
        some = lm.positions(block.texts)[:3]
        for without in (0, 1):
            got, want = (c.known(*some, without) for c in (block.counts(corpus.singles), whole))
            assert np.allclose(got[0], want[0], rtol=1e-5) and np.allclose(got[1], want[1])
        assert np.allclose(corpus.counts_of(*some).known(*some)[0], whole.known(*some)[0], rtol=1e-5)
        seen.append(len(block.texts))
    assert len(seen) > 2 and sum(seen) == len(rows)
    assert np.allclose(corpus.shares, whole.shares)

    def scores():
        return sorted((str(r["doc_id"]), round(r["score"], 3)) for r in lm.score_texts(table, LIBRARY, PATTERN, steps=3).collect())

    first = scores()
    monkeypatch.setattr(lm, "PAIRS", 2)
    monkeypatch.setattr(lm, "TRIPLES", 2)
    assert scores() == first


def test_words_are_spelt_from_their_ids():
    for text in [*ODD_TEXTS, LONG, "x<|endoftext|>y z", "\u3000 \u3000 a\x85 b", "x\u3000 \u3000y"]:
        words = lm.words_of(text)
        assert lm.spelt(lm.ids_of(words, LIBRARY, PATTERN), LIBRARY) == words, repr(text[:40])


def test_windows_score_as_whole_windows_do():
    """Only scored places ask; what they find equals the forward pass over whole windows."""
    from tidepanel.llm import attention

    rng = np.random.default_rng(17)
    model = attention.initial(40, 8, 6, 5, np.ones(40))
    lengths = np.array([1, 3, 8, 9, 30, 2, 17])
    inputs, targets = rng.integers(0, 6, (2, lengths.sum()))
    known = rng.random(len(inputs)).astype(np.float32) / 40
    evidence = rng.random((len(inputs), attention.EVIDENCE)).astype(np.float32)
    for stride in (3, 4, 8):
        got = attention.token_scores(model, inputs, targets, known, evidence, lengths, stride, batch=4)
        starts, first = attention.cut_windows(lengths, 8, stride)
        ends = np.cumsum(lengths)
        scored = np.zeros(len(inputs), int)
        for start, place in zip(starts, first):
            end = min(start + 8, ends[np.searchsorted(ends, start, side="right")])
            own = slice(start, end)
            padded = np.append(inputs[own], np.zeros(8 - (end - start), int))[None]
            *_, w, gathered = model.forward(padded)
            weights, total = model.gates(inputs[own], gathered[0, : end - start], evidence[own])
            for at in range(place, end - start):
                p = start + at
                pointed = sum(w[0, at, j] * (targets[start + j] == targets[p]) for j in range(at)) + w[0, at, at] * known[p]
                parts = np.append(model.outputs[targets[p]], [known[p], pointed])
                assert np.isclose(got[p], (weights[at] * parts).sum() / total[at], rtol=1e-4)
                scored[p] += 1
        assert (scored == 1).all()


def test_lookups_find_all_keys_and_no_others():
    from tidepanel.llm.counts import Lookup

    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 1000):
        keys = rng.choice(10**12, n, replace=False)
        asked = np.append(keys, rng.integers(10**12, 2 * 10**12, 500))
        assert Lookup(keys).find(asked).tolist() == [*range(n), *[-1] * 500]


def test_samples_choose_rows_and_are_bounded(spark):
    """One id or none for all rows; then copies of one row."""
    for key in ("null", "7"):
        rows = spark.range(5000).selectExpr(f"cast({key} as long) as doc_id", "concat('text ', id) as text")
        got = samples.some_texts(rows, F.lit(True), 200).count()
        assert 120 <= got <= 200
    same = spark.range(5000).selectExpr("cast(null as long) as doc_id", "'same' as text")
    for salt in range(4):
        assert samples.some_texts(same.withColumn("text", F.lit(f"same {salt}")), F.lit(True), 200).count() <= 200
    labels = spark.createDataFrame([(7, 1)], "doc_id long, quality int")
    hot = spark.range(5000).selectExpr("cast(7 as long) as doc_id", "concat('text ', id) as text")
    assert 120 <= samples.labelled_texts(hot, labels, "quality", F.lit(True), 200).count() <= 200


def test_pieces_cover_texts_and_are_bounded(spark):
    rows = [(1, "abcdefghij" * 10), (2, "short"), (None, None), (3, ""), (4, "x" * 64), (4, "x" * 64)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = samples.some_pieces(table, 10**9, 32).collect()
    assert sorted((r["text"], r["first"], r["last"]) for r in got) == sorted(
        (t[a : a + 32], a == 0, a + 32 >= len(t))
        for t in ((t or "") for _, t in rows) for a in range(0, max(1, len(t)), 32)
    )
    many = spark.range(1000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("word " * 1000), "id").alias("text"))
    some = samples.some_pieces(many, 100_000, 100).collect()
    assert 600 < len(some) <= 2001 and not all(r["first"] for r in some)


def test_memos_are_bounded_by_bytes():
    from tidepanel.llm import pretokens

    made = Counter()

    def make(piece):
        made[piece] += 1
        return b"1234" * len(piece)

    encoder = MemoEncoder(make, re.compile(r"\S+|\s+").findall, 1 << 16, 1 << 16)
    for i in range(10_000):
        encoder.encode("w " + f"{i:x}" * (100_000 // 16 // len(f"{i:x}")) + f" é{i}")
    for memo in (encoder._pretokens, encoder._words):
        for part in (memo, memo.older):
            assert sum(len(k.encode()) + len(v) + pretokens.ENTRY_BYTES for k, v in part.items()) <= (1 << 16) + 1000
            assert all(len(k) <= pretokens.LONGEST_KEPT for k in part)


def test_memos_of_token_files_leave_room_beside_the_heap(monkeypatch):
    from tidepanel.llm import queries

    asked = {}
    monkeypatch.setattr(queries, "table", lambda *_: None)
    monkeypatch.setattr(queries, "scratch_path", lambda *_: "")
    monkeypatch.setattr(token_files, "write_token_files", lambda *_, **options: asked.update(options))
    monkeypatch.setattr(token_files, "read_token_digests", lambda *_: None)
    queries.op2_token_files(None, "")
    # Two workers an executor, each with two generations of words and of pre-tokens (a quarter).
    assert 2 * 2.5 * asked["memo_bytes"] <= 600 << 20


def test_simple8b_words_are_the_densest():
    values = np.concatenate([np.zeros(300), np.arange(1, 5000), np.full(130, 1 << 20), [1 << 40], np.ones(70)]).astype(np.uint64)
    words, offsets, escaped = simple8b.encode(values)
    at, found = 0, []
    while at < len(values):
        end = min(len(values), (at // simple8b.BLOCK + 1) * simple8b.BLOCK)
        fits = [
            s for s in range(simple8b.ESCAPE)
            if all(int(v).bit_length() <= simple8b.WIDTHS[s] for v in values[at : min(end, at + simple8b.COUNTS[s])])
        ]
        s = fits[0] if fits and int(values[at]).bit_length() <= 30 else simple8b.ESCAPE
        found.append(s)
        at = min(end, at + int(simple8b.COUNTS[s]))
    assert (words >> np.uint64(60)).tolist() == found and escaped.tolist() == [1 << 40]


def test_scored_positions_see_half_a_window():
    import inspect

    from tidepanel.llm import attention

    defaults = {n: p.default for n, p in inspect.signature(lm.fit_lm).parameters.items()}
    _, first = attention.cut_windows(np.array([1000]), defaults["window"], defaults["stride"])
    assert len(first) > 1 and first[1:].min() >= defaults["window"] // 2 >= 16
