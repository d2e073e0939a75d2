"""Toxicity classifier that is held to equal scores for swapped identity terms.

A logistic classifier over the words and word beginnings that occur in a text.
Beside the log loss of labelled texts, it pays for each change of score when an
identity term of a labelled text is swapped for another one of its group, with all
features that the swap changes, so a mention of a group by itself moves no score.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidepanel.llm.common import fold, ship_package, sigmoid, text_or_empty
from tidepanel.llm.samples import labelled_texts
from tidepanel.session import materialize

# Groups of identity terms; a term may be swapped within its group.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "homosexual", "queer"),
    ("immigrants", "refugees", "migrants", "natives", "foreigners", "citizens"),
    ("disabled", "blind", "deaf", "old", "young", "elderly"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas"),
)

WORD = re.compile(r"[^\W\d_]+")
#: Beginnings of words that are features beside the whole word.
PREFIXES = (4, 5, 6)


def word_features(word: str) -> list[str]:
    """The word itself and its longer beginnings, marked by a hyphen."""
    return [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) > n)]


def text_features(text: str) -> set[str]:
    return {f for w in set(WORD.findall(text.lower())) for f in word_features(w)}


def swapped_features(words: set[str], term: str, other: str) -> tuple[set[str], set[str]]:
    """The features that a text of these words loses and gains when `other` replaces `term`."""
    before = {f for w in words for f in word_features(w)}
    after = {f for w in (words - {term}) | {other} for f in word_features(w)}
    return before - after, after - before


@dataclass
class Classifier:
    weights: dict[str, float]
    bias: float
    _known: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False, compare=False)

    def score(self, text: str) -> float:
        known, weights = self._known, self.weights
        if len(known) > 400_000:
            known.clear()
        hits: set[str] = set()
        for word in set(WORD.findall(text.lower())):
            found = known.get(word)
            if found is None:
                found = known[word] = tuple(f for f in word_features(word) if f in weights)
            if found:
                hits.update(found)
        return float(sigmoid(np.float64(self.bias + sum(weights[f] for f in sorted(hits)))))


def _laid_out(features: list) -> tuple[np.ndarray, np.ndarray]:
    """The features of all swaps end to end, and the swap of each."""
    each = [np.atleast_1d(np.asarray(f, np.int64)) for f in features]
    return np.concatenate([np.zeros(0, np.int64), *each]), np.repeat(np.arange(len(each)), [len(f) for f in each])


def fit_counterfactual(
    rows: list[np.ndarray], labels: np.ndarray, width: int, swaps: list[tuple],
    penalty: float = 4.0, ridge: float = 2e-3, steps: int = 400, rate: float = 0.1,
) -> tuple[np.ndarray, float]:
    """Weights and bias of the features.

    `rows` holds the features present in each text; `swaps` the counterfactuals:
    row, features that go and features that come (each one number or several).
    Minimises the mean log loss, plus `penalty` times the mean squared change of
    score under the swaps, plus a ridge.
    """
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    row_of = np.repeat(np.arange(len(rows)), sizes)
    swap = np.array([s[0] for s in swaps], np.int64)
    gone, gone_of = _laid_out([s[1] for s in swaps])
    come, come_of = _laid_out([s[2] for s in swaps])
    weights = np.zeros(width)
    mean = min(max(labels.mean(), 1e-3), 1 - 1e-3) if len(labels) else 0.5
    bias = float(np.log(mean / (1 - mean)))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1 if len(rows) else 1):
        z = bias + np.bincount(row_of, weights=weights[flat], minlength=len(rows))
        s = sigmoid(z)
        on_row = (s - labels) / len(rows)
        slope = np.bincount(flat, weights=on_row[row_of], minlength=width) + ridge * weights
        slope_bias = on_row.sum()
        if len(swap):
            s0 = s[swap]
            lost = np.bincount(gone_of, weights=weights[gone], minlength=len(swap))
            s1 = sigmoid(z[swap] - lost + np.bincount(come_of, weights=weights[come], minlength=len(swap)))
            change = 2 * penalty * (s1 - s0) / len(swap)
            on0, on1 = -change * s0 * (1 - s0), change * s1 * (1 - s1)
            per_row = np.bincount(swap, weights=on0 + on1, minlength=len(rows))
            slope += np.bincount(flat, weights=per_row[row_of], minlength=width)
            slope -= np.bincount(gone, weights=on1[gone_of], minlength=width)
            slope += np.bincount(come, weights=on1[come_of], minlength=width)
            slope_bias += (on0 + on1).sum()
        g = np.append(slope, slope_bias)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, bias


def fit_toxicity(
    documents: DataFrame, labels: DataFrame, held_out_fold: tuple[int, int] = (4, 2), most_labelled: int = 16_000,
    most_features: int = 3000, least_texts: int = 4, identity_terms: Iterable[Iterable[str]] = IDENTITY_TERMS,
    id_col: str = "doc_id", text_col: str = "text",
) -> Classifier:
    """Fit on at most `most_labelled` labelled texts outside the held-out fold.

    The features are those of at least `least_texts` sampled texts whose
    presence says most about the label (G statistic), at most `most_features`,
    and all identity terms. Without labels of both kinds every score is the
    share of label 1.
    """
    ship_package(documents.sparkSession)
    modulus, remainder = held_out_fold
    sample = labelled_texts(
        documents, labels, "toxic", fold("doc_id", modulus) != remainder, most_labelled, id_col, text_col
    )

    @F.arrow_udf("array<string>")
    def present(texts: pa.Array) -> pa.Array:
        return pa.array((sorted(text_features(t.as_py())) for t in texts), pa.list_(pa.string()))

    seen = materialize(sample.select("label", present("text").alias("present")), "toxicity-sample")
    total = seen.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("k")).first()
    n, k = float(total["n"]), float(total["k"])
    terms = [tuple(dict.fromkeys(group)) for group in identity_terms]
    if not k or k == n:
        return Classifier({}, float(np.log((k + 0.5) / (n - k + 0.5))))

    counts = (
        seen.select("label", F.explode("present").alias("feature"))
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("with_it"), F.sum("label").alias("toxic"))
        .filter(F.col("with_it") >= least_texts)
    )

    def part(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    a, both = F.col("toxic").cast("double"), F.col("with_it").cast("double")
    g = (
        part(a, both * (k / n))
        + part(both - a, both * (1 - k / n))
        + part(F.lit(k) - a, (F.lit(n) - both) * (k / n))
        + part(F.lit(n - k) - (both - a), (F.lit(n) - both) * (1 - k / n))
    )
    best = counts.withColumn("g", g).filter("g > 5").orderBy(F.desc("g"), "feature").limit(most_features)
    names = [r["feature"] for r in best.select("feature").collect()]
    names = list(dict.fromkeys([*names, *(t for group in terms for t in group)]))
    place = {name: i for i, name in enumerate(names)}

    @F.arrow_udf("array<int>")
    def places(rows: pa.Array) -> pa.Array:
        return pa.array(([place[f] for f in r.as_py() if f in place] for r in rows), pa.list_(pa.int32()))

    # A term of several groups may be swapped within each of them.
    others = {t: sorted({o for group in terms if t in group for o in group} - {t}) for group in terms for t in group}
    pairs = pa.list_(pa.list_(pa.list_(pa.int32())))

    @F.arrow_udf("array<array<array<int>>>")
    def swapped(rows: pa.Array) -> pa.Array:
        out = []
        for r in rows:
            # Words are letters only, their beginnings end with a hyphen.
            words = {f for f in r.as_py() if not f.endswith("-")}
            changes = [swapped_features(words, t, o) for t in sorted(words & others.keys()) for o in others[t]]
            out.append([[sorted(place[f] for f in side if f in place) for side in change] for change in changes])
        return pa.array(out, pairs)

    got = seen.select("label", places("present").alias("at"), swapped("present").alias("swaps")).toArrow()
    rows = [np.array(r, np.int64) for r in got.column("at").to_pylist()]
    marks = got.column("label").to_numpy().astype(np.float64)
    swaps = [(i, gone, come) for i, row in enumerate(got.column("swaps").to_pylist()) for gone, come in row]
    weights, bias = fit_counterfactual(rows, marks, len(names), swaps)
    return Classifier(dict(zip(names, weights.tolist())), float(bias))


def with_toxicity(documents: DataFrame, model: Classifier, out: str, text_col: str = "text") -> DataFrame:
    """`documents` and a column with the score of the whole text; null is empty."""
    ship_package(documents.sparkSession)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    return documents.withColumn(out, score(text_or_empty(text_col)))


def score_toxicity(
    documents: DataFrame, labels: DataFrame, held_out_fold: tuple[int, int] = (4, 2), threshold: float = 0.3,
    id_col: str = "doc_id", text_col: str = "text", **options,
) -> DataFrame:
    """One row per document: its id, held_out, score, predicted.

    Null and empty texts have the score of a text without features. Null ids
    count as empty text in the fold and have no label. Repeated rows are kept,
    other columns ignored; an empty table gives an empty result.
    """
    model = fit_toxicity(documents, labels, held_out_fold, id_col=id_col, text_col=text_col, **options)
    rows = documents.select(F.col(id_col), F.col(text_col).alias("text"))
    modulus, remainder = held_out_fold
    return with_toxicity(rows, model, "score", "text").select(
        id_col, (fold(id_col, modulus) == remainder).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
