"""Quality classifier from positive and unlabelled texts.

Method: non-negative PU learning. With the class prior p, the risk on
negatives is the risk of calling unlabelled text positive less p times that of
calling trusted positives so; where a batch brings this difference below zero,
the fit steps back instead of following it. The score is a logistic function of
features of the writing: how kinds of characters follow each other, word
lengths and repetition. Labels only choose the trusted positives and estimate
the prior.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidepanel.llm.common import fold, ship_package, sigmoid, text_or_empty
from tidepanel.llm.samples import labelled_texts, some_texts

# The kind of each byte.
KINDS = (
    (b" ", 0), (b"\t\n\v\f\r", 1), (bytes(range(0x61, 0x7B)), 2), (bytes(range(0x41, 0x5B)), 3),
    (b"0123456789", 4), (b".", 5), (b",;:", 6), (b"!?", 7), (b"|", 8), (b"*", 9), (b"%$&#@", 10),
    (b"'\"-", 11), (b"()[]{}<>/\\=+_~^`", 12), (bytes(range(0xC0, 0x100)), 13),
    (bytes(range(0x80, 0xC0)), 14),
)
N_KINDS = 16
KIND_OF = np.full(256, 15, np.uint8)
for _bytes, _kind in KINDS:
    KIND_OF[list(_bytes)] = _kind
#: Texts are read in pieces of so many bytes, to bound the memory of a task.
PIECE = 1 << 20
N_FEATURES = N_KINDS * N_KINDS + 3


def features(text: str) -> np.ndarray:
    """Square roots of the shares of pairs of kinds; then length, distinct words, mean word."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    out = np.zeros(N_FEATURES, np.float32)
    pairs = np.zeros(N_KINDS * N_KINDS, np.int64)
    for at in range(0, len(data), PIECE):
        kinds = KIND_OF[data[at : at + PIECE + 1]]
        pairs += np.bincount(kinds[:-1] * np.uint8(N_KINDS) + kinds[1:], minlength=len(pairs))
    out[: len(pairs)] = np.sqrt(pairs / max(1, pairs.sum()))
    words = text.split()
    out[-3] = np.log1p(len(data)) / 10
    out[-2] = len(set(words)) / max(1, len(words))
    out[-1] = np.log1p(len(data) / (len(words) + 1)) / 5
    return out


@dataclass(frozen=True)
class Classifier:
    centre: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid((rows - self.centre) @ self.weights + self.bias)


def fit_nnpu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 6000, rate: float = 0.05,
    batch: int = 512, ridge: float = 1e-5, seed: int = 7,
) -> Classifier:
    """Minimise the non-negative PU risk of a logistic classifier by Adam.

    Without positives or without unlabelled rows the classifier gives the prior.
    """
    width = positive.shape[1] if len(positive) else unlabelled.shape[1]
    rest = Classifier(np.zeros(width, np.float32), np.zeros(width, np.float32), float(np.log(prior / (1 - prior))))
    if not len(positive) or not len(unlabelled):
        return rest
    centre = unlabelled.mean(axis=0)
    positive, unlabelled = positive - centre, unlabelled - centre
    rng = np.random.default_rng(seed)
    theta = np.append(np.zeros(width), rest.bias)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    share = max(1, round(batch * len(positive) / (len(positive) + len(unlabelled))))
    p_order, u_order = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
    for step in range(1, steps + 1):
        p = positive[p_order[np.arange(step * share, (step + 1) * share) % len(positive)]]
        rest_of = max(1, batch - share)
        u = unlabelled[u_order[np.arange(step * rest_of, (step + 1) * rest_of) % len(unlabelled)]]
        sp, su = sigmoid(p @ theta[:-1] + theta[-1]), sigmoid(u @ theta[:-1] + theta[-1])
        # Logistic losses: -log s of a positive call, -log(1 - s) of a negative one.
        negative = -np.log1p(-su + 1e-9).mean() + prior * np.log1p(-sp + 1e-9).mean()
        gp = (prior * (sp - 1) / len(p), -prior * sp / len(p), su / len(u))
        if negative >= 0:
            on_p, on_u = gp[0] + gp[1], gp[2]
        else:
            on_p, on_u = -gp[1], -gp[2]
        slope = np.append(p.T @ on_p + u.T @ on_u + ridge * theta[:-1], on_p.sum() + on_u.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Classifier(centre.astype(np.float32), theta[:-1].astype(np.float32), float(theta[-1]))


def _collect_features(texts: DataFrame) -> np.ndarray:
    """Feature rows of a bounded sample on the driver."""
    ship_package(texts.sparkSession)

    @F.arrow_udf("binary")
    def of_text(column: pa.Array) -> pa.Array:
        return pa.array((features(t.as_py()).tobytes() for t in column), pa.binary())

    rows = texts.select(of_text("text").alias("x")).toArrow().column("x").to_pylist()
    return np.frombuffer(b"".join(rows), np.float32).reshape(-1, N_FEATURES)


def fit_quality(
    documents: DataFrame, labels: DataFrame, held_out_fold: tuple[int, int] = (3, 1), most_positive: int = 6000,
    most_unlabelled: int = 12000, id_col: str = "doc_id", text_col: str = "text",
) -> Classifier:
    """Fit on samples of at most `most_positive` trusted and about `most_unlabelled` other texts.

    Both leave out the ids of the held-out fold (modulus, remainder). The prior
    is the share of label 1 among the labelled ids outside that fold, with one
    row added to either side.
    """
    modulus, remainder = held_out_fold
    allowed = fold("doc_id", modulus) != remainder
    share = (
        labels.filter(allowed & F.col("quality").isin(0, 1))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("k"))
        .first()
    )
    prior = ((share["k"] or 0) + 1) / (share["n"] + 2)
    good = labels.filter(F.col("quality") == 1)
    positive = labelled_texts(documents, good, "quality", allowed, most_positive, id_col, text_col)
    others = some_texts(documents, fold(id_col, modulus) != remainder, most_unlabelled, id_col, text_col)
    return fit_nnpu(_collect_features(positive.select("text")), _collect_features(others), prior)


def with_quality(documents: DataFrame, model: Classifier, out: str, text_col: str = "text") -> DataFrame:
    """`documents` and a column with the score of the whole text; null is empty."""
    ship_package(documents.sparkSession)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.float64())
        rows = np.stack([features(t.as_py()) for t in texts])
        return pa.array(model.score(rows).astype(np.float64))

    return documents.withColumn(out, score(text_or_empty(text_col)))


def score_quality(
    documents: DataFrame, labels: DataFrame, held_out_fold: tuple[int, int] = (3, 1),
    id_col: str = "doc_id", text_col: str = "text", **bounds: int,
) -> DataFrame:
    """One row per document: its id, held_out, score, predicted.

    Null and empty texts are scored like any other. Null ids count as empty
    text in the fold and have no label. Without usable labels every score is
    0.5. Repeated rows are kept, other columns ignored; an empty table gives an empty
    result.
    """
    model = fit_quality(documents, labels, held_out_fold, id_col=id_col, text_col=text_col, **bounds)
    rows = documents.select(F.col(id_col), F.col(text_col).alias("text"))
    modulus, remainder = held_out_fold
    return with_quality(rows, model, "score", "text").select(
        id_col, (fold(id_col, modulus) == remainder).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
