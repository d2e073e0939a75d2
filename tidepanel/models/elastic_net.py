"""Elastic nets per group, searched over several parameters without another pass per choice.

Every fit works on second moments (see `linear.group_moments`): rows are read once
to sum them per group and block of days, folds and the refit are sums of those sums,
and coordinate descent runs on the correlations. Along falling penalties each
fit starts from the one before.

With standardised features z and targets the objective is
mean((y - z w)^2) / 2 + penalty * (ratio * |w|_1 + (1 - ratio) / 2 * |w|^2), so penalties
mean the same for small and large groups; ratio 0 is ridge, solved directly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidepanel.models import linear
from tidepanel.session import materialize

SWEEPS, STILL = 1000, 1e-10


def net_grid(penalties, ratios) -> list[tuple[float, float]]:
    """(penalty, ratio) of all choices; penalties fall inside each ratio, as the path takes them."""
    return [(float(p), float(r)) for r in ratios for p in sorted(penalties, reverse=True)]


def descend(c: np.ndarray, b: np.ndarray, penalty: float, ratio: float, start: np.ndarray) -> np.ndarray:
    """Coefficients (group x feature x target) of standardised features with correlations `c` and `b`.

    Each group stops by itself when a sweep hardly moves it.
    """
    p = c.shape[1]
    if ratio == 0:
        # A feature without spread has a row of zeros and no coefficient.
        return np.linalg.pinv(c + penalty * np.eye(p), rcond=1e-12, hermitian=True) @ b
    w = start.copy()
    live = np.arange(len(c))
    for _ in range(SWEEPS):
        own, now = c[live], w[live]
        moved = np.zeros(len(live))
        for j in range(p):
            scale = own[:, j, j]
            used = scale != 0
            pull = b[live, j] - np.einsum("gi,git->gt", own[:, j], now) + scale[:, None] * now[:, j]
            size = np.where(used, scale + penalty * (1 - ratio), 1.0)[:, None]
            new = np.sign(pull) * np.maximum(np.abs(pull) - penalty * ratio, 0) / size
            new = np.where(used[:, None], new, now[:, j])
            moved = np.fmax(moved, np.abs(new - now[:, j]).max(axis=1, initial=0.0))
            now[:, j] = new
        w[live] = now
        live = live[moved >= STILL]
        if not len(live):
            break
    return w


def net_paths(m: np.ndarray, n_features: int, n_targets: int, grid: list[tuple[float, float]]) -> list:
    """Per group, choice and target [intercept, coefficients...], in the units of the data."""
    p, h = n_features, n_targets
    n = m[:, :1, 0]
    mean = m[:, 0, 1:] / n
    cov = m[:, 1:, 1:] / n[..., None] - mean[:, :, None] * mean[:, None, :]
    spread = np.sqrt(np.clip(np.einsum("gii->gi", cov), 0, None))
    varies = spread > 1e-9 * np.maximum(1.0, np.abs(mean))
    s = np.where(varies, spread, 1.0)
    corr = cov / (s[:, :, None] * s[:, None, :]) * (varies[:, :, None] & varies[:, None, :])
    c, b = corr[:, :p, :p], corr[:, :p, p:]
    out = np.empty((len(m), len(grid), h, 1 + p))
    w, last = np.zeros((len(m), p, h)), None
    for k, (penalty, ratio) in enumerate(grid):
        if ratio != last:
            w, last = np.zeros((len(m), p, h)), ratio
        w = descend(c, b, penalty, ratio, w)
        slope = w * s[:, None, p:] / s[:, :p, None]
        out[:, k, :, 0] = mean[:, p:] - np.einsum("gi,git->gt", mean[:, :p], slope)
        out[:, k, :, 1:] = slope.transpose(0, 2, 1)
    return out.tolist()


def net_path(moments: np.ndarray, n_features: int, n_targets: int, grid: list[tuple[float, float]]) -> list:
    """`net_paths` of one group."""
    size = 1 + n_features + n_targets
    return net_paths(np.asarray(moments, float).reshape(1, size, size), n_features, n_targets, grid)[0]


def solve_net(moments: Column, n_features: int, n_targets: int, grid: list[tuple[float, float]]) -> Column:
    """array<array<array<double>>>: per choice and target [intercept, coefficients...]."""

    @F.pandas_udf("array<array<array<double>>>")
    def solve(column: pd.Series) -> pd.Series:
        size = 1 + n_features + n_targets
        return linear.solved_together(column, size, lambda m: net_paths(m, n_features, n_targets, grid))

    return solve(moments)


def net_search(
    blocks: DataFrame, group: str, features: list[str], targets: list[str], grid: list[tuple[float, float]],
    n_splits: int, shares: int = linear.SHARES,
) -> tuple[DataFrame, DataFrame]:
    """(choices, models) of the best choice per group by time-ordered cross-validation.

    `blocks` are training rows with a `block` from splits.ts_cv_blocks. Choices
    have the group, penalty, l1_ratio, score (mean over the splits of the mean
    absolute error over all targets) and the scores by split; of scores that are
    equal to nine places the first in the grid wins. Models are refitted on all blocks. Groups with
    an empty split have no choice and no model.
    """
    p, h = len(features), len(targets)
    per_block = materialize(linear.group_moments(blocks, [group, "block"], features, targets), "moments")
    fitted = linear.sum_moments(linear.earlier_blocks(per_block, group, n_splits), [group, "block"], p + h)
    fitted = fitted.select(group, "block", solve_net(F.col("moments"), p, h, grid).alias("grid"))
    rows = linear.join_by_share(
        blocks.filter(F.col("block") > 0).select(group, "block", *features, *targets), fitted, [group, "block"], shares,
        linear.block_sizes(per_block, group),
    )
    sums = [
        F.sum(linear.mean_error(features, targets, F.col("grid")[g])).alias(f"_s{g}") for g in range(len(grid))
    ]
    shared = rows.groupBy(group, "block", linear.SHARE).agg(F.count(F.lit(1)).alias("n"), *sums)
    folds = shared.groupBy(group, "block").agg(
        F.array(*[F.sum(f"_s{g}") / F.sum("n") for g in range(len(grid))]).alias("errors")
    )
    per_group = folds.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("block", "errors"))).alias("folds"))
    per_group = per_group.filter(F.size("folds") == n_splits)

    def mean_of_folds(choice: int) -> Column:
        return F.aggregate("folds", F.lit(0.0), lambda total, fold: total + fold["errors"][choice]) / n_splits

    scores = [
        F.struct(F.round(mean_of_folds(g), 9).alias("score"), F.lit(g).alias("choice")) for g in range(len(grid))
    ]
    scored = per_group.select(group, "folds", F.array_min(F.array(*scores)).alias("best"))
    pairs = F.array(*[F.struct(F.lit(x).alias("penalty"), F.lit(r).alias("l1_ratio")) for x, r in grid])
    chosen = scored.select(
        group, pairs[F.col("best.choice")].alias("of"), F.col("best.choice").alias("choice"),
        F.col("best.score").alias("score"),
        F.transform("folds", lambda f: f["errors"][F.col("best.choice")]).alias("fold_scores"),
    )
    whole = linear.sum_moments(per_block.drop("block"), [group], p + h)
    models = whole.join(chosen.select(group, "choice"), group).select(
        group, F.element_at("moments", 1).cast("bigint").alias("n"),
        solve_net(F.col("moments"), p, h, grid)[F.col("choice")].alias("coefficients"),
    )
    return chosen.select(group, "of.penalty", "of.l1_ratio", "score", "fold_scores"), models
