"""Linear models per group, fitted from second moments.

The cross products of features and targets are summed per task and group,
merged map-side, and solved for many groups at once. No group is ever
gathered: a cluster holding a third of all rows costs what its share of tasks
costs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from tidepanel.session import materialize

FLUSH_GROUPS = 64
#: Column and number of the shares that a group's rows are dealt into before they meet their model.
SHARE, SHARES = "_share", 16
#: Rows from which a group of known size is dealt into shares.
SHARE_ROWS = 100_000
#: Features and targets up to which products are summed by expressions, and features up to which a prediction is one sum.
WIDE = 12
#: Numbers of the moments that are solved at once.
SOLVED_AT_ONCE = 1 << 20


def join_by_share(
    rows: DataFrame, models: DataFrame, keys: list[str], shares: int = SHARES, sizes: DataFrame | None = None
) -> DataFrame:
    """`rows` with their group's model, dealt by keys and share, which stays as a column.

    Each model is repeated once per share and rows go to a share by a hash of
    themselves, so the rows of one group are spread over `shares` tasks. With
    `sizes` (keys, n) only groups of more than `SHARE_ROWS` rows are dealt, others have one
    share; the dealt ones are at most a `SHARE_ROWS`th as many as there are rows.
    """
    values = [F.col(c) for c in rows.columns]
    several = F.lit(shares)
    if sizes is not None:
        large = F.broadcast(sizes.filter(F.col("n") > SHARE_ROWS).select(*keys, F.lit(shares).alias("_shares")))
        rows, models = rows.join(large, keys, "left"), models.join(large, keys, "left")
        several = F.coalesce("_shares", F.lit(1))
    dealt = rows.withColumn(SHARE, F.pmod(F.xxhash64(*values), several).cast("int"))
    spread = models.withColumn(SHARE, F.explode(F.sequence(F.lit(0), several - 1)))
    return dealt.drop("_shares").join(spread.drop("_shares"), [*keys, SHARE])


def group_moments(
    df: DataFrame, keys: list[str], features: list[str], targets: list[str]
) -> DataFrame:
    """(keys..., moments): flattened Z'Z of Z = [1, features, targets] per group.

    Up to `WIDE` columns each product is a sum of one aggregate, combined before
    the shuffle. For more, rows are sorted by group inside their partition (no shuffle),
    so a task emits each of its groups about once and keeps at most FLUSH_GROUPS
    partial matrices. A null counts as not a number.
    """
    numeric = features + targets
    if len(numeric) <= WIDE:
        return _summed_products(df, keys, numeric)
    narrow = df.select(
        *keys, *[F.col(c).cast("double").alias(c) for c in numeric]
    ).sortWithinPartitions(*keys)
    key_fields = [f for f in narrow.schema.fields if f.name in keys]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in key_fields)
    key_names, limit = [f.name for f in key_fields], FLUSH_GROUPS

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = {}

        def flush():
            frame = pd.DataFrame(list(held.keys()), columns=key_names)
            frame["moments"] = [m.ravel() for m in held.values()]
            held.clear()
            return frame

        for batch in batches:
            for key, part in batch.groupby(key_names, sort=False, dropna=False):
                z = np.column_stack([np.ones(len(part)), part[numeric].to_numpy(float)])
                m = z.T @ z
                held[key] = held[key] + m if key in held else m
                if len(held) >= limit:
                    yield flush()
        if held:
            yield flush()

    parts = narrow.mapInPandas(partial, f"{ddl}, moments array<double>")
    return sum_moments(parts, keys)


def _summed_products(df: DataFrame, keys: list[str], numeric: list[str]) -> DataFrame:
    z = [F.lit(1.0), *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in numeric]]
    size = range(len(z))
    sums = df.groupBy(*keys).agg(*[F.sum(z[i] * z[j]).alias(f"_m{i}_{j}") for i in size for j in size if i <= j])
    return _squared(sums, keys, len(numeric))


def sum_moments(moments: DataFrame, keys: list[str], columns: int | None = None) -> DataFrame:
    """(keys..., moments) added up; `columns` is their number of features and targets, if it is known."""
    if columns is None or columns > WIDE:
        return moments.groupBy(*keys).agg(
            vector_to_array(Summarizer.sum(array_to_vector("moments"))).alias("moments")
        )
    size = range(1 + columns)
    numbers = {(i, j): F.col("moments")[i * (1 + columns) + j] for i in size for j in size if i <= j}
    sums = moments.groupBy(*keys).agg(*[F.sum(c).alias(f"_m{i}_{j}") for (i, j), c in numbers.items()])
    return _squared(sums, keys, columns)


def _squared(sums: DataFrame, keys: list[str], columns: int) -> DataFrame:
    size = range(1 + columns)
    flat = F.array(*[F.col(f"_m{min(i, j)}_{max(i, j)}") for i in size for j in size])
    return sums.select(*keys, flat.alias("moments"))


def solve_ridge(moments: Column, n_features: int, n_targets: int, alphas: list[float]) -> Column:
    """array<array<array<double>>>: per alpha and target [intercept, coefficients...].

    The penalty acts on standardised features; alpha 0 is least squares, by
    pseudo-inverse so collinear features are harmless.
    """
    p, h, grid = n_features, n_targets, [float(a) for a in alphas]

    def some(m: np.ndarray) -> list:
        n = m[:, :1, 0]
        mx, my = m[:, 0, 1 : 1 + p] / n, m[:, 0, 1 + p :] / n
        sxx = m[:, 1 : 1 + p, 1 : 1 + p] - n[..., None] * mx[:, :, None] * mx[:, None, :]
        sxy = m[:, 1 : 1 + p, 1 + p :] - n[..., None] * mx[:, :, None] * my[:, None, :]
        spread = np.sqrt(np.clip(np.einsum("gii->gi", sxx), 0, None) / n)
        # A spread lost in rounding noise marks a constant column.
        varies = spread > 1e-9 * np.maximum(1.0, np.abs(mx))
        s = np.where(varies, spread, 1.0)
        a = np.where(varies[:, :, None] & varies[:, None, :], sxx / (s[:, :, None] * s[:, None, :]), 0.0)
        b = np.where(varies[:, :, None], sxy / s[:, :, None], 0.0)
        out = np.empty((len(m), len(grid), h, 1 + p))
        for k, alpha in enumerate(grid):
            w = np.linalg.pinv(a + alpha * np.eye(p), rcond=1e-12, hermitian=True) @ b / s[:, :, None]
            out[:, k, :, 0] = my - np.einsum("gi,gij->gj", mx, w)
            out[:, k, :, 1:] = w.transpose(0, 2, 1)
        return out.tolist()

    @F.pandas_udf("array<array<array<double>>>")
    def solve(column: pd.Series) -> pd.Series:
        return solved_together(column, 1 + p + h, some)

    return solve(moments)


def solved_together(column: pd.Series, size: int, solve: Callable[[np.ndarray], list]) -> pd.Series:
    """One list per row from `solve`, which takes the square matrices of as many rows as fit."""
    step = max(1, SOLVED_AT_ONCE // size**2)
    out = []
    for at in range(0, len(column), step):
        some = np.array([np.asarray(flat, float) for flat in column.iloc[at : at + step]])
        with np.errstate(invalid="ignore"):
            out.extend(solve(some.reshape(-1, size, size)))
    return pd.Series(out, dtype=object)


def linear_prediction(features: list[str], coefficients: Column) -> Column:
    """Dot product of [1, features] with one coefficient array."""
    if len(features) <= WIDE:
        total = coefficients[0]
        for k, c in enumerate(features, 1):
            total = total + F.col(c).cast("double") * coefficients[k]
        return total
    x = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in features])
    return F.aggregate(
        F.zip_with(x, coefficients, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v
    )


def fit_group_ridge(
    train: DataFrame, group: str, features: list[str], targets: list[str], alpha: float = 1.0
) -> DataFrame:
    """(group, n, coefficients): one multi-output linear model per group, as rows."""
    moments = group_moments(train, [group], features, targets)
    solved = solve_ridge(F.col("moments"), len(features), len(targets), [alpha])
    return moments.select(
        group,
        F.element_at("moments", 1).cast("bigint").alias("n"),
        F.element_at(solved, 1).alias("coefficients"),
    )


def predict_group_linear(
    df: DataFrame, models: DataFrame, group: str, features: list[str], horizon: int
) -> DataFrame:
    """pred_j1..pred_jH of rows whose group has a model.

    Rows meet it by group and share, so that no task has a whole group.
    """
    joined = join_by_share(df, models.select(group, "coefficients"), [group]).drop(SHARE)
    return joined.withColumns(
        {
            f"pred_j{h}": linear_prediction(features, F.col("coefficients")[h - 1])
            for h in range(1, horizon + 1)
        }
    ).drop("coefficients")


def earlier_blocks(per_block: DataFrame, group: str, n_splits: int) -> DataFrame:
    """Moments per block, once for each later block, whose split trains on them."""
    return per_block.filter(F.col("block") < n_splits).select(
        group,
        F.explode(F.sequence(F.col("block") + 1, F.lit(n_splits))).alias("block"),
        "moments",
    )


def block_sizes(per_block: DataFrame, group: str) -> DataFrame:
    """(group, block, n): rows of each block, from its moments."""
    return per_block.select(group, "block", F.element_at("moments", 1).alias("n"))


def mean_error(features: list[str], targets: list[str], coefficients: Column) -> Column:
    """Mean over the targets of a row's absolute error under one choice's coefficients."""
    parts = [
        F.abs(F.col(t) - linear_prediction(features, coefficients[j])) for j, t in enumerate(targets)
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total / F.lit(float(len(targets)))


def ridge_search(
    blocks: DataFrame,
    group: str,
    features: list[str],
    targets: list[str],
    alphas: list[float],
    n_splits: int,
) -> DataFrame:
    """(group, name, value, score): the penalty with the lowest mean validation error.

    `blocks` are training rows with a `block` from splits.ts_cv_blocks: split k
    trains on blocks before k and validates on block k. Moments are summed per
    (group, block) once and reused by every split and penalty.
    """
    per_block = materialize(group_moments(blocks, [group, "block"], features, targets), "moments")
    later = earlier_blocks(per_block, group, n_splits)
    solved = solve_ridge(F.col("moments"), len(features), len(targets), alphas)
    fitted = sum_moments(later, [group, "block"], len(features) + len(targets)).select(group, "block", solved.alias("grid"))
    rows = join_by_share(
        blocks.filter(F.col("block") > 0).select(group, "block", *features, *targets), fitted, [group, "block"],
        sizes=block_sizes(per_block, group),
    )
    shared = rows.groupBy(group, "block", SHARE).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(mean_error(features, targets, F.col("grid")[a])).alias(f"_s{a}") for a in range(len(alphas))],
    )
    fold_scores = shared.groupBy(group, "block").agg(
        *[(F.sum(f"_s{a}") / F.sum("n")).alias(f"_s{a}") for a in range(len(alphas))]
    )
    mean = fold_scores.groupBy(group).agg(*[F.avg(f"_s{a}").alias(f"_s{a}") for a in range(len(alphas))])
    listed = F.array_sort(
        F.array(
            *[
                F.struct(F.col(f"_s{a}").alias("score"), F.lit(float(x)).alias("value"))
                for a, x in enumerate(alphas)
            ]
        )
    )
    winner = F.element_at(listed, 1)
    return mean.select(
        group, F.lit("alpha").alias("name"), winner["value"].alias("value"), winner["score"].alias("score")
    )


def linear_regression(
    df: DataFrame,
    key: Column,
    features: list[str],
    target: str,
    test_size: float = 0.2,
    folds: int = 5,
) -> DataFrame:
    """One row: cross-validated and held-out errors of one ordinary linear model.

    Rows fall into test and folds by a digest of their (text) key, so the split is the
    same in every run and needs no shuffle. All folds share one pass: the
    training moments of a fold are the sum of the other folds' moments.
    """
    digest = F.md5(key)

    def bucket(start: int, n: int) -> Column:
        return F.pmod(F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint"), F.lit(n))

    is_test = bucket(1, 10_000) < int(test_size * 10_000)
    fold = F.when(~is_test, bucket(9, folds).cast("int"))
    rows = df.select(
        *features, target, F.coalesce(fold, F.lit(-1)).alias("fold")
    )
    per_fold = group_moments(rows.filter(F.col("fold") >= 0), ["fold"], features, [target])
    others = F.array(*[F.lit(k) for k in range(-1, folds)])
    # Model -1 is trained on every fold and is the final one.
    spread = per_fold.select(F.explode(others).alias("model"), "fold", "moments").filter(
        F.col("model") != F.col("fold")
    )
    solved = solve_ridge(F.col("moments"), len(features), 1, [0.0])
    models = sum_moments(spread, ["model"], len(features) + 1).select(
        F.col("model").alias("fold"), solved[0][0].alias("coefficients")
    )
    # folds + 1 coefficient rows: bounded by the call.
    scored = rows.join(F.broadcast(models), "fold").select(
        "fold",
        F.col(target).cast("double").alias("y"),
        linear_prediction(features, F.col("coefficients")).alias("p"),
    )
    y, p = F.col("y"), F.col("p")
    per = scored.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.avg("y").alias("mean"),
        F.sum((y - p) * (y - p)).alias("sse"),
        F.var_pop("y").alias("var"),
    )
    test, cv = F.col("fold") == -1, F.col("fold") >= 0

    def of_test(c):
        return F.max(F.when(test, c))

    return per.agg(
        F.avg(F.when(cv, F.col("mae"))).alias("mae_cv"),
        F.stddev_pop(F.when(cv, F.col("mae"))).alias("mae_cv_std"),
        of_test(F.col("n")).alias("n_test"),
        of_test(F.col("mae")).alias("mae"),
        of_test(
            1.0 - F.col("sse") / F.nullif(F.col("var") * F.col("n"), F.lit(0.0))
        ).alias("r2"),
        of_test(F.col("mae") / F.nullif(F.col("mean"), F.lit(0.0)) * 100).alias("mae_pct"),
    )
