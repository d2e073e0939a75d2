"""Time splits without leakage. Day tables are bounded by the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidepanel.session import materialize

#: Rows up to which a group may be ordered by one task.
LARGE_GROUP = 100_000

def day_index(df: DataFrame, day: str = "JOUR") -> DataFrame:
    """(day, idx, n): dense 0-based index of the distinct days, and their number.

    The window is global, over distinct days only.
    """
    days = df.select(day).distinct().withColumn("_all", F.lit(1))
    ordered = Window.partitionBy("_all").orderBy(day)
    return days.select(
        day,
        (F.row_number().over(ordered) - 1).cast("int").alias("idx"),
        F.count(F.lit(1)).over(Window.partitionBy("_all")).cast("int").alias("n"),
    )


def cut_index(n: Column, test_size: float) -> Column:
    """First test position among n ordered days: n * (1 - test_size), truncated."""
    return (n * F.lit(1.0 - test_size)).cast("int")


def day_cutoff(df: DataFrame, test_size: float = 0.2, day: str = "JOUR") -> DataFrame:
    """One row: the first test day, over all distinct days of the frame."""
    days = day_index(df, day)
    return days.filter(F.col("idx") == cut_index(F.col("n"), test_size)).select(
        F.col(day).alias("cutoff")
    )


def group_day_cutoffs(
    df: DataFrame, group: str, test_size: float = 0.2, day: str = "JOUR"
) -> DataFrame:
    """(group, cutoff): first test day over each group's own distinct days."""
    days = df.select(group, day).distinct()
    ordered = Window.partitionBy(group).orderBy(day)
    ranked = days.withColumns(
        {
            "idx": F.row_number().over(ordered) - 1,
            "n": F.count(F.lit(1)).over(Window.partitionBy(group)),
        }
    )
    return ranked.filter(F.col("idx") == cut_index(F.col("n"), test_size)).select(
        group, F.col(day).alias("cutoff")
    )


def large_groups(df: DataFrame, group: str, most: int = LARGE_GROUP) -> DataFrame:
    """(group): those of more than `most` rows, so at most a `most`th as many as there are rows."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return materialize(sizes.filter((F.col("n") > most) & F.col(group).isNotNull()).select(group), "large-groups")


def _by_size(df: DataFrame, group: str, large: DataFrame, one_task, spread) -> DataFrame:
    """`one_task` of the rows of small groups and `spread` of those of `large` ones; rows without group are left out."""
    df = df.filter(F.col(group).isNotNull())
    if large.isEmpty():
        return one_task(df)
    known = F.broadcast(large)
    small = one_task(df.join(known, group, "left_anti"))
    return small.unionByName(spread(df.join(known, group, "left_semi")))


def with_group_cutoff(
    df: DataFrame, group: str, test_size: float = 0.2, day: str = "JOUR", large: DataFrame | None = None
) -> DataFrame:
    """Rows with the `cutoff` of their group, see `group_day_cutoffs`.

    With `large` (see `large_groups`) the days of any other group are counted where its rows are ordered.
    """
    def spread(rows: DataFrame) -> DataFrame:
        return rows.join(group_day_cutoffs(rows, group, test_size, day), group)

    def one_task(rows: DataFrame) -> DataFrame:
        ordered = Window.partitionBy(group).orderBy(day)
        whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ranked = rows.withColumn("_i", F.dense_rank().over(ordered) - 1).withColumn("_n", F.max("_i").over(whole) + 1)
        cut = F.col("_i") == cut_index(F.col("_n"), test_size)
        return ranked.withColumn("cutoff", F.max(F.when(cut, F.col(day))).over(whole)).drop("_i", "_n")

    return spread(df) if large is None else _by_size(df, group, large, one_task, spread)


def holdout(df: DataFrame, cutoff, day: str = "JOUR") -> tuple[DataFrame, DataFrame]:
    """(train, test) rows before, and from, the cutoff day."""
    bound = F.lit(cutoff).cast("date")
    return df.filter(F.col(day) < bound), df.filter(F.col(day) >= bound)


def sliding_folds(
    df: DataFrame, fold_length: int, fold_stride: int, day: str = "JOUR"
) -> DataFrame:
    """(fold, day, pos): fixed-length folds every `fold_stride` days.

    Every day lists the folds that contain it, so no join is needed. A fold
    past the end does not exist; with fewer than `fold_length` days there is none.
    """
    idx, n = F.col("idx"), F.col("n")
    first = F.greatest(
        F.lit(0), F.ceil((idx - F.lit(fold_length - 1)) / F.lit(fold_stride)).cast("int")
    )
    last = F.least(
        F.floor(idx / F.lit(fold_stride)).cast("int"),
        F.floor((n - F.lit(fold_length)) / F.lit(fold_stride)).cast("int"),
    )
    folds = F.when(first <= last, F.sequence(first, last))
    return (
        day_index(df, day)
        .select(day, "idx", F.explode(folds).alias("fold"))
        .select("fold", day, (F.col("idx") - F.col("fold") * fold_stride).alias("pos"))
    )


def train_test_context(
    fold: DataFrame,
    fold_length: Column,
    ratio: float,
    input_length: int,
    pos: str = "pos",
) -> DataFrame:
    """Rows of a fold with their `role`; the last `input_length` train days also
    open the test part, as the context of its first sequence.

    The train part ends at the half-even rounding of ratio * length. A context
    longer than the train part starts at the fold's first day.
    """
    last_train = F.bround(F.lit(ratio) * fold_length).cast("int")
    in_train = F.col(pos) < last_train
    in_test = F.col(pos) >= F.greatest(F.lit(0), last_train - input_length)
    roles = F.array_compact(
        F.array(F.when(in_train, F.lit("train")), F.when(in_test, F.lit("test")))
    )
    return fold.withColumn("role", F.explode(roles))


def prefix_columns(df: DataFrame, prefix: str = "_") -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns})


def walk_forward_folds(
    df: DataFrame,
    test_cutoff,
    n_folds: int = 3,
    min_train_frac: float = 0.5,
    day: str = "JOUR",
) -> DataFrame:
    """(fold, val_first, val_last, level_cutoff) over the distinct days before the test.

    The first `min_train_frac` of the days only trains; the rest is cut into
    equal contiguous validation blocks. Fold k trains on all days before its
    block. `level_cutoff` is the first validation day of all folds.
    """
    pre = df.filter(F.col(day) < F.lit(test_cutoff).cast("date"))
    days = day_index(pre, day)
    n = F.col("n")
    start = (n * F.lit(float(min_train_frac))).cast("int")
    step = (n - start) / F.lit(float(n_folds))

    def bound(k: int) -> Column:
        return n if k == n_folds else (F.lit(float(k)) * step + start).cast("int")

    edges = F.array(
        *[
            F.struct(
                F.lit(k + 1).alias("fold"), bound(k).alias("lo"), (bound(k + 1) - 1).alias("hi")
            )
            for k in range(n_folds)
        ]
    )
    marks = days.select(day, "idx", F.inline(edges)).filter(
        (F.col("idx") == F.col("lo")) | (F.col("idx") == F.col("hi"))
    )
    blocks = marks.groupBy("fold").agg(
        F.min(day).alias("val_first"), F.max(day).alias("val_last")
    )
    whole = Window.partitionBy(F.lit(1))
    return blocks.withColumn("level_cutoff", F.min("val_first").over(whole))


def assign_folds(df: DataFrame, folds: DataFrame, day: str = "JOUR") -> DataFrame:
    """(day, fold, role) of every distinct day that trains or validates in a fold."""
    listed = folds.agg(
        F.sort_array(F.collect_list(F.struct("fold", "val_first", "val_last"))).alias("folds")
    )
    per_day = df.select(day).distinct().withColumn("folds", listed.scalar())
    role = F.when(F.col(day) < F.col("val_first"), "train").when(
        F.col(day) <= F.col("val_last"), "validation"
    )
    return (
        per_day.select(day, F.inline("folds"))
        .select(day, "fold", role.alias("role"))
        .filter(F.col("role").isNotNull())
    )


def spread_key(column: str) -> Column:
    """Two hex digits of a digest: 256 even shares of any key column."""
    return F.substring(F.md5(F.col(column).cast("string")), 1, 2)


def ordered_index(
    df: DataFrame, group: str, day: str, tie: str, name: str = "idx", large: DataFrame | None = None
) -> DataFrame:
    """0-based position of each row in its group's day order, and the group's `n`.

    Rows of one day are ordered by (share, tie), where the share is a digest of
    the tie. Rows are counted per (group, day, share) and the counts turned
    into offsets; numbering then happens inside a share, so neither a group nor
    a day with a third of all rows lands in one task. With `large` (see `large_groups`) any
    other group is numbered by one task, in the same order.
    """
    def spread(rows: DataFrame) -> DataFrame:
        shared = rows.withColumn("_s", spread_key(tie))
        per_share = shared.groupBy(group, day, "_s").agg(F.count(F.lit(1)).alias("_c"))
        upto = Window.partitionBy(group).orderBy(day, "_s")
        offsets = per_share.select(
            group,
            day,
            "_s",
            (F.sum("_c").over(upto) - F.col("_c")).alias("_before"),
            F.sum("_c").over(Window.partitionBy(group)).alias("n"),
        )
        within = F.row_number().over(Window.partitionBy(group, day, "_s").orderBy(tie))
        return (
            shared.withColumn("_k", within)
            .join(offsets, [group, day, "_s"])
            .withColumn(name, F.col("_before") + F.col("_k") - 1)
            .drop("_before", "_k", "_s")
        )

    def one_task(rows: DataFrame) -> DataFrame:
        # Rows of one day have one share if the day itself is the tie.
        order = [day] if tie == day else [day, spread_key(tie), tie]
        ordered = Window.partitionBy(group).orderBy(*order)
        whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        numbered = rows.withColumns({
            "n": F.count(F.lit(1)).over(whole), name: F.row_number().over(ordered).cast("bigint") - 1
        })
        return numbered.filter(F.col(day).isNotNull() & F.col(tie).isNotNull())

    return spread(df) if large is None else _by_size(df, group, large, one_task, spread)


def ts_cv_blocks(indexed: DataFrame, n_splits: int, idx: str = "idx", n: str = "n") -> DataFrame:
    """`block` of each indexed row: 0 trains in every split, block k is split k's test.

    Test blocks have n // (n_splits + 1) rows and end at the last row; split k
    trains on all blocks before k.
    """
    size = F.floor(F.col(n) / F.lit(n_splits + 1))
    first_test = F.col(n) - size * n_splits
    block = F.when(F.col(idx) < first_test, F.lit(0)).otherwise(
        F.floor((F.col(idx) - first_test) / F.when(size > 0, size).otherwise(1)) + 1
    )
    return indexed.withColumn("block", block.cast("int"))


def seeded_order(entity: str, seed: int) -> Column:
    """Reproducible pseudo-random order key of an id."""
    return F.md5(F.concat_ws("-", F.col(entity).cast("string"), F.lit(str(seed))))


def stratified_sample(
    clusters: DataFrame,
    n_per_cluster: int = 10,
    seed: int = 42,
    entity: str = "ID_LIEU",
    cluster: str = "cluster",
) -> DataFrame:
    """Exactly `n_per_cluster` seeded ids of every cluster (all ids of a smaller one).

    The rank filter is pushed below the shuffle, so each task forwards at most
    `n_per_cluster` ids of a cluster.
    """
    order = Window.partitionBy(cluster).orderBy(seeded_order(entity, seed), F.col(entity))
    return (
        clusters.filter(F.col(cluster).isNotNull())
        .select(entity, cluster)
        .withColumn("_r", F.row_number().over(order))
        .filter(F.col("_r") <= n_per_cluster)
        .drop("_r")
    )


def cluster_sizes(clusters: DataFrame, entity="ID_LIEU", cluster="cluster") -> DataFrame:
    """Size, smallest and largest id of every cluster."""
    return clusters.groupBy(cluster).agg(
        F.count(entity).alias("size"), F.min(entity).alias("min_id"), F.max(entity).alias("max_id")
    )


