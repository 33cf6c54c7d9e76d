"""Pearson correlations between features and with the target."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from tabwright.functions.state import local_frame, settle
from tabwright.functions.types import get_numerical_features

# tasks get the code of this module with them, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Columns whose pairs are counted in one scan; their sums are five square arrays of doubles.
COLUMNS_AT_ONCE = 1000
# Tasks that add up partial sums before the driver adds up theirs.
MERGES = 16


def _batch_sums(left: list[pa.Array], right: list[pa.Array] | None) -> np.ndarray:
    """Pairwise sums of a batch: rows where both are known, both means, and the centred squares and product.

    Columns are shifted by one of their own values near their mean, so constant columns stay exactly constant.
    """
    def shifted(columns: list[pa.Array]):
        values = np.column_stack([c.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) for c in columns])
        known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])
        finite = np.isfinite(values)
        odd = known & ~finite  # NaN and infinite values spoil their pairs
        values = np.where(finite, values, 0.0)
        mean = values.sum(axis=0) / np.maximum(finite.sum(axis=0), 1)
        away = np.where(finite, np.abs(values - mean), np.inf)
        centre = values[away.argmin(axis=0), np.arange(values.shape[1])]
        return np.where(finite, values - centre, 0.0), finite.astype(float), odd, centre

    x, in_x, odd_x, centre_x = shifted(left)
    y, in_y, odd_y, centre_y = (x, in_x, odd_x, centre_x) if right is None else shifted(right)
    n = in_x.T @ in_y
    some = np.maximum(n, 1)
    mean_x, mean_y = (x.T @ in_y) / some, (in_x.T @ y) / some
    out = np.stack([
        n, np.where(n > 0, mean_x + centre_x[:, None], 0.0), np.where(n > 0, mean_y + centre_y[None, :], 0.0),
        (x * x).T @ in_y - n * mean_x ** 2, in_x.T @ (y * y) - n * mean_y ** 2, x.T @ y - n * mean_x * mean_y])
    if odd_x.any() or odd_y.any():
        spoiled = odd_x.astype(float).T @ (in_y + odd_y) + in_x.T @ odd_y.astype(float)
        out[5] += np.where(spoiled > 0, np.nan, 0.0)
        out[0] += spoiled
    return out


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sums of two sets of rows together."""
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1)
    dx, dy = (np.where((a[0] > 0) & (b[0] > 0), b[k] - a[k], 0.0) for k in (1, 2))
    weight = a[0] * share
    mean = [np.where(a[0] > 0, a[k] + d * share, b[k]) for k, d in ((1, dx), (2, dy))]
    return np.stack([n, *mean, a[3] + b[3] + dx * dx * weight, a[4] + b[4] + dy * dy * weight, a[5] + b[5] + dx * dy * weight])


def _pair_sums(df: DataFrame, left: list[str], right: list[str] | None) -> np.ndarray:
    """Sums of all pairs of ``left`` and ``right`` (None: the same columns) from one scan."""
    shape = (6, len(left), len(right or left))
    wide = df.select([F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate([*left, *(right or [])])])

    def row(sums: np.ndarray, slot: int) -> dict:
        return {"slot": pa.array([slot], pa.int32()), "sums": pa.array([sums.tobytes()], pa.large_binary())}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = _batch_sums(batch.columns[:len(left)], batch.columns[len(left):] if right else None)
                total = part if total is None else _added(total, part)
        if total is not None:
            yield pa.RecordBatch.from_pydict(row(total, TaskContext.get().partitionId() % MERGES))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for sums in batch.column("sums"):
                part = np.frombuffer(sums.as_buffer()).reshape(shape)
                total = part if total is None else _added(total, part)
        if total is not None:
            yield pa.RecordBatch.from_pydict(row(total, 0))

    parts = wide.mapInArrow(count, "slot int, sums binary").repartition(MERGES, "slot").mapInArrow(merge, "slot int, sums binary")
    total = np.zeros(shape)
    for sums in parts.toArrow()["sums"]:
        total = _added(total, np.frombuffer(sums.as_buffer()).reshape(shape))
    return total


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None, columns_at_once: int = COLUMNS_AT_ONCE) -> DataFrame:
    """a, b, r for every pair of columns (a before b), each over the rows where both are known.

    One scan: every task keeps sums of products as square arrays, tasks add them up, and so does the driver, which
    holds a result of that size anyway. More than ``columns_at_once`` columns are taken in blocks, one scan for
    each pair of blocks. NULL where fewer than two rows know both columns or one is constant; NaN where values are not finite.
    """
    names = list(columns or get_numerical_features(df))
    if len(names) < 2:
        raise ValueError("at least two numeric columns are needed")
    r = np.full((len(names), len(names)), np.nan)
    known = np.zeros(r.shape, bool)
    starts = range(0, len(names), columns_at_once)
    for i in starts:
        for j in starts:
            if j < i:
                continue
            own, other = slice(i, i + columns_at_once), slice(j, j + columns_at_once)
            n, _, _, xx, yy, xy = _pair_sums(df, names[own], None if i == j else names[other])
            spread = np.sqrt(np.maximum(xx, 0)) * np.sqrt(np.maximum(yy, 0))
            known[own, other] = (n >= 2) & ((spread > 0) | np.isnan(xy))
            r[own, other] = np.where(spread > 0, xy / np.where(spread > 0, spread, 1.0), np.nan)
    first, second = np.triu_indices(len(names), 1)
    return local_frame(df.sparkSession, pa.table({
        "pair_no": pa.array(np.arange(len(first), dtype=np.int32)), "a": pa.array(names, pa.string()).take(pa.array(first)),
        "b": pa.array(names, pa.string()).take(pa.array(second)), "r": pa.array(r[first, second], mask=~known[first, second])}))


def target_correlation(pairs: DataFrame, target: str) -> DataFrame:
    """feature, r: the pairs that involve the target."""
    return pairs.where((F.col("a") == target) | (F.col("b") == target)).select(
        F.when(F.col("a") == target, F.col("b")).otherwise(F.col("a")).alias("feature"), "r"
    )


def strength(r: Column) -> Column:
    """Name of the correlation band; a band holds its outer end."""
    size = F.abs(r)
    sign = F.when(r > 0, F.lit("positive")).otherwise(F.lit("negative"))
    level = F.when(size > 0.5, F.lit("strong ")).when(size > 0.3, F.lit("moderate ")).when(size > 0.1, F.lit("weak "))
    return F.when(r.isNotNull(), F.coalesce(F.concat(level, sign), F.lit("none")))


def target_correlation_buckets(pairs: DataFrame, target: str) -> DataFrame:
    return target_correlation(pairs, target).withColumn("bucket", strength(F.col("r")))


def multicollinear_pairs(pairs: DataFrame, target: str, threshold: float = 0.7) -> DataFrame:
    """Feature pairs that say nearly the same, with the one to keep (closer to the target; ties: first)."""
    with_target = target_correlation(pairs, target).select("feature", F.abs("r").alias("t"))
    high = pairs.where(
        (F.col("a") != target) & (F.col("b") != target) & (F.abs("r") > F.lit(float(threshold)))
    )
    first = with_target.select(F.col("feature").alias("a"), F.col("t").alias("target_corr_a"))
    second = with_target.select(F.col("feature").alias("b"), F.col("t").alias("target_corr_b"))
    keep_first = F.col("target_corr_a") >= F.col("target_corr_b")
    return high.join(first, "a").join(second, "b").select(
        "a", "b", "r", "target_corr_a", "target_corr_b",
        F.when(keep_first, F.col("a")).otherwise(F.col("b")).alias("keep"),
        F.when(keep_first, F.col("b")).otherwise(F.col("a")).alias("drop"),
    ).orderBy(F.abs("r").desc(), "a", "b")


def both_ways(pairs: DataFrame) -> DataFrame:
    flipped = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    return pairs.select("a", "b", "r").unionByName(flipped)


def isolated_features(pairs: DataFrame, target: str, threshold: float = 0.3) -> DataFrame:
    """Features that correlate with no other feature, with advice from their target correlation."""
    others = both_ways(pairs.where((F.col("a") != target) & (F.col("b") != target)))
    widest = others.groupBy(F.col("a").alias("feature")).agg(F.max(F.abs("r")).alias("max_corr"))
    return widest.where(F.col("max_corr") < F.lit(float(threshold))).join(
        target_correlation(pairs, target).withColumnRenamed("r", "target_corr"), "feature"
    ).withColumn("advice", F.when(F.abs("target_corr") < 0.3, F.lit("investigate or drop")).otherwise(F.lit("keep")))


def select_by_correlation(pairs: DataFrame, target: str, threshold: float = 0.05) -> DataFrame:
    return target_correlation(pairs, target).where(F.abs("r") > F.lit(float(threshold)))


def merge_by_ward(distance: np.ndarray, cut: float) -> list[int]:
    """Cluster number per item: closest clusters join first, until their Ward distance exceeds ``cut``."""
    d2 = distance.astype(float) ** 2
    np.fill_diagonal(d2, np.inf)
    members = [[i] for i in range(len(d2))]
    alive = list(range(len(d2)))
    while len(alive) > 1:
        block = d2[np.ix_(alive, alive)]
        i, j = divmod(int(block.argmin()), len(alive))
        if np.sqrt(block[i, j]) > cut:
            break
        u, v = sorted((alive[i], alive[j]))
        nu, nv = len(members[u]), len(members[v])
        for w in alive:
            if w not in (u, v):
                nw = len(members[w])
                d2[u, w] = d2[w, u] = (
                    (nu + nw) * d2[u, w] + (nv + nw) * d2[v, w] - nw * d2[u, v]
                ) / (nu + nv + nw)
        members[u] += members[v]
        alive.remove(v)
    number = [0] * len(d2)
    for place, u in enumerate(sorted(alive, key=lambda a: min(members[a])), start=1):
        for item in members[u]:
            number[item] = place
    return number


def feature_clusters(pairs: DataFrame, target: str, cut: float = 0.5) -> DataFrame:
    """feature, cluster: features grouped by Ward linkage on 1 - |r|.

    Only the matrix of feature correlations, as large as the number of columns squared, is brought here.
    """
    rows = settle(pairs.select("pair_no", "a", "b", "r")).collect()
    names: list[str] = []
    for row in sorted(rows, key=lambda r: r["pair_no"]):
        names += [n for n in (row["a"], row["b"]) if n not in names and n != target]
    place = {n: i for i, n in enumerate(names)}
    distance = np.ones((len(names), len(names)))
    for row in rows:
        if row["a"] in place and row["b"] in place and row["r"] is not None:
            i, j = place[row["a"]], place[row["b"]]
            distance[i, j] = distance[j, i] = 1 - abs(row["r"])
    clusters = merge_by_ward(distance, cut) if names else []
    return local_frame(pairs.sparkSession, pa.table({
        "feature": pa.array(names, pa.string()), "cluster": pa.array(clusters, pa.int32()),
    }))


def cluster_summary(pairs: DataFrame, target: str, cut: float = 0.5) -> DataFrame:
    """Per cluster of several features: size, mean |target r|, best feature, and whether to keep only that."""
    with_target = target_correlation(pairs, target)
    joined = feature_clusters(pairs, target, cut).join(with_target, "feature")
    return joined.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n_features"), F.avg(F.abs("r")).alias("avg_target_corr"),
        F.max_by("feature", F.struct(F.abs("r"), F.col("feature"))).alias("best_feature"),
    ).where(F.col("n_features") > 1).withColumn("keep_only_best", F.col("n_features") > 3)
