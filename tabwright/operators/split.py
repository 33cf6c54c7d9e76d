"""Reproducible splits: stratified, by entity, and into folds.

Membership follows the seeded hash order of row keys. Only the rows at which a quota ends are
searched for; every row then tells its own side by comparing its hash with those cut points,
so the table itself is never sorted or shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabwright.functions.state import local_frame, small_rows
from tabwright.operators.ranking import cut_key, quota_cuts

TRAIN, VALIDATION, TEST = "train", "validation", "test"


def share_out(total: int, sizes: Sequence[int]) -> list[int]:
    """Divide ``total`` over groups in proportion to their sizes; leftovers go to the largest
    remainders, the earlier group first on a tie."""
    whole = sum(sizes)
    if whole == 0:
        return [0] * len(sizes)
    base = [total * s // whole for s in sizes]
    by_remainder = sorted(range(len(sizes)), key=lambda i: (-(total * sizes[i] % whole), i))
    for i in by_remainder[: total - sum(base)]:
        base[i] += 1
    return base


def part_size(n: int, fraction: float) -> int:
    return math.ceil(round(n * fraction, 9))


def class_counts(df: DataFrame, label_col: str) -> list[tuple]:
    rows = small_rows(df.groupBy(label_col).count(), f"classes of {label_col}")
    rows.sort(key=lambda r: (r[label_col] is None, r[label_col]))
    return [(r[label_col], r["count"]) for r in rows]


def _assign(df: DataFrame, label_col: str | None, id_cols: Sequence[str], seed, cuts: list[tuple], names: Sequence,
            otherwise, output: str, n_rows: int) -> DataFrame:
    """``cuts`` holds (class, name index, cumulative quota); a row takes the first name it falls under."""
    spark = df.sparkSession
    table = pa.table({
        "class_value": pa.array([c[0] for c in cuts]),
        "name": pa.array([str(c[1]) for c in cuts], pa.string()),
        "quota": pa.array([c[2] for c in cuts], pa.int64()),
    })
    if all(c[0] is None for c in cuts):
        table = table.set_column(0, "class_value", pa.array([None] * len(cuts), pa.string()))
    ends = quota_cuts(df, id_cols, seed, local_frame(spark, table), label_col, n_rows)
    key = cut_key(id_cols, seed)
    wide = ends.groupBy("class_value").agg(*[
        F.first(F.when(F.col("name") == str(i), F.col("cut")), ignorenulls=True).alias(f"_cut{i}")
        for i in range(len(names))
    ])
    joined = df.join(wide, F.col(label_col).eqNullSafe(F.col("class_value")), "left")
    side = F.when(key <= F.col("_cut0"), F.lit(names[0]))
    for i in range(1, len(names)):
        side = side.when(key <= F.col(f"_cut{i}"), F.lit(names[i]))
    return joined.withColumn(output, side.otherwise(F.lit(otherwise))).select(*df.columns, output)


def stratified_split(df: DataFrame, label_col: str, id_col: str, test_size: float = 0.2,
                     val_size: float | None = 0.2, seed: int = 42, output: str = "split") -> DataFrame:
    """Adds train / validation / test (or train / test when ``val_size`` is None), stratified.

    The test part holds ``ceil(test_size * n)`` rows and validation ``ceil(val_size * rest)``.
    """
    counts = class_counts(df, label_col)
    sizes = [n for _, n in counts]
    test = share_out(part_size(sum(sizes), test_size), sizes)
    names, cuts = [TEST], [(c, 0, t) for (c, _), t in zip(counts, test)]
    if val_size is not None:
        left = [n - t for n, t in zip(sizes, test)]
        val = share_out(part_size(sum(left), val_size), left)
        names.append(VALIDATION)
        cuts += [(c, 1, t + v) for (c, _), t, v in zip(counts, test, val)]
    return _assign(df, label_col, [id_col], seed, cuts, names, TRAIN, output, sum(sizes))


def stratified_folds(df: DataFrame, label_col: str, id_col: str, k: int = 5, seed: int = 42,
                     output: str = "fold") -> DataFrame:
    """Adds a fold number 0..k-1; within each class fold sizes differ by at most one."""
    counts = class_counts(df, label_col)
    cuts = [(c, f, -(-(f + 1) * n // k)) for c, n in counts for f in range(k - 1)]
    return _assign(df, label_col, [id_col], seed, cuts, list(range(k - 1)), k - 1, output,
                   sum(n for _, n in counts))


def group_split(df: DataFrame, group_col: str, test_size: float = 0.2, val_size: float = 0.2, seed: int = 42,
                output: str = "split", drop_group: bool = True) -> DataFrame:
    """Adds a split in which all rows of one entity are on the same side; the entity column is dropped."""
    keys = df.select(group_col).distinct()
    n = keys.count()
    test = part_size(n, test_size)
    val = part_size(n - test, val_size)
    quotas = local_frame(df.sparkSession, pa.table({
        "class_value": pa.array([0, 0], pa.int32()),
        "name": pa.array([TEST, VALIDATION]),
        "quota": pa.array([test, test + val], pa.int64()),
    }))
    ends = quota_cuts(keys, [group_col], seed, quotas, n_rows=n)
    key = cut_key([group_col], seed)
    end_of = lambda name: ends.where(F.col("name") == name).select("cut").scalar()
    side = F.when(key <= end_of(TEST), F.lit(TEST)).when(key <= end_of(VALIDATION), F.lit(VALIDATION))
    out = df.withColumn(output, side.otherwise(F.lit(TRAIN)))
    return out.drop(group_col) if drop_group else out
