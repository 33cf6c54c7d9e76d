"""Projection, filtering and sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabwright.functions.state import local_frame
from tabwright.functions.types import replace_columns, require_columns
from tabwright.operators.ranking import cut_key, quota_cuts


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require_columns(df, columns)
    return df.drop(*columns)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def null_out(df: DataFrame, column: str, condition: Column) -> DataFrame:
    """NULL where the condition is true; a NULL condition leaves the value."""
    return replace_columns(df, {column: F.when(~F.coalesce(condition, F.lit(False)), F.col(column))})


def keep_top_categories(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """Rows whose category is among the k most frequent (ties: smaller value first)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).count()
    top = counts.orderBy(F.desc("count"), column).limit(k).select(column)
    return df.join(F.broadcast(top), column, "left_semi")  # at most k rows


def preview(df: DataFrame, order_cols: str | Sequence[str], n: int = 15) -> DataFrame:
    """The first n rows in a named order (a top-n, not a full sort)."""
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    return df.orderBy(*cols).limit(n)


def sample_rows(df: DataFrame, n: int, id_cols: str | Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly n rows (or all, if fewer), the same ones whatever the partitioning.

    The cut in hash order is found first, so the sample itself is a plain filter: no sort, and a
    sample of any size stays distributed.
    """
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    total = df.count()
    if n >= total:
        return df
    quotas = local_frame(df.sparkSession, pa.table({
        "class_value": pa.array([0], pa.int32()), "name": ["sample"], "quota": pa.array([n], pa.int64()),
    }))
    cuts = quota_cuts(df, ids, seed, quotas, n_rows=total).select("cut")
    return df.where(cut_key(ids, seed) <= cuts.scalar())
