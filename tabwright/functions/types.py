"""Schema-driven column selection and output shaping."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def get_numerical_features(df: DataFrame) -> list[str]:
    """Names of numeric columns (booleans are not numeric)."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def get_categorical_features(df: DataFrame) -> list[str]:
    """Names of string columns."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def columns_matching(df: DataFrame, *, contains: Sequence[str] = (), prefix: str = "", pattern: str | None = None) -> list[str]:
    """Names that hold every substring, start with the prefix and match the pattern."""
    rx = re.compile(pattern) if pattern else None
    return [
        c for c in df.columns
        if c.startswith(prefix) and all(s in c for s in contains) and (rx is None or rx.search(c))
    ]


def split_features_target(df: DataFrame, target: str) -> tuple[list[str], str]:
    """Feature names and the label name. The table stays in one piece."""
    if target not in df.columns:
        raise ValueError(f"target column '{target}' not found")
    return [c for c in df.columns if c != target], target


def dtype_name(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {', '.join(absent)}")


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Rewrite some columns in one projection, keeping the column order; new names go last."""
    kept = [new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns]
    added = [expr.alias(name) for name, expr in new.items() if name not in df.columns]
    return df.select(*kept, *added)


def rounded(column: Column, digits: int = 6) -> Column:
    """Rounded double with negative zero folded into zero."""
    return F.round(column.cast("double"), digits) + F.lit(0.0)


def metric_name(feature: str, metric: str) -> str:
    return f"{feature}·{metric}"


def tall(wide: DataFrame, features: Sequence[str], metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, feature) from an aggregate that computed every feature at once.

    ``wide`` holds a column ``metric_name(feature, metric)`` per pair, so a report over many
    columns costs one scan and one aggregate.
    """
    records = F.array(*[
        F.struct(
            F.lit(feature).alias("feature"),
            *[F.col(f"`{metric_name(feature, m)}`").alias(m) for m in metrics],
        )
        for feature in features
    ])
    return wide.select(*by, F.inline(records))
