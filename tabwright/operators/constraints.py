"""Range and integer constraints on numeric columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabwright.functions.types import replace_columns, require_columns

REQUIRED = ("min", "max", "integer")


def _rule(constraints: Mapping[str, Mapping], column: str) -> Mapping:
    if column not in constraints:
        raise ValueError(f"no constraints defined for column '{column}'")
    lacking = [k for k in REQUIRED if k not in constraints[column]]
    if lacking:
        raise ValueError(f"missing constraints for column '{column}': {', '.join(lacking)}")
    return constraints[column]


def _below(column: Column, rule: Mapping) -> Column:
    return F.lit(False) if rule["min"] is None else column < F.lit(rule["min"])


def _above(column: Column, rule: Mapping) -> Column:
    return F.lit(False) if rule["max"] is None else column > F.lit(rule["max"])


def whole_number(column: Column) -> Column:
    """Long; a fractional value fails the query (a plain cast would cut it off silently)."""
    return F.when(column.isNull() | (column == F.floor(column)), column.cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit("not a whole number: "), column.cast("string"))).cast("bigint")
    )


def set_constraints_for_numeric_features(df: DataFrame, numeric_columns: str | Sequence[str],
                                         constraints: Mapping[str, Mapping]) -> DataFrame:
    """Out-of-range values become NULL; integer columns become longs. All columns in one projection."""
    names = [numeric_columns] if isinstance(numeric_columns, str) else list(numeric_columns)
    require_columns(df, names)
    new = {}
    for name in names:
        rule = _rule(constraints, name)
        column = F.col(name)
        kept = F.when(~(_below(column, rule) | _above(column, rule)), column)
        new[name] = whole_number(kept) if rule["integer"] else kept
    return replace_columns(df, new)


def constraint_violations(df: DataFrame, numeric_columns: Sequence[str], constraints: Mapping[str, Mapping]) -> DataFrame:
    """Values below the minimum and above the maximum, per column, from one aggregate."""
    rules = {c: _rule(constraints, c) for c in numeric_columns}
    counted = df.agg(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(_below(F.col(c), r)).alias("below_min"),
            F.count_if(_above(F.col(c), r)).alias("above_max"),
        ).alias(c)
        for c, r in rules.items()
    ])
    return counted.select(F.inline(F.array(*[F.col(f"`{c}`") for c in rules])))
