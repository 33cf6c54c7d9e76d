"""Repair of malformed text columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabwright.functions import text
from tabwright.functions.types import replace_columns, require_columns


def convert_non_numeric_strings_to_nan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text without any digit becomes NULL; everything else is kept as text."""
    require_columns(df, columns)
    return replace_columns(df, {
        c: F.when(F.col(c).cast("string").rlike("[0-9]"), F.col(c).cast("string")) for c in columns
    })


def _cells(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """(column_name, value) per non-null cell: one scan for all columns."""
    present = [c for c in columns if c in df.columns]
    records = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in present
    ])
    return df.select(*keep, F.inline(records)).where(F.col("value").isNotNull())


def identify_problematic_characters(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct (column_name, token) that keep values from being numbers.

    A value without digits is a token as a whole; otherwise each character that is not a digit, a
    dot or a minus is one. Columns that are not in the table are skipped.
    """
    bad = _cells(df, columns).where(~F.col("value").rlike(text.NUMBER_PATTERN))
    tokens = F.when(
        F.col("value").rlike("[0-9]"),
        F.array_distinct(F.regexp_extract_all("value", F.lit(r"([^0-9.\-])"), F.lit(1))),
    ).otherwise(F.array("value"))
    return bad.select("column_name", F.explode(tokens).alias("token")).distinct()


def problem_value_report(df: DataFrame, columns: Sequence[str], tokens: Iterable[str], order_col: str,
                         n_samples: int = 3) -> DataFrame:
    """Per column: how many values hold a token, and the first few of them in ``order_col`` order."""
    listed = sorted(set(tokens), key=lambda t: (len(t), t))
    # a token that contains another one adds nothing to the test
    minimal = [t for i, t in enumerate(listed) if not any(s in t for s in listed[:i])]
    hits = _cells(df, columns, order_col)
    hits = hits.where(F.col("value").rlike(text.literal_alternation(minimal)) if minimal else F.lit(False))
    counts = hits.groupBy("column_name").agg(F.count(F.lit(1)).alias("problem_count"))
    first = Window.partitionBy("column_name").orderBy(order_col)
    # the rank filter is applied before the shuffle as well (group limit), so few rows move
    samples = hits.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= n_samples)
    samples = samples.groupBy("column_name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", "value"))), lambda s: s["value"]).alias("samples")
    )
    return counts.join(samples, "column_name")


def remove_characters(df: DataFrame, columns: Sequence[str], characters_to_remove: str | Iterable[str] = "_") -> DataFrame:
    """Take literal tokens out, one after the other. A plain string means each of its characters."""
    if isinstance(characters_to_remove, (set, frozenset)):
        tokens = sorted(characters_to_remove, key=lambda t: (-len(t), t))
    else:
        tokens = list(characters_to_remove)

    def stripped(column: Column) -> Column:
        for token in tokens:
            column = F.replace(column, F.lit(token), F.lit(""))
        return column

    present = [c for c in columns if c in df.columns]
    return replace_columns(df, {c: stripped(F.col(c).cast("string")) for c in present})


def convert_to_numeric(df: DataFrame, columns: Sequence[str], lenient: bool = False) -> DataFrame:
    """Double columns; a value that is not a number is an error, or NULL when lenient."""
    parse = text.number_or_null if lenient else text.number_or_error
    return replace_columns(df, {c: parse(F.col(c)) for c in columns if c in df.columns})


def clean_column_with_regex(df: DataFrame, column_name: str, pattern: str) -> DataFrame:
    """Values that do not match from their first character become NULL."""
    column = F.col(column_name)
    return replace_columns(df, {column_name: F.when(text.matches_from_start(column, pattern), column)})


def regex_clean_report(df: DataFrame, column_name: str, pattern: str, order_col: str, n_samples: int = 5) -> DataFrame:
    """How many values the pattern rejects, with the first few of them (one row)."""
    rejected = df.where(F.col(column_name).isNotNull() & ~text.matches_from_start(F.col(column_name), pattern))
    samples = rejected.orderBy(order_col).limit(n_samples).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(column_name).alias("v")))),
            lambda s: s["v"],
        ).alias("samples")
    )
    return rejected.agg(F.count(F.lit(1)).alias("replaced")).select(
        F.lit(column_name).alias("column_name"), "replaced", samples.scalar().alias("samples")
    )


def add_space_before_word(df: DataFrame, feature_column: str, separator_word: str) -> DataFrame:
    return replace_columns(df, {feature_column: text.spaced_before(F.col(feature_column), separator_word)})


def parse_time_period(df: DataFrame, column: str, output: str | None = None,
                      pattern: str = text.DURATION_PATTERN) -> DataFrame:
    return replace_columns(df, {output or column: text.duration_years(F.col(column), pattern)})


def get_unique_values_and_counts(df: DataFrame, column: str, split_pattern: str = text.LIST_SEPARATOR) -> DataFrame:
    """Rows per distinct list member, most frequent first (ties: smaller value)."""
    members = df.select(F.explode(text.list_items(F.col(column), split_pattern)).alias("value"))
    return members.groupBy("value").agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), "value")


def flag_name(value: str, prefix: str = "Has_") -> str:
    return prefix + re.sub(r"[ ,&-]+", "_", value)


def transform_to_binary_features(df: DataFrame, column: str, unique_values: Sequence[str],
                                 feature_name: str = "Loan", prefix: str = "Has_") -> DataFrame:
    """A 0/1 column per value (case-sensitive substring) and the count of all occurrences."""
    items = F.col(column)
    new: dict[str, Column] = {
        flag_name(v, prefix): F.coalesce(F.contains(items, F.lit(v)), F.lit(False)).cast("int") for v in unique_values
    }
    new[f"{feature_name}_Count"] = F.regexp_count(items, F.lit(text.literal_alternation(unique_values)))
    return replace_columns(df, new)


def binary_feature_rows(df: DataFrame, column: str, unique_values: Sequence[str], keep: Sequence[str],
                        prefix: str = "Has_") -> DataFrame:
    """The same flags as rows (``keep``, flag, value), for values too many or too alike (in case) to be column names."""
    cells = F.array(*[
        F.struct(F.lit(flag_name(v, prefix)).alias("flag"), F.coalesce(F.contains(column, F.lit(v)), F.lit(False)).cast("int").alias("value"))
        for v in unique_values
    ])
    return df.select(*keep, F.inline(cells))


def binary_feature_totals(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows carrying each flag."""
    totals = df.agg(*[F.sum(F.col(f"`{c}`").cast("bigint")).alias(c) for c in flags])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("flag"), F.col(f"`{c}`").alias("total")) for c in flags
    ])))


def fill_missing_with_category(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Constant fill per column."""
    return df.fillna(dict(values))
