"""From a dirty table to a curated one, as one lazy plan around a few fitted values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tabwright.functions.state import small_rows
from tabwright.functions.text import DURATION_PATTERN, LIST_SEPARATOR
from tabwright.operators import cleaning
from tabwright.operators.constraints import set_constraints_for_numeric_features
from tabwright.operators.impute import apply_and_evaluate_knn_imputation
from tabwright.operators.relational import sample_rows


@dataclass
class CurationSpec:
    """What to do with which column. Empty entries skip their step."""

    id_col: str
    drop: Sequence[str] = ()
    spaced_words: Mapping[str, str] = field(default_factory=dict)
    durations: Sequence[str] = ()
    duration_pattern: str = DURATION_PATTERN
    list_column: str | None = None
    list_fill: str = "Missing_Loan"
    list_separator: str = LIST_SEPARATOR
    list_feature: str = "Loan"
    dirty_numbers: Sequence[str] = ()
    constraints: Mapping[str, Mapping] = field(default_factory=dict)
    sample_size: int | None = None
    knn_columns: Sequence[str] = ()
    knn_neighbors: int = 3
    category_fills: Mapping[str, str] = field(default_factory=dict)
    label_col: str | None = None
    seed: int = 42


def curate(raw: DataFrame, spec: CurationSpec) -> tuple[DataFrame, DataFrame | None]:
    """The curated table, and the quality report of the neighbour imputation if there was one."""
    df = raw.drop(*spec.drop)
    for column, word in spec.spaced_words.items():
        df = cleaning.add_space_before_word(df, column, word)
    for column in spec.durations:
        df = cleaning.parse_time_period(df, column, pattern=spec.duration_pattern)
    if spec.list_column:
        df = cleaning.fill_missing_with_category(df, {spec.list_column: spec.list_fill})
        found = cleaning.get_unique_values_and_counts(df, spec.list_column, spec.list_separator)
        values = [r["value"] for r in small_rows(found, "list members")]
        df = cleaning.transform_to_binary_features(df, spec.list_column, values, spec.list_feature).drop(spec.list_column)
    if spec.dirty_numbers:
        df = cleaning.convert_non_numeric_strings_to_nan(df, spec.dirty_numbers)
        tokens = small_rows(cleaning.identify_problematic_characters(df, spec.dirty_numbers), "problem characters")
        df = cleaning.remove_characters(df, spec.dirty_numbers, {r["token"] for r in tokens})
        df = cleaning.convert_to_numeric(df, spec.dirty_numbers)
    if spec.constraints:
        df = set_constraints_for_numeric_features(df, [c for c in spec.constraints if c in df.columns], spec.constraints)
    if spec.sample_size:
        df = sample_rows(df, spec.sample_size, spec.id_col, spec.seed)
    report = None
    if spec.knn_columns:
        df, report = apply_and_evaluate_knn_imputation(
            df, spec.knn_columns, k=spec.knn_neighbors, id_col=spec.id_col, label_col=spec.label_col
        )
    if spec.category_fills:
        df = cleaning.fill_missing_with_category(df, spec.category_fills)
    return df, report


