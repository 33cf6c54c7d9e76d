"""Text predicates and parsers as Spark expressions (no Python per row)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# The shape of a plain decimal number, the list separator and the duration text.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
LIST_SEPARATOR = r"\s*(?:,|and)\s*"
DURATION_PATTERN = r"([0-9]+)\s*years?\s*and\s*([0-9]+)\s*months?"


def looks_numeric(column: Column) -> Column:
    return column.cast("string").rlike(NUMBER_PATTERN)


def number_or_null(column: Column) -> Column:
    """Double, or NULL where the text is not a plain number (``1d``, ``0x1`` and ``NaN`` are not)."""
    return F.when(looks_numeric(column), F.trim(column.cast("string")).try_cast("double"))


def number_or_error(column: Column) -> Column:
    """Double; a non-null value that is not a plain number fails the query."""
    text = column.cast("string")
    return (
        F.when(column.isNull(), F.lit(None).cast("double"))
        .when(looks_numeric(column), F.trim(text).try_cast("double"))
        .otherwise(F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double"))
    )


def literal_alternation(tokens: Iterable[str]) -> str:
    """Pattern matching any of the tokens as they stand."""
    return "|".join(re.escape(t) for t in tokens)


def matches_from_start(column: Column, pattern: str) -> Column:
    """Anchored at the first character only, as a prefix match."""
    return column.cast("string").rlike(f"^(?:{pattern})")


def spaced_before(column: Column, word: str) -> Column:
    return F.regexp_replace(column, F.lit(rf"(\w+)({re.escape(word)})"), F.lit("$1 $2"))


def duration_years(column: Column, pattern: str = DURATION_PATTERN) -> Column:
    """Decimal years from a pattern with two groups (years, months); NULL without a match."""
    rx = f"(?i){pattern}"
    years = F.regexp_extract(column, rx, 1).try_cast("int")
    months = F.regexp_extract(column, rx, 2).try_cast("int")
    return F.when(column.rlike(rx), years.cast("double") + months.cast("double") / F.lit(12.0))


def list_items(column: Column, separator: str = LIST_SEPARATOR) -> Column:
    """Distinct non-blank members of a list written as text."""
    parts = F.transform(F.split(column, separator), lambda part: F.trim(part))
    return F.array_distinct(F.filter(parts, lambda part: part != F.lit("")))
