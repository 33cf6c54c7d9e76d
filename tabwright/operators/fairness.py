"""Bias checks on predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabwright.operators.evaluate import score_table
from tabwright.operators.profile import cross_tab


def prediction_distribution(df: DataFrame, sensitive: str, prediction: str, classes: Sequence | None = None) -> DataFrame:
    """How predicted classes spread within each group of a sensitive column."""
    return cross_tab(df, sensitive, prediction, classes)


def class_purity(df: DataFrame, columns: Sequence[str], label_col: str) -> DataFrame:
    """Per column: how far a category value decides the class.

    Purity is the share of rows whose class is the majority class of their category; 1 means the
    column gives the class away.
    """
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"), F.col(label_col).alias("class"))
        for c in columns
    ]))).where(F.col("value").isNotNull() & F.col("class").isNotNull())
    counts = cells.groupBy("feature", "value", "class").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature", "value").agg(F.max("n").alias("top"), F.sum("n").alias("rows"))
    return best.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_values"),
        (F.sum("top").cast("double") / F.sum("rows").cast("double")).alias("purity"),
        F.min(F.col("top").cast("double") / F.col("rows").cast("double")).alias("lowest_value_purity"),
    ).withColumn("leaks", F.col("lowest_value_purity") == F.lit(1.0))


def compare_models(base: DataFrame, changed: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy and macro F1 before and after mitigation."""
    before = score_table(base, label, prediction).withColumnRenamed("value", "baseline")
    after = score_table(changed, label, prediction).withColumnRenamed("value", "mitigated")
    return before.join(after, "metric").withColumn("change", F.col("mitigated") - F.col("baseline"))
