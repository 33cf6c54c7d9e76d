"""Classification metrics from a label column and a prediction column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabwright.functions.state import small_rows


def accuracy(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    hit = F.col(label).eqNullSafe(F.col(prediction)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """by..., actual, predicted, n: as small as the number of classes squared."""
    return df.groupBy(*by, F.col(label).cast("string").alias("actual"), F.col(prediction).cast("string").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence | None = None) -> DataFrame:
    """Per actual class: counts ``n_<class>`` and row shares ``share_<class>`` of each prediction."""
    if classes is None:
        both = df.select(F.col(label).alias("v")).union(df.select(F.col(prediction).alias("v"))).distinct()
        classes = sorted(r["v"] for r in small_rows(both.where(F.col("v").isNotNull()), "classes"))
    counted = df.groupBy(F.col(label).alias("actual")).agg(
        F.count(F.lit(1)).alias("_all"), *[F.count_if(F.col(prediction) == F.lit(c)).alias(f"n_{c}") for c in classes]
    )
    return counted.select(
        "actual", *[F.col(f"`n_{c}`") for c in classes],
        *[(F.col(f"`n_{c}`").cast("double") / F.col("_all").cast("double")).alias(f"share_{c}") for c in classes],
    )


def per_class_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """precision, recall, f1 and support of every class; 0 where a measure is undefined."""
    cells = confusion_counts(df, label, prediction, by)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("actual_n"), zero.alias("predicted_n"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(zero).alias("hit_n")),
        F.struct(F.col("predicted").alias("class"), zero.alias("actual_n"), F.col("n").alias("predicted_n"), zero.alias("hit_n")),
    )
    sums = cells.select(*by, F.inline(sides)).where(F.col("class").isNotNull()).groupBy(*by, "class").agg(
        F.sum("actual_n").alias("support"), F.sum("predicted_n").alias("predicted"), F.sum("hit_n").alias("hit")
    )
    ratio = lambda a, b: F.coalesce(
        F.col(a).cast("double") / F.nullif(F.col(b), F.lit(0)).cast("double"), F.lit(0.0))
    scored = sums.withColumns({"precision": ratio("hit", "predicted"), "recall": ratio("hit", "support")})
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both > 0, F.lit(2.0) * F.col("precision") * F.col("recall") / both).otherwise(F.lit(0.0))
    return scored.select(*by, "class", "precision", "recall", f1.alias("f1"), "support")


def classification_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Per-class rows plus ``accuracy``, ``macro avg`` and ``weighted avg``."""
    rows = per_class_metrics(df, label, prediction, by)
    measures = ["precision", "recall", "f1"]
    macro = rows.groupBy(*by).agg(*[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support")).select(
        *by, F.lit("macro avg").alias("class"), *measures, "support")
    weighted = rows.groupBy(*by).agg(
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support").cast("double")).alias(m) for m in measures],
        F.sum("support").alias("support"),
    ).select(*by, F.lit("weighted avg").alias("class"), *measures, "support")
    # overall accuracy is recall weighted by support
    overall = weighted.select(*by, F.lit("accuracy").alias("class"), *[F.col("recall").alias(m) for m in measures], "support")
    return rows.unionByName(macro).unionByName(weighted).unionByName(overall)


def macro_f1(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return per_class_metrics(df, label, prediction, by).groupBy(*by).agg(F.avg("f1").alias("macro_f1"))


def averaged_score(df: DataFrame, label: str, prediction: str, measure: str, weighted: bool = False) -> DataFrame:
    """``precision``, ``recall`` or ``f1`` of the classes as one number: their mean, or their mean weighted by support."""
    rows = per_class_metrics(df, label, prediction)
    if weighted:
        return rows.agg((F.sum(F.col(measure) * F.col("support")) / F.sum("support").cast("double")).alias("score"))
    return rows.agg(F.avg(measure).alias("score"))


def balanced_accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Mean recall of the classes that occur as labels."""
    return per_class_metrics(df, label, prediction).where("support > 0").agg(F.avg("recall").alias("score"))


def score_table(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and macro F1 as (by..., metric, value) rows."""
    acc = accuracy(df, label, prediction, by).select(*by, F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))
    f1 = macro_f1(df, label, prediction, by).select(*by, F.lit("macro_f1").alias("metric"), F.col("macro_f1").alias("value"))
    return acc.unionByName(f1)
