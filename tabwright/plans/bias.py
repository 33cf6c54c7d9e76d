"""Bias mitigation: leave sensitive columns out, rebuild the preparation, retrain, compare."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabwright.functions.types import get_categorical_features, get_numerical_features
from tabwright.operators.encode import FeatureEncoder, StandardScaler
from tabwright.operators.fairness import compare_models
from tabwright.operators.impute import SimpleImputer
from tabwright.operators.importance import fit_forest, assembled
from tabwright.operators.split import TEST, stratified_split


def prepared_forest(split: DataFrame, label_col: str, id_col: str, split_col: str = "split", n_estimators: int = 100,
                    max_depth: int = 10, seed: int = 42) -> DataFrame:
    """Impute, scale and one-hot encode from the training rows, fit a forest, and predict the test rows.

    Labels must be 0..k-1. The result has the key, the label, the other columns and ``prediction``.
    """
    train = split.where(F.col(split_col) != TEST)
    skip = {label_col, id_col, split_col}
    numeric = [c for c in get_numerical_features(split) if c not in skip]
    text = [c for c in get_categorical_features(split) if c not in skip]
    stages = []
    if numeric:
        stages.append(SimpleImputer("median", numeric))
        stages.append(StandardScaler(numeric))
    if text:
        stages.append(SimpleImputer("most_frequent", text))
        stages.append(FeatureEncoder({c: "one-hot" for c in text}))
    test = split.where(F.col(split_col) == TEST)
    for stage in stages:
        fitted = stage.fit(train)
        train, test = fitted.transform(train), fitted.transform(test)
    features = [c for c in get_numerical_features(train) if c not in skip]
    model = fit_forest(train, features, label_col, n_estimators, max_depth, seed)
    scored = model.transform(assembled(test, features))
    return scored.select(id_col, label_col, F.col("prediction").cast("int").alias("prediction"))


def mitigate_bias(df: DataFrame, sensitive: Sequence[str], label_col: str, id_col: str, *, test_size: float = 0.2,
                  n_estimators: int = 100, max_depth: int = 10, seed: int = 42) -> dict[str, DataFrame]:
    """Baseline and reduced model on the same split, with their predictions and the metric table."""
    split = stratified_split(df, label_col, id_col, test_size, None, seed)
    options = dict(n_estimators=n_estimators, max_depth=max_depth, seed=seed)
    base = prepared_forest(split, label_col, id_col, **options)
    fair = prepared_forest(split.drop(*sensitive), label_col, id_col, **options)
    return {"baseline": base, "mitigated": fair, "comparison": compare_models(base, fair, label_col, "prediction")}
