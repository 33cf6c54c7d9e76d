"""Feature analysis: prepare, correlate, rank, describe, select."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabwright.functions.state import settle
from tabwright.operators import correlate, distribution, importance
from tabwright.operators.profile import class_imbalance, target_profile


def correlation_analysis(df: DataFrame, target: str, columns: Sequence[str]) -> dict[str, DataFrame]:
    """Target buckets, collinear pairs, clusters and isolated features from one pass over the table."""
    pairs = settle(correlate.correlation_pairs(df, [*columns, target]))
    return {
        "pairs": pairs,
        "target": correlate.target_correlation_buckets(pairs, target),
        "multicollinear": correlate.multicollinear_pairs(pairs, target),
        "clusters": correlate.feature_clusters(pairs, target),
        "cluster_summary": correlate.cluster_summary(pairs, target),
        "isolated": correlate.isolated_features(pairs, target),
    }


def feature_importance_analysis(df: DataFrame, features: Sequence[str], label_col: str, *, id_col: str,
                                pairs: DataFrame | None = None, n_estimators: int = 100, max_depth: int = 10,
                                n_repeats: int = 10, seed: int = 42) -> dict[str, DataFrame]:
    """Forest and permutation importance, their agreement with correlation, and a recommended set."""
    model = importance.fit_forest(df, features, label_col, n_estimators, max_depth, seed)
    forest = settle(importance.importance_frame(df, features, model.featureImportances.toArray()))
    permuted = settle(importance.permutation_importance(
        df, lambda rows: model.transform(importance.assembled(rows, features)), features, label_col,
        id_col=id_col, n_repeats=n_repeats, seed=seed, thresholds=importance.split_points(model, features),
    ))
    top = importance.top_features(forest)
    out = {"forest": forest, "permutation": permuted, "top": top}
    classified = None
    if pairs is not None:
        with_target = correlate.target_correlation(pairs, label_col).where(F.col("feature").isin(*features))
        compared = importance.importance_vs_correlation(forest, permuted, with_target)
        classified = settle(importance.classify_features(compared))
        out["comparison"] = classified
    out["recommended"] = importance.recommended_features(top, classified)
    return out


def statistical_analysis(df: DataFrame, target: str, numeric: Sequence[str], important: Sequence[str] | None = None,
                         top_n: int = 20) -> dict[str, DataFrame]:
    """Target balance and a per-feature report with advice."""
    chosen = distribution.choose_features(df, target, numeric, important, top_n)
    profile = target_profile(df, target)
    classification = df.select(target).distinct().limit(11).count() <= 10
    report = settle(distribution.feature_report(df, chosen, target, classification))
    return {
        "target": profile, "imbalance": class_imbalance(df, target), "features": report,
        "advice": distribution.transformation_advice(report, classification),
        "lists": distribution.feature_lists(report),
    }


def select_features(df: DataFrame, features: Sequence[str], label_col: str, k: int = 20, correlation_above: float = 0.05,
                    n_estimators: int = 100, max_depth: int = 10, seed: int = 42) -> DataFrame:
    """Features chosen by at least two of correlation, mutual information and recursive elimination."""
    pairs = correlate.correlation_pairs(df, [*features, label_col])
    by_correlation = correlate.select_by_correlation(pairs, label_col, correlation_above)
    by_information = importance.select_k_best(importance.mutual_information(df, features, label_col), k)
    by_elimination = importance.recursive_elimination(df, features, label_col, k, n_estimators, max_depth, seed)
    return importance.vote([by_correlation, by_information, by_elimination.where("selected")])
