"""Queries that train models. Scores have no SQL equivalent; the ``*_stated`` queries return what SQL can state about them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.correlating import pairs
from tabwright.catalog.registry import query
from tabwright.functions.state import settle
from tabwright.functions.types import rounded
from tabwright.operators import evaluate, importance
from tabwright.operators.split import TEST, TRAIN, VALIDATION, stratified_folds, stratified_split
from tabwright.plans import analysis, bias, search
from tabwright.plans.classifier import TabularClassifier

_XS = ["x1", "x2", "x3", "x4"]

# A search space small enough for a check run; the keys are those of a full one.
SETTINGS = {
    "preprocessing": {
        "outliers": {"strategies": ["none", "clip"], "thresholds": [2.0, 3.0, 4.0]},
        "encoding": {"features": {
            "lang": {"strategy": "one-hot", "alternatives": ["frequency", "ordinal"]},
            "source": {"strategy": "frequency"},
        }},
        "target_balancing": {"smote": {"sampling_strategy": ["auto", "not majority"], "k_neighbors": [3, 5]}},
    },
    "models": {
        "boosted_trees": {"n_estimators": [3, 5], "max_depth": [2, 3], "learning_rate": [0.1, 0.3]},
        "random_forest": {"n_estimators": [5, 10], "max_depth": [3, 5]},
    },
}


def _rows(t):
    return t.v_feat.select("row_id", *_XS, "cat", "label")


def _fitted(t, **options):
    split = stratified_split(_rows(t), "label", "row_id")
    estimator = TabularClassifier("label", "row_id", {"cat": "one-hot"}, **options)
    model = estimator.fit(split.where(F.col("split") == TRAIN).drop("split"))
    return model, model.transform(split.where(F.col("split") == TEST))


@query("m1_boosted_trees")
def boosted_trees(t):
    _, scored = _fitted(t, oversample=False, params={"classifier__n_estimators": 10, "classifier__max_depth": 3})
    return evaluate.classification_report(scored, "label", "prediction")


@query("m2_random_forest")
def random_forest(t):
    _, scored = _fitted(t, model="random_forest", oversample=False,
                        params={"classifier__n_estimators": 100, "classifier__max_depth": 10})
    return evaluate.classification_report(scored, "label", "prediction")


@query("m3_oversampling_classifier")
def oversampling(t):
    _, scored = _fitted(t, model="random_forest", params={
        "outlier_handler__strategy": "clip", "smote__k_neighbors": 3, "classifier__n_estimators": 100,
        "classifier__max_depth": 10})
    return evaluate.per_class_metrics(scored, "label", "prediction")


@query("m5_random_search")
def random_search(t):
    encoding = {"lang": ("one-hot", ["frequency", "ordinal"]), "source": "frequency"}
    estimator = TabularClassifier("quality", "row_id", encoding, model="random_forest")
    space = search.parameter_space(SETTINGS, encoding, "random_forest")
    return search.tune_hyperparameters(t.v_doc, estimator, space, n_iter=4, cv=3).table


@query("m11_model_importance")
def model_importance(t):
    model, _ = _fitted(t, model="random_forest", oversample=False, params={"classifier__n_estimators": 100, "classifier__max_depth": 10})
    return model.importances(20)


@query("m12_full_run")
def full_run(t):
    out = search.run_full_pipeline(t.v_doc, SETTINGS, label_col="quality", id_col="row_id", n_iter=2, cv=3,
                                   model="random_forest")
    return out["report"]


@query("f1_forest_importance")
def forest_importance(t):
    return importance.forest_importance(t.v_feat, _XS, "label", n_estimators=100)


@query("f4_permutation_importance")
def permutation_importance(t):
    rows = _rows(t).drop("cat")
    model = importance.fit_forest(rows, _XS, "label", n_estimators=100)
    out = importance.permutation_importance(
        rows, lambda r: model.transform(importance.assembled(r, _XS)), _XS, "label", id_col="row_id", n_repeats=10,
        thresholds=importance.split_points(model, _XS))
    return out.withColumns({c: rounded(F.col(c)) for c in ("importance", "deviation")})


@query("f9_recursive_elimination")
def recursive_elimination(t):
    return importance.recursive_elimination(t.v_feat, [*_XS, "pred"], "label", keep=3, n_estimators=100)


@query("f11_principal_components")
def principal_components(t):
    return importance.principal_components(t.v_feat, _XS, 2, keep=["row_id", "label"])


@query("g3_mitigated_model")
def mitigated_model(t):
    rows = t.v_feat.select("row_id", *_XS, "cat", "leak", "label")
    return bias.mitigate_bias(rows, ["leak"], "label", "row_id")["comparison"]


@query("analysis_feature_importance")
def feature_importance(t):
    found = analysis.feature_importance_analysis(
        t.v_feat, _XS, "label", id_col="row_id", pairs=pairs(t), n_estimators=10, max_depth=5, n_repeats=3)
    return found["comparison"]


@query("analysis_select_features")
def select_features(t):
    return analysis.select_features(t.v_feat, [*_XS, "pred"], "label", k=3, n_estimators=10, max_depth=5)


@query("analysis_statistics")
def statistics(t):
    return analysis.statistical_analysis(t.v_feat, "label", _XS)["features"]


# ---- what SQL can state about trained models ------------------------------------------------------------------------

_SUPPORT = "SELECT CAST(label AS INTEGER) AS label, count(*) AS support, TRUE AS beats_majority FROM v_feat GROUP BY label"


def _stated(t, **options):
    """Rows per class, and whether a model trained on the training split is right more often on the test split than naming
    the largest class would be."""
    split = stratified_split(_rows(t), "label", "row_id")
    model = TabularClassifier("label", "row_id", {"cat": "one-hot"}, **options).fit(split.where(F.col("split") == TRAIN).drop("split"))
    scored = model.transform(split.where(F.col("split") == TEST)).groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(F.col("prediction") == F.col("label")).alias("right")).collect()  # a row per class
    better = sum(r["right"] for r in scored) > max(r["n"] for r in scored)
    return split.groupBy(F.col("label").cast("int").alias("label")).agg(F.count("*").alias("support")).withColumn("beats_majority", F.lit(better))


@query("m1_boosted_trees_stated", _SUPPORT)
def boosted_trees_stated(t):
    return _stated(t, oversample=False, params={"classifier__n_estimators": 10, "classifier__max_depth": 3})


@query("m2_random_forest_stated", _SUPPORT)
def random_forest_stated(t):
    return _stated(t, model="random_forest", oversample=False, params={"classifier__n_estimators": 100, "classifier__max_depth": 10})


@query("m3_oversampling_classifier_stated", _SUPPORT)
def oversampling_stated(t):
    return _stated(t, model="random_forest", params={
        "outlier_handler__strategy": "clip", "smote__k_neighbors": 3, "classifier__n_estimators": 20, "classifier__max_depth": 6})


@query("m5_random_search_stated", """
SELECT CAST(range AS INTEGER) AS place, TRUE AS scored, TRUE AS ordered, TRUE AS own_params, (SELECT count(*) FROM v_doc) AS fold_rows FROM range(4)""")
def random_search_stated(t):
    """One row per candidate, best first: its score lies between 0 and 1 and not above the one before it, no other candidate has
    its parameters, and the folds together hold every row."""
    encoding = {"lang": ("one-hot", ["frequency", "ordinal"]), "source": "frequency"}
    estimator = TabularClassifier("quality", "row_id", encoding, model="random_forest")
    found = search.tune_hyperparameters(t.v_doc, estimator, search.parameter_space(SETTINGS, encoding, "random_forest"), n_iter=4, cv=3)
    rows = found.table.collect()  # a row per candidate, in the table's order
    scores = [r["mean_test_score"] for r in rows]
    params = [tuple(sorted(r["params"].items())) for r in rows]
    held = stratified_folds(t.v_doc, "quality", "row_id", 3, 42, output="fold").groupBy("fold").count().collect()  # a row per fold
    even = max(r["count"] for r in held) - min(r["count"] for r in held) <= 2  # one row per class at most
    whole = sum(r["count"] for r in held) if even and len(held) == 3 else -1
    return t.spark.createDataFrame(
        [(k, 0 <= s <= 1, k == 0 or s <= scores[k - 1], params.count(params[k]) == 1, whole) for k, s in enumerate(scores)],
        "place int, scored boolean, ordered boolean, own_params boolean, fold_rows long")


@query("m11_model_importance_stated", """
SELECT feature, feature = 'x4' AS is_top, TRUE AS sums_to_one FROM (
  SELECT 'x' || range AS feature FROM range(1, 5) UNION ALL SELECT DISTINCT 'cat_' || cat FROM v_feat) f""")
def model_importance_stated(t):
    """A feature per numeric column and category; x4 holds the label, so it comes first; importances sum to one."""
    return _importances(t, model_importance(t))


@query("m12_full_run_stated", """
SELECT CAST(quality AS INTEGER) AS label, count(*) AS n_rows, TRUE AS reported, TRUE AS same_support FROM v_doc GROUP BY quality""")
def full_run_stated(t):
    """Every row is in one split; the report of the validation and test rows has every class, with as many rows as the split."""
    out = search.run_full_pipeline(t.v_doc, SETTINGS, label_col="quality", id_col="row_id", n_iter=2, cv=3, model="random_forest")
    sizes = out["split"].groupBy("split", "quality").count().collect()  # a row per split and class
    report = {(r["split"], r["class"]): r["support"] for r in out["report"].collect()}
    scored = [r for r in sizes if r["split"] in (VALIDATION, TEST)]
    rows = []
    for label in sorted({r["quality"] for r in sizes}):
        own = [r for r in scored if r["quality"] == label]
        rows.append((int(label), sum(r["count"] for r in sizes if r["quality"] == label), len(own) == 2 and all((r["split"], str(label)) in report for r in own),
                     all(report.get((r["split"], str(label))) == r["count"] for r in own)))
    return t.spark.createDataFrame(rows, "label int, n_rows long, reported boolean, same_support boolean")


@query("f9_recursive_elimination_stated", """
SELECT CAST(5 AS BIGINT) AS n_features, CAST(3 AS BIGINT) AS n_selected, CAST(3 AS INTEGER) AS last_rank,
  (SELECT corr(x4, label) > abs(corr(x1, label)) FROM v_feat) AS keeps_label_features""")
def recursive_elimination_stated(t):
    """Three of five features stay, the others have ranks 2 and 3, and the two columns that tell the label are among those that stay."""
    found = recursive_elimination(t)
    return found.agg(F.count("*").alias("n_features"), F.count_if("selected").alias("n_selected"), F.max("ranking").alias("last_rank"),
                     (F.count_if(F.col("selected") & F.col("feature").isin("x4", "pred")) == 2).alias("keeps_label_features"))


def _importances(t, frame):
    rows = frame.collect()  # a row per feature
    whole = abs(sum(r["importance"] for r in rows) - 1) < 1e-6
    top = max(rows, key=lambda r: r["importance"])["feature"]
    return t.spark.createDataFrame([(r["feature"], r["feature"] == top, whole) for r in rows], "feature string, is_top boolean, sums_to_one boolean")


@query("f1_forest_importance_stated", """
SELECT feature, feature = 'x4' AS is_top, TRUE AS sums_to_one FROM (VALUES ('x1'), ('x2'), ('x3'), ('x4')) f (feature)""")
def forest_importance_stated(t):
    """x4 holds the label, so it comes first; importances sum to one."""
    return _importances(t, importance.forest_importance(t.v_feat, _XS, "label", n_estimators=100))


@query("f4_permutation_importance_stated", """
SELECT feature, feature = 'x4' AS is_top FROM (VALUES ('x1'), ('x2'), ('x3'), ('x4')) f (feature)""")
def permutation_importance_stated(t):
    rows = _rows(t).drop("cat")
    model = importance.fit_forest(rows, _XS, "label", n_estimators=100)
    out = settle(importance.permutation_importance(
        rows, lambda r: model.transform(importance.assembled(r, _XS)), _XS, "label", id_col="row_id", n_repeats=10,
        thresholds=importance.split_points(model, _XS)))
    top = out.agg(F.max_by("feature", "importance")).first()[0]
    return out.select("feature", (F.col("feature") == top).alias("is_top"))


@query("f11_principal_components_stated", """
SELECT count(*) AS n_rows, TRUE AS centred, TRUE AS uncorrelated, TRUE AS in_order FROM v_feat""")
def principal_components_stated(t):
    """Components over standardised features have mean zero, no covariance, and falling variance."""
    found = importance.principal_components(t.v_feat, _XS, 2, keep=["row_id", "label"])
    one, two = [c for c in found.columns if c not in ("row_id", "label")][:2]
    return found.agg(F.count("*").alias("n_rows"), F.avg(one).alias("a"), F.avg(two).alias("b"), F.covar_pop(one, two).alias("c"),
                     F.var_pop(one).alias("v"), F.var_pop(two).alias("w")).select(
        "n_rows", ((F.abs("a") < 1e-6) & (F.abs("b") < 1e-6)).alias("centred"), (F.abs("c") < 1e-6).alias("uncorrelated"), (F.col("v") >= F.col("w")).alias("in_order"))


@query("i7_impute_and_report_stated", """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS gaps, CAST(2 AS BIGINT) AS reports, CAST(0 AS BIGINT) AS errors FROM v_feat""")
def impute_and_report_stated(t):
    """No row is lost or doubled, no gap stays, every column is reported."""
    from tabwright.operators import impute

    rows = t.v_feat.select("row_id", *[F.when(F.col("row_id") % m != 0, F.col(c)).alias(c) for c, m in (("x1", 11), ("x3", 7))], "x2", "x4")
    filled, report = impute.apply_and_evaluate_knn_imputation(rows, ["x1", "x3"], k=3, id_col="row_id")
    told = report.agg(F.count("*").alias("n"), F.count("error").alias("e")).first()
    return filled.agg(F.count("*").alias("n_rows"), F.count_if(F.col("x1").isNull() | F.col("x3").isNull()).alias("gaps")).select(
        "n_rows", "gaps", F.lit(told["n"]).cast("long").alias("reports"), F.lit(told["e"]).cast("long").alias("errors"))
