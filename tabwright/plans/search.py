"""Random search with stratified folds, evaluation, and the full model run."""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from tabwright.functions.state import cut_lineage
from tabwright.operators.encode import encoding_spec
from tabwright.operators.evaluate import accuracy, averaged_score, balanced_accuracy, classification_report, confusion_counts, macro_f1
from tabwright.operators.split import TEST, TRAIN, VALIDATION, group_split, stratified_folds, stratified_split
from tabwright.plans.classifier import TabularClassifier, TabularClassifierModel

SCORES = {
    "accuracy": accuracy, "balanced_accuracy": balanced_accuracy, "f1_macro": macro_f1,
    "f1_weighted": partial(averaged_score, measure="f1", weighted=True),
    "precision_macro": partial(averaged_score, measure="precision"), "precision_weighted": partial(averaged_score, measure="precision", weighted=True),
    "recall_macro": partial(averaged_score, measure="recall"), "recall_weighted": partial(averaged_score, measure="recall", weighted=True),
}


class SharedSteps:
    """Steps of fits on the same rows, each computed once and stored, also when several threads ask for it."""

    def __init__(self):
        self.steps: dict[tuple, Future] = {}
        self.lock = Lock()

    def __call__(self, key: tuple, make: Callable):
        with self.lock:
            mine = key not in self.steps
            if mine:
                self.steps[key] = Future()
            step = self.steps[key]
        if mine:
            try:
                step.set_result(make(cut_lineage))
            except BaseException as failure:  # whoever waits for the step gets the error
                step.set_exception(failure)
        return step.result()


def parameter_space(settings: Mapping, encoding_map: Mapping, model: str = "boosted_trees") -> dict[str, list]:
    """Named choices from a flat spec: outliers, encoding alternatives, oversampling and one model grid."""
    prep = settings["preprocessing"]
    space = {
        "outlier_handler__strategy": list(prep["outliers"]["strategies"]),
        "outlier_handler__z_thresh": list(prep["outliers"]["thresholds"]),
    }
    for feature, entry in encoding_map.items():
        if not isinstance(entry, str):
            space[f"encoder__hyperparams__{feature}"] = [entry[0], *entry[1]]
    space |= {f"classifier__{k}": list(v) for k, v in settings["models"][model].items()}
    smote = prep["target_balancing"]["smote"]
    space["smote__sampling_strategy"] = list(smote["sampling_strategy"])
    space["smote__k_neighbors"] = list(smote["k_neighbors"])
    return space


def sample_candidates(space: Mapping[str, Sequence], n_iter: int, seed: int = 42) -> list[dict]:
    """Distinct combinations drawn from the whole space (all of them if there are no more)."""
    size = 1
    for choices in space.values():
        size *= len(choices)
    picks = random.Random(seed).sample(range(size), min(n_iter, size))
    out = []
    for pick in picks:
        candidate = {}
        for name, choices in space.items():
            pick, at = divmod(pick, len(choices))
            candidate[name] = choices[at]
        out.append(candidate)
    return out


@dataclass
class SearchResult:
    """``table`` has one row per candidate; ``model`` is the best one refitted on all training rows; ``steps`` counts the
    steps of preparation that were computed, all folds together."""

    table: DataFrame
    best_params: dict
    best_score: float
    model: TabularClassifierModel
    steps: Counter = field(default_factory=Counter)


def tune_hyperparameters(train: DataFrame, estimator: TabularClassifier, space: Mapping[str, Sequence], n_iter: int = 20,
                         cv: int = 5, scoring: str = "accuracy", parallelism: int = 4, seed: int = 42) -> SearchResult:
    """Mean score over stratified folds for each sampled candidate. Oversampling sees training folds only.

    Candidates share what they have in common: in each fold, rows are clipped once per outlier setting, encoded once per
    encoding on top of that, searched for neighbours once per encoding, and oversampled once per oversampling setting; the trees
    alone are grown for every candidate. Steps are stored, and given up when the fold is done.
    """
    if scoring not in SCORES:
        raise ValueError(f"unknown scoring '{scoring}'")
    label = estimator.label_col
    folded = cut_lineage(stratified_folds(train, label, estimator.id_col, cv, seed, output="_fold"))
    candidates = sample_candidates(space, n_iter, seed)
    estimators = [estimator.with_params(c) for c in candidates]
    most = max([e.most_neighbours() for e in estimators], default=0) if estimator.oversample else 0
    scored, counted = [], Counter()

    for fold in range(cv):
        steps = SharedSteps()
        inside = folded.where(F.col("_fold") != fold).drop("_fold")
        outside = folded.where(F.col("_fold") == fold).drop("_fold")

        def score(number: int, model: TabularClassifierModel, name: str, rows: DataFrame) -> float:
            ready = steps((name, *estimators[number].prepared_key()), lambda store: store(model.prepare(rows)))
            return SCORES[scoring](model.predict_prepared(ready), label, "prediction").first()[0]

        def run(number: int) -> tuple[int, float, float]:
            model = estimators[number].fit_sharing(inside, steps, most or None)
            return number, score(number, model, "outside", outside), score(number, model, "inside", inside)

        with ThreadPoolExecutor(parallelism) as pool:
            scored += pool.map(inheritable_thread_target(train.sparkSession)(run), range(len(candidates)))
        counted.update(key[0] for key in steps.steps)
    rows = []
    for number, candidate in enumerate(candidates):
        outer = [s[1] for s in scored if s[0] == number]
        inner = [s[2] for s in scored if s[0] == number]
        mean = sum(outer) / cv
        spread = (sum((o - mean) ** 2 for o in outer) / cv) ** 0.5
        rows.append((number, {k: str(v) for k, v in candidate.items()}, mean, spread, sum(inner) / cv))
    best = max(rows, key=lambda r: (r[2], -r[0]))
    table = train.sparkSession.createDataFrame(
        rows, "candidate int, params map<string,string>, mean_test_score double, std_test_score double, mean_train_score double"
    ).orderBy(F.desc("mean_test_score"), "candidate")
    model = estimator.with_params(candidates[best[0]]).fit(train)
    return SearchResult(table, candidates[best[0]], best[2], model, counted)


def evaluate_model(model: TabularClassifierModel | None, split: DataFrame, label_col: str,
                   split_col: str = "split") -> dict[str, DataFrame]:
    """Accuracy, class report and confusion counts on the validation and test rows."""
    if model is None:
        raise ValueError("the model is not fitted")
    scored = model.transform(split.where(F.col(split_col).isin(VALIDATION, TEST)))
    scored = cut_lineage(scored.select(split_col, label_col, "prediction"))
    by = [split_col]
    return {
        "accuracy": accuracy(scored, label_col, "prediction", by),
        "report": classification_report(scored, label_col, "prediction", by),
        "confusion": confusion_counts(scored, label_col, "prediction", by),
    }


def run_full_pipeline(df: DataFrame, settings: Mapping, *, label_col: str, id_col: str, test_size: float = 0.2,
                      val_size: float = 0.2, n_iter: int = 20, cv: int = 5, scoring: str = "accuracy",
                      custom_split: bool = False, customer_id_col: str = "Customer_ID", model: str = "boosted_trees",
                      ignore: Sequence[str] = (), parallelism: int = 4, seed: int = 42) -> dict:
    """Split, tune, evaluate and rank features. Returns the search result and the report tables."""
    if custom_split:
        split = group_split(df, customer_id_col, test_size, val_size, seed)
    else:
        split = stratified_split(df, label_col, id_col, test_size, val_size, seed)
    split = cut_lineage(split)
    train = split.where(F.col("split") == TRAIN).drop("split")
    encoding_map, encoding_params = encoding_spec(settings["preprocessing"]["encoding"]["features"], train.columns)
    estimator = TabularClassifier(label_col, id_col, encoding_map, encoding_params, model, ignore=ignore, seed=seed)
    found = tune_hyperparameters(
        train, estimator, parameter_space(settings, encoding_map, model), n_iter, cv, scoring, parallelism, seed
    )
    return {
        "search": found, "split": split, **evaluate_model(found.model, split, label_col),
        "importance": found.model.importances(),
    }
