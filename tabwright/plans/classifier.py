"""Classifier whose fit clips, encodes, oversamples and trains, and whose model only clips and encodes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import chain

import pyarrow as pa
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabwright.functions.state import cut_lineage, dealt, local_frame
from tabwright.functions.types import get_numerical_features
from tabwright.operators.balance import SMOTEBalancer
from tabwright.operators.encode import FeatureEncoder
from tabwright.operators.importance import assembled, trained
from tabwright.operators.outliers import OutlierHandler
from tabwright.operators.split import class_counts

INDEX_COL = "_class_index"


def boosted_trees(n_estimators: int = 100, max_depth: int = 5, learning_rate: float = 0.1, subsample: float = 1.0,
                  colsample_bytree: float = 1.0, min_child_weight: int = 1, gamma: float = 0.0, random_state: int = 42,
                  parallelism: int = 4) -> OneVsRest:
    """Multi-class boosted trees: one binary booster per class.

    Column sampling is per node and the two weights are the nearest tree limits Spark offers.
    """
    booster = GBTClassifier(
        maxIter=n_estimators, maxDepth=max_depth, stepSize=learning_rate, subsamplingRate=subsample,
        featureSubsetStrategy="all" if colsample_bytree >= 1 else str(colsample_bytree),
        minInstancesPerNode=max(1, int(min_child_weight)), minInfoGain=float(gamma), seed=random_state,
    )
    return OneVsRest(classifier=booster, featuresCol="features", labelCol=INDEX_COL, parallelism=parallelism)


def random_forest(n_estimators: int = 100, max_depth: int | None = 10, random_state: int = 42) -> RandomForestClassifier:
    """Spark trees are at most 30 levels deep, which stands in for "no limit"."""
    return RandomForestClassifier(featuresCol="features", labelCol=INDEX_COL, numTrees=n_estimators,
                                  maxDepth=30 if max_depth is None else max_depth, seed=random_state)


MODELS: dict[str, Callable] = {"boosted_trees": boosted_trees, "random_forest": random_forest}


class TabularClassifier(Estimator):
    """Outlier handling, encoding, optional oversampling and a tree classifier as one estimator.

    ``params`` uses ``<component>__<name>`` keys: ``outlier_handler__strategy``,
    ``outlier_handler__z_thresh``, ``encoder__hyperparams__<feature>``, ``smote__sampling_strategy``,
    ``smote__k_neighbors`` and ``classifier__<argument of the model>``.
    """

    COMPONENTS = ("outlier_handler", "encoder", "smote", "classifier")

    def __init__(self, label_col: str, id_col: str, encoding_map: Mapping | None = None,
                 encoding_params: Mapping | None = None, model: str = "boosted_trees", oversample: bool = True,
                 ignore: Sequence[str] = (), params: Mapping | None = None, seed: int = 42):
        super().__init__()
        if model not in MODELS:
            raise ValueError(f"unknown model '{model}'")
        self.label_col, self.id_col, self.model, self.oversample = label_col, id_col, model, oversample
        self.encoding_map, self.encoding_params = dict(encoding_map or {}), dict(encoding_params or {})
        self.ignore, self.chosen, self.seed = tuple(ignore), dict(params or {}), seed
        for name in self.chosen:
            if name.split("__", 1)[0] not in self.COMPONENTS:
                raise ValueError(f"unknown parameter '{name}'")

    def with_params(self, params: Mapping) -> "TabularClassifier":
        return TabularClassifier(self.label_col, self.id_col, self.encoding_map, self.encoding_params, self.model,
                                 self.oversample, self.ignore, {**self.chosen, **params}, self.seed)

    def _of(self, component: str) -> dict:
        head = component + "__"
        return {k[len(head):]: v for k, v in self.chosen.items() if k.startswith(head)}

    def _fit(self, dataset: DataFrame) -> "TabularClassifierModel":
        done: dict[tuple, object] = {}

        def node(key: tuple, make: Callable):
            if key not in done:
                done[key] = make(lambda frame: frame)
            return done[key]

        return self.fit_sharing(dataset, node)

    def fit_sharing(self, dataset: DataFrame, node: Callable, most_neighbours: int | None = None) -> "TabularClassifierModel":
        """Fit with every step taken from ``node(key, make)``.

        The key names the step and all settings it rests on, so fits on the same rows can share the steps they have in common;
        ``make(store)`` computes one and hands the frames that others will read to ``store``. With ``most_neighbours``
        the neighbours for oversampling are found once, for all numbers of neighbours up to that one.
        """
        clip, encode, balance = (_frozen(self._of(c)) for c in ("outlier_handler", "encoder", "smote"))

        def clipped(store):
            table = dataset.drop(*self.ignore)
            outliers = OutlierHandler(**{"exclude": (self.label_col, self.id_col), **self._of("outlier_handler")}).fit(table)
            return outliers, store(outliers.transform(table))

        def encoded(store):
            table = node(("clip", clip), clipped)[1]
            encoder = FeatureEncoder(self.encoding_map, self.encoding_params, order_col=self.id_col)
            model = encoder.set_params(**self._of("encoder")).fit(table)
            table = store(model.transform(table))
            features = [c for c in get_numerical_features(table) if c not in (self.label_col, self.id_col)]
            return model, table, features, [c for c, _ in class_counts(table, self.label_col) if c is not None]

        def neighbours(store):
            _, table, features, _ = node(("encode", clip, encode), encoded)
            return store(SMOTEBalancer.neighbours(table, features, self.label_col, self.id_col, most_neighbours))

        def balanced(store):
            _, table, features, classes = node(("encode", clip, encode), encoded)
            if self.oversample:
                near = node(("neighbours", clip, encode), neighbours) if most_neighbours else None
                smote = SMOTEBalancer(**{"random_state": self.seed, **self._of("smote")})
                table = smote.fit_resample(table, features, self.label_col, self.id_col, near)
            index = F.create_map(*chain.from_iterable((F.lit(c), F.lit(float(i))) for i, c in enumerate(classes)))
            train = table.select(*features, F.try_element_at(index, F.col(self.label_col)).alias(INDEX_COL))
            # the trainer reads its input many times; synthetic rows are not made twice for the sake of their number
            return dealt(cut_lineage(train) if self.oversample else train)

        train = node(("balance", clip, encode, balance), balanced)
        learner = MODELS[self.model](**{"random_state": self.seed, **self._of("classifier")})
        outliers, _ = node(("clip", clip), clipped)
        encoder, _, features, classes = node(("encode", clip, encode), encoded)
        if isinstance(learner, RandomForestClassifier):
            fitted = trained(learner, train, features)
        else:
            fitted = learner.fit(assembled(train, features).select("features", INDEX_COL))
        return TabularClassifierModel(outliers, encoder, features, classes, fitted, self.ignore)

    def most_neighbours(self) -> int:
        return SMOTEBalancer(**self._of("smote")).k_neighbors

    def prepared_key(self) -> tuple:
        """What clipping and encoding rest on: models with the same key prepare rows in the same way."""
        return _frozen(self._of("outlier_handler")), _frozen(self._of("encoder"))


def _frozen(params: Mapping) -> tuple:
    return tuple(sorted((k, repr(v)) for k, v in params.items()))


class TabularClassifierModel(Model):
    def __init__(self, outliers, encoder, features: list[str], classes: list, fitted, ignore: tuple):
        super().__init__()
        self.outliers, self.encoder, self.features = outliers, encoder, features
        self.classes, self.fitted, self.ignore = classes, fitted, ignore

    def prepare(self, dataset: DataFrame) -> DataFrame:
        return self.encoder.transform(self.outliers.transform(dataset.drop(*self.ignore)))

    def predict_prepared(self, prepared: DataFrame) -> DataFrame:
        """Adds ``prediction`` (a class value) to rows that are clipped and encoded already."""
        scored = self.fitted.transform(assembled(prepared, self.features))
        values = F.array(*[F.lit(c) for c in self.classes])
        extra = {"features", "rawPrediction", "probability"} - set(prepared.columns)
        return scored.withColumn("prediction", F.element_at(values, F.col("prediction").cast("int") + 1)).drop(*extra)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.predict_prepared(self.prepare(dataset))

    def importances(self, top_n: int | None = None) -> DataFrame:
        """feature, importance: for boosters the mean over the per-class models."""
        if hasattr(self.fitted, "featureImportances"):
            values = self.fitted.featureImportances.toArray()
        else:
            each = [m.featureImportances.toArray() for m in self.fitted.models]
            values = sum(each) / len(each)
        ranked = local_frame(SparkSession.active(), pa.table({
            "feature": pa.array(self.features, pa.string()), "importance": pa.array(values.tolist(), pa.float64()),
        })).orderBy(F.desc("importance"), "feature")
        return ranked if top_n is None else ranked.limit(top_n)
