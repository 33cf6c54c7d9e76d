"""Categorical encoding and scaling, fitted on one table and applied to any other."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.ml.base import Estimator, Model
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabwright.functions.state import rows_if_small, settle, small_rows
from tabwright.functions.types import replace_columns, require_columns
from tabwright.operators.ranking import with_position

STRATEGIES = ("ordinal", "one-hot", "frequency", "binary")
UNSEEN_CODE = -1
# Codes of up to this many values are written into the plan; more are joined.
INLINE_VALUES = 64
# One-hot output: a column per category, or one sparse vector per feature with a place per category.
ONE_HOT_OUTPUTS = ("columns", "vector")


def appearance_codes(df: DataFrame, features: Sequence[str], order_col: str) -> DataFrame:
    """feature, value, n_rows, code: values numbered by the row on which they first appear."""
    cells = df.select(order_col, F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features
    ]))).where(F.col("value").isNotNull())
    seen = settle(cells.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(order_col).alias("first_row")
    ))
    if rows_if_small(seen) is not None:
        code = F.row_number().over(Window.partitionBy("feature").orderBy("first_row", "value")) - 1
        return seen.select("feature", "value", "n_rows", code.alias("code"))
    # very many distinct values: rank them in pieces, one feature after the other
    parts = [
        with_position(seen.where(F.col("feature") == f), "first_row", ["value"], "code") for f in features
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("feature", "value", "n_rows", F.col("code").cast("int").alias("code"))


def frequency_codes(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature, value, code: the share of each value among the rows that have one."""
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features
    ]))).where(F.col("value").isNotNull())
    counts = cells.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    filled = df.agg(*[F.count(f).alias(f) for f in features])
    totals = filled.select(F.create_map(*chain.from_iterable((F.lit(f), F.col(f"`{f}`")) for f in features)))
    return counts.select(
        "feature", "value", "n_rows",
        (F.col("n_rows").cast("double") / totals.scalar()[F.col("feature")].cast("double")).alias("code"),
    )


def one_hot_name(feature: str, value: str) -> str:
    return f"{feature}_{value}"


class FeatureEncoder(Estimator):
    """Encodes text columns by strategy.

    ``encoding_map`` gives a strategy per feature, or a pair (default, alternatives) from which
    ``hyperparams`` may choose. Features the table lacks are skipped with a warning. ``order_col``
    defines what "first appearance" means for ordinal codes without a map and for binary codes.

    ``one_hot`` chooses the shape of one-hot features, whatever the number of categories: ``columns`` gives a column per
    category, whose names come to the driver; ``vector`` one sparse column ``<feature>_onehot`` whose places are
    the rows of ``model.sparse[feature]``, a table that stays distributed.
    """

    def __init__(self, encoding_map: Mapping[str, str | tuple], encoding_params: Mapping[str, Mapping] | None = None,
                 hyperparams: Mapping[str, str] | None = None, order_col: str | None = None, one_hot: str = "columns"):
        super().__init__()
        if one_hot not in ONE_HOT_OUTPUTS:
            raise ValueError(f"unknown one-hot output '{one_hot}'")
        self.one_hot = one_hot
        self.encoding_map = dict(encoding_map)
        self.encoding_params = dict(encoding_params or {})
        self.hyperparams = dict(hyperparams or {})
        self.order_col = order_col

    def set_params(self, **params) -> "FeatureEncoder":
        """``hyperparams__<feature>=strategy`` overrides one feature; other names are attributes."""
        for name, value in params.items():
            head, _, feature = name.partition("__")
            if head == "hyperparams" and feature:
                self.hyperparams[feature] = value
            elif hasattr(self, name):
                setattr(self, name, value)
            else:
                raise ValueError(f"unknown parameter '{name}'")
        return self

    def strategy_of(self, feature: str) -> str:
        entry = self.encoding_map[feature]
        chosen = entry if isinstance(entry, str) else self.hyperparams.get(feature, entry[0])
        if chosen not in STRATEGIES:
            raise ValueError(f"unknown encoding strategy '{chosen}' for '{feature}'")
        return chosen

    def _fit(self, dataset: DataFrame) -> "FeatureEncoderModel":
        plan: dict[str, str] = {}
        for feature in self.encoding_map:
            if feature in dataset.columns:
                plan[feature] = self.strategy_of(feature)
            else:
                warnings.warn(f"feature '{feature}' of the encoding map is not in the table", stacklevel=2)
        maps = {
            f: dict(self.encoding_params[f]["order_map"])
            for f, s in plan.items() if s == "ordinal" and "order_map" in self.encoding_params.get(f, {})
        }
        by_order = [f for f, s in plan.items() if s in ("ordinal", "binary") and f not in maps]
        frames = []
        if by_order:
            if self.order_col is None:
                raise ValueError(f"order_col is needed to number {by_order} by first appearance")
            codes = appearance_codes(dataset, by_order, self.order_col)
            frames.append(codes.select("feature", "value", F.col("code").cast("double").alias("code")))
        shares = [f for f, s in plan.items() if s == "frequency"]
        if shares:
            frames.append(frequency_codes(dataset, shares).select("feature", "value", "code"))
        state = None
        for frame in frames:
            state = frame if state is None else state.unionByName(frame)
        if state is not None:
            state = settle(state)
        codes = _inline_codes(state)
        for f in (f for f, s in plan.items() if s == "binary"):
            found = len(codes.get(f, {})) if f not in codes or codes[f] is not None else "many"
            if found != 2:
                raise ValueError(f"binary encoding expects 2 categories, got {found} for {f}")
        wide = [f for f, s in plan.items() if s == "one-hot"]
        categories: dict[str, list[str]] = {f: [] for f in wide}
        sparse: dict[str, tuple[DataFrame, int]] = {}
        if wide:
            values = dataset.select(F.inline(F.array(*[
                F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in wide
            ]))).where(F.col("value").isNotNull()).distinct()
            if self.one_hot == "columns":
                for r in values.toArrow().to_pylist():  # one name per column
                    categories[r["feature"]].append(r["value"])
            else:
                values = settle(values)
                sizes = {r["feature"]: r["count"] for r in small_rows(values.groupBy("feature").count(), "one-hot features", len(wide) + 1)}
                for f in wide:
                    own = with_position(values.where(F.col("feature") == f), "value", name="code")
                    sparse[f] = (settle(own.select("value", F.col("code").cast("int").alias("code"))), sizes.get(f, 0))
        return FeatureEncoderModel(plan, maps, {f: sorted(v) for f, v in categories.items()}, state, codes, sparse)


def _inline_codes(state: DataFrame | None) -> dict[str, dict | None]:
    """Codes per feature with few values; None for a feature whose codes have to be joined."""
    if state is None:
        return {}
    rows = rows_if_small(state)
    if rows is None:
        sizes = small_rows(state.groupBy("feature").count(), "encoded features")
        few = [r["feature"] for r in sizes if r["count"] <= INLINE_VALUES]
        rows = small_rows(state.where(F.col("feature").isin(few)), "codes", INLINE_VALUES * max(1, len(few)))
        codes: dict[str, dict | None] = {r["feature"]: None for r in sizes if r["count"] > INLINE_VALUES}
    else:
        codes = {}
    for r in rows:
        codes.setdefault(r["feature"], {})[r["value"]] = r["code"]
    return {f: c if c is not None and len(c) <= INLINE_VALUES else None for f, c in codes.items()}


class FeatureEncoderModel(Model):
    """Fitted codes: given maps, one-hot categories, and a (feature, value, code) table for the rest."""

    def __init__(self, plan: dict[str, str], maps: dict[str, dict], categories: dict[str, list[str]],
                 state: DataFrame | None, codes: dict[str, dict | None],
                 sparse: dict[str, tuple[DataFrame, int]] | None = None):
        super().__init__()
        self.plan, self.maps, self.categories, self.state, self.codes = plan, maps, categories, state, codes
        self.sparse = sparse or {}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        new: dict[str, Column] = {}
        dropped: list[str] = []
        for feature, strategy in self.plan.items():
            if feature not in dataset.columns:
                continue
            value = F.col(feature).cast("string")
            if feature in self.sparse:
                out = _sparse_one_hot(out, feature, *self.sparse[feature])
                dropped.append(feature)
                continue
            if strategy == "one-hot":
                for v in self.categories[feature]:
                    new[one_hot_name(feature, v)] = F.coalesce(value == F.lit(v), F.lit(False)).cast("int")
                dropped.append(feature)
                continue
            whole = strategy != "frequency"
            unseen = F.lit(UNSEEN_CODE) if whole else F.lit(0.0)
            if feature in self.maps:
                code = _looked_up(value, self.maps[feature], whole)
                if any(isinstance(c, float) for c in self.maps[feature].values()):
                    unseen = unseen.cast("double")
            elif self.codes.get(feature, {}) is not None:
                known = self.codes.get(feature, {})
                code = _looked_up(value, {v: int(c) if whole else c for v, c in known.items()}, whole)
            else:
                lookup = self.state.where(F.col("feature") == feature).select(
                    F.col("value").alias(f"_v_{feature}"), F.col("code").cast("int" if whole else "double").alias(f"_c_{feature}")
                )
                out = out.join(lookup, value == F.col(f"_v_{feature}"), "left").drop(f"_v_{feature}")
                code = F.col(f"_c_{feature}")
            new[feature] = F.coalesce(code, unseen)
        shaped = replace_columns(out, new)
        return shaped.drop(*dropped, *[c for c in shaped.columns if c.startswith("_c_") and c not in dataset.columns])


def _sparse_one_hot(df: DataFrame, feature: str, codes: DataFrame, size: int) -> DataFrame:
    """Adds ``<feature>_onehot``, a sparse vector with one place per category and none set for an unknown one."""
    lookup = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    joined = df.join(lookup, F.col(feature).cast("string") == F.col("_value"), "left").withColumn(
        "_code", F.coalesce("_code", F.lit(size)).cast("double"))
    # the last place, that of unknown categories, is dropped
    if not size:  # no category was seen: a vector without places
        return joined.withColumn(f"{feature}_onehot", array_to_vector(F.array().cast("array<double>"))).drop("_value", "_code")
    fitted = OneHotEncoder(inputCols=["_code"], outputCols=[f"{feature}_onehot"], dropLast=True).fit(
        df.sparkSession.createDataFrame([(float(size),)], "_code double"))
    return fitted.transform(joined).drop("_value", "_code")


def _looked_up(value: Column, codes: Mapping, whole: bool) -> Column:
    if not codes:
        return F.lit(None).cast("int" if whole else "double")
    if any(isinstance(c, float) for c in codes.values()):
        codes = {k: float(c) for k, c in codes.items()}
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(c)) for k, c in codes.items()))
    return F.try_element_at(table, value)


def encoding_spec(settings: Mapping[str, Mapping], columns: Sequence[str]) -> tuple[dict, dict]:
    """(encoding_map, encoding_params) for the features that are present.

    ``settings`` holds per feature ``strategy`` and optionally ``alternatives`` and ``params``.
    """
    chosen, params = {}, {}
    for feature, entry in settings.items():
        if feature not in columns:
            warnings.warn(f"feature '{feature}' of the spec is not in the table", stacklevel=2)
            continue
        alternatives = entry.get("alternatives")
        chosen[feature] = (entry["strategy"], list(alternatives)) if alternatives else entry["strategy"]
        if "params" in entry:
            params[feature] = entry["params"]
    return chosen, params


class StandardScaler(Estimator):
    """Centres on the mean and divides by the population deviation (1 for a constant column)."""

    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, dataset: DataFrame) -> "StandardScalerModel":
        require_columns(dataset, self.columns)
        row = dataset.agg(*[
            F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in self.columns
        ]).first()
        return StandardScalerModel({c: (row[c]["mean"], row[c]["std"] or 1.0) for c in self.columns})


class StandardScalerModel(Model):
    def __init__(self, moments: dict[str, tuple[float, float]]):
        super().__init__()
        self.moments = moments

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return replace_columns(dataset, {
            c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in self.moments.items() if m is not None
        })
