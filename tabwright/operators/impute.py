"""Imputation from statistics and from nearest neighbours, with hold-out evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.ml.base import Estimator, Model
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabwright.functions.state import cut_lineage, local_frame, settle
from tabwright.functions.types import replace_columns, require_columns
from tabwright.operators.knn import k_nearest
from tabwright.operators.profile import numeric_columns_except
from tabwright.operators.ranking import cut_key, exact_quantiles, quota_cuts

UNKNOWN = "Unknown"


def impute_missing_values_for_categorical_features(df: DataFrame, categorical_columns: Sequence[str],
                                                   methods: Mapping[str, str]) -> DataFrame:
    """Fill by method: ``unknown_category`` writes 'Unknown', ``knn`` leaves the column for later."""
    require_columns(df, categorical_columns)
    new = {}
    for c in categorical_columns:
        method = methods.get(c)
        if method == "unknown_category":
            new[c] = F.coalesce(F.col(c), F.lit(UNKNOWN))
        elif method != "knn":
            raise ValueError(f"no valid imputation method for column '{c}': {method}")
    return replace_columns(df, new)


class SimpleImputer(Estimator):
    """Learns one fill value per column: the exact median, or the most frequent value (ties: smallest)."""

    def __init__(self, strategy: str, columns: Sequence[str]):
        super().__init__()
        if strategy not in ("median", "most_frequent"):
            raise ValueError(f"unknown strategy '{strategy}'")
        self.strategy, self.columns = strategy, list(columns)

    def _fit(self, dataset: DataFrame) -> "SimpleImputerModel":
        require_columns(dataset, self.columns)
        if self.strategy == "median":
            found = exact_quantiles(dataset, self.columns, [0.5]).collect()
            return SimpleImputerModel({r["feature"]: r["q"][0] for r in found if r["q"]})
        fills = {}
        cells = dataset.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in self.columns
        ]))).where(F.col("value").isNotNull())
        counts = cells.groupBy("feature", "value").count()
        place = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("count"), "value"))
        for r in counts.withColumn("_p", place).where(F.col("_p") == 1).collect():
            fills[r["feature"]] = r["value"]
        return SimpleImputerModel(fills)


class SimpleImputerModel(Model):
    def __init__(self, fills: dict):
        super().__init__()
        self.fills = fills

    def _transform(self, dataset: DataFrame) -> DataFrame:
        new = {}
        for c, fill in self.fills.items():
            if c in dataset.columns:
                kind = dataset.schema[c].dataType
                if isinstance(kind, T.NumericType):
                    new[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(fill)))
                else:
                    new[c] = F.coalesce(F.col(c), F.lit(fill))
        return replace_columns(dataset, new)


def _standardised(df: DataFrame, features: Sequence[str], gappy: Sequence[str]) -> DataFrame:
    """``_vec``: the features with medians in the gaps, centred and scaled by the population deviation."""
    values = {f: F.col(f).cast("double") for f in features}
    if gappy:
        for f, median in SimpleImputer("median", gappy).fit(df).fills.items():
            values[f] = F.coalesce(values[f], F.lit(float(median)))
    row = df.agg(*[
        F.struct(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std")).alias(f) for f, v in values.items()
    ]).first()
    return df.withColumn("_vec", F.array(*[
        (v - F.lit(row[f]["mean"])) / F.lit(row[f]["std"] or 1.0) for f, v in values.items()
    ]))


def require_ids(rows: DataFrame, id_col: str) -> None:
    """An error if an id is missing or occurs twice: a join on such ids would lose rows or multiply them."""
    bad = rows.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where(F.col(id_col).isNull() | (F.col("_n") > 1)).first()
    if bad is not None:
        what = "is missing" if bad[id_col] is None else f"{bad[id_col]!r} occurs {bad['_n']} times"
        raise ValueError(f"rows need one id each, but in '{id_col}' a value {what}")


def _search_input(df: DataFrame, column: str, id_col: str, feature_cols: Sequence[str] | None, label_col: str | None,
                  known: Column) -> tuple[DataFrame | None, float | None]:
    """(id, ``_vec``, ``_known``, ``_value``) of all rows for a search, stored; or, without any feature, the mean of the known values.

    ``_value`` is the column, ``_known`` the same as a double where ``known`` says so. Both results are None if that is everywhere.
    """
    require_columns(df, [column, id_col])
    if not isinstance(df.schema[column].dataType, T.NumericType):
        raise ValueError(f"column '{column}' is not numeric")
    target = F.when(known, F.col(column))
    features = list(feature_cols) if feature_cols else numeric_columns_except(df, column, id_col, label_col)
    filled = df.agg(
        F.count(F.lit(1)).alias("_rows"), F.count(target).alias("_known"), *[F.count(f).alias(f"_n_{f}") for f in features]
    ).first()
    if filled["_known"] == 0:
        raise ValueError(f"all values in column '{column}' are missing")
    if filled["_known"] == filled["_rows"]:
        return None, None
    # a column without any value cannot tell rows apart
    features = [f for f in features if filled[f"_n_{f}"]]
    gappy = [f for f in features if filled[f"_n_{f}"] < filled["_rows"]]
    if not features:
        return None, df.agg(F.avg(target.cast("double"))).scalar()
    require_ids(df.where(target.isNull()), id_col)
    rows = df.select(id_col, *features, target.cast("double").alias("_known"), F.col(column).alias("_value"))
    # the search reads donors and receivers several times
    return cut_lineage(_standardised(rows, features, gappy).select(id_col, "_vec", "_known", "_value")), None


def _finished(value: Column, kind: T.DataType) -> Column:
    return F.bround(value).cast(kind) if isinstance(kind, T.IntegralType) else value.cast(kind)


def _mean_of(neighbours: Column, kind: T.DataType) -> Column:
    total = F.aggregate(neighbours, F.lit(0.0), lambda total, n: total + n["payload"])
    return _finished(F.when(F.size(neighbours) > 0, total / F.size(neighbours)), kind)


def _knn_fills(df: DataFrame, column: str, k: int, id_col: str, feature_cols: Sequence[str] | None,
               label_col: str | None, options: dict) -> tuple[DataFrame | None, Column | None]:
    """What goes into the gaps of a column: (id, ``_fill``) for the rows with a gap, or one value for all of them."""
    ready, mean = _search_input(df, column, id_col, feature_cols, label_col, F.col(column).isNotNull())
    kind = df.schema[column].dataType
    if ready is None:
        return None, None if mean is None else _finished(F.lit(mean), kind)
    near = k_nearest(
        ready.where(F.col("_known").isNull()), ready.where(F.col("_known").isNotNull()), k,
        id_col=id_col, vector_col="_vec", payload="_known", **options,
    )
    return near.select(id_col, _mean_of(F.col("neighbours"), kind).alias("_fill")), None


def impute_knn(df: DataFrame, column_to_impute: str, n_neighbors: int = 5, *, id_col: str,
               feature_cols: Sequence[str] | None = None, label_col: str | None = None, **options) -> DataFrame:
    """Fill a numeric column with the mean of the k nearest rows that know it.

    Nearness is Euclidean over the other numeric columns (never the label). Known values and all
    other columns stay as they are; an integer column gets the mean rounded half to even. Rows with
    a gap need an id of their own; a missing or repeated one is an error.
    """
    fills, constant = _knn_fills(df, column_to_impute, n_neighbors, id_col, feature_cols, label_col, options)
    target = F.col(column_to_impute)
    if constant is not None:
        return df.withColumn(column_to_impute, F.coalesce(target, constant))
    if fills is None:
        return df
    # only rows with a gap are joined; all others pass without a shuffle
    done = df.where(target.isNull()).join(fills, id_col, "left").withColumn(column_to_impute, F.col("_fill")).select(*df.columns)
    return df.where(target.isNotNull()).unionByName(done)


def create_holdout_mask(df: DataFrame, column: str, holdout_fraction: float = 0.2, *, id_col: str,
                        seed: int = 42) -> DataFrame:
    """Adds ``is_holdout`` (a seeded share of the known values, rounded down) and ``holdout_value``."""
    known = df.where(F.col(column).isNotNull())
    n_known = known.count()
    quotas = local_frame(df.sparkSession, pa.table({
        "class_value": pa.array([0], pa.int32()), "name": ["holdout"],
        "quota": pa.array([int(n_known * holdout_fraction)], pa.int64()),
    }))
    cut = quota_cuts(known, [id_col], seed, quotas, n_rows=n_known).select("cut").scalar()
    held = F.coalesce(F.col(column).isNotNull() & (cut_key([id_col], seed) <= cut), F.lit(False))
    return df.withColumn("is_holdout", held).withColumn("holdout_value", F.when(F.col("is_holdout"), F.col(column)))


def evaluate_knn_imputation(df: DataFrame, column: str, holdout_fraction: float = 0.2, k: int = 3, *, id_col: str,
                            feature_cols: Sequence[str] | None = None, label_col: str | None = None, seed: int = 42,
                            **options) -> DataFrame:
    """One row of quality measures for imputing held-out values of a column.

    The shift of mean, deviation and quartiles is a percentage of the original value.
    """
    features = list(feature_cols) if feature_cols else numeric_columns_except(df, column, id_col, label_col)
    masked = create_holdout_mask(df.select(id_col, column, *features), column, holdout_fraction, id_col=id_col, seed=seed)
    blind = masked.withColumn(column, F.when(~F.col("is_holdout"), F.col(column)))
    imputed = impute_knn(blind, column, k, id_col=id_col, feature_cols=features, **options)
    # measured several times
    return _quality(df, cut_lineage(imputed.select(id_col, column, "is_holdout", "holdout_value")), column)


def _quality(df: DataFrame, imputed: DataFrame, column: str) -> DataFrame:
    """The measures, from the column before and a stored table of the column after, ``is_holdout`` and ``holdout_value``."""
    value = F.col(column).cast("double")

    def summary(frame: DataFrame):
        moments = frame.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")).first()
        q = exact_quantiles(frame, [column], [0.25, 0.75]).first()["q"]
        return moments["mean"], moments["std"], q[0], q[1]

    before, after = summary(df), summary(imputed)
    shift = [abs((b - a) / a * 100) if a else None for a, b in zip(before, after)]
    miss = value - F.col("holdout_value").cast("double")
    scored = imputed.where("is_holdout").agg(F.sqrt(F.avg(miss * miss)).alias("rmse"))
    names = ["delta_mean", "delta_std", "delta_25", "delta_75"]
    out = scored.select(
        F.lit(column).alias("column_name"), "rmse", *[F.lit(s).cast("double").alias(n) for n, s in zip(names, shift)]
    ).withColumn("distribution_score", sum((F.col(n) for n in names[1:]), F.col(names[0])) / F.lit(4.0))
    return out.withColumn("combined_score", F.col("rmse") * (F.lit(1.0) + F.col("distribution_score") / F.lit(100.0)))


def _fills_and_quality(df: DataFrame, column: str, holdout_fraction: float, k: int, id_col: str, label_col: str | None,
                       seed: int, options: dict) -> tuple[DataFrame | None, Column | None, DataFrame] | None:
    """What ``_knn_fills`` and ``evaluate_knn_imputation`` give, from one preparation of the rows and without a second search
    among most donors; None where there are no gaps, or no neighbours to look for.

    Predictors are the same with and without held-out values. The nearest donors of a gap are among the nearest that
    were not held out, which the evaluation looks for, and the nearest held-out ones.
    """
    require_columns(df, [column, id_col])
    kind = df.schema[column].dataType
    if not isinstance(kind, T.NumericType) or not numeric_columns_except(df, column, id_col, label_col):
        return None
    features = numeric_columns_except(df, column, id_col, label_col)
    masked = create_holdout_mask(df.select(id_col, column, *features), column, holdout_fraction, id_col=id_col, seed=seed)
    blind = F.col(column).isNotNull() & ~F.col("is_holdout")
    ready, _ = _search_input(masked, column, id_col, features, None, blind)
    if ready is None:
        return None
    gap, held = F.col("_value").isNull(), F.col("_value").isNotNull() & F.col("_known").isNull()
    found = dict(id_col=id_col, vector_col="_vec", payload="_known", **options)
    near = cut_lineage(k_nearest(ready.where(gap | held), ready.where(F.col("_known").isNotNull()), k, **found))
    scored = ready.select(id_col, F.col("_value").alias(column), held.alias("is_holdout"), F.when(held, F.col("_value")).alias("holdout_value"))
    fills = near.select(id_col, _mean_of(F.col("neighbours"), kind).alias("_fill"))
    missing = F.col(column).isNull() | F.col("is_holdout")
    filled = scored.where(missing).join(fills, id_col, "left").withColumn(column, F.col("_fill")).select(*scored.columns)
    quality = settle(_quality(df, cut_lineage(scored.where(~missing).unionByName(filled)), column))
    gaps = ready.where(gap)
    if not gaps.limit(1).count():
        return None, None, quality
    if ready.where(held).limit(1).count():
        told = ready.where(held).withColumn("_known", F.col("_value").cast("double"))
        others = k_nearest(gaps, told, k, **found).select(id_col, F.col("neighbours").alias("_held"))
        both = F.slice(F.array_sort(F.concat("neighbours", "_held")), 1, k)
        near = near.join(others, id_col).select(id_col, both.alias("neighbours"))
    return near.select(id_col, _mean_of(F.col("neighbours"), kind).alias("_fill")), None, quality


def apply_and_evaluate_knn_imputation(df: DataFrame, columns: Sequence[str], holdout_fraction: float = 0.2, k: int = 3,
                                      *, id_col: str, label_col: str | None = None, seed: int = 42, **options) -> tuple[DataFrame, DataFrame]:
    """Impute the gaps of each column and measure the quality on held-out values.

    A column that cannot be imputed, for whatever reason, keeps its gaps and is reported with its error. The fills of
    all columns are put together and joined once, to the rows with a gap.
    """
    result, fills, values = None, [], {}
    for column in columns:
        try:
            # predictors come from the table as it was, not from columns filled earlier
            if by_one := _fills_and_quality(df, column, holdout_fraction, k, id_col, label_col, seed, options):
                found, constant, report = by_one
            else:
                found, constant = _knn_fills(df, column, k, id_col, None, label_col, options)
                report = settle(evaluate_knn_imputation(df, column, holdout_fraction, k, id_col=id_col, label_col=label_col, seed=seed, **options))
            if found is not None:  # computed here, so that an error in a task concerns this column only
                found = cut_lineage(found)
            report = report.withColumn("error", F.lit(None).cast("string"))
        except Exception as failure:  # noqa: BLE001  (one column must not end the run for the others)
            report = df.sparkSession.range(1).select(
                F.lit(column).alias("column_name"),
                *[F.lit(None).cast("double").alias(c) for c in (
                    "rmse", "delta_mean", "delta_std", "delta_25", "delta_75", "distribution_score", "combined_score")],
                F.lit(str(failure)).alias("error"),
            )
        else:
            if constant is not None:
                values[column] = constant
            elif found is not None:
                fills.append(column)
                part = found.select(id_col, F.lit(column).alias("_column"), F.col("_fill").cast("double").alias("_fill"))
                gathered = part if len(fills) == 1 else gathered.unionByName(part)
        result = report if result is None else result.unionByName(report)
    if fills:
        by_id = gathered.groupBy(id_col).agg(*[F.max(F.when(F.col("_column") == c, F.col("_fill"))).alias(f"_fill_{c}") for c in fills])
        some = F.lit(False)
        for c in fills:
            some = some | F.col(c).isNull()
        filled = df.where(some).join(by_id, id_col, "left").withColumns(
            {c: F.coalesce(c, F.col(f"_fill_{c}").cast(df.schema[c].dataType)) for c in fills}).select(*df.columns)
        df = df.where(~some).unionByName(filled)
    return df.withColumns({c: F.coalesce(c, v) for c, v in values.items()}) if values else df, result
