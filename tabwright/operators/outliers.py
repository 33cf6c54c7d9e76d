"""Outlier handling: z-score clipping and removal, interquartile counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.base import Estimator, Model
from pyspark.sql import Column, DataFrame, functions as F

from tabwright.functions.types import get_numerical_features, metric_name, replace_columns, tall
from tabwright.operators.ranking import exact_quantiles

STRATEGIES = ("none", "clip", "remove")


def z_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, mean, std (sample form): one aggregate over all columns."""
    wide = df.agg(*[
        agg.alias(metric_name(c, m))
        for c in columns
        for m, agg in (("mean", F.avg(c)), ("std", F.stddev_samp(c)))
    ])
    return tall(wide, columns, ["mean", "std"])


def _clipped(column: Column, low: float, high: float) -> Column:
    # least/greatest skip NULL, so NULL is kept explicitly
    value = column.cast("double")
    return F.when(column.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


class OutlierHandler(Estimator):
    """Learns mean and standard deviation of numeric columns on the training rows.

    ``none`` leaves the rows alone, ``clip`` moves values beyond ``z_thresh`` standard deviations to
    that bound, ``remove`` drops rows holding such a value.
    """

    def __init__(self, strategy: str = "none", z_thresh: float = 3.0, columns: Sequence[str] | None = None,
                 exclude: Sequence[str] = ()):
        super().__init__()
        self.strategy, self.z_thresh = strategy, z_thresh
        self.columns, self.exclude = columns, tuple(exclude)

    def _fit(self, dataset: DataFrame) -> "OutlierModel":
        if self.strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {list(STRATEGIES)}")
        names = [c for c in (self.columns or get_numerical_features(dataset)) if c not in self.exclude]
        if self.strategy == "none":
            return OutlierModel("none", self.z_thresh, {})
        if not names:
            raise ValueError("no numeric columns found for outlier handling")
        moments = {r["feature"]: (r["mean"], r["std"]) for r in z_moments(dataset, names).collect()}
        constant = [c for c in names if moments[c][1] == 0]
        if constant:
            raise ValueError(f"constant columns have no z-score: {constant}")
        return OutlierModel(self.strategy, self.z_thresh, moments)


class OutlierModel(Model):
    def __init__(self, strategy: str, z_thresh: float, moments: dict[str, tuple[float, float]]):
        super().__init__()
        self.strategy, self.z_thresh, self.moments = strategy, z_thresh, moments

    def bounds(self) -> dict[str, tuple[float, float]]:
        known = {c: m for c, m in self.moments.items() if None not in m}
        return {c: (m - self.z_thresh * s, m + self.z_thresh * s) for c, (m, s) in known.items()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        limits = {c: b for c, b in self.bounds().items() if c in dataset.columns}
        if self.strategy == "none" or not limits:
            return dataset
        if self.strategy == "clip":
            return replace_columns(dataset, {c: _clipped(F.col(c), *b) for c, b in limits.items()})
        keep = F.lit(True)
        for c in limits:
            mean, std = self.moments[c]
            # a NULL has no z-score and fails the test, as it does in a dataframe comparison
            keep = keep & F.coalesce(F.abs((F.col(c) - F.lit(mean)) / F.lit(std)) <= F.lit(self.z_thresh), F.lit(False))
        return dataset.where(keep)


def iqr_outliers(df: DataFrame, columns: Sequence[str], whisker: float = 1.5, direct_rows: int | None = None,
                 quartiles: DataFrame | None = None) -> DataFrame:
    """Per column: quartile bounds, how many non-null values lie outside them, and their share.

    ``quartiles`` (feature, q with the first and third) may be given if they are known.
    """
    options = {} if direct_rows is None else {"direct_rows": direct_rows}
    quartiles = exact_quantiles(df, columns, [0.25, 0.75], **options) if quartiles is None else quartiles
    q = {r["feature"]: r["q"] for r in quartiles.collect()}
    fences = {}
    for c in columns:
        q1, q3 = q[c] if q.get(c) else (None, None)
        spread = None if q1 is None else q3 - q1
        fences[c] = (None, None) if q1 is None else (q1 - whisker * spread, q3 + whisker * spread)
    wide = df.agg(*[
        agg.alias(metric_name(c, m))
        for c in columns
        for m, agg in (
            ("lower_bound", F.lit(fences[c][0]).cast("double")),
            ("upper_bound", F.lit(fences[c][1]).cast("double")),
            ("n", F.count(c)),
            ("outliers", F.count_if((F.col(c) < F.lit(fences[c][0])) | (F.col(c) > F.lit(fences[c][1])))),
        )
    ])
    report = tall(wide, columns, ["lower_bound", "upper_bound", "n", "outliers"])
    share = F.col("outliers").cast("double") / F.nullif(F.col("n"), F.lit(0)).cast("double")
    return report.withColumn("outlier_pct", share * F.lit(100.0))
