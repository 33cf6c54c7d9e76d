"""Shape of numeric distributions and how well features separate the classes."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabwright.functions.state import settle
from tabwright.functions.types import metric_name, tall
from tabwright.operators.correlate import correlation_pairs, target_correlation
from tabwright.operators.outliers import iqr_outliers
from tabwright.operators.profile import ladder, numeric_by_class
from tabwright.operators.ranking import exact_quantiles

GRID_POINTS = 1000
PEAK_DIGITS = 9
# Bins in a bandwidth, terms of the series inside a bin, and bandwidths beyond which a kernel counts as zero.
BINS_PER_WIDTH = 16
TERMS = 6
REACH = 7.5


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.agg(*[
        agg.alias(metric_name(c, m))
        for c in columns
        for m, agg in (
            ("n", F.count(c).cast("double")), ("min", F.min(c).cast("double")), ("max", F.max(c).cast("double")),
            ("mean", F.avg(c)), ("std", F.stddev_samp(c)), ("g1", F.skewness(c)), ("g2", F.kurtosis(c)),
        )
    ])
    return tall(wide, columns, ["n", "min", "max", "mean", "std", "g1", "g2"])


def adjusted_skew() -> Column:
    """Sample skewness from the population one; 0 for a constant column, NULL below three rows."""
    n, g1 = F.col("n"), F.col("g1")
    value = F.sqrt(n * (n - F.lit(1.0))) / (n - F.lit(2.0)) * g1
    return F.when(n >= 3, F.when(F.col("std") == 0, F.lit(0.0)).otherwise(value))


def adjusted_kurtosis() -> Column:
    """Sample excess kurtosis; 0 for a constant column, NULL below four rows."""
    n, g2 = F.col("n"), F.col("g2")
    value = (n - F.lit(1.0)) / ((n - F.lit(2.0)) * (n - F.lit(3.0))) * ((n + F.lit(1.0)) * g2 + F.lit(6.0))
    return F.when(n >= 4, F.when(F.col("std") == 0, F.lit(0.0)).otherwise(value))


def basic_stats(df: DataFrame, columns: Sequence[str], moments: DataFrame | None = None, medians: DataFrame | None = None) -> DataFrame:
    """min, max, mean, median, skew and kurtosis per column. ``moments`` and ``medians`` (feature, median) if they are known."""
    medians = exact_quantiles(df, columns, [0.5]).select("feature", F.col("q")[0].alias("median")) if medians is None else medians
    return (_moments(df, columns) if moments is None else moments).join(medians, "feature", "left").select(
        "feature", "min", "max", "mean", "median",
        adjusted_skew().alias("skew"), adjusted_kurtosis().alias("kurtosis"),
    )


def normality_test(df: DataFrame, columns: Sequence[str], alpha: float = 0.05, moments: DataFrame | None = None) -> DataFrame:
    """Jarque-Bera over all rows: statistic, p-value, verdict and a name for the shape."""
    stats = (_moments(df, columns) if moments is None else moments).withColumn("skew", adjusted_skew())
    jb = F.col("n") / F.lit(6.0) * (F.col("g1") * F.col("g1") + F.col("g2") * F.col("g2") / F.lit(4.0))
    shape = (
        F.when(F.col("is_normal"), F.lit("approximately normal"))
        .when(F.col("skew") > 1, F.lit("skewed to the right"))
        .when(F.col("skew") < -1, F.lit("skewed to the left"))
        .otherwise(F.lit("not normal, not highly skewed"))
    )
    return stats.withColumn("statistic", jb).withColumn("p_value", F.exp(-F.col("statistic") / F.lit(2.0))).withColumn(
        "is_normal", F.col("p_value") > F.lit(float(alpha))
    ).select("feature", "statistic", "p_value", "is_normal", shape.alias("shape"))


def kernel_density(df: DataFrame, columns: Sequence[str], points: int = GRID_POINTS, moments: DataFrame | None = None) -> DataFrame:
    """Gaussian density at ``points`` even places from minimum to maximum, with Scott's bandwidth.

    Values are summed up in bins of a sixteenth of the bandwidth: their number and the powers one to six of their distance from
    the middle. The kernel of a value is the kernel of its bin's middle times a series in that distance (Hermite
    polynomials), and reaches ``REACH`` bandwidths. Per value the error is below 1e-12 of the kernel's height, so that is the error
    of the density in units of 1 / (width * sqrt(2 pi)), at any number of rows. After the one aggregate, work depends on
    the number of bins and places only.
    """
    spans = {r["feature"]: r for r in (_moments(df, columns) if moments is None else moments).collect()}
    usable = [c for c in columns if spans[c]["n"] >= 2 and spans[c]["std"]]
    if not usable:
        raise ValueError("no column with spread")
    last, cells = points - 1, []
    for c in usable:
        s = spans[c]
        width = s["std"] * s["n"] ** (-0.2)
        cells.append(F.struct(
            F.lit(c).alias("feature"), ((F.col(c).cast("double") - F.lit(s["min"])) / F.lit(width)).alias("u"),
            F.lit(s["min"]).alias("low"), F.lit((s["max"] - s["min"]) / last).alias("step"), F.lit(width).alias("width"), F.lit(s["n"]).alias("n"),
        ))
    places = df.select(F.inline(F.array(*cells))).where(F.col("u").isNotNull())
    places = places.withColumn("bin", F.floor(F.col("u") * BINS_PER_WIDTH))
    middle = (F.col("bin") + F.lit(0.5)) / F.lit(float(BINS_PER_WIDTH))
    known = ["feature", "low", "step", "width", "n"]
    powers = [F.sum(F.pow(F.col("u") - middle, F.lit(float(k)))).alias(f"p{k}") for k in range(1, TERMS + 1)]
    bins = places.groupBy(*known, "bin").agg(F.count(F.lit(1)).cast("double").alias("p0"), *powers).withColumn("middle", middle)
    grid = F.col("step") / F.col("width")  # between places, in bandwidths
    first = F.greatest(F.lit(0), F.ceil((F.col("middle") - F.lit(REACH)) / grid)).cast("int")
    final = F.least(F.lit(last), F.floor((F.col("middle") + F.lit(REACH)) / grid)).cast("int")
    near = bins.where(first <= final).withColumn("point", F.explode(F.sequence(first, final)))
    near = near.withColumn("z", F.col("point") * grid - F.col("middle"))
    # Hermite polynomials, each from the two before it
    hermite = [F.lit(1.0), F.col("z")]
    for k in range(1, TERMS):
        near = near.withColumn(f"h{k + 1}", F.col("z") * hermite[k] - F.lit(float(k)) * hermite[k - 1])
        hermite.append(F.col(f"h{k + 1}"))
    series = F.col("p0")
    for k in range(1, TERMS + 1):
        series = series + F.col(f"p{k}") * hermite[k] / F.lit(float(math.factorial(k)))
    mass = near.select(*known, "point", (F.exp(F.col("z") * F.col("z") * F.lit(-0.5)) * series).alias("mass"))
    # places that no value reaches have no density, but a row
    every = df.sparkSession.createDataFrame(
        [(c, spans[c]["min"], (spans[c]["max"] - spans[c]["min"]) / last, spans[c]["std"] * spans[c]["n"] ** (-0.2), spans[c]["n"]) for c in usable],
        "feature string, low double, step double, width double, n double").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("point"), F.lit(0.0).alias("mass"))
    return mass.unionByName(every).groupBy(*known, "point").agg(F.sum("mass").alias("mass")).select(
        "feature", "point", (F.col("low") + F.col("point") * F.col("step")).alias("x"),
        (F.greatest("mass", F.lit(0.0)) / (F.col("n") * F.col("width") * F.lit(math.sqrt(2 * math.pi)))).alias("density"),
    )


def density_peaks(density: DataFrame) -> DataFrame:
    """Local maxima of a density: one row per peak, at the middle of a flat top.

    Heights are compared relative to the highest point, to nine digits.
    """
    line = Window.partitionBy("feature").orderBy("point")
    height = F.round(F.col("density") / F.max("density").over(Window.partitionBy("feature")), PEAK_DIGITS)
    flat = density.withColumn("height", height)
    # first point of every level stretch
    level = flat.withColumn("_before", F.lag("height").over(line)).where(
        F.col("_before").isNull() | (F.col("_before") != F.col("height"))
    )
    runs = level.withColumns({
        "_left": F.lag("height").over(line), "_right": F.lead("height").over(line), "_next": F.lead("point").over(line),
    })
    tops = runs.where((F.col("_left") < F.col("height")) & (F.col("_right") < F.col("height"))).select(
        "feature", F.floor((F.col("point") + F.col("_next") - F.lit(1)) / F.lit(2)).cast("int").alias("point")
    )
    return tops.join(density, ["feature", "point"]).select(
        "feature", F.row_number().over(line).alias("peak_no"), "point", "x"
    )


def multimodality(df: DataFrame, columns: Sequence[str], points: int = GRID_POINTS, moments: DataFrame | None = None) -> DataFrame:
    """Peaks per column and whether there is more than one."""
    peaks = density_peaks(kernel_density(df, columns, points, moments)).groupBy("feature").agg(F.count(F.lit(1)).alias("found"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    several = F.coalesce(F.col("found") > 1, F.lit(False))
    return names.join(peaks, "feature", "left").select(
        "feature", several.alias("is_multimodal"),
        F.when(several, F.col("found")).otherwise(F.lit(1)).cast("bigint").alias("num_peaks"),
    )


def normal_qq(df: DataFrame, columns: Sequence[str], points: int = 100) -> DataFrame:
    """Sample quantiles against those of a standard normal, at evenly spaced probabilities."""
    probs = [(i + 0.5) / points for i in range(points)]
    theory = [NormalDist().inv_cdf(p) for p in probs]
    table = F.array(*[
        F.struct(F.lit(i).alias("point"), F.lit(p).alias("prob"), F.lit(t).alias("theoretical"))
        for i, (p, t) in enumerate(zip(probs, theory))
    ])
    paired = F.zip_with(table, F.col("q"), lambda t, q: F.struct(t["point"], t["prob"], t["theoretical"], q.alias("sample")))
    return exact_quantiles(df, columns, probs).select("feature", F.inline(paired).alias("point", "prob", "theoretical", "sample"))


# Separation and relationship limits and their names, highest first.
SEPARATION_LEVELS = (
    (1.2, "Excellent separation"), (0.8, "Good separation"), (0.5, "Moderate separation"), (0.2, "Weak separation"),
)
POOR_SEPARATION = "Poor separation"
RELATION_LEVELS = ((0.7, "Strong relationship"), (0.4, "Moderate relationship"), (0.2, "Weak relationship"))
NO_RELATION = "Very weak or no linear relationship"


def class_separation(df: DataFrame, columns: Sequence[str], label_col: str) -> DataFrame:
    """Mean effect size over all pairs of classes, per column (only class summaries are paired)."""
    summary = numeric_by_class(df.where(F.col(label_col).isNotNull()), columns, label_col)
    per_feature = summary.groupBy("feature").agg(
        F.array_sort(F.collect_list(F.struct(F.col(label_col), "mean", "std"))).alias("c")
    )
    later = lambda i: F.slice("c", i + 2, F.size("c"))

    def effect(a, b):
        pooled = F.sqrt((a["std"] * a["std"] + b["std"] * b["std"]) / F.lit(2.0))
        return F.abs(a["mean"] - b["mean"]) / F.nullif(pooled, F.lit(0.0))

    effects = F.flatten(F.transform("c", lambda a, i: F.transform(later(i), lambda b: effect(a, b))))
    listed = per_feature.select("feature", F.explode_outer(effects).alias("d"))
    return listed.groupBy("feature").agg(F.avg("d").alias("effect_size")).withColumn(
        "separation",
        F.when(F.col("effect_size").isNull(), F.lit("Cannot determine")).otherwise(
            ladder(F.col("effect_size"), SEPARATION_LEVELS, POOR_SEPARATION)
        ),
    )


def target_relationship(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """|correlation| with a continuous target and its name, from one aggregate."""
    wide = df.agg(*[
        F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(metric_name(c, "r")) for c in columns
    ])
    return tall(wide, columns, ["r"]).withColumn("relationship", ladder(F.abs("r"), RELATION_LEVELS, NO_RELATION))


def choose_features(df: DataFrame, target: str, numeric: Sequence[str], important: Sequence[str] | None = None,
                    top_n: int = 20) -> list[str]:
    """The given features that are numeric, or those closest to the target; at most ``top_n``."""
    if important is not None:
        return [f for f in important if f in numeric][:top_n]
    return [r["feature"] for r in ranked_by_target(df, target, numeric, top_n).collect()]


def ranked_by_target(df: DataFrame, target: str, numeric: Sequence[str], top_n: int = 20) -> DataFrame:
    wide = df.agg(*[
        F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(metric_name(c, "r")) for c in numeric
    ])
    return tall(wide, numeric, ["r"]).orderBy(F.abs("r").desc_nulls_last(), "feature").limit(top_n)


def feature_report(df: DataFrame, columns: Sequence[str], label_col: str, classification: bool = True) -> DataFrame:
    """One row per feature: moments, normality, modes, outliers and class separation.

    Scans of the table: moments, quartiles, bins of the densities, rows outside the fences, and the classes.
    """
    moments = settle(_moments(df, columns))
    quartiles = settle(exact_quantiles(df, columns, [0.25, 0.5, 0.75]))
    if classification:
        apart = class_separation(df, columns, label_col).select(
            "feature", F.col("effect_size").alias("separation_value"), "separation")
    else:
        apart = target_relationship(df, columns, label_col).select(
            "feature", F.abs("r").alias("separation_value"), F.col("relationship").alias("separation"))
    return (
        basic_stats(df, columns, moments, quartiles.select("feature", F.col("q")[1].alias("median")))
        .join(normality_test(df, columns, moments=moments).select("feature", "p_value", "is_normal"), "feature")
        .join(multimodality(df, columns, moments=moments), "feature")
        .join(iqr_outliers(df, columns, quartiles=quartiles.select("feature", F.array(F.col("q")[0], F.col("q")[2]).alias("q")))
              .select("feature", "outliers", "outlier_pct"), "feature")
        .join(apart, "feature")
    )


def transformation_advice(report: DataFrame, classification: bool = True) -> DataFrame:
    """What to do with each feature, as a list."""
    weak, fair = (0.2, 0.5) if classification else (0.1, 0.3)
    value = F.col("separation_value")
    steps = F.array(
        F.when(F.col("skew") > 1, F.lit("log1p")).when(F.col("skew") < -1, F.lit("square")),
        F.when(F.col("outlier_pct") > 5, F.lit("clip outliers")),
        F.when(F.col("is_multimodal"), F.lit("bin by modes")),
        F.when(value < weak, F.lit("drop")).when(value < fair, F.lit("engineer")).when(value.isNotNull(), F.lit("keep")),
    )
    return report.select("feature", F.array_compact(steps).alias("advice"))


def feature_lists(report: DataFrame) -> DataFrame:
    """list_name, feature, value for good separators, skewed, outlying and multimodal features."""
    entries = F.array_compact(F.array(
        F.when(F.col("separation_value") > 0.5, F.struct(F.lit("good_separators").alias("list_name"), F.col("separation_value").alias("value"))),
        F.when(F.abs("skew") > 1, F.struct(F.lit("skewed_features").alias("list_name"), F.col("skew").alias("value"))),
        F.when(F.col("outlier_pct") > 5, F.struct(F.lit("outlier_features").alias("list_name"), F.col("outlier_pct").alias("value"))),
        F.when(F.col("is_multimodal"), F.struct(
            F.lit("multimodal_features").alias("list_name"), F.col("num_peaks").cast("double").alias("value"))),
    ))
    return report.select("feature", F.inline(entries)).select("list_name", "feature", "value").orderBy(
        "list_name", F.desc("value"), "feature"
    )


def correlations_with(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    return target_correlation(correlation_pairs(df, [*columns, target]), target)
