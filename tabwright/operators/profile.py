"""Profiling aggregates: missing values, categories, numeric summaries, class balance."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabwright.functions.state import settle, small_rows
from tabwright.functions.types import dtype_name, get_numerical_features, metric_name, tall
from tabwright.operators.ranking import exact_quantiles

# tasks get the code of this module with them, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MISSING_LABEL = "Missing"
# Different values a task holds before it hands them on.
HELD_VALUES = 2_000_000


def percent(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * F.lit(100.0)


def two_decimals(value: Column) -> Column:
    """Rounded to two digits, a half to the even neighbour."""
    return F.rint(value * F.lit(100.0)) / F.lit(100.0)


def missing_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percentage of every column, from one aggregate."""
    names = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names]
    )
    records = F.array(*[
        F.struct(
            F.lit(c).alias("feature"), F.col(f"`{c}`").alias("missing_count"),
            percent(F.col(f"`{c}`"), F.col("_rows")).alias("missing_percentage"),
            F.lit(dtype_name(df, c)).alias("dtype"),
        )
        for c in names
    ])
    return counted.select(F.inline(records))


def analyze_missing_values(df: DataFrame) -> DataFrame:
    """Columns that miss values, worst first."""
    report = missing_share(df).where(F.col("missing_count") > 0)
    return report.withColumn("missing_percentage", two_decimals(F.col("missing_percentage"))).orderBy(
        F.desc("missing_percentage"), "feature"
    )


def _long(df: DataFrame, columns: Sequence[str], missing_label: str | None = None) -> DataFrame:
    def text(c: str) -> Column:
        value = F.col(f"`{c}`").cast("string")
        return value if missing_label is None else F.coalesce(value, F.lit(missing_label))

    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), text(c).alias("category")) for c in columns
    ])))


def unique_categories(df: DataFrame, columns: Sequence[str], show_all_up_to: int = 35, sample: int = 10) -> DataFrame:
    """Distinct non-null values per column: all of them, or the first ten when there are many."""
    values = _long(df, columns).where(F.col("category").isNotNull()).distinct()
    sizes = values.groupBy("feature").agg(F.count(F.lit(1)).alias("n_unique"))
    rank = F.row_number().over(Window.partitionBy("feature").orderBy("category"))
    shown = values.withColumn("value_rank", rank).where(F.col("value_rank") <= show_all_up_to)
    return shown.join(sizes, "feature").where(
        (F.col("n_unique") <= show_all_up_to) | (F.col("value_rank") <= sample)
    ).select("feature", "n_unique", "value_rank", F.col("category").alias("value"))


def category_shares(df: DataFrame, columns: Sequence[str], missing_label: str | None = MISSING_LABEL) -> DataFrame:
    """Count and percentage of every category of every column, missing values as a category."""
    counts = _long(df, columns, missing_label).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)))
    return counts.withColumn("percentage", percent(F.col("n"), total.scalar()))


def proportion_of_unique_categories(df: DataFrame, columns: Sequence[str], top: int = 10) -> DataFrame:
    """Proportions, of the most frequent categories only where a column has more than ``top``."""
    ranked = category_shares(df, columns).withColumn(
        "rank", F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "category"))
    )
    return ranked.where(F.col("rank") <= top).select(
        "feature", "rank", "category", "n", (F.col("percentage") / F.lit(100.0)).alias("proportion")
    )


def top_n_categories(df: DataFrame, column: str, top_n: int = 35) -> DataFrame:
    """The most frequent categories with running coverage of the table."""
    top = category_shares(df, [column]).orderBy(F.desc("n"), "category").limit(top_n)
    order = Window.orderBy(F.desc("n"), "category")  # at most top_n rows
    return top.select(
        F.row_number().over(order).alias("rank"), "category", F.col("n").alias("count"), "percentage",
        F.sum("percentage").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative_percentage"),
    )


def cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, exact or by sketch (fixed memory, no extra rows).

    The exact form is one scan of any number of columns: each task keeps the different values of its rows, column by
    column, and only those are shuffled, by (column, value), so a column with many values spreads over all tasks.
    """
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(metric_name(c, "n_unique")) for c in columns])
        return tall(wide, columns, ["n_unique"])
    texts = df.select([_as_text(F.col(f"`{c}`"), df.select(f"`{c}`").schema[0].dataType).alias(f"_{i}") for i, c in enumerate(columns)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.Array]] = {}
        size = 0

        def rows(column: int) -> pa.RecordBatch:
            values = pc.unique(pa.chunked_array(held.pop(column)))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(values), column, np.int32)), values], names=["column", "value"])

        for batch in batches:
            for column, values in enumerate(batch.columns):
                held.setdefault(column, []).append(pc.unique(values).drop_null())
                size += len(held[column][-1])
            if size > HELD_VALUES:  # first what the batches have in common, then, if that is little, everything
                held = {c: [pc.unique(pa.chunked_array(parts))] for c, parts in held.items()}
                size = sum(len(parts[0]) for parts in held.values())
                if size > HELD_VALUES // 2:
                    yield from (rows(c) for c in list(held))
                    size = 0
        yield from (rows(c) for c in list(held))

    values = texts.mapInArrow(work, "column int, value string").distinct()
    counts = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(columns)], "column int, feature string")
    return names.join(counts, "column", "left").select("feature", F.coalesce("n_unique", F.lit(0).cast("bigint")).alias("n_unique"))


def _as_text(column: Column, kind: T.DataType) -> Column:
    """A text that is equal exactly for equal values."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):  # 0.0 and -0.0 are equal
        column = F.when(column == 0, F.lit(0.0)).otherwise(column)
    elif isinstance(kind, T.TimestampType):  # local times repeat when clocks are set back
        column = F.unix_micros(column)
    elif isinstance(kind, T.BinaryType):
        column = F.hex(column)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        column = F.when(column.isNotNull(), F.to_json(F.struct(column.alias("v"))))
    return column.cast("string")


def describe_numeric(df: DataFrame, columns: Sequence[str], direct_rows: int | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max per column."""
    wide = df.agg(*[
        agg.alias(metric_name(c, m))
        for c in columns
        for m, agg in (
            ("count", F.count(c)), ("mean", F.avg(c)), ("std", F.stddev_samp(c)),
            ("min", F.min(c).cast("double")), ("max", F.max(c).cast("double")),
        )
    ])
    moments = tall(wide, columns, ["count", "mean", "std", "min", "max"])
    options = {} if direct_rows is None else {"direct_rows": direct_rows}
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], **options)
    return moments.join(quartiles, "feature", "left").select(
        "feature", "count", "mean", "std", "min",
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max",
    )


def class_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """Rows and share per class, in class order."""
    total = df.agg(F.count(F.lit(1)))
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("percentage", percent(F.col("count"), total.scalar())).orderBy(label_col)


def numeric_by_class(df: DataFrame, columns: Sequence[str], label_col: str) -> DataFrame:
    """count, mean, std, min, max of each column within each class: one aggregate."""
    wide = df.groupBy(label_col).agg(*[
        agg.alias(metric_name(c, m))
        for c in columns
        for m, agg in (
            ("count", F.count(c)), ("mean", F.avg(c)), ("std", F.stddev_samp(c)),
            ("min", F.min(c).cast("double")), ("max", F.max(c).cast("double")),
        )
    ])
    return tall(wide, columns, ["count", "mean", "std", "min", "max"], by=[label_col])


def target_by_category(df: DataFrame, column: str, target: str, missing_label: str = MISSING_LABEL) -> DataFrame:
    """Summary of the target within each category, with the category's share of the rows."""
    total = df.agg(F.count(F.lit(1)))
    category = F.coalesce(F.col(column).cast("string"), F.lit(missing_label)).alias("category")
    grouped = df.groupBy(category).agg(
        F.count(target).alias("count"), F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"),
        F.min(target).cast("double").alias("min"), F.max(target).cast("double").alias("max"),
        F.count(F.lit(1)).alias("_rows"),
    )
    return grouped.withColumn("percentage", two_decimals(percent(F.col("_rows"), total.scalar()))).drop("_rows")


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r")).select(
        F.lit(a).alias("feature"), F.lit(b).alias("target"), "r"
    )


def linear_fit(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Least-squares line of the target on each column."""
    y = F.col(target).cast("double")
    wide = df.agg(*[
        agg.alias(metric_name(c, m))
        for c in columns
        for m, agg in (
            ("slope", F.regr_slope(y, F.col(c).cast("double"))),
            ("intercept", F.regr_intercept(y, F.col(c).cast("double"))),
            ("r2", F.regr_r2(y, F.col(c).cast("double"))),
        )
    ])
    return tall(wide, columns, ["slope", "intercept", "r2"])


def _bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based equal-width bin, the last one closed on both sides."""
    raw = F.floor((value - low) / (high - low) * F.lit(float(bins))) + F.lit(1)
    return F.when(high > low, F.least(raw, F.lit(bins))).otherwise(F.lit(1)).cast("int")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30,
              ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Rows per equal-width bin between each column's minimum and maximum (or a given range)."""
    if ranges is None:
        found = df.agg(*[
            F.struct(F.min(c).cast("double"), F.max(c).cast("double")).alias(c) for c in columns
        ]).first()
        ranges = {c: tuple(found[c]) for c in columns}
    known = [c for c in columns if None not in ranges[c]]
    records = []
    for c in known:
        low, high = F.lit(ranges[c][0]).cast("double"), F.lit(ranges[c][1]).cast("double")
        value = F.col(c).cast("double")
        width = (high - low) / F.lit(float(bins))
        place = F.when(value.between(low, high), _bin_of(value, low, high, bins))
        records.append(F.struct(
            F.lit(c).alias("feature"), place.alias("bin"), low.alias("_low"), width.alias("_width"),
        ))
    cells = df.select(F.inline(F.array(*records))).where(F.col("bin").isNotNull())
    counts = cells.groupBy("feature", "bin", "_low", "_width").agg(F.count(F.lit(1)).alias("n"))
    edge = lambda k: F.col("_low") + F.col("_width") * k.cast("double")
    return counts.select(
        "feature", "bin", edge(F.col("bin") - 1).alias("bin_low"), edge(F.col("bin")).alias("bin_high"), "n"
    )


def box_plot(df: DataFrame, columns: Sequence[str], by: str | None = None, whisker: float = 1.5,
             direct_rows: int | None = None) -> DataFrame:
    """Quartiles, whisker ends and flier count per column, overall or by class."""
    keys = [by] if by else []
    options = {} if direct_rows is None else {"direct_rows": direct_rows}
    quartiles = settle(exact_quantiles(df, columns, [0.25, 0.5, 0.75], by=keys, **options))
    wide = quartiles.groupBy(*keys).agg(*[
        F.first(F.when(F.col("feature") == c, F.col("q")), ignorenulls=True).alias(f"_q_{c}") for c in columns
    ])
    wide = settle(wide)
    if by:
        renamed = wide.withColumnRenamed(by, "_by")
        joined = df.select(by, *columns).join(renamed, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
    else:
        row = wide.first()
        joined = df.select(*columns, *[
            F.array(*[F.lit(v) for v in (row[f"_q_{c}"] or [None] * 3)]).cast("array<double>").alias(f"_q_{c}")
            for c in columns
        ])

    aggregates = []
    for c in columns:
        q1, q3 = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[2]
        value = F.col(c).cast("double")
        inside = value.between(q1 - F.lit(whisker) * (q3 - q1), q3 + F.lit(whisker) * (q3 - q1))
        aggregates += [
            F.first(F.col(f"_q_{c}")).alias(metric_name(c, "quart")),
            F.min(F.when(inside, value)).alias(metric_name(c, "whisker_low")),
            F.max(F.when(inside, value)).alias(metric_name(c, "whisker_high")),
            F.count_if(~inside).alias(metric_name(c, "fliers")),
        ]
    report = tall(joined.groupBy(*keys).agg(*aggregates), columns,
                  ["quart", "whisker_low", "whisker_high", "fliers"], by=keys)
    return report.select(
        *keys, "feature", "whisker_low", F.col("quart")[0].alias("q1"), F.col("quart")[1].alias("median"),
        F.col("quart")[2].alias("q3"), "whisker_high", "fliers",
    )


# Imbalance limits and their names, highest first.
IMBALANCE_LEVELS = ((50.0, "Extreme imbalance"), (10.0, "High imbalance"), (3.0, "Moderate imbalance"))
BALANCED = "Relatively balanced"
# Advice per limit.
IMBALANCE_ADVICE = (
    (10.0, "resample, weight classes, use F1 or AUC"),
    (3.0, "weight classes, use F1 or AUC"),
)
NO_ADVICE = "standard modelling"


def ladder(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The name of the first limit the value exceeds."""
    chain = F.when(value > F.lit(steps[0][0]), F.lit(steps[0][1]))
    for limit, name in steps[1:]:
        chain = chain.when(value > F.lit(limit), F.lit(name))
    return chain.otherwise(F.lit(otherwise))


def class_imbalance(df: DataFrame, label_col: str) -> DataFrame:
    """Largest class over smallest class, with its level and advice (one row)."""
    sizes = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    one = sizes.agg(
        F.count(F.lit(1)).alias("n_classes"), F.max("n").alias("largest"), F.min("n").alias("smallest"),
    ).withColumn("imbalance_ratio", F.col("largest").cast("double") / F.col("smallest").cast("double"))
    return one.withColumn("level", ladder(F.col("imbalance_ratio"), IMBALANCE_LEVELS, BALANCED)).withColumn(
        "advice", ladder(F.col("imbalance_ratio"), IMBALANCE_ADVICE, NO_ADVICE)
    )


def target_profile(df: DataFrame, target: str, max_classes: int = 10, bins: int = 5) -> DataFrame:
    """Class counts, or counts over equal-width bins when a numeric target has many values.

    Bins are right-closed; the lowest value belongs to the first one.
    """
    numeric = isinstance(df.schema[target].dataType, T.NumericType)
    distinct = df.select(target).distinct().limit(max_classes + 1).count() if numeric else 0
    total = df.agg(F.count(F.lit(1)))
    if distinct > max_classes:
        value = F.col(target).cast("double")
        low, high = df.agg(F.min(value), F.max(value)).first()
        width = (high - low) / bins
        place = F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil((value - F.lit(low)) / F.lit(width)).cast("int")))
        grouped = df.where(value.isNotNull()).groupBy(place.cast("string").alias("class_or_bin"))
    else:
        grouped = df.where(F.col(target).isNotNull()).groupBy(F.col(target).cast("string").alias("class_or_bin"))
    return grouped.agg(F.count(F.lit(1)).alias("count")).select(
        "class_or_bin", "count", two_decimals(percent(F.col("count"), total.scalar())).alias("percentage"),
        F.lit(distinct <= max_classes).alias("is_classification"),
    )


def cross_tab(df: DataFrame, rows: str, columns: str, values: Sequence | None = None) -> DataFrame:
    """Counts ``n_<value>`` and row shares ``share_<value>`` of one column within another."""
    if values is None:
        found = small_rows(df.select(columns).where(F.col(columns).isNotNull()).distinct(), f"values of {columns}")
        values = sorted(r[columns] for r in found)
    kept = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    counted = kept.groupBy(rows).agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.col(columns) == F.lit(v)).alias(f"n_{v}") for v in values],
    )
    return counted.select(
        rows, *[F.col(f"`n_{v}`") for v in values],
        *[(F.col(f"`n_{v}`").cast("double") / F.col("_all").cast("double")).alias(f"share_{v}") for v in values],
    )


def compare_numeric_distribution(before: DataFrame, after: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Histograms of a column before and after a step, on the bins of the first table."""
    low, high = before.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    spans = {column: (low, high)}
    old = histogram(before, [column], bins, spans).select("bin", F.col("n").alias("n_before"))
    new = histogram(after, [column], bins, spans).select("bin", F.col("n").alias("n_after"))
    zero = F.lit(0).cast("bigint")
    return old.join(new, "bin", "full_outer").select(
        "bin", F.coalesce("n_before", zero).alias("n_before"), F.coalesce("n_after", zero).alias("n_after")
    )


def compare_category_distribution(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Category shares of a column before and after a step."""
    old = category_shares(before, [column]).select(
        "category", F.col("n").alias("n_before"), F.col("percentage").alias("pct_before"))
    new = category_shares(after, [column]).select(
        "category", F.col("n").alias("n_after"), F.col("percentage").alias("pct_after"))
    zero = F.lit(0).cast("bigint")
    return old.join(new, "category", "full_outer").select(
        "category",
        F.coalesce("n_before", zero).alias("n_before"), F.coalesce("pct_before", F.lit(0.0)).alias("pct_before"),
        F.coalesce("n_after", zero).alias("n_after"), F.coalesce("pct_after", F.lit(0.0)).alias("pct_after"),
    )


def numeric_columns_except(df: DataFrame, *excluded: str) -> list[str]:
    return [c for c in get_numerical_features(df) if c not in excluded]
