"""Profiling reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.registry import dbl, query, r6
from tabwright.functions.types import rounded
from tabwright.operators import profile
from tabwright.operators.impute import impute_missing_values_for_categorical_features
from tabwright.operators.outliers import OutlierHandler

_GAPPY = ("cat", "cat_n", "v_n", "raw")
_DTYPES = {"cat": "string", "cat_n": "string", "v_n": "double", "raw": "string"}
_XS = ("x1", "x2", "x3", "x4")


def r6_all(frame, *columns):
    return frame.withColumns({c: rounded(F.col(c)) for c in columns})


def two_decimals(expression):
    return f"(round_even(({expression}) * CAST(100 AS DOUBLE), 0) / CAST(100 AS DOUBLE))"


def _missing(c, digits=None):
    share = f"{dbl(f'count_if({c} IS NULL)')} / {dbl('count(*)')} * 100"
    share = two_decimals(share) if digits else r6(share)
    return (f"SELECT '{c}' AS feature, CAST(count_if({c} IS NULL) AS BIGINT) AS missing_count, {share} AS missing_percentage, "
            f"'{_DTYPES[c]}' AS dtype FROM v_ev")


@query("a1_missing_values", "SELECT * FROM (" + " UNION ALL ".join(_missing(c, 2) for c in _GAPPY) + ") u WHERE missing_count > 0")
def missing_values(t):
    return profile.analyze_missing_values(t.v_ev.select(*_GAPPY))


@query("a2_missing_share", " UNION ALL ".join(_missing(c) for c in _GAPPY))
def missing_share(t):
    return r6_all(profile.missing_share(t.v_ev.select(*_GAPPY)), "missing_percentage")


@query("a3_unique_categories", """
WITH vals AS (SELECT DISTINCT 'p_name' AS feature, p_name AS value FROM part UNION SELECT DISTINCT 'p_type', p_type FROM part),
ranked AS (SELECT feature, value, count(*) OVER (PARTITION BY feature) AS n_unique,
                  row_number() OVER (PARTITION BY feature ORDER BY value) AS rn FROM vals)
SELECT feature, n_unique, CAST(rn AS INTEGER) AS value_rank, value FROM ranked WHERE n_unique <= 35 OR rn <= 10
""")
def unique_categories(t):
    return profile.unique_categories(t.part, ["p_name", "p_type"])


@query("a4_category_proportions", f"""
WITH cells AS (SELECT 'cat_n' AS feature, coalesce(cat_n, 'Missing') AS category FROM v_ev
               UNION ALL SELECT 'raw', coalesce(raw, 'Missing') FROM v_ev),
counts AS (SELECT feature, category, count(*) AS n FROM cells GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, category) AS rn FROM counts)
SELECT feature, CAST(rn AS INTEGER) AS rank, category, n, {r6('n / (SELECT count(*) FROM v_ev)')} AS proportion FROM ranked WHERE rn <= 10
""")
def proportions(t):
    return r6_all(profile.proportion_of_unique_categories(t.v_ev, ["cat_n", "raw"]), "proportion")


@query("a5_top_n_categories", f"""
WITH counts AS (SELECT coalesce(items, 'Missing') AS category, count(*) AS n FROM v_multi GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY n DESC, category) AS rn FROM counts),
share AS (SELECT *, {dbl('n')} / (SELECT count(*) FROM v_multi) * 100 AS p FROM ranked WHERE rn <= 35)
SELECT CAST(rn AS INTEGER) AS rank, category, n AS count, {r6('p')} AS percentage,
       {r6('sum(p) OVER (ORDER BY rn)')} AS cumulative_percentage FROM share
""")
def top_n(t):
    return r6_all(profile.top_n_categories(t.v_multi, "items", 35), "percentage", "cumulative_percentage")


@query("a6_cardinality", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_unique FROM part" for c in ("p_name", "p_brand", "p_type", "p_size")))
def cardinality(t):
    return profile.cardinality(t.part, ["p_name", "p_brand", "p_type", "p_size"])


_DESCRIBE = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, count({c}) AS count, {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std, {dbl(f'min({c})')} AS min,
       {r6(f'quantile_cont({c}, 0.25)')} AS q25, {r6(f'quantile_cont({c}, 0.5)')} AS q50, {r6(f'quantile_cont({c}, 0.75)')} AS q75,
       {dbl(f'max({c})')} AS max FROM v_feat""" for c in _XS)


@query("a7_describe", _DESCRIBE)
def describe(t):
    return r6_all(profile.describe_numeric(t.v_feat, _XS), "mean", "std", "q25", "q50", "q75")


@query("a7_describe_bracketed", _DESCRIBE)
def describe_bracketed(t):
    """The way quartiles are found on groups too large for one task."""
    return r6_all(profile.describe_numeric(t.v_feat, _XS, direct_rows=2000), "mean", "std", "q25", "q50", "q75")


@query("a8_class_distribution", f"""
SELECT label, count(*) AS count, {r6(f"{dbl('count(*)')} / (SELECT count(*) FROM v_feat) * 100")} AS percentage FROM v_feat GROUP BY label
""")
def class_distribution(t):
    return r6_all(profile.class_distribution(t.v_feat, "label"), "percentage")


def _moments(c):
    return (f"count({c}) AS count, {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std, "
            f"{dbl(f'min({c})')} AS min, {dbl(f'max({c})')} AS max")


@query("a9_numeric_by_class", " UNION ALL ".join(
    f"SELECT label, '{c}' AS feature, {_moments(c)} FROM v_feat GROUP BY label" for c in _XS))
def numeric_by_class(t):
    return r6_all(profile.numeric_by_class(t.v_feat, _XS, "label"), "mean", "std")


@query("a10_target_by_category", f"""
SELECT coalesce(cat_n, 'Missing') AS category, {_moments('v')},
       {two_decimals(f"{dbl('count(*)')} / (SELECT count(*) FROM v_ev) * 100")} AS percentage FROM v_ev GROUP BY 1
""")
def target_by_category(t):
    return r6_all(profile.target_by_category(t.v_ev, "cat_n", "v"), "mean", "std")


@query("a11_target_correlation", f"SELECT 'v_n' AS feature, 'user_id' AS target, {r6('corr(v_n, user_id)')} AS r FROM v_ev")
def correlation(t):
    return r6_all(profile.correlation(t.v_ev, "v_n", "user_id"), "r")


@query("a12_category_shares", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, coalesce({c}, 'Missing') AS category, count(*) AS n,
       {r6(f"{dbl('count(*)')} / (SELECT count(*) FROM v_ev) * 100")} AS percentage FROM v_ev GROUP BY 2""" for c in ("cat", "cat_n")))
def category_shares(t):
    return r6_all(profile.category_shares(t.v_ev, ["cat", "cat_n"]), "percentage")


def _hist(c, table, bins):
    return f"""
SELECT '{c}' AS feature, CAST(bin AS INTEGER) AS bin, {r6(f'lo + (hi - lo) / {bins} * (bin - 1)')} AS bin_low,
       {r6(f'lo + (hi - lo) / {bins} * bin')} AS bin_high, count(*) AS n
FROM (SELECT lo, hi, least(floor(({c} - lo) / (hi - lo) * CAST({bins} AS DOUBLE)) + 1, {bins}) AS bin
      FROM {table}, (SELECT min({c}) AS lo, max({c}) AS hi FROM {table}) e WHERE {c} IS NOT NULL) b GROUP BY bin, lo, hi"""


@query("a13_histogram", " UNION ALL ".join(_hist(c, "v_feat", 30) for c in ("x1", "x3")))
def histogram(t):
    return r6_all(profile.histogram(t.v_feat, ["x1", "x3"], 30), "bin_low", "bin_high")


def _box(c, by=None):
    keys = f"{by}, " if by else ""
    on = f"v_feat.{by} = q.{by}" if by else "true"
    inside = f"{c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return f"""
SELECT {f'q.{by}, ' if by else ''}'{c}' AS feature, min(CASE WHEN {inside} THEN {c} END) AS whisker_low, {r6('q1')} AS q1, {r6('q2')} AS median,
  {r6('q3')} AS q3, max(CASE WHEN {inside} THEN {c} END) AS whisker_high, CAST(count_if(NOT ({inside})) AS BIGINT) AS fliers
FROM v_feat JOIN (SELECT {keys}quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3
      FROM v_feat {f'GROUP BY {by}' if by else ''}) q ON {on} GROUP BY {f'q.{by}, ' if by else ''}q1, q2, q3"""


@query("a14_box_plot", " UNION ALL ".join(_box(c) for c in ("x1", "x4")))
def box_plot(t):
    return r6_all(profile.box_plot(t.v_feat, ["x1", "x4"]), "q1", "median", "q3")


@query("a14_box_plot_by_class", " UNION ALL ".join(_box(c, "label") for c in ("x1", "x4")))
def box_plot_by_class(t):
    return r6_all(profile.box_plot(t.v_feat, ["x1", "x4"], by="label"), "q1", "median", "q3")


@query("a14_box_plot_bracketed", " UNION ALL ".join(_box(c, "label") for c in ("x1", "x4")))
def box_plot_bracketed(t):
    return r6_all(profile.box_plot(t.v_feat, ["x1", "x4"], by="label", direct_rows=2000), "q1", "median", "q3")


@query("a15_linear_fit", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r6(f'regr_slope(label, {c})')} AS slope, {r6(f'regr_intercept(label, {c})')} AS intercept, "
    f"{r6(f'regr_r2(label, {c})')} AS r2 FROM v_feat" for c in _XS))
def linear_fit(t):
    return r6_all(profile.linear_fit(t.v_feat, _XS, "label"), "slope", "intercept", "r2")


@query("a16_class_imbalance", f"""
WITH sizes AS (SELECT label, count(*) AS n FROM v_feat GROUP BY label),
one AS (SELECT count(*) AS n_classes, max(n) AS largest, min(n) AS smallest, {dbl('max(n)')} / {dbl('min(n)')} AS ratio FROM sizes)
SELECT n_classes, largest, smallest, {r6('ratio')} AS imbalance_ratio,
  CASE WHEN ratio > 50 THEN 'Extreme imbalance' WHEN ratio > 10 THEN 'High imbalance' WHEN ratio > 3 THEN 'Moderate imbalance' ELSE 'Relatively balanced' END AS level,
  CASE WHEN ratio > 10 THEN 'resample, weight classes, use F1 or AUC' WHEN ratio > 3 THEN 'weight classes, use F1 or AUC' ELSE 'standard modelling' END AS advice
FROM one""")
def imbalance(t):
    return r6_all(profile.class_imbalance(t.v_feat, "label"), "imbalance_ratio")


@query("a17_target_classes", f"""
SELECT CAST(label AS VARCHAR) AS class_or_bin, count(*) AS count,
       {two_decimals(f"{dbl('count(*)')} / (SELECT count(*) FROM v_feat) * 100")} AS percentage, true AS is_classification FROM v_feat GROUP BY label
""")
def target_classes(t):
    return profile.target_profile(t.v_feat, "label")


@query("a17_target_bins", f"""
WITH e AS (SELECT min(x3) AS lo, (max(x3) - min(x3)) / 5 AS w FROM v_feat)
SELECT CAST(greatest(1, least(5, CAST(ceil((x3 - lo) / w) AS INTEGER))) AS VARCHAR) AS class_or_bin, count(*) AS count,
       {two_decimals(f"{dbl('count(*)')} / (SELECT count(*) FROM v_feat) * 100")} AS percentage, false AS is_classification FROM v_feat, e GROUP BY 1
""")
def target_bins(t):
    return profile.target_profile(t.v_feat, "x3")


_PREDS = (0, 1, 2, 3)


@query("a18_cross_tab", "SELECT cat, " + ", ".join(f"CAST(count_if(pred = {p}) AS BIGINT) AS n_{p}" for p in _PREDS) + ", "
       + ", ".join(r6(f"count_if(pred = {p}) / {dbl('count(*)')}") + f" AS share_{p}" for p in _PREDS)
       + " FROM v_feat GROUP BY cat")
def cross_tab(t):
    return r6_all(profile.cross_tab(t.v_feat, "cat", "pred"), *[f"share_{p}" for p in _PREDS])


@query("a19_compare_numeric", """
WITH m AS (SELECT avg(x1) - 3 * stddev_samp(x1) AS lo3, avg(x1) + 3 * stddev_samp(x1) AS hi3, min(x1) AS lo, max(x1) AS hi FROM v_feat),
b AS (SELECT CAST(least(floor((x1 - lo) / (hi - lo) * CAST(30 AS DOUBLE)) + 1, 30) AS INTEGER) AS bin, count(*) AS n FROM v_feat, m GROUP BY 1),
a AS (SELECT CAST(least(floor((least(greatest(x1, lo3), hi3) - lo) / (hi - lo) * CAST(30 AS DOUBLE)) + 1, 30) AS INTEGER) AS bin, count(*) AS n FROM v_feat, m GROUP BY 1)
SELECT coalesce(b.bin, a.bin) AS bin, coalesce(b.n, 0) AS n_before, coalesce(a.n, 0) AS n_after FROM b FULL JOIN a ON b.bin = a.bin
""")
def compare_numeric(t):
    rows = t.v_feat.select("row_id", "x1")
    clipped = OutlierHandler("clip", 3.0, columns=["x1"]).fit(rows).transform(rows)
    return profile.compare_numeric_distribution(rows, clipped, "x1", 30)


@query("a19_compare_categorical", f"""
WITH total AS (SELECT {dbl('count(*)')} AS c FROM v_ev),
b AS (SELECT coalesce(cat_n, 'Missing') AS category, count(*) AS n FROM v_ev GROUP BY 1),
a AS (SELECT coalesce(cat_n, 'Unknown') AS category, count(*) AS n FROM v_ev GROUP BY 1)
SELECT coalesce(b.category, a.category) AS category, coalesce(b.n, 0) AS n_before, {r6('coalesce(b.n, 0) / c * 100')} AS pct_before,
       coalesce(a.n, 0) AS n_after, {r6('coalesce(a.n, 0) / c * 100')} AS pct_after
FROM b FULL JOIN a ON b.category = a.category, total
""")
def compare_categorical(t):
    filled = impute_missing_values_for_categorical_features(t.v_ev, ["cat_n"], {"cat_n": "unknown_category"})
    return r6_all(profile.compare_category_distribution(t.v_ev, filled, "cat_n"), "pct_before", "pct_after")
