"""Distribution queries."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from tabwright.catalog.registry import dbl, query, r6
from tabwright.functions.state import settle
from tabwright.functions.types import rounded
from tabwright.operators import distribution

_XS = ("x1", "x2", "x3", "x4")
_FEW = ("x3", "x4")


def _r6(frame, *columns):
    return frame.withColumns({c: rounded(F.col(c)) for c in columns})


_STATS = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, {dbl(f'count({c})')} AS n, {dbl(f'min({c})')} AS lo, {dbl(f'max({c})')} AS hi, avg({c}) AS mean, median({c}) AS mid,
  stddev_samp({c}) AS std, skewness({c}) AS sk, kurtosis({c}) AS ku FROM v_feat""" for c in _XS)


@query("q1_basic_stats", f"WITH s AS ({_STATS}) SELECT feature, lo AS min, hi AS max, {r6('mean')} AS mean, {r6('mid')} AS median, "
       f"{r6('sk')} AS skew, {r6('ku')} AS kurtosis FROM s")
def basic_stats(t):
    return _r6(distribution.basic_stats(t.v_feat, _XS), "mean", "median", "skew", "kurtosis")


# population moments from the adjusted ones
_JB = f"""s AS ({_STATS}), pop AS (SELECT *, sk * (n - 2) / sqrt(n * (n - 1)) AS g1, (ku * (n - 2) * (n - 3) / (n - 1) - 6) / (n + 1) AS g2 FROM s),
jb AS (SELECT *, n / 6 * (g1 * g1 + g2 * g2 / 4) AS stat FROM pop)"""


@query("q2_normality", f"""WITH {_JB}
SELECT feature, round(stat, 2) AS statistic, {r6('exp(-stat / 2)')} AS p_value, exp(-stat / 2) > 0.05 AS is_normal,
  CASE WHEN exp(-stat / 2) > 0.05 THEN 'approximately normal' WHEN sk > 1 THEN 'skewed to the right' WHEN sk < -1 THEN 'skewed to the left'
       ELSE 'not normal, not highly skewed' END AS shape FROM jb""")
def normality(t):
    out = distribution.normality_test(t.v_feat, _XS)
    return out.withColumns({"statistic": rounded(F.col("statistic"), 2), "p_value": rounded(F.col("p_value"))})


_POINTS = distribution.GRID_POINTS
_LAST = _POINTS - 1


def _density(view, columns):
    spans = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, min({c}) AS lo, max({c}) AS hi, (max({c}) - min({c})) / {dbl(_LAST)} AS step,
  stddev_samp({c}) * pow({dbl(f'count({c})')}, -0.2) AS h, {dbl(f'count({c})')} AS n FROM {view}""" for c in columns)
    cells = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v FROM {view} WHERE {c} IS NOT NULL" for c in columns)
    return f"""spans AS ({spans}), cells AS ({cells}),
density AS (SELECT feature, CAST(point AS INTEGER) AS point, lo + point * step AS x,
    sum(exp(((lo + point * step - v) / h) * ((lo + point * step - v) / h) * -0.5)) / (n * h * sqrt(2 * pi())) AS density
  FROM cells JOIN spans USING (feature), (SELECT unnest(generate_series(0, {_LAST})) AS point) g GROUP BY feature, point, lo, step, n, h)"""


@query("q3_kernel_density", f"WITH {_density('v_feat', _FEW)} SELECT feature, point, {r6('x')} AS x, round(density, 9) AS density FROM density")
def kernel_density(t):
    out = distribution.kernel_density(t.v_feat, _FEW)
    return out.withColumns({"x": rounded(F.col("x")), "density": rounded(F.col("density"), 9)})


_PEAKS = """heights AS (SELECT *, round(density / max(density) OVER (PARTITION BY feature), 9) AS height FROM density),
level AS (SELECT * FROM heights QUALIFY lag(height) OVER (PARTITION BY feature ORDER BY point) IS DISTINCT FROM height),
runs AS (SELECT *, lag(height) OVER w AS lh, lead(height) OVER w AS rh, lead(point) OVER w AS nx FROM level WINDOW w AS (PARTITION BY feature ORDER BY point)),
tops AS (SELECT feature, CAST(floor((point + nx - 1) / 2) AS INTEGER) AS point FROM runs WHERE lh < height AND rh < height)"""


@query("q4_density_peaks", f"""WITH {_density('v_feat', _FEW)}, {_PEAKS}
SELECT tops.feature, CAST(row_number() OVER (PARTITION BY tops.feature ORDER BY tops.point) AS INTEGER) AS peak_no, tops.point, {r6('x')} AS x
FROM tops JOIN density d ON d.feature = tops.feature AND d.point = tops.point""")
def density_peaks(t):
    return _r6(distribution.density_peaks(distribution.kernel_density(t.v_feat, _FEW)), "x")


@query("q4_multimodality", f"""WITH {_density('v_feat', _FEW)}, {_PEAKS}
SELECT feature, count(*) > 1 AS is_multimodal, CASE WHEN count(*) > 1 THEN count(*) ELSE 1 END AS num_peaks FROM tops GROUP BY feature""")
def multimodality(t):
    return distribution.multimodality(t.v_feat, _FEW)


_QQ_PROBS = [(i + 0.5) / 100 for i in range(100)]
_QQ_NORMAL = [NormalDist().inv_cdf(p) for p in _QQ_PROBS]


@query("q5_normal_qq", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, CAST(unnest(generate_series(0, 99)) AS INTEGER) AS point, unnest([{", ".join(dbl(repr(p)) for p in _QQ_PROBS)}]) AS prob,
  {r6(f'unnest([{", ".join(repr(z) for z in _QQ_NORMAL)}])')} AS theoretical, {r6(f'unnest(quantile_cont({c}, [{", ".join(map(repr, _QQ_PROBS))}]))')} AS sample
FROM v_feat""" for c in _FEW))
def normal_qq(t):
    return _r6(distribution.normal_qq(t.v_feat, _FEW), "theoretical", "sample")


def _separation(columns):
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, label, avg({c}) AS m, stddev_samp({c}) AS s FROM v_feat GROUP BY label" for c in columns)
    return f"""by_class AS ({parts}),
apart AS (SELECT a.feature, avg(abs(a.m - b.m) / sqrt((a.s * a.s + b.s * b.s) / 2)) AS d
          FROM by_class a JOIN by_class b ON a.feature = b.feature AND a.label < b.label GROUP BY a.feature)"""


_SEPARATION_NAME = """CASE WHEN d > 1.2 THEN 'Excellent separation' WHEN d > 0.8 THEN 'Good separation'
  WHEN d > 0.5 THEN 'Moderate separation' WHEN d > 0.2 THEN 'Weak separation' ELSE 'Poor separation' END"""


@query("q6_class_separation", f"WITH {_separation(_XS)} SELECT feature, {r6('d')} AS effect_size, {_SEPARATION_NAME} AS separation FROM apart")
def class_separation(t):
    return _r6(distribution.class_separation(t.v_feat, _XS, "label"), "effect_size")


@query("q7_target_relationship", " UNION ALL ".join(f"""
SELECT feature, {r6('r')} AS r, CASE WHEN abs(r) > 0.7 THEN 'Strong relationship' WHEN abs(r) > 0.4 THEN 'Moderate relationship'
  WHEN abs(r) > 0.2 THEN 'Weak relationship' ELSE 'Very weak or no linear relationship' END AS relationship
FROM (SELECT '{c}' AS feature, corr({c}, x4) AS r FROM v_feat) q""" for c in ("x1", "x2", "x3", "label")))
def relationship(t):
    return _r6(distribution.target_relationship(t.v_feat, ["x1", "x2", "x3", "label"], "x4"), "r")


def _report_sql():
    outliers = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, {dbl(f'count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))')} / count({c}) * 100 AS pct
FROM v_feat, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM v_feat) q GROUP BY q1, q3""" for c in _XS)
    return f"""s AS ({_STATS}), {_separation(_XS)}, {_density('v_feat', _XS)}, {_PEAKS}, outs AS ({outliers}),
modes AS (SELECT feature, count(*) AS k FROM tops GROUP BY feature),
rep AS (SELECT s.feature, sk, pct, coalesce(k, 1) AS k, d FROM s JOIN outs ON outs.feature = s.feature JOIN apart ON apart.feature = s.feature
        LEFT JOIN modes ON modes.feature = s.feature)"""


def _report(t):
    return settle(distribution.feature_report(t.v_feat, _XS, "label"))


@query("q8_transformation_advice", f"""WITH {_report_sql()}
SELECT feature, array_to_string(list_filter([CASE WHEN sk > 1 THEN 'log1p' WHEN sk < -1 THEN 'square' END, CASE WHEN pct > 5 THEN 'clip outliers' END,
  CASE WHEN k > 1 THEN 'bin by modes' END, CASE WHEN d < 0.2 THEN 'drop' WHEN d < 0.5 THEN 'engineer' ELSE 'keep' END], lambda x: x IS NOT NULL), ', ') AS advice
FROM rep""")
def advice(t):
    return distribution.transformation_advice(_report(t)).withColumn("advice", F.concat_ws(", ", "advice"))


@query("q9_feature_lists", f"""WITH {_report_sql()}
SELECT list_name, feature, {r6('value')} AS value FROM (
  SELECT 'good_separators' AS list_name, feature, d AS value FROM rep WHERE d > 0.5
  UNION ALL SELECT 'skewed_features', feature, sk FROM rep WHERE abs(sk) > 1
  UNION ALL SELECT 'outlier_features', feature, pct FROM rep WHERE pct > 5
  UNION ALL SELECT 'multimodal_features', feature, k FROM rep WHERE k > 1) u""")
def feature_lists(t):
    return _r6(distribution.feature_lists(_report(t)), "value")


@query("q10_choose_features", "SELECT feature, " + r6("r") + " AS r FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, label) AS r FROM v_feat" for c in (*_XS, "pred")) + ") u ORDER BY abs(r) DESC, feature LIMIT 3")
def choose_features(t):
    return _r6(distribution.ranked_by_target(t.v_feat, "label", [*_XS, "pred"], 3), "r")
