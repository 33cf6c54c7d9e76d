"""Correlation queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tabwright.catalog.registry import query, r6
from tabwright.functions.state import settle
from tabwright.functions.types import rounded
from tabwright.operators import correlate

COLUMNS = ("x1", "x2", "x3", "x4", "x5", "pred", "label")
# x5 nearly repeats x2, so that there is something collinear to find
WIDE = "SELECT row_id, x1, x2, x3, x4, x2 * 2 + CAST(row_id % 7 AS DOUBLE) * 6 AS x5, pred, label FROM v_feat"

_PAIRS = "pairs AS (" + " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS pair_no, '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM wide"
    for i, (a, b) in enumerate(combinations(COLUMNS, 2))) + ")"
_WITH = f"WITH wide AS ({WIDE}), {_PAIRS}, tc AS (SELECT a AS feature, r FROM pairs WHERE b = 'label')"


def wide(t):
    return t.v_feat.withColumn("x5", F.col("x2") * 2 + (F.col("row_id") % 7).cast("double") * 6)


def pairs(t):
    return settle(correlate.correlation_pairs(wide(t), COLUMNS))


@query("k1_correlation_matrix", f"{_WITH} SELECT pair_no, a, b, {r6('r')} AS r FROM pairs")
def matrix(t):
    return pairs(t).withColumn("r", rounded(F.col("r")))


@query("k2_target_buckets", f"""{_WITH}
SELECT feature, {r6('r')} AS r, CASE WHEN r > 0.5 THEN 'strong positive' WHEN r > 0.3 THEN 'moderate positive' WHEN r > 0.1 THEN 'weak positive'
  WHEN r < -0.5 THEN 'strong negative' WHEN r < -0.3 THEN 'moderate negative' WHEN r < -0.1 THEN 'weak negative' ELSE 'none' END AS bucket FROM tc""")
def buckets(t):
    return correlate.target_correlation_buckets(pairs(t), "label").withColumn("r", rounded(F.col("r")))


@query("k3_multicollinear_pairs", f"""{_WITH}
SELECT a, b, {r6('p.r')} AS r, {r6('abs(i.r)')} AS target_corr_a, {r6('abs(j.r)')} AS target_corr_b,
  CASE WHEN abs(i.r) >= abs(j.r) THEN a ELSE b END AS keep, CASE WHEN abs(i.r) >= abs(j.r) THEN b ELSE a END AS drop
FROM pairs p JOIN tc i ON i.feature = a JOIN tc j ON j.feature = b WHERE abs(p.r) > 0.7""")
def multicollinear(t):
    out = correlate.multicollinear_pairs(pairs(t), "label")
    return out.withColumns({c: rounded(F.col(c)) for c in ("r", "target_corr_a", "target_corr_b")})


@query("k4_feature_clusters")
def clusters(t):
    return correlate.feature_clusters(pairs(t), "label")


@query("k4_cluster_summary")
def cluster_summary(t):
    return correlate.cluster_summary(pairs(t), "label")


@query("k5_isolated_features", f"""{_WITH},
both_ways AS (SELECT a AS f, r FROM pairs WHERE b <> 'label' UNION ALL SELECT b, r FROM pairs WHERE b <> 'label'),
widest AS (SELECT f, max(abs(r)) AS m FROM both_ways GROUP BY f)
SELECT feature, {r6('m')} AS max_corr, {r6('r')} AS target_corr, CASE WHEN abs(r) < 0.3 THEN 'investigate or drop' ELSE 'keep' END AS advice
FROM widest JOIN tc ON f = feature WHERE m < 0.3""")
def isolated(t):
    out = correlate.isolated_features(pairs(t), "label")
    return out.withColumns({c: rounded(F.col(c)) for c in ("max_corr", "target_corr")})


@query("k6_select_by_correlation", f"{_WITH} SELECT feature, {r6('r')} AS r FROM tc WHERE abs(r) > 0.05")
def select(t):
    return correlate.select_by_correlation(pairs(t), "label").withColumn("r", rounded(F.col("r")))
