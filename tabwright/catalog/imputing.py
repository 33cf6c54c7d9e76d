"""Imputation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.registry import query, r6
from tabwright.functions.types import rounded
from tabwright.operators import cleaning, impute

_XS = ["x2", "x3", "x4"]
_GAP = "CASE WHEN row_id % 10 = 3 THEN NULL ELSE x1 END"


def gappy(t):
    return t.v_feat.select("row_id", F.expr(_GAP).alias("x1"), *_XS, "label")


@query("i1_fill_category", "SELECT row_id, coalesce(occ, 'Unknown') AS occ, coalesce(month, '_') AS month FROM v_blk")
def fill_category(t):
    return cleaning.fill_missing_with_category(t.v_blk.select("row_id", "occ", "month"), {"occ": "Unknown", "month": "_"})


@query("i2_fill_by_method", "SELECT row_id, coalesce(occ, 'Unknown') AS occ, month FROM v_blk")
def fill_by_method(t):
    rows = t.v_blk.select("row_id", "occ", "month")
    return impute.impute_missing_values_for_categorical_features(
        rows, ["month", "occ"], {"month": "knn", "occ": "unknown_category"})


@query("i3_median_imputer", f"SELECT row_id, {r6('coalesce(v_n, (SELECT median(v_n) FROM v_ev))')} AS v_n FROM v_ev")
def median_imputer(t):
    rows = t.v_ev.select("row_id", "v_n")
    filled = impute.SimpleImputer("median", ["v_n"]).fit(rows).transform(rows)
    return filled.select("row_id", rounded(F.col("v_n")).alias("v_n"))


def _mode(c):
    return f"(SELECT {c} FROM v_blk WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query("i4_most_frequent_imputer", f"SELECT row_id, coalesce(occ, {_mode('occ')}) AS occ, coalesce(month, {_mode('month')}) AS month FROM v_blk")
def most_frequent(t):
    rows = t.v_blk.select("row_id", "occ", "month")
    return impute.SimpleImputer("most_frequent", ["occ", "month"]).fit(rows).transform(rows)


def _scaled(source):
    centre = ", ".join(f"median({c}) AS {c}d" for c in _XS)
    moments = ", ".join(f"avg(coalesce({c}, {c}d)) AS {c}m, stddev_pop(coalesce({c}, {c}d)) AS {c}s" for c in _XS)
    z = ", ".join(f"(coalesce({c}, {c}d) - {c}m) / {c}s AS z{c}" for c in _XS)
    return f"""mid AS (SELECT {centre} FROM {source}), mom AS (SELECT {moments} FROM {source}, mid),
z AS (SELECT row_id, x1, {z} FROM {source}, mid, mom)"""


_DISTANCE = "round(sqrt(" + " + ".join(f"(r.z{c} - d.z{c}) * (r.z{c} - d.z{c})" for c in _XS) + "), 9)"


def _near(k):
    return f"""near AS (SELECT r.row_id AS rid, d.x1 AS given FROM z r JOIN z d ON r.x1 IS NULL AND d.x1 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY r.row_id ORDER BY {_DISTANCE}, d.row_id) <= {k}),
fill AS (SELECT rid, avg(given) AS fill FROM near GROUP BY rid)"""


_IMPUTED = f"""
WITH g AS (SELECT row_id, {_GAP} AS x1, x2, x3, x4 FROM v_feat), {_scaled('g')}, {_near(5)}
SELECT row_id, {r6('coalesce(x1, fill)')} AS x1 FROM g LEFT JOIN fill ON row_id = rid"""


@query("i5_knn_impute_cells", _IMPUTED)
def knn_impute_cells(t):
    """With cells, chunks and blocks of the kind a large table has."""
    filled = impute.impute_knn(gappy(t), "x1", 5, id_col="row_id", feature_cols=_XS, label_col="label",
                               donors_per_pivot=250, chunk_rows=2000, block_rows=500)
    return filled.select("row_id", rounded(F.col("x1")).alias("x1"))


@query("i5_knn_impute", _IMPUTED)
def knn_impute(t):
    filled = impute.impute_knn(gappy(t), "x1", 5, id_col="row_id", feature_cols=_XS, label_col="label")
    return filled.select("row_id", rounded(F.col("x1")).alias("x1"))


_HELD = """ranked AS (SELECT row_id, row_number() OVER (ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), row_id) AS rn,
    count(*) OVER () AS n FROM {source} WHERE {column} IS NOT NULL),
held AS (SELECT row_id AS hid FROM ranked WHERE rn <= floor(n * 0.2))"""


@query("i6_holdout_mask", f"""
WITH {_HELD.format(source='v_ev', column='v_n')}
SELECT row_id, v_n, hid IS NOT NULL AS is_holdout, CASE WHEN hid IS NOT NULL THEN v_n END AS holdout_value
FROM v_ev LEFT JOIN held ON row_id = hid""")
def holdout_mask(t):
    return impute.create_holdout_mask(t.v_ev.select("row_id", "v_n"), "v_n", 0.2, id_col="row_id")


def _shift(expression):
    return r6(f"abs(((SELECT {expression.format('after')} FROM done) - (SELECT {expression.format('before')} FROM done)) / (SELECT {expression.format('before')} FROM done) * 100)")


@query("i7_evaluate_knn", f"""
WITH o AS (SELECT row_id, {_GAP} AS x1, x2, x3, x4 FROM v_feat), {_HELD.format(source='o', column='x1')},
g AS (SELECT row_id, CASE WHEN hid IS NULL THEN x1 END AS x1, x2, x3, x4 FROM o LEFT JOIN held ON row_id = hid),
{_scaled('g')}, {_near(3)},
done AS (SELECT o.row_id, o.x1 AS before, coalesce(g.x1, fill) AS after, hid FROM o JOIN g ON o.row_id = g.row_id
         LEFT JOIN fill ON o.row_id = rid LEFT JOIN held ON o.row_id = hid),
scores AS (SELECT sqrt((SELECT avg((after - before) * (after - before)) FROM done WHERE hid IS NOT NULL)) AS rmse,
  {_shift('avg({})')} AS delta_mean, {_shift('stddev_samp({})')} AS delta_std,
  {_shift('quantile_cont({}, 0.25)')} AS delta_25, {_shift('quantile_cont({}, 0.75)')} AS delta_75)
SELECT 'x1' AS column_name, {r6('rmse').replace(', 6)', ', 3)')} AS rmse, delta_mean, delta_std, delta_25, delta_75,
  round((delta_mean + delta_std + delta_25 + delta_75) / 4, 4) AS distribution_score,
  round(rmse * (1 + (delta_mean + delta_std + delta_25 + delta_75) / 400), 2) AS combined_score FROM scores""")
def evaluate_knn(t):
    scores = impute.evaluate_knn_imputation(gappy(t), "x1", 0.2, 3, id_col="row_id", feature_cols=_XS)
    return scores.select(
        "column_name", rounded(F.col("rmse"), 3).alias("rmse"),
        *[rounded(F.col(c)).alias(c) for c in ("delta_mean", "delta_std", "delta_25", "delta_75")],
        rounded(F.col("distribution_score"), 4).alias("distribution_score"),
        rounded(F.col("combined_score"), 2).alias("combined_score"),
    )


@query("i7_impute_and_report")
def impute_and_report(t):
    rows = gappy(t).withColumn("x3", F.when(F.col("row_id") % 9 != 4, F.col("x3")))
    filled, report = impute.apply_and_evaluate_knn_imputation(
        rows, ["x1", "x3"], 0.2, 3, id_col="row_id", label_col="label")
    left = filled.agg(F.count_if(F.col("x1").isNull() | F.col("x3").isNull())).scalar()
    return report.withColumn("gaps_left", left)
