"""Text repair and numeric constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.basics import LIST_MEMBERS, list_members
from tabwright.catalog.registry import dbl, query, r6
from tabwright.functions.state import small_rows
from tabwright.functions.text import DURATION_PATTERN, LIST_SEPARATOR, NUMBER_PATTERN, number_or_null
from tabwright.functions.types import rounded
from tabwright.operators import cleaning, constraints, outliers

_BAD_CELLS = f"""
cells AS (SELECT row_id, 'raw' AS column_name, raw AS value FROM v_ev UNION ALL SELECT row_id, 'cat_n', cat_n FROM v_ev),
bad AS (SELECT column_name, value FROM cells WHERE value IS NOT NULL AND NOT regexp_matches(value, '{NUMBER_PATTERN}')),
tokens AS (SELECT DISTINCT column_name, unnest(CASE WHEN regexp_matches(value, '[0-9]')
             THEN regexp_extract_all(value, '([^0-9.\\-])', 1) ELSE [value] END) AS token FROM bad)
"""


@query("c1_non_numeric_to_null", "SELECT row_id, CASE WHEN regexp_matches(raw, '[0-9]') THEN raw END AS raw FROM v_ev")
def non_numeric(t):
    return cleaning.convert_non_numeric_strings_to_nan(t.v_ev.select("row_id", "raw"), ["raw"])


@query("c2_problem_characters", f"WITH {_BAD_CELLS} SELECT column_name, token FROM tokens")
def problem_characters(t):
    return cleaning.identify_problematic_characters(t.v_ev, ["raw", "cat_n"])


@query("c3_problem_report", f"""WITH {_BAD_CELLS},
hits AS (SELECT c.column_name, c.value, c.row_id FROM cells c
         WHERE c.value IS NOT NULL AND EXISTS (SELECT 1 FROM tokens k WHERE contains(c.value, k.token))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY row_id) AS rn FROM hits)
SELECT column_name, count(*) AS problem_count,
       string_agg(value, '|' ORDER BY rn) FILTER (WHERE rn <= 3) AS samples
FROM ranked GROUP BY column_name""")
def problem_report(t):
    columns = ["raw", "cat_n"]
    tokens = small_rows(cleaning.identify_problematic_characters(t.v_ev, columns), "problem characters")
    report = cleaning.problem_value_report(t.v_ev, columns, [r["token"] for r in tokens], "row_id")
    return report.withColumn("samples", F.concat_ws("|", "samples"))


@query("c4_remove_characters", "SELECT row_id, replace(replace(raw, '_', ''), '$', '') AS raw FROM v_ev")
def remove_characters(t):
    return cleaning.remove_characters(t.v_ev.select("row_id", "raw"), ["raw"], "_$")


@query("c5_convert_to_numeric", """
SELECT row_id, CAST(CASE WHEN regexp_matches(raw, '[0-9]') THEN replace(replace(raw, '_', ''), '$', '') END AS DOUBLE) AS raw FROM v_ev
""")
def to_numeric(t):
    text = cleaning.convert_non_numeric_strings_to_nan(t.v_ev.select("row_id", "raw"), ["raw"])
    return cleaning.convert_to_numeric(cleaning.remove_characters(text, ["raw"], ["_", "$"]), ["raw"])


@query("c6_lenient_numeric", f"""
SELECT row_id, CASE WHEN regexp_matches(raw, '{NUMBER_PATTERN}') THEN TRY_CAST(raw AS DOUBLE) END AS number FROM v_ev
""")
def lenient_numeric(t):
    return t.v_ev.select("row_id", number_or_null(F.col("raw")).alias("number"))


@query("c7_clean_with_regex", "SELECT row_id, CASE WHEN regexp_matches(raw, '^(?:[0-9])') THEN raw END AS raw FROM v_ev")
def clean_regex(t):
    return cleaning.clean_column_with_regex(t.v_ev.select("row_id", "raw"), "raw", "[0-9]")


@query("c7_regex_report", """
WITH bad AS (SELECT row_id, raw, row_number() OVER (ORDER BY row_id) AS rn FROM v_ev
             WHERE raw IS NOT NULL AND NOT regexp_matches(raw, '^(?:[0-9])'))
SELECT 'raw' AS column_name, count(*) AS replaced, string_agg(raw, '|' ORDER BY rn) FILTER (WHERE rn <= 5) AS samples FROM bad
""")
def clean_regex_report(t):
    report = cleaning.regex_clean_report(t.v_ev, "raw", "[0-9]", "row_id")
    return report.withColumn("samples", F.concat_ws("|", "samples"))


@query("c8_space_before_word", r"SELECT row_id, regexp_replace(street, '(\w+)(Street)', '\1 \2', 'g') AS street FROM v_text")
def space_before(t):
    return cleaning.add_space_before_word(t.v_text.select("row_id", "street"), "street", "Street")


@query("c9_parse_duration", f"""
SELECT row_id, {r6(f"CASE WHEN regexp_matches(hist, '(?i){DURATION_PATTERN}') THEN CAST(regexp_extract(hist, '(?i){DURATION_PATTERN}', 1) AS DOUBLE) + CAST(regexp_extract(hist, '(?i){DURATION_PATTERN}', 2) AS DOUBLE) / 12 END")} AS years
FROM v_text
""")
def parse_duration(t):
    parsed = cleaning.parse_time_period(t.v_text, "hist", "years")
    return parsed.select("row_id", rounded(F.col("years")).alias("years"))


@query("c11_list_values", rf"""
WITH parts AS (SELECT row_id, unnest(list_distinct(list_filter(list_transform(
        regexp_split_to_array(items, '{LIST_SEPARATOR}'), lambda x: trim(x)), lambda x: x <> ''))) AS value FROM v_multi)
SELECT value, count(*) AS n_rows FROM parts GROUP BY value
""")
def list_values(t):
    return cleaning.get_unique_values_and_counts(t.v_multi, "items")


@query("c12_multi_hot", f"""
SELECT row_id, 'Has_' || replace(value, ' ', '_') AS flag, CAST(contains(coalesce(items, ''), value) AS INTEGER) AS value
FROM v_multi CROSS JOIN ({LIST_MEMBERS}) m
""")
def multi_hot(t):
    return cleaning.binary_feature_rows(t.v_multi, "items", list_members(t), ["row_id"])


@query("c12_flag_totals", f"""
SELECT 'Has_' || replace(value, ' ', '_') AS flag, CAST(count_if(contains(items, value)) AS BIGINT) AS total
FROM v_multi CROSS JOIN ({LIST_MEMBERS}) m GROUP BY value
""")
def flag_totals(t):
    flags = cleaning.binary_feature_rows(t.v_multi, "items", list_members(t), [])
    return flags.groupBy("flag").agg(F.sum("value").cast("bigint").alias("total"))


@query("c13_occurrence_count", f"""
WITH p AS (SELECT string_agg(value, '|' ORDER BY length(value) DESC, value) AS pattern FROM ({LIST_MEMBERS}) m)
SELECT row_id, CAST(len(regexp_extract_all(items, pattern)) AS INTEGER) AS "Loan_Count" FROM v_multi CROSS JOIN p
""")
def occurrence_count(t):
    flagged = cleaning.transform_to_binary_features(t.v_multi, "items", list_members(t))
    return flagged.select("row_id", "Loan_Count")


RULES = {
    "x1": {"min": 1000, "max": 400000, "integer": False},
    "x2": {"min": 5, "max": 90, "integer": True},
    "x3": {"min": 0, "max": None, "integer": False},
    "x4": {"min": None, "max": None, "integer": True},
}


@query("n1_range_constraints", """
SELECT row_id, CASE WHEN x1 < 1000 OR x1 > 400000 THEN NULL ELSE x1 END AS x1, CASE WHEN x3 < 0 THEN NULL ELSE x3 END AS x3 FROM v_feat
""")
def range_constraints(t):
    rows = t.v_feat.select("row_id", "x1", "x3")
    return constraints.set_constraints_for_numeric_features(rows, ["x1", "x3"], RULES)


@query("n2_integer_constraints", """
SELECT row_id, CAST(CASE WHEN x2 < 5 OR x2 > 90 THEN NULL ELSE x2 END AS BIGINT) AS x2, CAST(x4 AS BIGINT) AS x4 FROM v_feat
""")
def integer_constraints(t):
    rows = t.v_feat.select("row_id", "x2", "x4")
    return constraints.set_constraints_for_numeric_features(rows, ["x2", "x4"], RULES)


@query("n4_violation_counts", """
SELECT 'x1' AS column_name, CAST(count_if(x1 < 1000) AS BIGINT) AS below_min, CAST(count_if(x1 > 400000) AS BIGINT) AS above_max FROM v_feat
UNION ALL SELECT 'x2', CAST(count_if(x2 < 5) AS BIGINT), CAST(count_if(x2 > 90) AS BIGINT) FROM v_feat
UNION ALL SELECT 'x3', CAST(count_if(x3 < 0) AS BIGINT), CAST(count_if(false) AS BIGINT) FROM v_feat
UNION ALL SELECT 'x4', CAST(count_if(false) AS BIGINT), CAST(count_if(false) AS BIGINT) FROM v_feat
""")
def violation_counts(t):
    return constraints.constraint_violations(t.v_feat, list(RULES), RULES)


_XS = ["x1", "x2", "x3", "x4"]


@query("n5_zscore_fit", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std FROM v_feat" for c in _XS))
def zscore_fit(t):
    return outliers.z_moments(t.v_feat, _XS).select(
        "feature", rounded(F.col("mean")).alias("mean"), rounded(F.col("std")).alias("std"))


_CLIPPED = ", ".join(
    r6(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, m.{c}m - 3 * m.{c}s), m.{c}m + 3 * m.{c}s) END") + f" AS {c}"
    for c in _XS)
_MOMENTS = ", ".join(f"avg({c}) AS {c}m, stddev_samp({c}) AS {c}s" for c in _XS)


@query("n6_zscore_clip", f"WITH m AS (SELECT {_MOMENTS} FROM v_feat) SELECT row_id, {_CLIPPED} FROM v_feat, m")
def zscore_clip(t):
    rows = t.v_feat.select("row_id", *_XS)
    model = outliers.OutlierHandler("clip", 3.0, columns=_XS).fit(rows)
    return model.transform(rows).select("row_id", *[rounded(F.col(c)).alias(c) for c in _XS])


@query("n7_zscore_remove", f"WITH m AS (SELECT {_MOMENTS} FROM v_feat) SELECT row_id, x1, x2, x3, x4 FROM v_feat, m WHERE "
       + " AND ".join(f"abs(({c} - m.{c}m) / m.{c}s) <= 3" for c in _XS))
def zscore_remove(t):
    rows = t.v_feat.select("row_id", *_XS)
    return outliers.OutlierHandler("remove", 3.0, columns=_XS).fit(rows).transform(rows)


@query("n8_iqr_outliers", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, {r6('q1 - 1.5 * (q3 - q1)')} AS lower_bound, {r6('q3 + 1.5 * (q3 - q1)')} AS upper_bound, count({c}) AS n,
  CAST(count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers,
  {r6(f'{dbl(f"count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))")} / count({c}) * 100')} AS outlier_pct
FROM v_feat, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM v_feat) q GROUP BY q1, q3""" for c in _XS))
def iqr(t):
    report = outliers.iqr_outliers(t.v_feat, _XS)
    return report.select("feature", *[rounded(F.col(c)).alias(c) for c in ("lower_bound", "upper_bound")], "n", "outliers",
                         rounded(F.col("outlier_pct")).alias("outlier_pct"))
