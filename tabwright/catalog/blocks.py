"""Block-pattern queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.registry import query, r6
from tabwright.functions.types import rounded
from tabwright.operators import blocks

# The months of one block in order.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August")
_MONTH_CASE = "CASE pos " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MONTHS)) + " END"


def _unique_sql(view, column):
    return f"""
WITH per AS (SELECT blk, count(DISTINCT {column}) AS nu FROM {view} GROUP BY blk),
bad AS (SELECT min(blk) AS b FROM per WHERE nu NOT IN (0, 1))
SELECT b IS NULL AS is_pattern, b AS first_bad_block,
       (SELECT CAST(nu AS INTEGER) FROM per WHERE blk = b) AS n_unique,
       (SELECT count(*) FROM per WHERE nu = 0 AND blk < coalesce(b, 9223372036854775807)) AS n_null_blocks FROM bad"""


@query("b1_unique_per_block", _unique_sql("v_blk", "occ"))
def unique_per_block(t):
    return blocks.analyze_unique_values_pattern(t.v_blk, "occ", 8, 1, position_col="row_id")


@query("b1_unique_per_block_fails", _unique_sql("v_ev", "cat"))
def unique_per_block_fails(t):
    return blocks.analyze_unique_values_pattern(t.v_ev, "cat", 8, 1, order_col="row_id")


@query("b2_ordered_sequence", f"""
WITH per AS (SELECT blk, count(month) AS n, count_if(month IS NOT NULL AND month <> {_MONTH_CASE}) AS wrong FROM v_blk GROUP BY blk),
bad AS (SELECT min(blk) AS b FROM per WHERE wrong > 0)
SELECT b IS NULL AS is_pattern, b AS first_bad_block,
       (SELECT count(*) FROM per WHERE n = 0 AND blk < coalesce(b, 9223372036854775807)) AS n_null_blocks FROM bad""")
def ordered_sequence(t):
    return blocks.analyze_ordered_values_pattern(t.v_blk, "month", 8, MONTHS, position_col="row_id")


def _incremental_sql(view, column):
    return f"""
WITH known AS (SELECT blk, pos, {column} AS v, lag({column}) OVER w AS lv, lag(pos) OVER w AS lp FROM {view} WHERE {column} IS NOT NULL
               WINDOW w AS (PARTITION BY blk ORDER BY pos)),
per AS (SELECT blk, count(*) AS n, count_if(abs((v - lv) - (pos - lp) / CAST(12 AS DOUBLE)) > 0.001) AS wrong FROM known GROUP BY blk),
every AS (SELECT DISTINCT {view}.blk, coalesce(n, 0) AS n, coalesce(wrong, 0) AS wrong FROM {view} LEFT JOIN per ON {view}.blk = per.blk),
judged AS (SELECT blk, n, CASE WHEN n = 1 THEN 'too_few_values' WHEN wrong > 0 THEN 'wrong_step' END AS reason FROM every),
bad AS (SELECT min(blk) AS b FROM judged WHERE reason IS NOT NULL)
SELECT b IS NULL AS is_pattern, b AS first_bad_block, (SELECT reason FROM judged WHERE blk = b) AS reason,
       (SELECT count(*) FROM judged WHERE n = 0 AND blk < coalesce(b, 9223372036854775807)) AS n_null_blocks FROM bad"""


@query("b3_incremental", _incremental_sql("v_blk", "age"))
def incremental(t):
    return blocks.analyze_incremental_num_values_pattern(t.v_blk, "age", 8, position_col="row_id")


@query("b3_incremental_fails", _incremental_sql("v_ev", "v_n"))
def incremental_fails(t):
    return blocks.analyze_incremental_num_values_pattern(t.v_ev, "v_n", 8, position_col="row_id")


@query("b4_fill_unique", "SELECT row_id, coalesce(occ, max(occ) OVER (PARTITION BY blk)) AS occ FROM v_blk")
def fill_unique(t):
    rows = t.v_blk.select("row_id", "occ")
    return blocks.impute_missing_with_value_per_pattern(rows, "occ", 8, "unique", position_col="row_id")[0]


@query("b4_fill_unique_refused", "SELECT row_id, cat_n FROM v_ev")
def fill_unique_refused(t):
    rows = t.v_ev.select("row_id", "cat_n")
    return blocks.impute_missing_with_value_per_pattern(rows, "cat_n", 8, "unique", position_col="row_id")[0]


@query("b4_fill_mean", f"SELECT row_id, {r6('coalesce(v_n, avg(v_n) OVER (PARTITION BY blk))')} AS v_n FROM v_ev")
def fill_mean(t):
    rows = t.v_ev.select("row_id", "v_n")
    filled, _ = blocks.impute_missing_with_value_per_pattern(rows, "v_n", 8, "mean", position_col="row_id")
    return filled.select("row_id", rounded(F.col("v_n")).alias("v_n"))


@query("b4_fill_median", f"SELECT row_id, {r6('coalesce(v_n, median(v_n) OVER (PARTITION BY blk))')} AS v_n FROM v_ev")
def fill_median(t):
    rows = t.v_ev.select("row_id", "v_n")
    filled, _ = blocks.impute_missing_with_value_per_pattern(rows, "v_n", 8, "median", position_col="row_id")
    return filled.select("row_id", rounded(F.col("v_n")).alias("v_n"))


@query("b4_fill_mode", """
WITH counts AS (SELECT blk, cat_n AS value, count(*) AS n FROM v_ev WHERE cat_n IS NOT NULL GROUP BY ALL),
best AS (SELECT blk AS b, value FROM counts QUALIFY row_number() OVER (PARTITION BY blk ORDER BY n DESC, value) = 1)
SELECT row_id, coalesce(cat_n, value) AS cat_n FROM v_ev LEFT JOIN best ON blk = b""")
def fill_mode(t):
    rows = t.v_ev.select("row_id", "cat_n")
    return blocks.impute_missing_with_value_per_pattern(rows, "cat_n", 8, "mode", position_col="row_id")[0]


@query("b4_fill_report", """
WITH per AS (SELECT blk, count(v_n) AS n FROM v_ev GROUP BY blk)
SELECT true AS imputed, CAST(NULL AS BIGINT) AS first_bad_block, CAST(count_if(n = 0) AS BIGINT) AS n_null_blocks, 'median' AS method FROM per""")
def fill_report(t):
    return blocks.impute_missing_with_value_per_pattern(t.v_ev, "v_n", 8, "median", position_col="row_id")[1]


@query("b5_fill_sequence", f"SELECT row_id, coalesce(month, {_MONTH_CASE}) AS month FROM v_blk")
def fill_sequence(t):
    rows = t.v_blk.select("row_id", "month")
    return blocks.impute_missing_with_ordered_values_per_pattern(rows, "month", 8, MONTHS, position_col="row_id")


@query("b6_fill_incremental", f"""
WITH anchored AS (SELECT row_id, pos, age,
    last_value(age IGNORE NULLS) OVER back AS lv, last_value(CASE WHEN age IS NOT NULL THEN pos END IGNORE NULLS) OVER back AS lp,
    first_value(age IGNORE NULLS) OVER fwd AS fv, first_value(CASE WHEN age IS NOT NULL THEN pos END IGNORE NULLS) OVER fwd AS fp
  FROM v_blk WINDOW back AS (PARTITION BY blk ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    fwd AS (PARTITION BY blk ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT row_id, {r6('coalesce(age, lv + (pos - lp) * (1 / CAST(12 AS DOUBLE)), fv - (fp - pos) * (1 / CAST(12 AS DOUBLE)))')} AS age FROM anchored""")
def fill_incremental(t):
    rows = t.v_blk.select("row_id", "age")
    filled = blocks.impute_missing_with_incremental_value_per_pattern(rows, "age", 8, order_col="row_id")
    return filled.select("row_id", rounded(F.col("age")).alias("age"))
