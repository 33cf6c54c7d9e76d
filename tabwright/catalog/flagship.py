"""The flagship query: from dirty amounts to a summary per category."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.registry import query, r6
from tabwright.functions.types import rounded
from tabwright.operators import blocks, cleaning
from tabwright.operators.constraints import set_constraints_for_numeric_features
from tabwright.operators.encode import FeatureEncoder
from tabwright.operators.profile import numeric_by_class
from tabwright.plans.curation import CurationSpec, curate


@query("flagship_clean_events", f"""
WITH parsed AS (
  SELECT row_id, blk, cat, CAST(CASE WHEN regexp_matches(raw, '[0-9]') THEN replace(replace(raw, '_', ''), '$', '') END AS DOUBLE) AS amount
  FROM v_ev),
kept AS (SELECT row_id, blk, cat, CASE WHEN amount < 0 OR amount > 500 THEN NULL ELSE amount END AS amount FROM parsed),
filled AS (SELECT row_id, cat, coalesce(amount, median(amount) OVER (PARTITION BY blk)) AS amount FROM kept),
shares AS (SELECT cat AS c, CAST(count(*) AS DOUBLE) / CAST((SELECT count(cat) FROM v_ev) AS DOUBLE) AS share FROM v_ev GROUP BY cat)
SELECT {r6('share')} AS cat, count(amount) AS count, {r6('avg(amount)')} AS mean, {r6('stddev_samp(amount)')} AS std,
       min(amount) AS min, max(amount) AS max
FROM filled JOIN shares ON cat = c GROUP BY share
""")
def clean_events_summary(t):
    rows = t.v_ev.select("row_id", "cat", F.col("raw").alias("amount"))
    rows = cleaning.convert_non_numeric_strings_to_nan(rows, ["amount"])
    rows = cleaning.remove_characters(rows, ["amount"], ["_", "$"])
    rows = cleaning.convert_to_numeric(rows, ["amount"])
    rows = set_constraints_for_numeric_features(rows, "amount", {"amount": {"min": 0, "max": 500, "integer": False}})
    rows, _ = blocks.impute_missing_with_value_per_pattern(rows, "amount", 8, "median", position_col="row_id")
    rows = FeatureEncoder({"cat": "frequency"}).fit(rows).transform(rows)
    return numeric_by_class(rows, ["amount"], "cat").select(
        rounded(F.col("cat")).alias("cat"), "count", rounded(F.col("mean")).alias("mean"),
        rounded(F.col("std")).alias("std"), "min", "max",
    )


@query("curated_events", f"""
WITH d AS (SELECT row_id, v_n, coalesce(cat_n, 'Unknown') AS cat_n, CAST(CASE WHEN regexp_matches(raw, '[0-9]') THEN replace(replace(raw, '_', ''), '$', '') END AS DOUBLE) AS raw FROM v_ev),
c AS (SELECT row_id, CASE WHEN v_n > 200 THEN NULL ELSE v_n END AS v_n, cat_n, CASE WHEN raw < 0 OR raw > 150 THEN NULL ELSE raw END AS raw FROM d)
SELECT row_id, {r6('v_n')} AS v_n, cat_n, {r6('raw')} AS raw FROM c""")
def curated_events(t):
    spec = CurationSpec(
        id_col="row_id", drop=["blk", "pos", "user_id", "cat", "v"], dirty_numbers=["raw"],
        constraints={"raw": {"min": 0, "max": 150, "integer": False}, "v_n": {"min": None, "max": 200, "integer": False}},
        category_fills={"cat_n": "Unknown"},
    )
    curated, _ = curate(t.v_ev, spec)
    return curated.withColumns({"v_n": rounded(F.col("v_n")), "raw": rounded(F.col("raw"))})
